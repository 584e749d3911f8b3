"""SentencePiece encoding with byte offsets into the original text, and decoding.

The character map of a model is compiled into a double-array trie; text is
normalised by its longest matching prefix, and the source position of every
normalised byte is kept, so that each piece maps to a span of original bytes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from migratrace.llm.common import SLICE_BYTES, slices
from migratrace.session import bound_batches, ship_package

SPACE = "▁"
#: Entries of the memo of encoded words that a task keeps at most; it is emptied beyond.
MEMO = 50_000
#: Characters of a text that are split into words at a time.
STRETCH = 1 << 20
_BREAK = re.compile(r"(?<=[^ ]) ")


class CharacterMap:
    """Longest-prefix replacement by a compiled character map.

    The map is: size of the trie in bytes (uint32), the trie as uint32 units,
    and the replacements, each ended by a zero byte.
    """

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self.replacements = compiled[4 + size :]
        self.memo: dict[str, tuple[int, bytes] | None] = {}

    def _match(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes taken, replacement) of the longest entry that is a prefix of data[at:]."""
        units, found = self.units, None
        node = _offset(units[0])
        for length, byte in enumerate(data[at:], 1):
            node ^= byte
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                found = length, self.replacements[start : self.replacements.index(0, start)]
        return found

    def apply(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each the original byte it came from (one more for the end)."""
        if not self.units:
            return data, np.arange(len(data) + 1)
        out, source, at = [], [], 0
        while at < len(data):
            found = self._match(data, at)
            if found is None:
                width = 1 + (data[at] >= 0xC0) + (data[at] >= 0xE0) + (data[at] >= 0xF0)
                found = width, data[at : at + width]
            out.append(found[1])
            source.extend([at] * len(found[1]))
            at += found[0]
        source.append(len(data))
        return b"".join(out), np.array(source)


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & 512) >> 6)


class PieceCodec:
    """Ids, spans and texts of one SentencePiece model, given as its serialized bytes.

    If no piece of the model goes on with a word break after another character,
    a merge can never cross a word break.  The words of a text are then encoded
    apart and remembered, which gives the ids of the whole text.
    """

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = self.spec = proto.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        self.lengths = np.array([1 if p.type == p.BYTE else len(p.piece.encode()) for p in proto.pieces])
        self.unknown = proto.trainer_spec.unk_id
        self.end = self.library.eos_id()
        self.decimal = [str(i) for i in range(len(proto.pieces))]
        lone = self.library.piece_to_id(SPACE)
        crossing = re.compile(f"[^{SPACE}]{SPACE}")
        self.by_words = (
            not spec.precompiled_charsmap
            and spec.add_dummy_prefix
            and spec.escape_whitespaces
            and not spec.remove_extra_whitespaces
            and not self.suffix
            and proto.trainer_spec.byte_fallback
            and proto.trainer_spec.model_type == proto.trainer_spec.BPE
            and lone != self.unknown
            and not any(crossing.search(p.piece) for p in proto.pieces if p.type in (p.NORMAL, p.USER_DEFINED))
        )
        self.start = {"": [lone]}
        self.memo = dict(self.start)

    def encode(self, text: str) -> list[int]:
        """The ids that the library gives for the whole text, without an end id."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text; the words of all of them are looked up together."""
        short = [t for t in texts if self._apart(t) and len(t) <= STRETCH]
        words = [_split(t) for t in short]
        found = iter([list(chain.from_iterable(x)) for x in self._of(words)])
        return [next(found) if self._apart(t) and len(t) <= STRETCH else self._long(t) for t in texts]

    def count_all(self, texts: list[str]) -> list[int]:
        short = [t for t in texts if self._apart(t) and len(t) <= STRETCH]
        found = iter([sum(map(len, x)) for x in self._of([_split(t) for t in short])])
        return [next(found) if self._apart(t) and len(t) <= STRETCH else len(self._long(t)) for t in texts]

    def _apart(self, text: str) -> bool:
        """Whether the words can be encoded one by one; a written word break could merge with others."""
        return self.by_words and text != "" and SPACE not in text

    def _long(self, text: str) -> list[int]:
        if not self._apart(text):
            return self.library.encode(text)
        ids: list[int] = []
        for words in _stretches(text):
            ids.extend(chain.from_iterable(next(self._of([words]))))
        return ids

    def _of(self, lists: list[list[str]]) -> Iterator[Iterator[list[int]]]:
        """The ids of each word of each list."""
        if len(self.memo) > MEMO:
            self.memo = dict(self.start)
        memo = self.memo
        new = [w for w in dict.fromkeys(chain.from_iterable(lists)) if w not in memo]
        if new:
            memo.update(zip(new, self.library.encode(new, num_threads=1), strict=True))
        return (map(memo.__getitem__, words) for words in lists)

    def normalise(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes with word breaks escaped, and the source byte of each (one more for the end)."""
        out, source = self.map.apply(data)
        spec, b = self.spec, np.frombuffer(out, np.uint8)
        if spec.remove_extra_whitespaces:
            blank = b == 32
            keep = ~blank | ~np.r_[True, blank[:-1]] if len(b) else blank
            last = np.flatnonzero(~blank)
            keep[last[-1] + 1 if len(last) else 0 :] = False
            b, source = b[keep], np.r_[source[:-1][keep], source[-1]]
        blank = b == 32
        width = np.where(blank, len(SPACE.encode()) if spec.escape_whitespaces else 1, 1)
        mark = SPACE if spec.escape_whitespaces else " "
        text = b.tobytes().replace(b" ", mark.encode())
        places = np.r_[np.repeat(source[:-1], width), source[-1]]
        if spec.add_dummy_prefix and len(b):
            extra = len(mark.encode())
            if self.suffix:
                text, places = text + mark.encode(), np.r_[places, np.full(extra, source[-1])]
            else:
                text, places = mark.encode() + text, np.r_[np.full(extra, places[0]), places]
        return text, places

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of every id's piece in the UTF-8 bytes of the text.

        Pieces of one replaced or escaped character share its span's begin; an
        end id and the blank put before a text are empty spans.
        """
        data = text.encode()
        normal, places = self.normalise(data)
        index = np.array(ids, np.int64)
        lengths = self.lengths[index]
        lengths[index == self.end] = 0
        at = np.r_[0, np.cumsum(lengths)]
        if self.unknown in ids and at[-1] != len(normal):
            proto = self.library.encode(text, out_type="immutable_proto")
            lengths = np.array([len(p.piece.encode()) for p in proto.pieces])
            at = np.r_[0, np.cumsum(lengths)]
            at = np.r_[at, np.full(len(ids) + 1 - len(at), at[-1])]
        if at[-1] != len(normal):
            raise ValueError(f"pieces cover {at[-1]} of {len(normal)} normalised bytes")
        bounds = places[at]
        return bounds[:-1], bounds[1:]

    def spans_all(self, texts: list[str], ids: list[list[int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The spans of each text, taken together where the map is the identity."""
        if not self.by_words:
            yield from map(self.spans, texts, ids)
            return
        data = [t.encode() for t in texts]
        b = np.frombuffer(b"".join(data), np.uint8)
        width = np.where(b == 32, len(SPACE.encode()), 1).astype(np.uint8)
        at = np.zeros(len(b) + 1, np.int64)
        np.cumsum(width, out=at[1:])
        source = np.append(np.repeat(np.arange(len(b), dtype=np.int32), width), np.int32(len(b)))
        index = np.fromiter(chain.from_iterable(ids), np.int32)
        lengths = np.where(index == self.end, 0, self.lengths[index])
        reach = np.cumsum(lengths)
        done = first = 0
        for d, own in zip(data, ids, strict=True):
            last, n = first + len(own), at[done + len(d)] - at[done]
            ends = reach[first:last] - (reach[first - 1] if first else 0)
            prefix = len(SPACE.encode()) if d else 0
            if (ends[-1] if len(ends) else 0) != n + prefix:
                raise ValueError(f"pieces cover {ends[-1:]} of {n + prefix} normalised bytes")
            ends = source[at[done] + np.maximum(ends - prefix, 0)] - done
            yield np.append(np.int32(0), ends[:-1]) if len(ends) else ends, ends
            done, first = done + len(d), last

    def digits(self, ids: list[int]) -> str:
        if len(ids) < 2:
            return "".join(self.decimal[i] for i in ids)
        return " ".join(itemgetter(*ids)(self.decimal))


def _stretches(text: str) -> Iterator[list[str]]:
    """The words of a long text, stretch by stretch; each lacks the blank that the library puts before it."""
    start = 0
    while len(text) - start > STRETCH:
        cut = _BREAK.search(text, start + STRETCH)
        if cut is None:
            break
        yield _split(text[start : cut.start()])
        start = cut.end()
    rest = text[start:]
    # the break before the rest is gone already: blanks at its start belong to its first word
    yield _split(rest)


def _split(text: str) -> list[str]:
    if "  " in text or text[:1] == " ":
        return _BREAK.split(text)
    return text.split(" ")


_CODECS: dict[str, PieceCodec] = {}


def codec_of(model: bytes) -> PieceCodec:
    """One codec per worker and model."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = PieceCodec(model)
    return _CODECS[key]


ENCODED = (
    "ids array<int>, starts array<int>, ends array<int>, decoded string, "
    "n_tokens long, covered long, ids_sha256 string, decoded_sha256 string"
)


def encode_documents(
    docs: DataFrame,
    model: bytes,
    *,
    key: str = "doc_id",
    text: str = "text",
    end: bool = True,
    outputs: Iterable[str] | None = None,
) -> DataFrame:
    """Ids, byte spans and the decoded text of every whole text of ``docs``.

    Returns ``key`` and the columns of ``ENCODED``: ids with the end id last
    (if ``end``), begin and end byte of each piece in the UTF-8 of the text,
    decode(ids), the number of ids, the number of original bytes the spans
    cover, and digests of the ids (decimal, one space between) and of the
    decoded text.  ``outputs`` names those wanted, all by default; spans are
    computed and checked all the same.

    A null text counts as empty: no ids but the end id.  Null and repeated keys
    are kept, a row each; an empty table gives no rows; other columns, whatever
    their names, are not read.  A text is never cut; a task holds one text and
    its pieces at a time.
    """
    ship_package(docs.sparkSession)
    bound_batches(docs.sparkSession)
    schema = docs.select(key).schema
    order = [c.split()[0] for c in ENCODED.split(", ")]
    wanted = [c.split() for c in ENCODED.split(", ") if outputs is None or c.split()[0] in set(outputs)]
    places = [order.index(n) for n, _ in wanted]
    arrow_key = docs.select(key).limit(0).toArrow().schema.field(0).type
    kinds = {"array<int>": pa.list_(pa.int32()), "string": pa.string(), "long": pa.int64()}
    names = [key if key not in {n for n, _ in wanted} else f"{key}_in", *(n for n, _ in wanted)]
    arrow = pa.schema([pa.field(names[0], arrow_key), *(pa.field(n, kinds[k]) for n, k in wanted)])

    def run(batches):
        codec = codec_of(model)
        for part in slices(batches, "text_in", SLICE_BYTES // 4):
            rows: list[list] = [[] for _ in wanted]
            texts = [t or "" for t in part.column("text_in").to_pylist()]
            lists = codec.encode_all(texts)
            if end:
                lists = [[*x, codec.end] for x in lists]
            decodings = codec.library.decode(lists)
            for ids, decoded, (starts, ends) in zip(lists, decodings, codec.spans_all(texts, lists), strict=True):
                before = np.append(0, np.maximum.accumulate(ends)[:-1]) if len(ids) else ends
                covered = int(np.maximum(ends - np.maximum(starts, before), 0).sum())
                sums = [
                    len(ids),
                    covered,
                    hashlib.sha256(codec.digits(ids).encode()).hexdigest(),
                    hashlib.sha256(decoded.encode()).hexdigest(),
                ]
                figures = [ids, starts, ends, decoded, *sums]
                for column, place in zip(rows, places, strict=True):
                    column.append(figures[place])
            arrays = [pa.array(c, f.type) for c, f in zip(rows, list(arrow)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("key_in"), *arrays], schema=arrow)

    kind = schema[0].dataType.simpleString()
    out = f"{names[0]} {kind}, " + ", ".join(f"{n} {k}" for n, k in wanted)
    picked = docs.select(docs[key].alias("key_in"), docs[text].alias("text_in"))
    return picked.mapInArrow(run, out).withColumnRenamed(names[0], key)


def decode_ids(frame: DataFrame, model: bytes, *, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """The text of every id list, as the library decodes it; a null list gives null."""
    ship_package(frame.sparkSession)
    kind = frame.schema[key].dataType.simpleString()

    def run(batches):
        codec = codec_of(model)
        for batch in batches:
            texts = [None if x is None else codec.library.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["key_in", "decoded"])

    picked = frame.select(frame[key].alias("key_in"), frame[ids].alias("ids_in"))
    return picked.mapInArrow(run, f"key_in {kind}, decoded string").withColumnRenamed("key_in", key)
