"""Removal of lines that many documents share, by range partitions and keep bitmaps."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from migratrace.llm.common import BLANKS, slices
from migratrace.session import materialize, ship_package

MIN_CHARS = 20
MIN_DOCS = 3
_UPPER_TO_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

OCCURRENCE = "hi long, lo long, doc long, fp long, pos int, n_lines int"
_ARROW = pa.schema(
    [("hi", pa.int64()), ("lo", pa.int64()), ("doc", pa.int64()), ("fp", pa.int64()), ("pos", pa.int32()), ("n_lines", pa.int32())]
)
_DECIDED, _OPEN, _SUMMARY = 0, 1, 2


def _occurrences(min_chars: int):
    """Hash, document and position of every line long enough to be compared."""

    def run(batches):
        for part in slices(batches, "text_in"):
            columns: list[list] = [[] for _ in _ARROW]
            for doc, text in zip(part.column("key_in").to_pylist(), part.column("text_in").to_pylist(), strict=True):
                if doc is None or not text or len(text) < min_chars:
                    continue
                raw = text.encode()
                fp, lines = zlib.crc32(raw), raw.translate(_UPPER_TO_LOWER).split(b"\n")
                for pos, line in enumerate(lines):
                    line = line.strip(BLANKS)
                    n = len(line)
                    if n < min_chars or (not line.isascii() and n < 4 * min_chars and len(line.decode()) < min_chars):
                        continue
                    digest = xxhash.xxh3_128_intdigest(line)
                    for column, x in zip(columns, (digest >> 64, digest & 0xFFFFFFFFFFFFFFFF, doc, fp, pos, len(lines)), strict=True):
                        column.append(x)
            if columns[0]:
                halves = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in columns[:2]]
                rest = [pa.array(c, f.type) for c, f in zip(columns[2:], list(_ARROW)[2:], strict=True)]
                yield pa.RecordBatch.from_arrays([*halves, *rest], schema=_ARROW)

    return run


def _stream(min_docs: int):
    """First occurrences of a sorted range: what is dropped, and what its neighbours have to decide.

    Rows come ordered by hash, then from the largest document down.  A run is
    the rows of one hash.  Of a run that begins in this range the first document
    keeps its lines, and from the ``min_docs``-th document on all others lose
    theirs; only the rows of the documents before that wait.  The range's first
    run may have begun in the range before, and its last may go on in the next:
    their undecided rows go out as such, with a summary of the run (documents
    counted, largest document).  Memory: one batch and the lines of
    ``min_docs`` - 2 documents.
    """
    names = ["kind", *_ARROW.names, "docs"]

    def out(kind: int, rows: list[np.ndarray], docs: int = 0):
        n = len(rows[0])
        arrays = [np.full(n, kind, np.int32), *rows, np.full(n, docs, np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=names)

    def run(batches: Iterator[pa.RecordBatch]):
        last = None  # hash and document of the row before
        count = top = 0  # documents of the open run, the largest of them
        first = True  # whether the open run is the first of the range
        waiting: list[list[np.ndarray]] = []

        def summary():
            n = np.int32(0)
            row = [np.array([x], t) for x, t in zip((last[0], last[1], top, 0, n, n), ("i8", "i8", "i8", "i8", "i4", "i4"), strict=True)]
            return out(_SUMMARY, row, count)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(_ARROW))]
            hi, lo, doc = rows[:3]
            begins = np.ones(len(hi), bool)
            begins[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
            turns = begins.copy()
            turns[1:] |= doc[1:] != doc[:-1]
            if last is not None and (hi[0], lo[0]) == last[:2]:
                begins[0], turns[0] = False, doc[0] != last[2]
            runs = np.cumsum(begins)
            seen = np.cumsum(turns)
            base = np.append(-count, seen[begins] - 1)  # documents before each run; the open run goes on from count
            nth = seen - base[runs]
            ends = np.append(np.flatnonzero(np.diff(runs)), len(runs) - 1)
            total = np.zeros(runs[-1] + 1, np.int64)
            total[0] = count
            total[runs[ends]] = nth[ends]
            closes = runs[-1] > 0  # the run that was open ends in this batch
            opening = runs == 0 if last is not None else runs == 1
            if first:
                if opening.any():
                    yield out(_OPEN, [r[opening] for r in rows])
                if last is None:
                    top = doc[0]
            of_first = opening & first
            if waiting and total[0] >= min_docs:
                for w in waiting:
                    yield out(_DECIDED, w)
                waiting = []
            lost = ~of_first & (nth > 1) & (total[runs] >= min_docs)
            if lost.any():
                yield out(_DECIDED, [r[lost] for r in rows])
            if last is not None and closes:
                if first:
                    yield summary()
                first, waiting = False, []
            elif last is None and runs[-1] > 1:
                last, count = (hi[0], lo[0], doc[0]), int(total[1])
                yield summary()
                first = False
            final = runs == runs[-1]
            if not first and total[-1] < min_docs:
                hold = final & (nth > 1)
                if hold.any():
                    waiting.append([r[hold] for r in rows])
            if begins[final].any():
                top = doc[np.flatnonzero(final)[0]]
            count = int(total[-1])
            last = (hi[-1], lo[-1], doc[-1])
        if last is not None:
            for w in waiting:
                yield out(_OPEN, w)
            yield summary()

    return run


def keep_bitmaps(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """Which lines stay, for every document that loses some: (key, fp, n_lines, n_dropped, keep).

    Lines are compared without white space at both ends and with A-Z as a-z; a
    line of at least ``min_chars`` code points that at least ``min_docs``
    different keys hold stays only in the largest key.  ``fp`` is the CRC-32 of
    the text, which tells apart rows that share a key; ``keep`` is a
    zlib-compressed bitmap, a bit per line, first line first.

    Rows (hash, document, position) are range-partitioned by 128-bit hash and
    document, so a line that a third of all documents hold spreads over as many
    ranges as it needs.  No text is shuffled.  Null texts hold no line, rows
    with a null key are neither counted nor changed, repeated keys count once
    and each of their rows loses the line.  An empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    picked = docs.select(docs[key].cast("long").alias("key_in"), docs[text].alias("text_in"))
    found = materialize(picked.mapInArrow(_occurrences(min_chars), OCCURRENCE), "lines")
    order = [F.asc("hi"), F.asc("lo"), F.desc("doc")]
    ranged = found.repartitionByRange(*order).sortWithinPartitions(*order, "fp", "pos")
    streamed = materialize(ranged.mapInArrow(_stream(min_docs), f"kind int, {OCCURRENCE}, docs long"), "dropped")
    edges = (
        streamed.where(F.col("kind") == _SUMMARY)
        .groupBy("hi", "lo")
        .agg(F.sum("docs").alias("all_docs"), F.max("doc").alias("largest"))
        .where(F.col("all_docs") >= min_docs)
    )
    # two summaries per range at most, so this side is bounded by the number of ranges, not of rows
    late = streamed.where(F.col("kind") == _OPEN).join(F.broadcast(edges), ["hi", "lo"]).where("doc <> largest")
    columns = ["doc", "fp", "pos", "n_lines"]
    lost = streamed.where(F.col("kind") == _DECIDED).select(*columns).unionByName(late.select(*columns))
    grouped = lost.groupBy("doc", "fp").agg(F.max("n_lines").alias("n_lines"), F.collect_list("pos").alias("lost"))

    def pack(batches):
        for batch in batches:
            maps, counts = [], []
            for n, gone in zip(batch.column("n_lines").to_pylist(), batch.column("lost"), strict=True):
                bits = np.ones(n, bool)
                bits[gone.values.to_numpy()] = False
                maps.append(zlib.compress(np.packbits(bits).tobytes()))
                counts.append(int(n - bits.sum()))
            arrays = [batch.column("doc"), batch.column("fp"), batch.column("n_lines"), pa.array(counts, pa.int32()), pa.array(maps, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc", "fp", "n_lines", "n_dropped", "keep"])

    packed = grouped.mapInArrow(pack, "doc long, fp long, n_lines int, n_dropped int, keep binary")
    return packed.withColumnRenamed("doc", key)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the kept lines of each text, joined by \\n; texts that lose none are unchanged."""
    taken = {c.lower() for c in docs.columns}
    keep, print_ = (next(n for n in (base + "_" * i for i in range(len(taken) + 1)) if n not in taken) for base in ("keep_map", "keep_fp"))
    small = bitmaps.select(F.col(key), F.col("fp").alias(print_), F.col("keep").alias(keep))
    marked = docs.withColumn(print_, F.crc32(docs[text].cast("binary")))
    columns = docs.columns

    def run(batches):
        for part in slices(batches, text):
            texts = part.column(text).to_pylist()
            kept = [t if m is None else _kept(t, m) for t, m in zip(texts, part.column(keep).to_pylist(), strict=True)]
            at = part.schema.get_field_index(text)
            whole = part.set_column(at, text, pa.array(kept, pa.string()))
            yield whole.select(columns)

    return marked.join(small, [key, print_], "left").select(*columns, keep).mapInArrow(run, docs.schema)


def _kept(text: str, bitmap: bytes) -> str:
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
    return "\n".join([line for line, stays in zip(lines, bits.tolist(), strict=True) if stays])


def line_report(docs: DataFrame, bitmaps: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: key, n_lines before, n_dropped, and the SHA-256 of the kept text.

    A null text is one empty line.
    """
    rows = docs.select(
        docs[key],
        F.coalesce(docs[text], F.lit("")).alias("text_in"),
    )
    counted = rows.select(key, "text_in", F.crc32(F.col("text_in").cast("binary")).alias("fp"))
    joined = counted.join(bitmaps.select(key, "fp", "n_dropped", "keep"), [key, "fp"], "left")
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        import hashlib

        for part in slices(batches, "text_in"):
            texts = part.column("text_in").to_pylist()
            kept = [t if m is None else _kept(t, m) for t, m in zip(texts, part.column("keep").to_pylist(), strict=True)]
            lines = pa.array([t.count("\n") + 1 for t in texts], pa.int64())
            dropped = part.column("n_dropped").cast(pa.int64()).fill_null(0)
            sums = pa.array([hashlib.sha256(k.encode()).hexdigest() for k in kept])
            yield pa.RecordBatch.from_arrays([part.column("key_in"), lines, dropped, sums], names=["key_in", "n_lines", "n_dropped", "kept_sha256"])

    picked = joined.select(F.col(key).alias("key_in"), "text_in", "n_dropped", "keep")
    return picked.mapInArrow(run, f"key_in {kind}, n_lines long, n_dropped long, kept_sha256 string").withColumnRenamed("key_in", key)
