"""Ranked lexical search: documents grouped by which terms of an item they hold, groups searched by their best possible score."""

from __future__ import annotations

import heapq
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from migratrace.llm.common import slices
from migratrace.llm.textscan import buffers, word_hashes
from migratrace.session import materialize, ship_package

TOP = 20
#: Items and bytes of their texts that are searched for in one pass over the documents.
BLOCK_ITEMS = 2048
BLOCK_BYTES = 4 << 20
#: Documents whose bitmaps a task holds at once.
BLOCK_DOCS = 1 << 13

_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_IN_TERM = np.ones(256, bool)
_IN_TERM[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER_BYTES = _LOWER.tobytes()


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in their order, with A-Z as a-z."""
    return _TERM.findall((text or "").encode().translate(_LOWER_BYTES))


class Vocabulary:
    """The distinct terms of a block of items, found in batches of texts by hash and then compared byte by byte."""

    def __init__(self, terms: list[bytes]):
        raw = np.frombuffer(b"".join(terms), np.uint8)
        ends = np.cumsum([len(t) for t in terms], dtype=np.int64)
        starts = ends - np.array([len(t) for t in terms], np.int64)
        hashes = word_hashes(raw, starts, ends)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.raw, self.starts, self.lengths = raw, starts, ends - starts

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words of lower-cased ``data`` are terms: their positions, and the numbers of the terms."""
        hashes = word_hashes(data, starts, ends)
        first = np.searchsorted(self.hashes, hashes)
        at, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        step = 0
        left = np.arange(len(hashes))
        while len(left):
            place = first[left] + step
            left = left[place < len(self.hashes)]
            left = left[self.hashes[first[left] + step] == hashes[left]]
            term = self.order[first[left] + step]
            same = self._equal(data, starts[left], ends[left], term)
            at.append(left[same])
            found.append(term[same])
            left = left[~same]
            step += 1
        return np.concatenate(at), np.concatenate(found)

    def _equal(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, term: np.ndarray) -> np.ndarray:
        same = ends - starts == self.lengths[term]
        where = np.flatnonzero(same)
        lengths = self.lengths[term[where]]
        bounds = np.cumsum(lengths) - lengths
        within = np.arange(lengths.sum()) - np.repeat(bounds, lengths)
        differs = data[np.repeat(starts[where], lengths) + within] != self.raw[np.repeat(self.starts[term[where]], lengths) + within]
        if differs.any():
            same[where[np.repeat(np.arange(len(where)), lengths)[differs]]] = False
        return same


def _postings(vocabulary: Vocabulary):
    """Per document its number of terms, and those of the vocabulary that it holds with their counts."""

    def run(batches):
        for part in slices(batches, "text_in"):
            data, rows = buffers(part.column("text_in"))
            data = _LOWER[data]
            solid = np.zeros(len(data) + 1, bool)
            solid[:-1] = _IN_TERM[data]
            edge = np.zeros(len(data) + 1, bool)
            edge[rows] = True
            starts = np.flatnonzero(solid & (edge | ~np.append(False, solid[:-1])))
            ends = np.flatnonzero(solid[:-1] & (edge[1:] | ~solid[1:])) + 1
            words = np.searchsorted(starts, rows)
            n = np.diff(words)
            at, term = vocabulary.find(data, starts, ends)
            row = np.searchsorted(words, at, "right") - 1
            pairs, counts = np.unique(row.astype(np.int64) << 32 | term, return_counts=True)
            bounds = np.searchsorted(pairs >> 32, np.arange(len(n) + 1)).astype(np.int32)
            numbers = pa.array((pairs & 0xFFFFFFFF).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key_in"),
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(bounds, numbers),
                    pa.ListArray.from_arrays(bounds, pa.array(counts, pa.int64())),
                ],
                names=["key_in", "n", "terms", "counts"],
            )

    return run


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class MaskSearch:
    """The best documents of each item of a block, over any number of blocks of documents.

    ``items`` holds for each item the numbers of its distinct terms and their
    weights times how often the item has them.
    """

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]], top: int):
        self.items, self.top = items, top
        self.best: list[list[tuple]] = [[] for _ in items]
        self.evaluated = self.seen = 0

    def add(self, keys: list, order: np.ndarray, m: np.ndarray, rows: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> None:
        """A block of documents: key, rank of the key, m, and entries (row, term, count)."""
        by_term = np.lexsort((rows, terms))
        rows, terms, counts = rows[by_term], terms[by_term], counts[by_term]
        for heap, (own, weights) in zip(self.best, self.items, strict=True):
            lows, highs = np.searchsorted(terms, own), np.searchsorted(terms, own, "right")
            bits = np.zeros((len(m), -(-len(own) // 8)), np.uint8)
            for j, (a, b) in enumerate(zip(lows, highs, strict=True)):
                bits[rows[a:b], j >> 3] |= np.uint8(1 << (j & 7))
            held = np.flatnonzero(bits.any(axis=1))
            if not len(held):
                continue
            masks, group = _distinct(bits[held])
            self.seen += len(masks)
            present = np.unpackbits(masks, axis=1, bitorder="little")[:, : len(own)].astype(np.int64)
            # no document of a mask scores more than its shortest one would with the highest counts of the block
            shortest = np.full(len(masks), np.iinfo(np.int64).max)
            np.minimum.at(shortest, group, m[held])
            most = np.array([counts[a:b].max() if b > a else 1 for a, b in zip(lows, highs, strict=True)], np.int64)
            bound = (present * weights * _part(most[None, :], shortest[:, None])).sum(axis=1)
            members = held[np.argsort(group, kind="stable")]
            sizes = np.bincount(group)
            firsts = np.cumsum(sizes) - sizes
            best_first = np.argsort(-bound, kind="stable")
            at = 0
            while at < len(best_first):
                # neighbouring masks that hold enough documents together; all are safe to leave once the first is
                top = bound[best_first[at]]
                if top <= 0 or (len(heap) == self.top and top < heap[0][0]):
                    break
                until = at + 1 + int(np.searchsorted(np.cumsum(sizes[best_first[at:]]), 2 * self.top))
                picked = best_first[at:until]
                self.evaluated += len(picked)
                chosen = np.sort(np.concatenate([members[firsts[g] : firsts[g] + sizes[g]] for g in picked]))
                at = until
                scores = np.zeros(len(chosen), np.int64)
                for a, b, weight in zip(lows, highs, weights, strict=True):
                    if a < b:
                        place = np.minimum(a + np.searchsorted(rows[a:b], chosen), b - 1)
                        tf = np.where(rows[place] == chosen, counts[place], 0)
                        scores += weight * _part(tf, m[chosen])
                for i in np.lexsort((order[chosen], -scores))[: self.top]:
                    entry = (int(scores[i]), _Last(keys[chosen[i]]))
                    if entry[0] <= 0 or (len(heap) == self.top and not heap[0] < entry):
                        break
                    if len(heap) < self.top:
                        heapq.heappush(heap, entry)
                    else:
                        heapq.heapreplace(heap, entry)


def _distinct(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of a bitmap, and the number of each row among them."""
    if bits.shape[1] > 8:
        masks, group = np.unique(bits, axis=0, return_inverse=True)
        return masks, group.reshape(-1)
    wide = np.zeros((len(bits), 8), np.uint8)
    wide[:, : bits.shape[1]] = bits
    values, group = np.unique(wide.view("<u8").reshape(-1), return_inverse=True)
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : bits.shape[1]], group


class _Last:
    """A key that counts as higher the smaller it is; null is lowest."""

    __slots__ = ("key",)

    def __init__(self, key):
        self.key = key

    def __lt__(self, other: _Last) -> bool:
        if self.key is None or other.key is None:
            return self.key is None and other.key is not None
        return other.key < self.key

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Last) and self.key == other.key


def _tally(size: int):
    """Per task: how many of its documents hold each term, and (term null) its documents with a term and all their terms."""

    def run(batches):
        df, docs, words = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
            n = batch.column("n").to_numpy()
            docs, words = docs + int((n > 0).sum()), words + int(n.sum())
        held = np.flatnonzero(df)
        terms = pa.concat_arrays([pa.array(held, pa.int32()), pa.nulls(1, pa.int32())])
        yield pa.RecordBatch.from_arrays(
            [terms, pa.array([*df[held].tolist(), docs]), pa.array([0] * len(held) + [words], pa.int64())], names=["term", "docs", "words"]
        )

    return run


def _search(items: list[tuple[int, np.ndarray, np.ndarray]], n_docs: int, n_terms: int, top: int):
    """The best documents of a task for each item: (item_no, key_in, score)."""

    def run(batches):
        search = MaskSearch([(own, weights) for _, own, weights in items], top)
        kind = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_DOCS):
                part = batch.slice(at, BLOCK_DOCS)
                kind = part.column("key_in").type
                keys = part.column("key_in").to_pylist()
                m = 100 - 25 + (25 * part.column("n").to_numpy() * n_docs) // n_terms
                rows = np.repeat(np.arange(len(keys)), part.column("terms").value_lengths().to_numpy())
                ranked = sorted(range(len(keys)), key=lambda i: (keys[i] is None, 0 if keys[i] is None else keys[i]))
                order = np.empty(len(keys), np.int64)
                order[ranked] = np.arange(len(keys))
                terms, counts = (part.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "counts"))
                search.add(keys, order, m, rows, terms, counts)
        found = [(no, entry[1].key, entry[0]) for (no, _, _), heap in zip(items, search.best, strict=True) for entry in heap]
        if found:
            no, key, score = zip(*found, strict=True)
            arrays = [pa.array(no, pa.int64()), pa.array(key, kind), pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["item_no", "key_in", "score"])

    return run


def _blocks(items: DataFrame):
    """The numbered items, read partition by partition, in blocks of bounded rows and bytes."""
    block, held = [], 0
    for row in items.toLocalIterator():
        size = len(row["text_in"] or "")
        if block and (len(block) == BLOCK_ITEMS or held + size > BLOCK_BYTES):
            yield block
            block, held = [], 0
        block.append((row["item_no"], terms_of(row["text_in"])))
        held += size
    if block:
        yield block


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
) -> DataFrame:
    """The ``top`` documents of every item: (item_key, rank, key, score), scores above 0 only.

    Terms are runs of ASCII letters, digits and all characters from U+0080 on,
    in the whole text, with A-Z as a-z.  With N documents that hold a term, L
    terms in all, n terms in a document and df documents with a term, a term
    weighs floor(1000 ln((2N + 2) / (2df + 1))), a document's m is
    75 + 25nN div L, and it scores the sum over the item's terms, repeats
    included, of weight * (10^9 tf div (1000 tf + 12 m)).

    Items come in blocks of at most BLOCK_ITEMS rows and BLOCK_BYTES of text
    (one longer item is a block); the terms of a block go to every task, and a
    pass over the texts keeps, per document, the counts of these terms.  A task
    sets a bit per document and term of an item, groups documents by the mask,
    and looks into the masks from the highest possible score down until none
    can reach the item's last place; it hands on ``top`` rows per item.

    A null text holds no term.  Equal scores rank by key, null last; rows that
    repeat a key are documents of their own; each row of ``items`` is ranked
    for itself, also with a null or repeated key, and gives nothing without
    terms.  Empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.schema[key].dataType.simpleString()
    asked = items.select(items[item_key].alias("item_in"), items[item_text].alias("text_in"))
    asked = materialize(asked.withColumn("item_no", F.monotonically_increasing_id()), "items")
    picked = docs.select(docs[key].alias("key_in"), docs[text].alias("text_in"))
    found = None
    for block in _blocks(asked):
        terms = sorted({t for _, own in block for t in own})
        if not terms:
            continue
        number = {t: i for i, t in enumerate(terms)}
        postings = picked.mapInArrow(_postings(Vocabulary(terms)), f"key_in {kind}, n long, terms array<int>, counts array<long>")
        postings = materialize(postings.where("n > 0"), "postings")
        # a row per term of the block
        tally = postings.select("n", "terms").mapInArrow(_tally(len(terms)), "term int, docs long, words long")
        sums = {r["term"]: r for r in tally.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).collect()}
        n_docs, n_terms = (sums[None]["docs"], sums[None]["words"]) if None in sums else (0, 0)
        if not n_docs:
            break
        wanted = []
        for no, own in block:
            numbers, repeats = np.unique([number[t] for t in own], return_counts=True) if own else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            weights = [term_weight(n_docs, sums[t]["docs"]) if t in sums else 0 for t in numbers.tolist()]
            wanted.append((no, numbers, repeats * np.array(weights, np.int64)))
        best = postings.mapInArrow(_search(wanted, n_docs, n_terms, top), f"item_no long, key_in {kind}, score long")
        rank = F.row_number().over(W.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("key_in")))
        best = materialize(best.withColumn("rank", rank).where(F.col("rank") <= top), "ranked")
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = spark.createDataFrame([], f"item_no long, key_in {kind}, score long, rank int")
    named = found.join(asked.select("item_no", "item_in"), "item_no")
    return named.select(F.col("item_in").alias(item_key), F.col("rank").cast("int").alias("rank"), F.col("key_in").alias(key), "score")
