"""Packing of token sequences into fixed-length ones: best-fit per task, then underfull ones merged as items up a tree."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from migratrace.llm.byte_bpe import byte_bpe_of
from migratrace.llm.common import slices
from migratrace.session import materialize, ship_package

CAPACITY = 1024
END_ID = 2
#: Items that a task packs at once; a larger partition is packed in parts of so many.
CHUNK = 1 << 16
#: Partitions that meet in one task of the next round.
FAN = 8
#: A sequence with fewer free places than this is not offered again.
NEARLY_FULL = 8
#: The least share of sequences that a round has to save for another one at the same width.
GAIN = 0.002


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place in it of every item: largest first, each into the open bin that it leaves the least room in.

    Bins are named by the item that opened them.  Open bins are kept by their
    free places; a bit per number of free places finds the smallest that fits.
    """
    bins, places = np.empty(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_ = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        above = open_ >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            bin_ = free[room].pop()
            if not free[room]:
                open_ ^= 1 << room
            places[i] = capacity - room
        else:
            bin_, room = i, capacity
        bins[i] = bin_
        room -= size
        if room:
            if not free[room]:
                open_ |= 1 << room
            free[room].append(bin_)
    return bins, places


def _packed(items: np.ndarray, sizes: np.ndarray, capacity: int) -> list[pa.Array]:
    """Per item: bin, place, fill of the bin, and whether the bin is (nearly) full."""
    bins, places = best_fit(sizes, capacity)
    fill = np.bincount(bins, weights=sizes, minlength=len(sizes)).astype(np.int64)[bins]
    return [pa.array(items[bins]), pa.array(places), pa.array(fill), pa.array(capacity - fill < NEARLY_FULL)]


PLACED = "bin long, place long, fill long, full boolean"
_PLACED_NAMES = ["bin", "place", "fill", "full"]


def _cut_and_pack(file: bytes, end_id: int, capacity: int, with_ids: bool):
    """Encode texts, cut those longer than a sequence, and pack the pieces of the task."""

    def run(batches):
        encode = byte_bpe_of(file).encode
        end = np.array([end_id], "<u4").tobytes()
        base, made = TaskContext.get().partitionId() << 40, 0
        held: list[list] = []
        docs: list[pa.Array] = []

        def flush():
            nonlocal made, held, docs
            item = np.arange(base + made, base + made + len(held), dtype=np.int64)
            made += len(held)
            columns = [np.array(c, np.int64) for c in list(zip(*held, strict=True))[1:5]]
            doc = pa.concat_arrays(docs).take(pa.array([h[0] for h in held], pa.int64()))
            ids = [pa.array([h[5] for h in held], pa.list_(pa.int32()))] if with_ids else []
            arrays = [pa.array(item), doc, *(pa.array(c) for c in columns), *ids, *_packed(item, columns[2], capacity)]
            names = ["item", "key_in", "piece", "start", "length", "crc", *(["ids"] if with_ids else []), *_PLACED_NAMES]
            held, docs = [], []
            return pa.RecordBatch.from_arrays(arrays, names=names)

        rows = 0
        for part in slices(batches, "text_in"):
            docs.append(part.column("key_in"))
            for text in part.column("text_in").to_pylist():
                raw = encode(text or "") + end
                n = len(raw) // 4
                first = (n - 1) % capacity + 1
                for piece, stop in enumerate(range(first, n + 1, capacity)):
                    start = stop - first if piece == 0 else stop - capacity
                    own = raw[4 * start : 4 * stop]
                    ids = np.frombuffer(own, "<u4").astype(np.int32) if with_ids else None
                    held.append([rows, piece, start, stop - start, zlib.crc32(own), ids])
                rows += 1
            if len(held) >= CHUNK:
                yield flush()
                rows = 0
        if held:
            yield flush()

    return run


def _merge(capacity: int):
    """Pack bins of earlier rounds as items, at most CHUNK at a time."""

    def run(batches):
        held: list[pa.RecordBatch] = []

        def flush():
            table = pa.Table.from_batches(held)
            item, size = (table.column(c).to_numpy() for c in ("item", "size"))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(item), *_packed(item, size, capacity)], names=["item", *_PLACED_NAMES])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, CHUNK - sum(b.num_rows for b in held))
                at += part.num_rows
                held.append(part)
                if sum(b.num_rows for b in held) == CHUNK:
                    yield flush()
        if held:
            yield flush()

    return run


def _underfull(placed: DataFrame) -> DataFrame:
    """The bins that are offered again, as items: each is named by the item that opened it."""
    return placed.where("NOT full AND item = bin").select("item", F.col("fill").alias("size"))


def pack_documents(
    docs: DataFrame,
    tokenizer: bytes,
    *,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents and their places: (key, piece, start, length, ids_crc32, [ids,] sequence_id, offset).

    A document is the ids of its whole text under the ``tokenizers`` file
    ``tokenizer``, then ``end_id``; a null or empty text is that id alone.  A
    document of more than ``capacity`` ids is cut: pieces of ``capacity`` ids,
    the first of which may be shorter.  A sequence holds pieces without gaps,
    ``capacity`` ids at most; ``sequence_id`` is the number of the piece that
    opened it.  ``ids_crc32`` covers the ids as little-endian 32-bit numbers.

    Every task packs the pieces of its own rows by best fit.  Sequences with
    fewer than NEARLY_FULL free places are done.  The others become items: FAN
    partitions of them meet in a task of the next round, and so on up the tree
    until one task is left, or, where more than CHUNK underfull sequences
    remain, until a round saves less than GAIN of them.  A task holds at most
    CHUNK items and the ids of one slice of texts; texts are never shuffled.

    Rows with a null or repeated key are documents of their own; an empty table
    gives no rows; other columns are not read.  Equal input files give equal
    placements; another layout of the rows may give others.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    picked = docs.select(docs[key].alias("key_in"), docs[text].alias("text_in"))
    ids = ", ids array<int>" if with_ids else ""
    schema = f"item long, key_in {kind}, piece long, start long, length long, crc long{ids}, {PLACED}"
    pieces = materialize(picked.mapInArrow(_cut_and_pack(tokenizer, end_id, capacity, with_ids), schema), "pieces")

    moved = None  # where the bins of the first round have gone: (item, bin, place)
    left = _underfull(pieces)
    state = left.agg(F.count("*").alias("n"), F.countDistinct(F.shiftright("item", 40)).alias("tasks")).first()
    count, width, turn = state["n"], state["tasks"], 0
    while count > 1:
        turn += 1
        least = -(-count // CHUNK)
        narrow = max(least, -(-width // FAN))
        dealt = left.repartition(narrow, F.xxhash64("item", F.lit(turn))).sortWithinPartitions("item")
        round_ = materialize(dealt.mapInArrow(_merge(capacity), f"item long, {PLACED}"), "merged")
        step = round_.select("item", "bin", "place")
        if moved is None:
            moved = step
        else:
            after = step.select(F.col("item").alias("bin"), F.col("bin").alias("to"), F.col("place").alias("by"))
            moved = moved.join(after, "bin", "left").select(
                "item", F.coalesce("to", "bin").alias("bin"), (F.col("place") + F.coalesce("by", F.lit(0))).alias("place")
            )
            moved = materialize(moved, "moved")
        left = _underfull(round_)
        before, count = count, left.count()
        if narrow == 1 or (narrow == width and before - count < GAIN * before):
            break
        width = narrow

    sequence, offset = F.col("bin"), F.col("place")
    if moved is not None:
        moved = moved.select(F.col("item").alias("bin"), F.col("bin").alias("to"), F.col("place").alias("by"))
        pieces = pieces.join(moved, "bin", "left")
        sequence, offset = F.coalesce("to", "bin"), F.col("place") + F.coalesce("by", F.lit(0))
    return pieces.select(
        F.col("key_in").alias(key),
        F.col("piece").cast("int").alias("piece"),
        "start",
        "length",
        F.col("crc").alias("ids_crc32"),
        *(["ids"] if with_ids else []),
        sequence.alias("sequence_id"),
        offset.alias("offset"),
    )
