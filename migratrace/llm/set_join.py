"""Exact Jaccard self-join of shingle sets that skips by position and derives answers from similar sets.

A set is kept in the order of its 64-bit shingle hashes.  Index lists hold the
sets that agree on a whole segment of that order: two sets whose symmetric
difference is at most d agree on one of any d + 1 segments, so no link is lost,
and a passage that many documents share does not make a long list, since the
rest of a segment differs.  Lists are ordered by set size and by the position
of the segment; blocks of equal size and position are skipped when the bound on
the overlap that follows from them is too low.  Lists of equal members are one
list, and the counts of shingles per range of the hash order take lists apart
further.  Sets that possible links hold together are a family.

A family is searched in one task, or in blocks if it is large.  One set's
overlaps with the whole family are counted from the family's postings; those of
the next are derived from the most similar set that has answers already, by the
shingles in which the two differ.  Sets that links have joined to the largest
component need no answers of their own.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from migratrace.llm.common import components, slices
from migratrace.llm.textscan import buffers, mix, windows, word_bounds, word_hashes
from migratrace.session import materialize, ship_package

SHINGLE = 4
PERCENT = 85
#: Ratio of the largest to the smallest set size of a class; sets of a class are cut into equally many segments.
CLASS_RATIO = 1.4
#: Rows of one index list that a task looks through at once; the sets of a longer list are a family as they are.
LIST_ROWS = 1 << 12
#: Bits of the filter that keeps texts from being cut into sets again when no candidate needs them.
FILTER_BITS = 1 << 23
#: Sets and shingles of a family that one task searches; a larger family is dealt to blocks, and then what its largest
#: group leaves out meets every block.
FAMILY_SETS = 1 << 10
FAMILY_ITEMS = 1 << 19
#: Bits of a digest that name a set in the index.
SHORT_BITS = 64
#: Bits of the number of ranges of the hash order whose counts bound an overlap before sets are fetched: at least, at
#: most; between them there is a range for every two shingles of a set, or less than two.
RANGE_BITS = (8, 12)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The ordered set of shingle hashes of every text; empty without words."""
    data, rows = buffers(column)
    starts, ends, words = word_bounds(data, rows)
    hashes = word_hashes(data, starts, ends, lower=True)
    at, found = windows(hashes, words, size)
    row = np.searchsorted(words, at, "right") - 1
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    found, row = found[fresh], row[fresh]
    bounds = np.searchsorted(row, np.arange(len(words)))
    sets = [found[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for i in np.flatnonzero((np.diff(words) > 0) & (np.diff(words) < size)):
        h = np.uint64(words[i + 1] - words[i])
        for x in hashes[words[i] : words[i + 1]]:
            h = mix(np.array([h]) + x)[0]
        sets[i] = np.array([h], np.uint64)
    return sets


class Segments:
    """How sets are cut: classes of sizes, and segments of the hash range per class."""

    def __init__(self, percent: int):
        self.percent = percent
        low = 1
        while 2 * low * (100 - percent) < 100 + percent:
            low += 1
        self.lows = [low]

    def _low(self, k: int) -> int:
        while len(self.lows) <= k + 1:
            self.lows.append(int(self.lows[-1] * max(CLASS_RATIO, 100 / self.percent)) + 1)
        return self.lows[k]

    def classes(self, n: int) -> list[int]:
        """The class of a set of ``n`` shingles, and the next where a larger partner may be."""
        k = -1
        while self._low(k + 1) <= n:
            k += 1
        return [c for c in (k, k + 1) if c >= 0 and (c == k or 100 * n >= self.percent * self._low(c))]

    def keys(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the segments of a set, and the position at which each begins.

        Empty segments have no key.  A set with so many of them that they might
        be all it shares with a partner gets its first shingles as keys besides.
        """
        n = len(values)
        keys, places = [], []
        for c in self.classes(n):
            most = 2 * (self._low(c + 1) - 1) * (100 - self.percent) // (100 + self.percent)
            count = most + 1 + 2 + most // 16
            part = ((values >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
            at = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            sums = np.add.reduceat(mix(values), at)
            tag = part[at] + np.uint64((c + 1) << 32)
            keys.append(mix(sums ^ mix(tag)))
            places.append(at)
            if len(at) < most + 1:
                first = values[: most + 1]
                keys.append(mix(mix(first) + np.uint64((c + 1) << 40)))
                places.append(np.arange(len(first)))
        if not keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(keys), np.concatenate(places)


def _identity(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _short(node: bytes, bits: int) -> int:
    """The name of a set in the index: a part of its digest.  Sets that share it are told apart before they are compared."""
    return int.from_bytes(node[:8], "big", signed=True) >> (64 - bits)


def _profile(values: np.ndarray) -> bytes:
    """How many shingles lie in each of equal parts of the hash order, 255 for that many and more."""
    low, high = RANGE_BITS
    bits = min(max((len(values) // 2).bit_length(), low), high)
    counts = np.bincount((values >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _profiles(column: list[bytes]) -> np.ndarray:
    """The counts of every row by the widest ranges among them; 255 becomes a number that bounds nothing."""
    width = min(map(len, column))
    out = np.empty((len(column), width), np.int32)
    for row, raw in zip(out, column, strict=True):
        counts = np.frombuffer(raw, np.uint8).astype(np.int32)
        counts[counts == 255] = 1 << 20
        row[:] = counts.reshape(width, -1).sum(axis=1)
    return out.astype(np.int16) if out.max() < 1 << 15 else out


def _scan(size: int, bits: int):
    """Size and identity of every text's set; the counts per range once per set and task."""

    def run(batches):
        seen = set()
        for part in slices(batches, "text_in"):
            sets = shingle_sets(part.column("text_in"), size)
            nodes = [_identity(s) if len(s) else None for s in sets]
            profiles = []
            for node, values, keyed in zip(nodes, sets, part.column("key_in").is_valid().to_pylist(), strict=True):
                fresh = node is not None and keyed and node not in seen
                if fresh:
                    seen.add(node)
                profiles.append(_profile(values) if fresh else None)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key_in"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array([None if x is None else _short(x, bits) for x in nodes], pa.int64()),
                    pa.array(profiles, pa.binary()),
                ],
                names=["key_in", "n", "node", "short", "profile"],
            )

    return run


def _index(size: int, percent: int, bits: int):
    """A row (key, node, n, pos) per segment of every set, once per set and task."""

    def run(batches):
        segments, seen = Segments(percent), set()
        for part in slices(batches, "text_in"):
            columns: list[list[np.ndarray]] = [[], [], [], []]
            for values in shingle_sets(part.column("text_in"), size):
                node = _identity(values) if len(values) else None
                if node is None or node in seen:
                    continue
                seen.add(node)
                keys, places = segments.keys(values)
                rows = (keys.view(np.int64), np.full(len(keys), _short(node, bits)), np.full(len(keys), len(values), np.int32), places.astype(np.int32))
                for column, x in zip(columns, rows, strict=True):
                    column.append(x)
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=["key", "node", "n", "pos"])

    return run


def _enough(n, m, percent: int):
    """The least overlap of sets of ``n`` and ``m`` shingles that is a link."""
    return -((-percent * (n + m)) // (100 + percent))


def _skip(percent: int, list_rows: int):
    """Of whole lists of rows ordered by key, size, position and set: the rows that a partner in their list may link to.

    Copies of one set in a list count once.  A list of two is decided at once
    for all such lists of a batch; in longer ones blocks of equal size and
    position are compared, and the search of a block ends at the first size
    that is too large.  Rows go out as (list, node): a list is named by the sum
    over its members, so that lists of equal members are the same list.  A list
    of more than ``list_rows`` rows goes out in parts under its key, unskipped.
    """

    def handle(rows: list[np.ndarray]):
        key, node, n, pos = rows
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node, n, pos = (x[fresh] for x in (key, node, n, pos))
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        length = np.diff(np.append(start, len(key)))
        keep = np.zeros(len(key), bool)
        a = start[length == 2]
        b = a + 1
        bound = np.minimum(pos[a], pos[b]) + np.minimum(n[a] - pos[a], n[b] - pos[b])
        fits = bound >= _enough(n[a].astype(np.int64), n[b].astype(np.int64), percent)
        keep[a] = keep[b] = fits
        for s, c in zip(start[length > 2], length[length > 2], strict=True):
            own = slice(s, s + c)
            blocks, where = np.unique(n[own].astype(np.int64) << 32 | pos[own], return_inverse=True)
            size, place = blocks >> 32, blocks & 0xFFFFFFFF
            used = np.bincount(where) > 1
            for i in range(len(blocks)):
                j = np.arange(i + 1, np.searchsorted(size, 100 * size[i] // percent, "right"))
                ok = np.minimum(place[i], place[j]) + np.minimum(size[i] - place[i], size[j] - place[j]) >= _enough(size[i], size[j], percent)
                if ok.any():
                    used[i] = True
                    used[j[ok]] = True
            keep[own] = used[where]
        key, node = key[keep], node[keep]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        names = mix(np.add.reduceat(mix(node.view(np.uint64)), start)) if len(key) else np.zeros(0, np.uint64)
        return out(np.repeat(names.view(np.int64), np.diff(np.append(start, len(key)))), node)

    def out(name: np.ndarray, node: np.ndarray):
        return pa.RecordBatch.from_arrays([pa.array(name), pa.array(node)], names=["list", "node"])

    def run(batches):
        held, parted = None, False  # rows of the open list; whether some of it went out before
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if cut:
                first = int(np.searchsorted(rows[0], rows[0][0], "right")) if parted else 0
                if first:
                    yield out(rows[0][:first], rows[1][:first])
                if cut > first:
                    yield handle([x[first:cut] for x in rows])
                parted = False
            held = [x[cut:] for x in rows]
            if len(held[0]) > list_rows:
                yield out(held[0], held[1])
                held, parted = [x[:0] for x in held], True
        if held is not None and len(held[0]):
            yield out(held[0], held[1]) if parted else handle(held)

    return run


def _possible(percent: int, list_rows: int):
    """Edges that hold the sets of a list together where the counts per range leave a link possible.

    Rows come ordered by list.  Sets share at most the smaller count of each
    range; from one set after the other the rest of the list is searched for
    those it may link to, so each set is found once and an edge per set goes
    out.  The sets of a list of more than ``list_rows`` rows all hang on its first.
    """

    def edges(nodes: list[bytes], n: np.ndarray, profiles: list[bytes]):
        counts, left = _profiles(profiles), np.arange(1, len(nodes))
        found, queue = [], [0]
        while len(left):
            i = queue.pop() if queue else None
            if i is None:
                i, left = int(left[0]), left[1:]
            if not len(left):
                break
            most = np.minimum(counts[i], counts[left]).sum(axis=1, dtype=np.int64)
            near = most >= _enough(n[i], n[left], percent)
            hit = left[near].tolist()
            found.extend((nodes[i], nodes[j]) for j in hit)
            queue.extend(hit)
            left = left[~near]
        return found

    def run(batches):
        name, rows, first = None, [], None
        for batch in batches:
            out = []
            for list_, *row in zip(*(batch.column(c).to_pylist() for c in ("list", "node", "n", "profile")), strict=True):
                if list_ != name:
                    out += edges([r[0] for r in rows], np.array([r[1] for r in rows], np.int64), [r[2] for r in rows]) if len(rows) > 1 else []
                    name, rows, first = list_, [], None
                if first is not None:
                    out.append((first, row[0]))
                    continue
                rows.append(row)
                if len(rows) > list_rows:
                    first = rows[0][0]
                    out += [(first, r[0]) for r in rows[1:]]
                    rows = []
            if out:
                yield _pairs(out)
        if len(rows) > 1:
            out = edges([r[0] for r in rows], np.array([r[1] for r in rows], np.int64), [r[2] for r in rows])
            if out:
                yield _pairs(out)

    return run


def _pairs(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


class Family:
    """Sets of one family, the postings of their shingles, and overlaps derived from similar sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        items = np.concatenate(sets)
        order = np.argsort(items)
        items = items[order]
        fresh = np.ones(len(items), bool)
        fresh[1:] = items[1:] != items[:-1]
        self.starts = np.flatnonzero(fresh)
        self.lengths = np.diff(np.append(self.starts, len(items)))
        member = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)
        self.postings = member[order]
        ids = np.empty(len(items), np.int32)
        ids[order] = np.cumsum(fresh, dtype=np.int32) - 1
        self.ids = np.split(ids, np.cumsum(self.sizes)[:-1])
        #: How much of a set others hold: the more, the more answers can be derived from it.
        self.weight = np.bincount(member, weights=self.lengths[ids]) / self.sizes

    def holders(self, ids: np.ndarray) -> np.ndarray:
        """For every set, how many of the shingles ``ids`` it holds."""
        lengths = self.lengths[ids]
        at = np.repeat(self.starts[ids] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        return np.bincount(self.postings[at], minlength=len(self.sizes))

    def overlaps(self, i: int, near: int, answers: dict[int, np.ndarray]) -> np.ndarray:
        """Overlaps of set ``i`` with all: those of ``near``, less the shingles that only it has, and those that only ``i`` has."""
        if near >= 0:
            own, other = self.ids[i], self.ids[near]
            gone, new = np.setdiff1d(other, own, assume_unique=True), np.setdiff1d(own, other, assume_unique=True)
            if self.lengths[gone].sum() + self.lengths[new].sum() < self.lengths[own].sum():
                return answers[near] - self.holders(gone) + self.holders(new)
        return self.holders(self.ids[i])

    def join(self, groups: np.ndarray, percent: int, asked: np.ndarray | None = None, main: np.ndarray | None = None) -> np.ndarray:
        """``groups`` (a number per set) with those joined that a link of an ``asked`` set connects (default: of any).

        Where all sets are asked, those in the largest group need not be: a link
        between two groups has an end outside it.  Else the same holds for the
        group of the ``main`` sets, which are the same in all tasks.  Groups are
        named by a set that others resemble.
        """
        k = len(self.sizes)
        group = np.unique(groups, return_inverse=True)[1].reshape(-1)
        asked = np.ones(k, bool) if asked is None else asked
        fixed = np.flatnonzero(main) if main is not None else np.zeros(0, np.int64)
        done, near, share = np.zeros(k, bool), np.full(k, -1), np.zeros(k)
        answers: dict[int, np.ndarray] = {}
        open_ = asked
        while open_.any():
            i = int(np.argmax(np.where(open_, self.weight, -1)))
            shared = answers[i] = self.overlaps(i, int(near[i]), answers).astype(np.int32)
            done[i] = True
            linked = shared >= _enough(self.sizes, self.sizes[i], percent)
            joined = np.unique(group[linked])
            if len(joined) > 1:
                group[np.isin(group, joined)] = joined[0]
            closer = shared / np.maximum(self.sizes, self.sizes[i])
            better = closer > share
            share[better], near[better] = closer[better], i
            settled = np.bincount(group).argmax() if asked.all() else group[fixed[0]] if len(fixed) else -1
            open_ = asked & ~done & (group != settled)
        order = np.argsort(-self.weight, kind="stable")
        names, first = np.unique(group[order], return_index=True)
        return order[first][np.searchsorted(names, group)]


def _search(percent: int, kept: list[str]):
    """The groups of every family or block: rows (kept columns, node, label before, label after).

    Rows (place, node, label, asked, main, items) come ordered by place; sets
    that come twice count once, and are asked if one of them is.
    """

    def solve(rows: dict[bytes, tuple]) -> list[tuple]:
        nodes, (labels, sets, asked, main) = list(rows), zip(*rows.values(), strict=True)
        numbers = {x: i for i, x in enumerate(dict.fromkeys(labels))}
        named = Family(sets).join(np.array([numbers[x] for x in labels]), percent, np.array(asked), np.array(main))
        return [(node, label, nodes[j]) for node, label, j in zip(nodes, labels, named.tolist(), strict=True)]

    def run(batches):
        place, rows = None, {}

        def out():
            columns = zip(*solve(rows), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["node", "before", "label"])

        for batch in batches:
            items = batch.column("items")
            bounds, values = items.offsets.to_numpy(), items.values.to_numpy(zero_copy_only=False)
            names = [batch.column(c).to_pylist() for c in ("node", "label", "asked", "main", *kept)]
            for i, (node, label, asked, main, *own) in enumerate(zip(*names, strict=True)):
                if own != place:
                    if rows:
                        yield out()
                    place, rows = own, {}
                rows[node] = (label, values[bounds[i] : bounds[i + 1]].copy(), asked or (node in rows and rows[node][2]), main)
        if rows:
            yield out()

    return run


def _found(sets: DataFrame, percent: int, place: list[str]) -> DataFrame:
    """(node, before, label) of the groups of ``sets`` (place columns, node, label, asked, main, items)."""
    ordered = sets.select(*place, "node", "label", "asked", "main", "items").repartition(*place).sortWithinPartitions(*place)
    return ordered.mapInArrow(_search(percent, place), "node binary, before binary, label binary")


def _sets_of(texts: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """``members`` (node, bucket, ...) with the items of their sets; only their texts are cut again."""
    words = members.selectExpr("bucket div 32 AS w", "shiftleft(1L, cast(bucket % 32 AS int)) AS m")
    filled = words.groupBy("w").agg(F.expr("bit_or(m)").alias("m")).toPandas()  # at most FILTER_BITS / 32 rows
    table = np.zeros(FILTER_BITS // 32, np.uint32)
    table[filled["w"].to_numpy(np.int64)] = filled["m"].to_numpy(np.int64)
    packed = zlib.compress(table.tobytes(), 1)

    def run(batches):
        bits = np.frombuffer(zlib.decompress(packed), np.uint32)
        for batch in batches:
            at = batch.column("bucket").to_numpy()
            hit = pa.array((bits[at // 32] >> (at % 32).astype(np.uint32) & 1).astype(bool))
            for part in slices([batch.filter(hit)], "text_in"):
                found = [s for s in shingle_sets(part.column("text_in"), size) if len(s)]
                if found:
                    names = pa.array([_identity(s) for s in found], pa.binary())
                    items = pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([names, items], names=["node", "items"])

    return texts.mapInArrow(run, "node binary, items array<long>").join(members.drop("bucket"), "node")


def jaccard_components(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """Set size and component of every row of ``docs``: (key, n_shingles, component_id).

    Words are runs of other characters than ASCII white space, with A-Z as a-z.
    A set holds the distinct shingles of ``size`` words of the whole text; a
    shorter text is one shingle; without words the set is empty and linked with
    nothing.  Two rows link when 100 * shared >= ``percent`` * all shingles of
    both.  component_id is the smallest key reachable by links; keys may be of
    any type that has an order.

    Rows with a null key are given back with a null component and link
    nothing.  Rows that repeat a key are sets of their own.  A null text is
    empty; an empty table gives no rows; other columns are not read.

    Sets that are equal are one node from the start, by a digest of 128 bits,
    so copies are never paired.  A task holds one list of LIST_ROWS rows, or
    one block of FAMILY_SETS sets or FAMILY_ITEMS shingles, or two such blocks.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(
        docs[key].alias("key_in"), docs[text].alias("text_in"), F.pmod(F.xxhash64(docs[key]), F.lit(FILTER_BITS)).alias("bucket")
    )
    scanned = texts.mapInArrow(_scan(size, SHORT_BITS), f"key_in {kind}, n long, node binary, short long, profile binary")
    scanned = materialize(scanned, "sets")
    nodes = (
        scanned.where("node IS NOT NULL AND key_in IS NOT NULL")
        .groupBy("node")
        .agg(F.min("key_in").alias("doc"), F.min("n").alias("n"), F.min("short").alias("short"), F.first("profile", ignorenulls=True).alias("profile"))
    )
    nodes = materialize(nodes, "nodes")
    keyed = texts.where("key_in IS NOT NULL")
    rows = keyed.mapInArrow(_index(size, percent, SHORT_BITS), "key long, node long, n int, pos int")
    indexed = rows.repartition("key").sortWithinPartitions("key", "n", "pos", "node")
    lists = indexed.mapInArrow(_skip(percent, LIST_ROWS), "list long, node long").distinct()
    lists = materialize(lists.withColumnRenamed("node", "short"), "lists")
    named = lists.join(nodes.select("short", "node", "n", "profile"), "short").select("list", "node", "n", "profile")
    ordered = named.repartition("list").sortWithinPartitions("list", "node")
    edges = materialize(ordered.mapInArrow(_possible(percent, LIST_ROWS), "a binary, b binary").distinct(), "edges")
    labels = _labels(keyed, nodes, edges, size, percent)
    reached = labels.join(nodes, "node").groupBy("label").agg(F.min("doc").alias("least"))
    joined = labels.join(reached, "label").select("node", "least")
    placed = materialize(
        nodes.join(joined, "node", "left").select("node", F.coalesce("least", "doc").alias("component_id")), "placed"
    )
    own = F.when(F.col("node").isNull(), F.col("key_in")).otherwise(F.col("component_id"))
    return scanned.select("key_in", "n", "node").join(placed, "node", "left").select(
        F.col("key_in").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("key_in").isNotNull(), own).alias("component_id"),
    )


def _labels(texts: DataFrame, nodes: DataFrame, edges: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, label) of every node with a possible link: components of the exact links among them."""
    if not edges.limit(1).count():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    families = components(edges).withColumnRenamed("label", "family").join(nodes.select("node", "doc", "n"), "node")
    families = materialize(families, "families")
    sizes = families.groupBy("family").agg(F.count("*").alias("sets"), F.sum("n").alias("items"))
    blocks = F.greatest(F.ceil(F.col("sets") / FAMILY_SETS), F.ceil(F.col("items") / FAMILY_ITEMS)).cast("long")
    large = materialize(sizes.select("family", blocks.alias("blocks")).where("blocks > 1"), "large-families")
    dealt = families.join(large, "family", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    members = dealt.select(
        "node", "family", "blocks",
        F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"),
        F.col("node").alias("label"),
        F.pmod(F.xxhash64("doc"), F.lit(FILTER_BITS)).alias("bucket"),
    )
    members = materialize(members.withColumns({"asked": F.lit(True), "main": F.lit(False)}), "members")
    found = materialize(_found(_sets_of(texts, members, size), percent, ["family", "block"]), "labels")
    labels = found.select("node", "label")
    if not large.limit(1).count():
        return labels

    sets = materialize(_sets_of(texts, members.where("blocks > 1").drop("label", "asked", "main"), size), "family-sets")
    labels = materialize(labels.join(members.select("node", "family", "block", "blocks"), "node"), "block-labels")
    # first the sets that name the groups of a family's blocks meet
    ends = sets.join(labels.where("node = label AND blocks > 1").select("node", "label"), "node")
    counts = ends.groupBy("family").agg(F.count("*").alias("sets"), F.sum(F.size("items")).alias("items"))
    parts = F.greatest(F.ceil(F.col("sets") / FAMILY_SETS), F.ceil(F.col("items") / FAMILY_ITEMS)).cast("long")
    ends = ends.join(materialize(counts.select("family", parts.alias("parts")), "ends"), "family")
    ends = ends.withColumns({"part": F.pmod(F.xxhash64("node"), F.col("parts")), "asked": F.lit(True), "main": F.lit(False)})
    labels = _renamed(labels, materialize(_found(ends, percent, ["family", "part"]), "ends-met"))
    # what the largest group of a family leaves out meets every block
    groups = labels.where("blocks > 1").groupBy("family", "label").agg(F.count("*").alias("sets"))
    main = materialize(groups.groupBy("family").agg(F.max(F.struct("sets", "label")).alias("g")).select("family", "g.label"), "main-groups")
    out = labels.where("blocks > 1").join(main.withColumnRenamed("label", "main"), "family").where("label <> main")
    out = materialize(sets.join(out.select("node", "label"), "node"), "outside")
    counts = out.groupBy("family", "blocks").agg(F.count("*").alias("sets"), F.sum(F.size("items")).alias("items"))
    parts = F.greatest(F.ceil(F.col("sets") / FAMILY_SETS), F.ceil(F.col("items") / FAMILY_ITEMS)).cast("long")
    parts = materialize(counts.select("family", parts.alias("parts")), "outside-parts")
    if not parts.limit(1).count():
        return labels.select("node", "label")
    columns = ["family", "block", "part", "node", "label", "asked", "main", "items"]
    every_block = F.explode(F.expr("sequence(0L, blocks - 1)"))
    asked = out.join(parts, "family").withColumns({"part": F.pmod(F.xxhash64("node"), F.col("parts")), "block": every_block})
    asked = asked.withColumns({"asked": F.lit(True), "main": F.lit(False)})
    there = sets.select("node", "items").join(labels.select("node", "family", "block", "label"), "node").join(parts, "family")
    there = there.withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)")))
    there = there.join(main.select("family", F.col("label").alias("of_main")), "family")
    there = there.withColumns({"asked": F.lit(False), "main": F.col("label") == F.col("of_main")})
    met = _found(asked.select(*columns).unionByName(there.select(*columns)), percent, ["family", "block", "part"])
    return _renamed(labels, materialize(met, "met")).select("node", "label")


def _renamed(labels: DataFrame, met: DataFrame) -> DataFrame:
    """``labels`` with one label for all that ``met`` (node, before, label) has joined."""
    joined = met.where("before <> label").select(F.col("before").alias("a"), F.col("label").alias("b")).distinct()
    names = components(joined).select(F.col("node").alias("label"), F.col("label").alias("name"))
    columns = [F.coalesce("name", "label").alias(c) if c == "label" else F.col(c) for c in labels.columns]
    return materialize(labels.join(names, "label", "left").select(*columns), "renamed")
