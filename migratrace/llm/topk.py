"""Exact top-k inner products by branch and bound over a ball tree per shard."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from migratrace.session import bound_batches, materialize, ship_package

#: Distinct vectors of a shard, about, and queries of a block at most.
SHARD_ROWS = 4096
BLOCK_ROWS = 1024
LEAF_ROWS = 64
#: Shards whose trees a task holds at once, about.
TASK_SHARDS = 16
#: A vector is taken as float64 where that is exact for its inner products.
_EXACT = float(1 << 53)


class BallTree:
    """A tree of balls over integer vectors: each node has a centre, a radius and rows start..stop."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.arange(len(vectors))
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self.ranges: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        points = vectors.astype(float)
        stack = [(0, len(vectors), -1, 0)]
        while stack:
            start, stop, parent, side = stack.pop()
            rows = points[self.order[start:stop]]
            centre = rows.mean(axis=0)
            far = np.sqrt(((rows - centre) ** 2).sum(axis=1))
            node = len(self.radii)
            self.centres.append(centre)
            # rounding of the sums above must not make a ball too small
            self.radii.append(float(far.max()) * (1 + 1e-9) + 1e-6)
            self.ranges.append((start, stop))
            self.children.append(None)
            if parent >= 0:
                pair = self.children[parent] or (-1, -1)
                self.children[parent] = (node, pair[1]) if side == 0 else (pair[0], node)
            if stop - start > LEAF_ROWS:
                one = rows[far.argmax()]
                two = rows[((rows - one) ** 2).sum(axis=1).argmax()]
                split = np.argsort((rows - one) @ (two - one), kind="stable")
                self.order[start:stop] = self.order[start:stop][split]
                middle = (start + stop) // 2
                stack.append((middle, stop, node, 1))
                stack.append((start, middle, node, 0))
        self.vectors = vectors[self.order]
        self.centre_matrix = np.array(self.centres)
        self.radius_array = np.array(self.radii)
        self.peak = float(np.abs(points).max()) if points.size else 0.0

    def search(self, query: np.ndarray, ids: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """The k best (score, id) of the rows, the smaller id first at equal scores.

        ``ids`` are those of the rows in tree order, ``floor`` a score under
        which nothing counts.  Nodes are opened from the highest upper bound
        q.c + |q| r down, until a bound falls under the k-th score so far.
        """
        q = query.astype(float)
        norm = float(np.sqrt(q @ q))
        slack = 1e-9 * norm * (float(np.abs(self.centre_matrix).max(initial=0)) * len(q) + self.peak) + 1e-6
        bounds = self.centre_matrix @ q + norm * self.radius_array + slack
        exact = norm * self.peak * np.sqrt(len(q)) < _EXACT
        found: list[tuple[int, int]] = []  # a heap of (score, -id), the worst first
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            least = found[0][0] if len(found) == k else None
            if floor is not None:
                least = floor if least is None else max(least, floor)
            if least is not None and -bound < least:
                break
            if self.children[node] is not None:
                for child in self.children[node]:
                    heapq.heappush(queue, (-bounds[child], child))
                continue
            start, stop = self.ranges[node]
            rows = self.vectors[start:stop]
            scores = (rows @ q).astype(np.int64) if exact else rows.astype(np.int64) @ query
            pick = np.flatnonzero(scores >= least) if least is not None else np.arange(len(scores))
            for i in pick:
                entry = (int(scores[i]), -int(ids[start + i]))
                if len(found) < k:
                    heapq.heappush(found, entry)
                elif entry > found[0]:
                    heapq.heapreplace(found, entry)
        return [(s, -i) for s, i in sorted(found, reverse=True)]


def quantise(vectors: DataFrame, *, key: str, vector: str) -> DataFrame:
    """(id, dims, v): floor(256 x) of every component as 64-bit integers; vectors that take no part are left out."""
    x = F.col("v_in")
    usable = vectors.select(vectors[key].cast("long").alias("id"), vectors[vector].alias("v_in")).where(
        F.col("id").isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    )
    return usable.select("id", F.size(x).alias("dims"), F.transform(x, lambda c: F.floor(c.cast("double") * 256).cast("long")).alias("v"))


def top_inner_products(
    queries: DataFrame, candidates: DataFrame, *, key: str = "vec_id", vector: str = "embedding", k: int = 5
) -> DataFrame:
    """The k candidates of highest integer inner product for every query: (query_id, rank, vec_id, score).

    Components become floor(256 x).  A query is not its own candidate (equal
    keys); ties go to the smaller key; a query with fewer candidates gets them
    all.  Vectors that are null, or hold null or non-finite components, and rows
    with a null key take no part; vectors are only compared with others of
    their length.  Repeated candidate rows count once, as do repeated query
    keys with one vector.  Scores beyond 64 bits are an error.  Empty tables
    give no rows.

    Equal vectors are one candidate with their k + 1 smallest keys, which is
    all a query can need, so a vector that a third of the rows share weighs
    nothing.  Candidates are dealt to shards of about SHARD_ROWS by their first
    components' place among fixed directions, so that shards are compact.  A
    query first searches its own shard; the k-th score found there is the floor
    of its search in all others.  A task builds the trees of its shards once,
    then the queries come to it in blocks of BLOCK_ROWS: exact search needs every
    query at every shard, and only k rows of each query leave a task.  Shards and blocks
    are dealt to tasks as rows of one table: no join that could be planned
    as a broadcast sees a vector.
    """
    spark = candidates.sparkSession
    ship_package(spark)
    bound_batches(spark)
    base = quantise(candidates, key=key, vector=vector).distinct()
    nth = F.row_number().over(W.partitionBy("dims", "v").orderBy("id"))
    ranked = base.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    points = materialize(ranked.groupBy("dims", "v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "points")
    asked = materialize(quantise(queries, key=key, vector=vector).distinct(), "queries")
    total = points.count()
    bits = max(0, -(-total // SHARD_ROWS) - 1).bit_length()

    def shard(frame: DataFrame) -> DataFrame:
        """The side of ``bits`` fixed directions on which a vector lies, and a number that splits crowded cells."""
        if not bits:
            return frame.withColumn("cell", F.lit(0))
        directions = np.random.Generator(np.random.PCG64(5)).choice([-1, 1], (bits, 64)).tolist()

        def side(i: int):
            signs = F.array(*(F.lit(float(s)) for s in directions[i]))
            turned = F.transform("v", lambda c, j: c.cast("double") * F.element_at(signs, (j % 64 + 1).cast("int")))
            return F.when(F.aggregate(turned, F.lit(0.0), lambda a, c: a + c) > 0, 1 << i).otherwise(0)

        return frame.withColumn("cell", sum((side(i) for i in range(1, bits)), side(0)))

    placed = shard(points)
    crowd = materialize(
        placed.groupBy("dims", "cell").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("long").alias("parts")), "cells"
    )
    split = placed.join(crowd, ["dims", "cell"]).withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")))
    item = F.struct("ids", "v")
    shards = materialize(split.groupBy("dims", "cell", "part").agg(F.collect_list(item).alias("items")), "shards")

    number = int(crowd.agg(F.coalesce(F.sum("parts"), F.lit(0)).alias("n")).first()["n"])
    tasks = max(1, min(number, 4 * spark.sparkContext.defaultParallelism), -(-number // TASK_SHARDS))
    task = F.pmod(F.col("dims") + F.col("cell") + F.col("part"), F.lit(tasks)).cast("int")
    columns = ("task", "dims", "cell", "part", "items", "asked")
    trees = shards.withColumns({"task": task, "asked": F.lit(None)}).select(*columns)

    def searched(blocks: DataFrame, at_home: bool) -> DataFrame:
        """What the blocks (task, dims, cell, part, asked) find in the shards of their task."""
        both = trees.unionByName(blocks.withColumn("items", F.lit(None)).select(*columns))
        # a task's shards first
        dealt = both.repartitionById(tasks, F.col("task")).sortWithinPartitions(F.col("items").isNull())
        return dealt.drop("task").mapInArrow(_answers(k, at_home), "query_id long, vec_id long, score long")

    homed = shard(asked).join(crowd, ["dims", "cell"], "left")
    homed = homed.withColumn("part", F.coalesce(F.pmod(F.xxhash64("v"), F.col("parts")), F.lit(-1)))
    blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    homed = homed.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)))
    question = F.struct("id", "v", F.lit(None).cast("long").alias("floor"), "cell", "part")
    near = homed.where("part >= 0").groupBy("dims", "cell", "part", "block").agg(F.collect_list(question).alias("asked"))
    home = materialize(searched(near.withColumn("task", task), at_home=True).transform(_best(k)), "home")

    floors = home.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k)
    known = homed.join(floors.select(F.col("query_id").alias("id"), "floor"), "id", "left")
    question = F.struct("id", "v", "floor", "cell", "part")
    far = known.groupBy("dims", "block").agg(F.collect_list(question).alias("asked"))
    every = F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task")
    far = far.select("dims", F.lit(None).alias("cell"), F.lit(None).alias("part"), "asked", every)
    rest = searched(far, at_home=False)
    best = home.select("query_id", "vec_id", "score").unionByName(rest).transform(_best(k))
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias(key), "score")


def _best(k: int):
    """The k best candidates of each query; a pair that came up more than once counts with its best score."""

    def run(found: DataFrame) -> DataFrame:
        pairs = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return pairs.withColumn("rank", rank).where(F.col("rank") <= k)

    return lambda found: run(found.select("query_id", "vec_id", "score"))


class _Shard:
    """The tree of a shard, and the keys of its vectors in tree order."""

    def __init__(self, cell: int, part: int, vectors: np.ndarray, keys: list[list[int]]):
        self.place, self.tree = (cell, part), BallTree(vectors)
        keys = [keys[j] for j in self.tree.order]
        self.ids = np.array([x[0] for x in keys])
        self.equal = {x[0]: x for x in keys}

    def best(self, query: int, v: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """The k best (-score, key) besides the query itself, the best first."""
        # k vectors besides the query's own hold the k best; each stands for its smallest keys
        found = [(-s, key) for s, one in self.tree.search(v, self.ids, k + 1, floor) for key in self.equal[one] if key != query]
        return sorted(found)[:k]


def _vectors(items: pa.Array, dims: int) -> np.ndarray:
    return items.field("v").flatten().to_numpy(zero_copy_only=False).reshape(len(items), dims)


def _answers(k: int, at_home: bool):
    """The k best of a task's shards for each query of its blocks: of the query's own shard, or of all others.

    The shards come first.  What the k best so far reach is the floor in the next shard.
    """

    def run(batches):
        shards: dict[int, list[_Shard]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                dims, cell, part = (batch.column(c)[i].as_py() for c in range(3))
                items, asked = batch.column(3)[i], batch.column(4)[i]
                if items.is_valid:
                    shards.setdefault(dims, []).append(_Shard(cell, part, _vectors(items.values, dims), items.values.field("ids").to_pylist()))
                    continue
                asked = asked.values
                rows: list[tuple[int, int, int]] = []
                questions = zip(*(asked.field(f).to_pylist() for f in ("id", "floor", "cell", "part")), strict=True)
                for v, (query, floor, *own) in zip(_vectors(asked, dims), questions, strict=True):
                    best: list[tuple[int, int]] = []
                    for shard in shards.get(dims, ()):
                        if (shard.place == tuple(own)) == at_home:
                            best = sorted(best + shard.best(query, v, k, floor))[:k]
                            if len(best) == k:
                                floor = -best[-1][0] if floor is None else max(floor, -best[-1][0])
                    rows.extend((query, key, -s) for s, key in best)
                columns = zip(*rows, strict=True) if rows else ([], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    return run
