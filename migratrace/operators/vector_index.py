"""An index of ticket vectors as tables: written once, appended to, searched exactly or by a few cells per query."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from migratrace.functions.columns import col
from migratrace.operators.blocks import (
    MAX_CELLS,
    ROWS_PER_BLOCK,
    Cells,
    cells_within_reach,
    choose_pivots,
    describe_cells,
    matrix,
    to_cells,
)
from migratrace.operators.neighbours import nearest_cells, nearest_in_blocks
from migratrace.operators.retrieve import TOP_K, lifted_vectors
from migratrace.session import materialize

#: For the choice of probes: the share of the exact hits to find, and the queries it is measured on.
RECALL = 0.95
SAMPLED_QUERIES = 1_000
_BLOCKS_PER_FILE = 64


class VectorIndex:
    """Vectors by the nearest of a bounded number of pivots, as tables under ``folder``.

    ``pivots`` holds a row per cell, ``rows`` the unit vectors, partitioned by
    batch and cell, ``figures`` the rows and radius per batch and cell.  The
    figures of a batch are written last, and only batches that have them are
    read: a stopped append leaves nothing behind that counts, and may be repeated.
    """

    def __init__(self, spark: SparkSession, folder: str, per_block: int = ROWS_PER_BLOCK):
        self.spark, self.folder, self.per_block = spark, folder.rstrip("/"), per_block
        self._batches: dict[str, DataFrame] = {}
        self._stored: tuple[tuple, tuple[DataFrame, Cells]] | None = None

    @classmethod
    def build(
        cls,
        tickets: DataFrame,
        folder: str,
        key: str = "Ticket_ID",
        vector: str = "Embedding",
        per_block: int = ROWS_PER_BLOCK,
        max_cells: int = MAX_CELLS,
    ) -> VectorIndex:
        """Pivots from the tickets, and the tickets as first batch; an error when none has a vector.

        Vectors with a null, NaN or infinite component take no part.
        """
        points = materialize(lifted_vectors(tickets, key, vector, False), "points")
        rows = points.count()
        if not rows:
            raise ValueError("no ticket has a vector")
        ids, pivots = choose_pivots(points, rows, max_cells, per_block)
        index = cls(tickets.sparkSession, folder, per_block)
        listed = [(i, key_, [float(v) for v in p]) for i, (key_, p) in enumerate(zip(ids, pivots, strict=True))]
        schema = f"cell int, id {points.schema['id'].dataType.simpleString()}, vec array<double>"
        index.spark.createDataFrame(listed, schema).write.parquet(f"{index.folder}/pivots")
        index._add(points, ids, pivots)
        return index

    def append(self, tickets: DataFrame, key: str = "Ticket_ID", vector: str = "Embedding") -> None:
        """Add tickets, whose keys are to be new, to the cells that the index has."""
        self._add(lifted_vectors(tickets, key, vector, False), *self._pivots())

    def _pivots(self) -> tuple[list, np.ndarray]:
        rows = self.spark.read.parquet(f"{self.folder}/pivots").orderBy("cell").collect()  # a row per cell
        return [r["id"] for r in rows], np.array([r["vec"] for r in rows], dtype=np.float64)

    def _add(self, points: DataFrame, ids: list, pivots: np.ndarray) -> None:
        batch = uuid.uuid4().hex
        placed, cells = describe_cells(to_cells(points, pivots), pivots, ids, self.per_block)
        path = f"{self.folder}/rows/batch={batch}"
        # a large cell is written by many tasks, a small one by one
        together = placed.repartition("cell", F.floor(F.col("block") / _BLOCKS_PER_FILE))
        together.select("id", "vec", "reach", "cell").write.partitionBy("cell").parquet(path)
        used = np.flatnonzero(cells.count)
        figures = [(batch, int(c), int(cells.count[c]), float(cells.radius[c])) for c in used]
        self.spark.createDataFrame(figures, "batch string, cell int, n long, radius double").coalesce(1).write.mode("append").parquet(f"{self.folder}/figures")

    def _cells(self) -> tuple[list[str], Cells]:
        """The finished batches, and the figures of the cells over them."""
        ids, pivots = self._pivots()
        figures = self.spark.read.parquet(f"{self.folder}/figures")
        count, radius = np.zeros(len(pivots), dtype=np.int64), np.zeros(len(pivots))
        for r in figures.groupBy("cell").agg(F.sum("n").alias("n"), F.max("radius").alias("r")).collect():
            count[r["cell"]], radius[r["cell"]] = r["n"], r["r"]
        batches = [r["batch"] for r in figures.select("batch").distinct().collect()]
        return batches, Cells(pivots, ids, count, radius, np.maximum(1, -(-count // self.per_block)))

    def rows_of(self, batches: list[str], cells: list[int]) -> DataFrame:
        """The stored vectors of some cells; the folders of the others are not read."""
        kind = self.spark.read.parquet(f"{self.folder}/pivots").schema["id"].dataType.simpleString()
        schema = f"id {kind}, vec array<double>, reach double, cell int"
        # a finished batch does not change: its folders, one per cell, are listed once
        for b in batches:
            if b not in self._batches:
                self._batches[b] = self.spark.read.schema(schema).parquet(f"{self.folder}/rows/batch={b}")
        parts = [self._batches[b] for b in batches]
        stored = parts[0]
        for part in parts[1:]:
            stored = stored.unionByName(part)
        return stored.where(F.col("cell").isin(cells))

    def search(
        self,
        queries: DataFrame,
        k: int = TOP_K,
        query_key: str = "Query_ID",
        key: str = "Ticket_ID",
        vector: str = "Embedding",
        probes: int | None = None,
    ) -> DataFrame:
        """The k tickets of highest cosine per query: query key, ticket key, Similarity, Rank.

        Without ``probes`` exact: only cells are read whose distance to a query's
        pivot does not rule them out.  With it each query meets the tickets
        of its ``probes`` nearest cells only, and may miss some; a query whose
        cells hold fewer than k tickets gets fewer rows.  Ties rank by
        ticket key; without queries there are no rows.
        """
        batches, cells = self._cells()
        asked = lifted_vectors(queries, query_key, vector, True)
        placed, asked_cells = describe_cells(to_cells(asked, cells.pivots), cells.pivots, cells.pivot_ids, self.per_block)
        if probes is None:
            pairs = cells_within_reach(asked_cells, cells, k)
        else:
            placed = _opened(placed, cells, probes)
            pairs = _opened_pairs(placed, len(cells.pivots))
        stored, stored_cells = self._first_copies(batches, sorted({int(c) for c in pairs[:, 1]}), cells, k)
        opened = probes is not None
        found = nearest_in_blocks(placed, asked_cells, stored, stored_cells, k, cosine=True, pairs=pairs, opened=opened, per_block=self.per_block)
        return found.select(
            F.col("id").alias(query_key), F.col("other").alias(key), (-F.col("distance")).alias("Similarity"), F.col("rank").cast("int").alias("Rank")
        )

    def _first_copies(self, batches: list[str], wanted: list[int], cells: Cells, k: int) -> tuple[DataFrame, Cells]:
        """The vectors of the cells: of equal ones only the k smallest keys can be among the k nearest.  Those of the last search are kept."""
        key = (tuple(batches), tuple(wanted), k)
        if self._stored is None or self._stored[0] != key:
            among_copies = F.row_number().over(Window.partitionBy("cell", "vec").orderBy("id"))
            stored = self.rows_of(batches, wanted).withColumn("__copy", among_copies).where(F.col("__copy") <= k).drop("__copy")
            self._stored = key, describe_cells(materialize(stored, "stored"), cells.pivots, cells.pivot_ids, self.per_block)
        return self._stored[1]

    def probes_for(
        self,
        queries: DataFrame,
        target: float = RECALL,
        k: int = TOP_K,
        query_key: str = "Query_ID",
        vector: str = "Embedding",
        sampled_queries: int = SAMPLED_QUERIES,
    ) -> int:
        """The least number of probes that finds the share ``target`` of the exact hits of a bounded sample of queries.

        A hit is found if its cell is among those looked at, so one exact search
        gives the share for every number of probes.
        """
        # another hash than that of the pivots: a query that is a pivot finds more in its own cell than others do
        sample = materialize(queries.orderBy(F.xxhash64(col(query_key), F.lit(41)), col(query_key)).limit(sampled_queries), "sampled")
        batches, cells = self._cells()
        filled = [int(c) for c in np.flatnonzero(cells.count)]
        hits = materialize(self.search(sample, k, query_key, "__hit", vector), "hits").select(col(query_key).alias("id"), "__hit")
        placed = hits.join(self.rows_of(batches, filled).select(F.col("id").alias("__hit"), "cell"), "__hit")
        hit = placed.groupBy("id").agg(F.collect_list("cell").alias("hit"))
        turns = _turns(lifted_vectors(sample, query_key, vector, True).join(hit, "id"), cells)
        found = turns.groupBy("turn").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per cell at most
        count = np.zeros(len(filled) + 1)
        for r in found:
            count[r["turn"]] = r["n"]
        return int(np.argmax(np.cumsum(count) >= target * count.sum())) or 1


def _opened(placed: DataFrame, cells: Cells, probes: int) -> DataFrame:
    """The queries with a bit per cell (``open``), set for the ``probes`` nearest cells that hold tickets; written once."""
    shared = placed.sparkSession.sparkContext.broadcast((cells.pivots, np.flatnonzero(cells.count)))

    def marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots, filled = shared.value
        for batch in batches:
            if len(batch):
                open_ = np.zeros((len(batch), len(pivots)), dtype=bool)
                np.put_along_axis(open_, nearest_cells(matrix(batch["vec"]), pivots, filled, probes), True, axis=1)
                yield batch.assign(open=[row.tobytes() for row in np.packbits(open_, axis=1)])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    return materialize(placed.mapInPandas(marked, f"{schema}, open binary"), "opened")


def _opened_pairs(opened: DataFrame, cells: int) -> np.ndarray:
    """The pairs of a query's own cell and one that is open to it."""

    def marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            for own, bits in zip(batch["cell"], batch["open"], strict=True):
                bits = np.frombuffer(bits, np.uint8)
                seen[own] = seen[own] | bits if own in seen else bits
        yield pd.DataFrame({"cell": list(seen), "marks": [m.tobytes() for m in seen.values()]})

    met = np.zeros((cells, cells), dtype=bool)
    for r in opened.select("cell", "open").mapInPandas(marked, "cell int, marks binary").toLocalIterator():  # a bit per cell, for each cell of a task
        met[r["cell"]] |= np.unpackbits(np.frombuffer(r["marks"], np.uint8), count=cells).astype(bool)
    return np.argwhere(met)


def _turns(asked: DataFrame, cells: Cells) -> DataFrame:
    """A row per query and cell of its list ``hit``: the cell's ``turn`` among those that hold tickets, counted from 1, nearest first."""
    shared = asked.sparkSession.sparkContext.broadcast((cells.pivots, np.flatnonzero(cells.count)))

    def turn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots, filled = shared.value
        for batch in batches:
            if len(batch):
                best = nearest_cells(matrix(batch["vec"]), pivots, filled, len(filled))
                order = np.zeros((len(batch), len(pivots)), dtype=np.int32)
                np.put_along_axis(order, best, np.arange(1, len(filled) + 1, dtype=np.int32)[None], axis=1)
                yield pd.DataFrame({"turn": np.concatenate([row[hit] for row, hit in zip(order, batch["hit"], strict=True)])})

    return asked.select("vec", "hit").mapInPandas(turn, "turn int")


def recall(found: DataFrame, exact: DataFrame, query_key: str = "Query_ID", key: str = "Ticket_ID") -> DataFrame:
    """One row: Queries, and the Recall, the share of the exact hits that were found (null without any)."""
    hits = exact.select(col(query_key), col(key)).join(found.select(col(query_key), col(key), F.lit(1).alias("hit")), [query_key, key], "left")
    return hits.agg(F.count_distinct(col(query_key)).alias("Queries"), F.avg(F.coalesce("hit", F.lit(0))).alias("Recall"))
