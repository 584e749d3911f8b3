"""The index of ticket vectors: exact search, appended batches, pruned cells, and the approximate mode."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from migratrace.operators import vector_index
from migratrace.operators.retrieve import top_k_similar
from migratrace.operators.vector_index import VectorIndex, recall


def vectors(spark, x, name="Ticket_ID", first=0):
    rows = [(first + i, [float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, f"{name} int, Embedding array<double>")


def found(df):
    return {(r["Query_ID"], r["Ticket_ID"], r["Rank"]): round(r["Similarity"], 9) for r in df.collect()}


@pytest.fixture
def points():
    x = np.random.default_rng(3).normal(size=(240, 6))
    x[5] = 0.0
    x[20:100] = x[20]  # a third are copies
    return x


def test_search_equals_the_scan_after_every_append(spark, tmp_path, points):
    queries = vectors(spark, np.vstack([points[::12], np.zeros((1, 6)), points[20:21] * 2]), "Query_ID")
    index = VectorIndex.build(vectors(spark, points[:150]), str(tmp_path / "index"), per_block=16, max_cells=7)
    assert found(index.search(queries)) == found(top_k_similar(queries, vectors(spark, points[:150])))
    odd = spark.createDataFrame([(900, None), (901, [float("nan")] * 6)], "Ticket_ID int, Embedding array<double>")
    VectorIndex(spark, index.folder, 16).append(vectors(spark, points[150:], first=150).unionByName(odd))
    opened = VectorIndex(spark, index.folder, 16)
    assert found(opened.search(queries)) == found(top_k_similar(queries, vectors(spark, points)))
    assert opened.search(queries.limit(0)).collect() == []


def test_a_stopped_append_does_not_count(spark, tmp_path, points):
    index = VectorIndex.build(vectors(spark, points), str(tmp_path / "index"), per_block=16)
    lost = spark.range(1).select(F.lit(-1).alias("id"), F.array(*[F.lit(1.0)] * 8).alias("vec"), F.lit(0.0).alias("reach"), F.lit(0).alias("cell"))
    lost.write.partitionBy("cell").parquet(f"{index.folder}/rows/batch=unfinished")
    queries = vectors(spark, points[:30], "Query_ID")
    assert found(index.search(queries)) == found(top_k_similar(queries, vectors(spark, points)))


def test_cells_out_of_reach_are_not_read(spark, tmp_path, monkeypatch):
    draw = np.random.default_rng(4)
    far = np.repeat(np.eye(8), 40, axis=0) + draw.normal(size=(320, 8)) * 0.001
    index = VectorIndex.build(vectors(spark, far), str(tmp_path / "index"), per_block=8)
    read, plain = [], VectorIndex.rows_of

    def watched(self, batches, cells):
        read.append(cells)
        return plain(self, batches, cells)

    monkeypatch.setattr(VectorIndex, "rows_of", watched)
    queries = vectors(spark, far[:10], "Query_ID")
    got = found(index.search(queries))
    assert got == found(top_k_similar(queries, vectors(spark, far)))
    # the queries are of one of eight groups
    assert 0 < len(read[0]) <= len(index._pivots()[0]) / 2


def test_probes_reach_the_recall_they_were_chosen_for(spark, tmp_path, points):
    queries, tickets = vectors(spark, points, "Query_ID"), vectors(spark, points)
    index = VectorIndex.build(tickets, str(tmp_path / "index"), per_block=16)
    exact = top_k_similar(queries, tickets)
    probes = index.probes_for(queries, 0.95)
    shares = [recall(index.search(queries, probes=p), exact).first() for p in (max(probes - 1, 1), probes)]
    assert shares[1]["Queries"] == 240 and shares[1]["Recall"] >= 0.95
    assert probes == 1 or shares[0]["Recall"] < 0.95
    assert 1 <= probes < len(index._pivots()[0])


def test_probes_are_counted_over_hits_and_the_stored_vectors_are_read_once(spark, tmp_path, monkeypatch, points):
    queries = vectors(spark, points, "Query_ID")
    index = VectorIndex.build(vectors(spark, points[:150]), str(tmp_path / "index"), per_block=16)
    index.append(vectors(spark, points[150:], first=150))
    counted, turns, written, write = [], vector_index._turns, [], vector_index.materialize
    monkeypatch.setattr(vector_index, "_turns", lambda *args: counted.append(turns(*args)) or counted[-1])
    monkeypatch.setattr(vector_index, "materialize", lambda df, label="step": written.append(label) or write(df, label))
    probes = index.probes_for(queries, 0.95, k=3)
    # a row per hit, not one per query and cell
    assert counted[0].count() == 3 * len(points)
    assert len(index._batches) == 2
    index.search(queries, 3, probes=probes).collect()
    assert written.count("stored") == 1


def test_without_vectors(spark, tmp_path):
    none = spark.createDataFrame([(1, None)], "Ticket_ID int, Embedding array<double>")
    with pytest.raises(ValueError, match="no ticket"):
        VectorIndex.build(none, str(tmp_path / "index"))


def test_probes_are_not_chosen_on_the_pivots_themselves(spark, tmp_path):
    """Queries that are pivots find more in their own cell than the others do."""
    x = np.random.default_rng(6).normal(size=(1200, 24))
    index = VectorIndex.build(vectors(spark, x), str(tmp_path / "index"), per_block=4)
    assert len(index._pivots()[0]) == 300
    queries = vectors(spark, x, "Query_ID")
    probes = index.probes_for(queries, 0.9, sampled_queries=300)
    exact = top_k_similar(queries, vectors(spark, x))
    assert recall(index.search(queries, probes=probes), exact).first()["Recall"] >= 0.87
