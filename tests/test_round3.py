from pyspark.sql import functions as F

from migratrace.operators import generate as G


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _replies(spark):
    whole = '{"key_findings": [{"title": "t", "impact": "low"}, {"detail": "d"}], "shift_left_opportunities": [{"pattern": "p"}]}'
    rows = [
        (1, whole, None), (2, f"```json\n{whole}\n```", None), (3, f"See: {whole} - done", None), (4, f"[{whole}]", None),
        (5, f"{whole} {whole}", None), (6, "{ broken", None), (7, '{"key_findings": null}', None), (8, "", None), (9, None, "E: x"), (9, whole, None),
    ]
    return spark.createDataFrame(rows, "k int, Reply string, Error string").repartition(3)


def test_replies_are_parsed_once_per_row(spark):
    """The parse, and the steps before it, stand once in the plan of the rows of a list."""
    for field in ("key_findings", "shift_left_opportunities"):
        plan = _plan(G.summary_rows(G.parse_summary(_replies(spark)), field))
        assert plan.count("from_json") == 1
        assert plan.count("regexp_extract(") == 1


def test_rows_of_all_kinds_of_replies(spark):
    parsed = G.parse_summary(_replies(spark))
    findings = [tuple(r) for r in G.summary_rows(parsed, "key_findings").orderBy("k", "Position").collect()]
    assert findings == [row for k in (1, 2, 3, 9) for row in ((k, 0, "t", "", "low"), (k, 1, "", "d", ""))]
    shifts = [tuple(r) for r in G.summary_rows(parsed, "shift_left_opportunities").orderBy("k").collect()]
    assert shifts == [(k, 0, "p", "", "?") for k in (1, 2, 3, 9)]


def test_summaries_are_dealt_out(spark, tmp_path):
    """A customer file of one split is parsed by as many tasks as there are shuffle partitions."""
    from migratrace.registry.q_generate import key_findings

    spark.range(100).select(
        F.col("id").alias("c_custkey"), F.concat(F.lit("n"), "id").alias("c_name"), F.lit(1).alias("c_nationkey")
    ).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    df = key_findings(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert df.count() == 2 * 34


def _local_shuffle_bytes(spark):
    import os

    folder = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]
    return sum(os.path.getsize(f"{d}/{f}") for d, _, files in os.walk(folder) for f in files if f.startswith("shuffle_") and f.endswith(".data"))


def test_written_tables_leave_no_shuffle_files(spark):
    import time

    from migratrace.session import materialize

    before = _local_shuffle_bytes(spark)
    assert materialize(spark.range(200_000).repartition(7, "id"), "shuffled").count() == 200_000
    for _ in range(50):
        if _local_shuffle_bytes(spark) - before < 50_000:
            break
        time.sleep(0.2)
    assert _local_shuffle_bytes(spark) - before < 50_000


def test_tables_made_inside_scratch_are_deleted(spark):
    from migratrace.session import materialize, scratch

    with scratch(spark) as lasting:
        inner = materialize(spark.range(3), "inner")
        kept = materialize(inner, "kept", lasting)
        gone = inner.inputFiles()[0].removeprefix("file://")
    assert kept.count() == 3
    import os

    assert not os.path.exists(gone) and not os.path.exists(os.path.dirname(os.path.dirname(gone)))


def test_pairs_of_tiles_in_rounds_give_the_same(spark, monkeypatch):
    """Rounds send a bounded part at once; neighbours and tree stay what they are in one go."""
    import numpy as np

    from migratrace.operators import blocks, density, neighbours, spanning

    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(0, 6, 4)], 1) for i in range(300)]
    points = spark.createDataFrame(rows, "id long, vec array<double>, n long")

    def results():
        placed, cells = density.blocked_points(points, 300, per_block=16)
        cored = density.with_core(placed, cells, 3, per_block=16)
        tree = spanning.spanning_tree(spanning.candidate_edges(cored, cells, per_block=16))
        near = neighbours.nearest_in_blocks(placed, cells, placed, cells, 4, per_block=16).select("id", "other", "rank")
        return sorted(map(tuple, near.collect())), sorted((r["id"], r["core"]) for r in cored.collect()), sorted(r["w"] for r in tree.collect())

    whole = results()
    sent = []
    meet = blocks._meet

    def counted(left, right, pairs, *rest):
        sent.append(pairs.count())
        return meet(left, right, pairs, *rest)

    monkeypatch.setattr(blocks, "_meet", counted)
    monkeypatch.setattr(blocks, "SENT_AT_ONCE", 1)
    monkeypatch.setattr(neighbours, "pairs_wanted", lambda spark: 200)
    monkeypatch.setattr(spanning, "pairs_wanted", lambda spark: 200)
    monkeypatch.setattr(blocks, "pairs_wanted", lambda spark: 5)
    rounds = results()
    assert len(sent) > 6
    assert rounds == whole
