"""Counts that lose nothing, dates by column, stages without rows, finite vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from migratrace.functions.columns import DAY_FIRST, MONTH_FIRST, date_formats, parse_timestamp
from migratrace.plans.study import classify_export, normalize_export
from migratrace.operators.classify import flag_migration_noise
from migratrace.operators.blocks import pairwise
from migratrace.operators.facts import domain_crosstab, severity_crosstab
from migratrace.operators.neighbours import best_cosines
from migratrace.operators.retrieve import top_k_similar
from migratrace.operators.rules import Contains, Rule, system_types
from migratrace.sources import tables as S


def parsed(spark, values, formats):
    df = spark.createDataFrame([(v,) for v in values], "d string")
    return [str(r[0]) if r[0] else None for r in df.select(parse_timestamp(F.col("d"), formats)).collect()]


def test_dates_of_an_export_are_read_in_the_order_that_reads_more_of_them(spark):
    values = [("05/01/2024 10:30", "13/05/2024", "2024-05-01"), ("05/01/2024", "20/01/2024", "03/04/2024")]
    df = spark.createDataFrame(values, "a string, b string, c string")
    assert date_formats(df, ["a", "b", "c", "none"]) == dict.fromkeys("abc", DAY_FIRST)
    assert date_formats(df, ["a", "c"]) == dict.fromkeys("ac", MONTH_FIRST) and date_formats(df, ["none"]) == {}


def test_an_export_with_one_undecided_column_gets_its_hours_right(spark):
    rows = [("1", "Payroll", "05/01/2024 08:00", "13/01/2024 08:00"), ("2", "Payroll", "03/02/2024", "20/02/2024")]
    raw = spark.createDataFrame(rows, "Number string, `Business Service` string, Created string, Closed string")
    canonical = normalize_export(classify_export(raw)).orderBy("Ticket_ID").collect()
    assert [str(r["Created_Date"]) for r in canonical] == ["2024-01-05 08:00:00", "2024-02-03 00:00:00"]
    assert [r["Time_to_Resolve"] for r in canonical] == [192.0, 408.0]


def test_both_orders_read_their_own_texts(spark):
    assert parsed(spark, ["05/13/2024 10:30", "5/1/2024 1:05:09 PM"], MONTH_FIRST) == ["2024-05-13 10:30:00", "2024-05-01 13:05:09"]
    assert parsed(spark, ["13-05-2024 10:30:01", "13/05/2024"], DAY_FIRST) == ["2024-05-13 10:30:01", "2024-05-13 00:00:00"]
    assert parsed(spark, ["45321", "2024", "20240501", " 2024-05-01 ", "", None], DAY_FIRST) == [
        None, None, None, "2024-05-01 00:00:00", None, None,
    ]


def test_noise_flag_reads_the_given_formats(spark):
    df = spark.createDataFrame(
        [("05/13/2024", "0", "DBB"), ("05/20/2024", "2", "Legacy"), ("12/31/2024", "1", "DBB")],
        "Created string, `Reopen count` string, System_Type string",
    )
    assert [r["post_migration_noise"] for r in flag_migration_noise(df, formats=MONTH_FIRST).collect()] == [False, True, False]


def test_crosstabs_hold_every_ticket(spark):
    rows = [("DBB", 0.0, "A"), ("DBB", 4.0, "A"), ("Hosted", None, "A"), (None, 2.0, "B")]
    df = spark.createDataFrame(rows, "System_Type string, Severity double, Domain string")
    table = {r["System_Type"]: r for r in severity_crosstab(df).collect()}
    assert (table["DBB"]["Other"], table["DBB"]["4.0"], table["Hosted"]["Other"]) == (1, 1, 1)
    domains = {r["Domain"]: r.asDict() for r in domain_crosstab(df).collect()}
    assert {d: sum(v for k, v in r.items() if k != "Domain") for d, r in domains.items()} == {"A": 3, "B": 1}
    rule = Rule(((Contains("Service offering", "x"),),), "Hosted", "Hosted", 0.9, "own")
    assert system_types([rule]) == ("Hosted", "Unknown")


def test_a_stage_without_rows_replaces_the_old_one(spark, tmp_path):
    base, none = str(tmp_path), spark.range(0).withColumn("x", F.lit("a"))
    S.write_stage(none, base, "queue", "first time: 100%")
    assert S.read_stage(spark, base, "queue", "first time: 100%").columns == ["id", "x"]
    S.write_stage(spark.range(3).withColumn("x", F.lit("a")), base, "queue", "b")
    S.write_stage(none, base, "queue", "b")
    assert S.read_stage(spark, base, "queue", "b").count() == 0
    S.write_stage(spark.range(2).withColumn("x", F.lit("a")), base, "queue", "first time: 100%")
    assert [r[0] for r in S.list_datasets(spark, base, "queue").collect()] == ["first time: 100%"]
    assert S.read_stage(spark, base, "queue").where("dataset = 'first time: 100%'").count() == 2


def test_broken_vectors_take_no_part_and_both_plans_agree(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in draw.normal(size=5)]) for i in range(60)]
    rows += [(60, [float("nan")] * 5), (61, [1.0, None, 0.0, 0.0, 0.0]), (62, [float("inf")] * 5), (63, None), (64, [])]
    df = spark.createDataFrame(rows, "Ticket_ID long, Embedding array<double>")
    queries = df.withColumnRenamed("Ticket_ID", "Query_ID")
    plans = [sorted(map(tuple, top_k_similar(queries, df, k=3, **o).collect())) for o in ({}, {"shipped_values": 0, "per_block": 8})]
    assert plans[0] == plans[1] and len(plans[0]) == 180 and {r[0] for r in plans[0]} == set(range(60))


def test_best_cosines_do_not_depend_on_the_tiles():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(700, 9))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    rows, columns, cosines = best_cosines(x, x, 4)
    again = [best_cosines(x[i : i + 1], x, 4) for i in range(0, 700, 50)]
    for i, (_, c, s) in zip(range(0, 700, 50), again, strict=True):
        assert (c == columns[rows == i]).all() and (s == cosines[rows == i]).all()


def test_distances_survive_a_common_offset():
    draw = np.random.default_rng(5)
    x = draw.normal(scale=1e-2, size=(50, 6))
    far = pairwise(x + 1e5, x + 1e5)
    true = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    assert np.abs(far - true).max() < 1e-8
