from datetime import datetime as D

from pyspark.sql import functions as F

from migratrace import names as N
from migratrace.functions.columns import number
from migratrace.operators.normalize import normalize, with_days_from_migration, with_severity

RAW = (
    "`Number` string, `Business service` string, `Impacted OpCo` string, `Assignment group` string, `Short description` string, "
    "`Description` string, `Close notes` string, `Additional comments` string, `Priority` string, `Created` string, `Closed` string, "
    "`Reopen count` string, `System_Type` string, `System_Subtype` string, `Primary_System` string, `label_confidence` double, "
    "`label_source` string, `post_migration_noise` boolean"
)


def row(number, created, closed=None, priority=None, system="DBB", sub="DBB-OTD", notes=None, comments=None, reopens=None):
    return (number, None, None, None, None, None, notes, comments, priority, created, closed, reopens, system, sub, "None", 1.0, "x", False)


def test_edges(spark):
    rows = [
        row("a", "2024-01-10 12:00:00", "2024-01-10 15:00:00", "1 - Critical", notes="fixed", comments="thanks", reopens="2"),
        row("b", "2024-01-10 12:00:00", "2024-01-09 12:00:00", "2 - High"),
        row("c", "not a date", "2024-01-09 12:00:00", "odd"),
        row("d", "2024-01-10 00:00:00", None, None, system="Legacy", sub="Legacy-SAP", reopens="x"),
        row("e", "31/01/2024", "01/02/2024", "4 - Low", system="Legacy", sub="Legacy-SAP"),
    ]
    out = normalize(spark.createDataFrame(rows, RAW))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in N.CANONICAL_SCHEMA]
    got = {r["Ticket_ID"]: r for r in out.collect()}
    assert got["a"]["Resolution_Notes"] == "fixed thanks" and got["b"]["Resolution_Notes"] == " "
    assert got["a"]["Time_to_Resolve"] == 3.0 and got["b"]["Time_to_Resolve"] == 0.1
    assert got["c"]["Created_Date"] is None and got["c"]["Time_to_Resolve"] is None and got["c"]["Days_from_Migration"] is None
    assert [got[k]["Severity"] for k in "abcde"] == [4.0, 3.0, 1.0, 1.0, 1.0]
    assert got["a"]["Reopen_Flag"] is True and got["d"]["Reopen_Count"] == 0.0
    assert got["d"]["Days_from_Migration"] == -1  # 12 hours before the global date
    assert got["e"]["Created_Date"] == D(2024, 1, 31) and got["e"]["Time_to_Resolve"] == 24.0
    assert got["a"]["Week"] == D(2024, 1, 8) and got["a"]["Month"] == D(2024, 1, 1)
    assert got["a"]["Domain"] == "Unknown" and got["a"]["OpCo"] == N.DEFAULT_OPCO and got["a"]["Assignee_Team"] == "Unknown"


def test_severity_digits_only_when_no_text_matches(spark):
    def severities(values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, Priority string")
        return [r["Severity"] for r in with_severity(df).orderBy("i").collect()]

    assert severities(["1-URGENT", "10", "P3", "none", None]) == [4.0, -5.0, 2.0, 1.0, 1.0]
    assert severities(["1-URGENT", "4 - Low"]) == [1.0, 1.0]
    assert severities([None, None]) == [1.0, 1.0]


def test_days_use_the_module_date_then_the_global_one(spark):
    rows = [
        ("DBB-A", "DBB", "2024-01-10 00:00:00"), ("DBB-B", "DBB", "2024-01-05 00:00:00"), ("DBB-A", "Both", "2024-01-12 06:00:00"),
        ("Other", "DBB", "2024-01-01 00:00:00"), ("Legacy-X", "Legacy", "2023-12-31 12:00:00"), ("DBB-C", "Legacy", "2024-01-03 00:00:00"),
        (None, "Legacy", "2024-01-02 00:00:00"),
    ]
    df = spark.createDataFrame(rows, "Module string, System_Type string, t string").withColumn("Created_Date", F.col("t").cast("timestamp_ntz"))
    got = {(r["Module"], r["t"]): r["Days_from_Migration"] for r in with_days_from_migration(df).collect()}
    assert list(got[(m, t)] for m, _, t in rows) == [0, 0, 2, 0, -1, 2, 1]


def test_numbers(spark):
    values = [" 2 ", "1e1", "1d", "nan", "x", None, "-3.5"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    assert [r[0] for r in df.orderBy("i").select(number(F.col("c"))).collect()] == [2.0, 10.0, None, None, None, None, -3.5]


def test_no_new_system_means_no_days(spark):
    df = spark.createDataFrame([("Legacy-X", "Legacy", "2024-01-01")], "Module string, System_Type string, t string").withColumn(
        "Created_Date", F.col("t").cast("timestamp_ntz")
    )
    assert [r["Days_from_Migration"] for r in with_days_from_migration(df).collect()] == [None]
