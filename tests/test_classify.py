"""One hand-made ticket per rule, and the edges of the noise flag."""

from collections import Counter

import pytest

from migratrace.operators.classify import class_distribution, classify, flag_migration_noise, review_queue
from migratrace.operators.rules import DEFAULT_RULES, Rule, equals

SCHEMA = (
    "`Number` string, `Configuration item` string, `Service offering` string, `Assignment group` string, "
    "`Business service` string, `Short description` string, `Created` string, `Reopen count` string"
)

# ci, offering, group, service, short description -> type, subtype, confidence, source
CASES = [
    (("OTD Production", "POSM Non-DBB", None, "Middleware", None), ("Legacy", "Legacy-Other", 1.0, "rule-service")),
    ((None, None, None, "MIDDLEWARE", None), ("Both", "Middleware-ESB", 1.0, "rule-middleware")),
    (("Digital Integration", None, None, None, None), ("Both", "Middleware-ESB", 1.0, "rule-middleware")),
    (("Solace", None, None, None, None), ("Both", "Middleware-ESB", 1.0, "rule-middleware")),
    ((None, "Commerce Integration", None, None, None), ("Both", "Middleware-ESB", 1.0, "rule-middleware")),
    ((None, "Finance Technology Integration", None, None, None), ("Both", "Middleware-ESB", 1.0, "rule-middleware")),
    ((None, None, "Commerce Integration", None, None), ("Both", "Middleware-ESB", 1.0, "rule-middleware")),
    (("my OTD Production", None, None, None, "GlassRun down"), ("DBB", "DBB-GlassRun", 1.0, "rule-config+text")),
    (("OTD Production", None, None, None, None), ("DBB", "DBB-OTD", 1.0, "rule-config")),
    (("Tiger Tribe", None, None, None, None), ("DBB", "DBB-OMNI", 1.0, "rule-config")),
    (("Assembly line", None, None, None, None), ("DBB", "DBB-SEM", 1.0, "rule-config")),
    (("Dynamics 365", None, None, None, None), ("DBB", "DBB-SEM", 1.0, "rule-config")),
    (("VirtoCommerce", None, None, None, None), ("DBB", "DBB-DOT", 1.0, "rule-config")),
    (("DOT for B2B", None, None, None, None), ("DBB", "DBB-DOT", 1.0, "rule-config")),
    (("B2B only", None, None, None, None), ("Unknown", "Unknown", 0.0, "none")),
    (("D&A Hub", None, None, None, None), ("DBB", "DBB-DA", 1.0, "rule-config")),
    (("Qualass", None, None, None, None), ("Legacy", "Legacy-SAP", 1.0, "rule-config")),
    (("ISUB 3", None, None, None, None), ("Legacy", "Legacy-Network", 1.0, "rule-config")),
    ((None, "OTD core", None, None, None), ("DBB", "DBB-OTD", 0.95, "rule-service")),
    ((None, "OTD", None, None, None), ("Unknown", "Unknown", 0.0, "none")),
    ((None, "Omni", None, None, None), ("DBB", "DBB-OMNI", 0.95, "rule-service")),
    ((None, "SEM sales", None, None, None), ("DBB", "DBB-SEM", 0.95, "rule-service")),
    ((None, "DOT shop", None, None, None), ("DBB", "DBB-DOT", 0.95, "rule-service")),
    ((None, "D&A Hub", None, None, None), ("DBB", "DBB-DA", 0.95, "rule-service")),
    ((None, "B2Gaas", None, None, None), ("DBB", "DBB-Eazle", 0.95, "rule-service")),
    ((None, "RTR", None, None, None), ("Legacy", "Legacy-SAP", 0.95, "rule-service")),
    ((None, "SDWAN", None, None, None), ("Legacy", "Legacy-Network", 0.95, "rule-service")),
    ((None, "download tool", None, None, None), ("Legacy", "Legacy-Workplace", 0.95, "rule-service")),
    ((None, "Anti Virus", None, None, None), ("Legacy", "Legacy-Security", 0.95, "rule-service")),
    ((None, "OneDrive", None, None, None), ("Legacy", "Legacy-Collaboration", 0.95, "rule-service")),
    ((None, "HeiFund", None, None, None), ("Legacy", "Legacy-Finance", 0.95, "rule-service")),
    ((None, None, "OTD Support Tiger", None, None), ("DBB", "DBB-OMNI", 0.85, "rule-assignment")),
    ((None, None, "OTD Support", None, None), ("DBB", "DBB-OTD", 0.85, "rule-assignment")),
    ((None, None, "OMNI Support", None, None), ("DBB", "DBB-OMNI", 0.85, "rule-assignment")),
    ((None, None, "SEM DevOps", None, None), ("DBB", "DBB-SEM", 0.85, "rule-assignment")),
    ((None, None, "DOT Infosys", None, None), ("DBB", "DBB-DOT", 0.85, "rule-assignment")),
    ((None, None, "D&A Hub", None, None), ("DBB", "DBB-DA", 0.85, "rule-assignment")),
    ((None, None, "GIS Orange", None, None), ("Legacy", "Legacy-Network", 0.85, "rule-assignment")),
    ((None, None, "ERP SAP", None, None), ("Legacy", "Legacy-SAP", 0.85, "rule-assignment")),
    ((None, None, "T-Systems", None, None), ("Legacy", "Legacy-Workplace", 0.85, "rule-assignment")),
    ((None, None, None, "Market to Cash (MTC)", None), ("DBB", "DBB-Other", 0.7, "rule-business")),
    ((None, None, None, "Network", None), ("Legacy", "Legacy-Network", 0.7, "rule-business")),
    ((None, None, None, " Network", None), ("Unknown", "Unknown", 0.0, "none")),
    ((None, None, None, "Hosting SAP", None), ("Legacy", "Legacy-SAP", 0.7, "rule-business")),
    ((None, None, None, "Collaboration", None), ("Legacy", "Legacy-Workplace", 0.7, "rule-business")),
    ((None, None, None, "GSD (ITSM) Service", None), ("Legacy", "Legacy-ITSM", 0.7, "rule-business")),
    ((None, None, None, None, "Glassrun"), ("DBB", "DBB-GlassRun", 0.6, "rule-text")),
    ((None, None, None, None, "omni"), ("DBB", "DBB-OMNI", 0.6, "rule-text")),
    ((None, None, None, None, None), ("Unknown", "Unknown", 0.0, "none")),
]


def test_every_rule(spark):
    rows = [(str(i), *inputs, None, None) for i, (inputs, _) in enumerate(CASES)]
    got = {int(r["Number"]): r for r in classify(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, (inputs, want) in enumerate(CASES):
        r = got[i]
        assert (r["System_Type"], r["System_Subtype"], r["label_confidence"], r["label_source"]) == want, inputs
        assert r["Primary_System"] == ("Integration" if want[0] == "Both" else "None")
        assert r["mapping_version"] == "v2.0" and r["human_override_flag"] is False
    assert {w[3] for _, w in CASES} == {r.source for r in DEFAULT_RULES} | {"none"}


def test_own_rules_and_missing_columns(spark):
    rules = (Rule(equals("Team", "it's a \\ team"), "New", "New-Sub", 0.5, "own", primary="P"),)
    df = spark.createDataFrame([("It's a \\ Team",), ("other",)], "Team string")
    got = {r["Team"]: r["System_Type"] for r in classify(df, rules).collect()}
    assert got == {"It's a \\ Team": "New", "other": "Unknown"}
    assert {r["System_Type"] for r in classify(df).collect()} == {"Unknown"}


def test_noise_window_is_inclusive_and_for_all_systems(spark):
    rows = [
        ("first", "OTD Production", "2024-01-01 00:00:00", "0"),
        ("at start", None, "2024-01-01 00:00:00", "1"),
        ("day 90", "Fiori", "2024-03-31 00:00:00", "2"),
        ("after", "Fiori", "2024-03-31 00:00:01", "2"),
        ("before", "Fiori", "2023-12-31 23:59:59", "2"),
        ("half", "Fiori", "2024-01-02 00:00:00", "0.5"),
        ("no date", "Fiori", "soon", "3"),
        ("no count", "Fiori", "2024-01-02 00:00:00", None),
    ]
    df = spark.createDataFrame(rows, "`Number` string, `Configuration item` string, `Created` string, `Reopen count` string")
    flagged = {r["Number"] for r in flag_migration_noise(classify(df)).where("post_migration_noise").collect()}
    assert flagged == {"at start", "day 90"}
    none = flag_migration_noise(classify(df.where("`Configuration item` = 'Fiori'")))
    assert none.where("post_migration_noise").count() == 0


def test_queue_and_distribution(spark):
    rows = [(str(i), *inputs, None, None) for i, (inputs, _) in enumerate(CASES)]
    done = classify(spark.createDataFrame(rows, SCHEMA))
    counts = {r["System_Type"]: r["count"] for r in class_distribution(done).collect()}
    assert sum(counts.values()) == len(CASES)
    queue = review_queue(done)
    assert queue.columns[-3:] == ["SME_Label", "SME_Notes", "override_date"]
    assert queue.count() == counts["Unknown"]


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_partition_count_does_not_matter(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = [(str(i), *inputs, None, None) for i, (inputs, _) in enumerate(CASES)]
        counts = class_distribution(classify(spark.createDataFrame(rows, SCHEMA))).collect()
        want = Counter(labels[0] for _, labels in CASES)
        assert {r["System_Type"]: r["count"] for r in counts} == dict(want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
