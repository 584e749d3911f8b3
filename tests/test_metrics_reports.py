from datetime import datetime as D

import pytest
from pyspark.sql import functions as F

from migratrace.operators.facts import headline_totals, monthly_crosstab
from migratrace.operators.metrics import cluster_metrics, domain_module_pivot, is_stale_metric, refresh_metrics
from migratrace.operators.personas import assign_personas
from migratrace.operators.profile import date_ranges, id_prefixes, number_range, value_counts
from migratrace.plans import reports as R

TICKETS = (
    "Ticket_ID string, Cluster_ID int, System_Type string, Severity double, Time_to_Resolve double, Reopen_Flag boolean, "
    "post_migration_noise boolean, Domain string, Module string, OpCo string, Created_Date timestamp_ntz"
)


@pytest.fixture(scope="module")
def tickets(spark):
    def t(i, cluster, system, severity=1.0, ttr=None, reopened=False, noise=False, domain="Net", module="M", opco="X", created=D(2024, 1, 5)):
        return (f"T{i:03d}", cluster, system, severity, ttr, reopened, noise, domain, module, opco, created)

    rows = [
        t(1, 0, "Legacy", 4.0, 10.0, True), t(2, 0, "Legacy", 2.0, 20.0), t(3, 0, "DBB", 3.0, None, True, True), t(4, 0, "DBB", 1.0, 5.0),
        t(5, 0, "DBB", 1.0, 6.0), t(6, 1, "Both"), t(7, 1, "Both", created=None), t(8, 2, "DBB", 2.0, 1.0, True, domain=None, module=None),
        t(9, -1, "Legacy", 1.0, 1.0, True), t(10, 3, "Legacy", 1.0, 30.0, opco=None), t(11, 3, "Unknown"),
    ]
    return spark.createDataFrame(rows, TICKETS).cache()


def by(df, key="Cluster_ID"):
    return {r[key]: r for r in df.collect()}


def test_cluster_metrics(tickets):
    m = by(cluster_metrics(tickets))
    assert set(m) == {0, 1, 2, 3}
    assert (m[0]["Frequency_Legacy"], m[0]["Frequency_DBB"], m[0]["Reduction_Rate"]) == (2, 3, -0.5)
    assert (m[0]["Impact_Legacy"], m[0]["Impact_DBB"]) == (6.0, 5.0)
    assert (m[0]["AvgTTR_Legacy_Hours"], m[0]["AvgTTR_DBB_Hours"], m[0]["AvgTTR_Delta_Hours"]) == (15.0, 5.5, -9.5)
    assert m[0]["ReopenRate_Delta"] == -0.167
    assert m[0]["PostMigrationNoiseFlag"] is False  # exactly one in five
    assert (m[1]["Frequency_Legacy"], m[1]["Frequency_DBB"], m[1]["Impact_DBB"], m[1]["Reduction_Rate"]) == (0, 0, 0.0, None)
    assert m[2]["Reduction_Rate"] is None and m[2]["ReopenRate_Delta"] is None and m[3]["Reduction_Rate"] == 1.0


def test_refresh_twice_is_once(spark, tickets):
    catalog = spark.createDataFrame([(0, "k", 1.0, 2, 3), (9, "z", 1.0, 2, 3)], "Cluster_ID int, Top_Keywords string, Impact_DBB double, Size_x int, Reduction_Rate_old int")
    metrics = cluster_metrics(tickets)
    once = refresh_metrics(catalog, metrics)
    twice = refresh_metrics(once, metrics)
    assert once.columns == twice.columns and sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))
    assert set(catalog.columns) - set(once.columns) == {"Size_x", "Reduction_Rate_old"}
    assert by(once)[9]["Frequency_DBB"] is None
    assert is_stale_metric("Impact_DBB_2") and not is_stale_metric("Impact")


def test_pivot_and_totals(tickets):
    p = domain_module_pivot(tickets).collect()
    assert len(p) == 1 and (p[0]["Both"], p[0]["DBB"], p[0]["Legacy"], p[0]["Unknown"]) == (2, 3, 4, 1)
    assert p[0]["Reduction_Rate"] == 0.25
    h = headline_totals(tickets).first()
    assert (h["Total_Tickets"], h["Legacy_Tickets"], h["DBB_Tickets"], h["Clusters"]) == (11, 4, 4, 4)


def test_missing_month_takes_a_place(tickets):
    months = [r["YearMonth"] for r in monthly_crosstab(tickets).collect()]
    assert months == ["2024-01", "NaT"]
    assert [r["YearMonth"] for r in monthly_crosstab(tickets, months=1).collect()] == ["NaT"]


def test_drilldown_and_opco_names(spark, tickets):
    catalog = spark.createDataFrame([(0, "kw0", ""), (2, "kw2", "Two")], "Cluster_ID int, Top_Keywords string, Cluster_Name string")
    rows = R.reopened_drilldown(tickets, catalog).collect()
    assert [(r["Cluster_ID"], r["Pattern"], r["Reopened_Tickets"], r["Reopen_Rate_Text"]) for r in rows] == [
        (0, "kw0", 2, "40.0%"), (-1, "Noise / Unclustered", 1, "100.0%"), (2, "Two", 1, "100.0%")
    ]
    cells = {(r["Pattern"], r["OpCo"]): r["Count"] for r in R.opco_heatmap(tickets, catalog).collect()}
    assert cells == {("kw0", "X"): 5, ("Two", "X"): 1}
    timeline = R.cluster_timeline(tickets, over=4).collect()
    assert {(r["Cluster_ID"], r["System_Type"], r["Count"]) for r in timeline} == {(0, "Legacy", 2), (0, "DBB", 3)}
    assert R.cluster_timeline(tickets).count() == 0  # five tickets are not more than five


def test_trends_and_card(spark):
    catalog = spark.createDataFrame(
        [(0, 2, 3, "a", "w", None, 10.0, 48.0, 38.0), (1, 0, 4, "b", "", "P", None, 5.0, None), (2, 4, 0, None, None, "", 5.0, None, None), (3, 0, 0, "d", "x", None, 1.0, 1.0, 0.0), (-1, 5, 5, "n", "", None, None, None, None)],
        "Cluster_ID int, Frequency_Legacy long, Frequency_DBB long, Cluster_Name string, Analysis string, Strategic_Persona string, "
        "AvgTTR_Legacy_Hours double, AvgTTR_DBB_Hours double, AvgTTR_Delta_Hours double",
    ).withColumns({"Size": F.lit(1), "Top_Keywords": F.lit("k"), "Primary_Domains": F.lit("d")})
    assert {c: r["Trend"] for c, r in by(R.trend_verdict(catalog)).items()} == {0: "+50%", 1: "New in DBB", 2: "Eliminated", 3: "-"}
    assert set(by(R.introduced_patterns(catalog))) == {1, 3} and set(by(R.eliminated_patterns(catalog))) == {2, 3}
    assert set(by(R.root_cause_map(catalog))) == {0, 3}
    again = R.reappeared_patterns(catalog).collect()
    assert [(r["Cluster_ID"], r["Change_vs_Legacy"], r["DBB_Share"], r["Outcome"]) for r in again] == [(0, "+50%", "60.0%", "worse")]
    cards = by(R.cluster_card(catalog))
    assert (cards[0]["Legacy_MTTR"], cards[0]["DBB_MTTR"], cards[0]["MTTR_Delta"], cards[0]["MTTR_Verdict"]) == ("10.0h", "2.0d", "1.6d", "DBB slower")
    assert cards[1]["MTTR_Verdict"] == "No comparison" and cards[3]["MTTR_Verdict"] == "No comparison"
    assert {c: r["Label"] for c, r in by(R.cluster_labels(catalog)).items()} == {0: "a", 1: "[P] b", 2: None, 3: "d"}


def test_personas_are_taken_once(spark):
    rows = [(0, 100, 50, 10, 0.8, 0.5), (1, 90, 40, 60, -0.5, 0.1), (2, 80, 0, 9, None, None), (3, 70, 8, 0, 1.0, None), (4, 60, 0, 0, None, None)]
    catalog = spark.createDataFrame(rows, "Cluster_ID int, Size long, Frequency_Legacy long, Frequency_DBB long, Reduction_Rate double, ReopenRate_Delta double")
    got = {c: r["Strategic_Persona"] for c, r in by(assign_personas(catalog)).items()}
    assert got == {0: "The Chronic Defect", 1: "The DBB Pollutant", 2: "The Automation Goldmine", 3: "The Legacy Anchor", 4: "The New DBB Headache"}


def test_profiles(spark):
    df = spark.createDataFrame([("INC007", "2024-01-01"), ("INC12", "x"), ("7", None), ("REQ5a", "2023-05-05")], "Number string, Created string")
    assert {r["num_prefix"]: r["count"] for r in id_prefixes(df).collect()} == {"INC": 2, "REQ": 1}
    assert tuple(number_range(df).first()) == (7, 12)
    assert date_ranges(df).first()[0] == D(2023, 5, 5) and date_ranges(df).columns == ["min_Created", "max_Created"]
    assert [r["count"] for r in value_counts(df, ["Created"]).collect()] == [1, 1, 1]
