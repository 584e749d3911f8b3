"""Report queries over clustered tickets and the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from migratrace.operators.metrics import cluster_metrics, refresh_metrics
from migratrace.plans import reports as R
from migratrace.registry.q_metrics import METRICS_SQL
from migratrace.registry.tickets import clustered_tickets, label_catalog, table, with_views


def _over_tickets(report):
    return lambda spark, folder: report(clustered_tickets(spark, folder))


def _over_catalog(report):
    return lambda spark, folder: report(label_catalog(clustered_tickets(spark, folder)))


def _over_both(report):
    def run(spark, folder):
        tickets = clustered_tickets(spark, folder)
        return report(tickets, label_catalog(tickets))

    return run


def cluster_card(spark, folder):
    tickets = clustered_tickets(spark, folder)
    return R.cluster_card(refresh_metrics(label_catalog(tickets), cluster_metrics(tickets)))


def verdict_badge(spark, folder):
    """One verdict per order status, an unknown one included."""
    status = F.col("o_orderstatus")
    verdict = (
        F.when(status == "F", F.lit("DBB_REDUCED_ISSUES")).when(status == "O", F.lit("MIXED_RESULTS")).otherwise(F.lit("NOT_LISTED"))
    )
    verdicts = table(spark, folder, "orders").groupBy(verdict.alias("legacy_to_dbb_verdict")).agg(F.count(F.lit(1)).alias("orders"))
    return R.verdict_badge(verdicts)


QUERIES = {
    "monthly_volume": _over_tickets(R.monthly_volume),
    "cumulative_volume": _over_tickets(R.cumulative_volume),
    "cluster_timeline": _over_tickets(R.cluster_timeline),
    "cluster_timeline_all": _over_tickets(lambda tickets: R.cluster_timeline(tickets, over=None)),
    "domain_volume": _over_tickets(R.domain_volume),
    "severity_distribution": _over_tickets(R.severity_distribution),
    "reopen_rates": _over_tickets(R.reopen_rates),
    "reopened_drilldown": _over_both(R.reopened_drilldown),
    "reopened_details": _over_tickets(R.reopened_details),
    "mttr_by_system": _over_tickets(R.mttr_by_system),
    "domain_heatmap": _over_tickets(R.domain_heatmap),
    "opco_heatmap": _over_both(R.opco_heatmap),
    "opco_recurrence": _over_both(R.opco_recurrence),
    "trend_verdict": _over_catalog(R.trend_verdict),
    "root_cause_map": _over_catalog(R.root_cause_map),
    "reappeared_patterns": _over_catalog(R.reappeared_patterns),
    "introduced_patterns": _over_catalog(R.introduced_patterns),
    "eliminated_patterns": _over_catalog(R.eliminated_patterns),
    "cluster_card": cluster_card,
    "cluster_labels": _over_catalog(R.cluster_labels),
    "cluster_samples": _over_tickets(R.cluster_samples),
    "cluster_samples_detail": _over_tickets(lambda tickets: R.cluster_samples(tickets, R.DETAIL_SAMPLES)),
    "verdict_badge": verdict_badge,
}

_TWO = "\"System_Type\" IN ('Legacy', 'DBB')"
_MONTH = "strftime(\"Created_Date\", '%Y-%m')"
_REOPENED = f'({_TWO} AND "Reopen_Flag")'


def _hours(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN 'N/A' WHEN {c} < 24 THEN printf('%.1fh', round_even({c} * 10, 0) / 10) "
        f"ELSE printf('%.1fd', round_even({c} / 24 * 10, 0) / 10) END"
    )


def _percent(c: str) -> str:
    return f"printf('%.1f', round_even({c} * 100 * 10, 0) / 10) || '%'"


_NAMED = """
named AS (SELECT "Cluster_ID", coalesce(nullif("Cluster_Name", ''), nullif("Top_Keywords", '')) AS "Pattern" FROM catalog)"""
_OPCO = f"""
opco AS (
  SELECT coalesce("Pattern", 'Cluster ' || c."Cluster_ID") AS "Pattern", "OpCo", "System_Type", "Ticket_ID"
  FROM clustered c LEFT JOIN named USING ("Cluster_ID")
  WHERE {_TWO} AND c."Cluster_ID" <> -1 AND "OpCo" IS NOT NULL
)"""
_CHANGE = '(("Frequency_DBB" - "Frequency_Legacy")::DOUBLE / "Frequency_Legacy" * 100)'

SQL = {
    "monthly_volume": with_views(
        "clustered", f'SELECT {_MONTH} AS "YearMonth", "System_Type", count(*) AS "Tickets" FROM clustered WHERE {_TWO} GROUP BY 1, 2'
    ),
    "cumulative_volume": with_views(
        "clustered",
        f"""SELECT *, CAST(sum("Tickets") OVER (PARTITION BY "System_Type" ORDER BY "YearMonth") AS BIGINT) AS "Cumulative" FROM (
        SELECT {_MONTH} AS "YearMonth", "System_Type", count(*) AS "Tickets" FROM clustered WHERE {_TWO} GROUP BY 1, 2)""",
    ),
    "cluster_timeline": with_views(
        "clustered",
        f"""SELECT "Cluster_ID", {_MONTH} AS "YearMonth", "System_Type", count(*) AS "Count" FROM clustered
        WHERE {_TWO} AND "Cluster_ID" <> -1
        AND "Cluster_ID" IN (SELECT "Cluster_ID" FROM clustered GROUP BY 1 HAVING count(*) > 5) GROUP BY 1, 2, 3""",
    ),
    "cluster_timeline_all": with_views(
        "clustered",
        f"""SELECT "Cluster_ID", {_MONTH} AS "YearMonth", "System_Type", count(*) AS "Count" FROM clustered
        WHERE {_TWO} AND "Cluster_ID" <> -1 GROUP BY 1, 2, 3""",
    ),
    "domain_volume": with_views(
        "clustered", f'SELECT "Domain", "System_Type", count(*) AS "Count" FROM clustered WHERE {_TWO} GROUP BY 1, 2'
    ),
    "severity_distribution": with_views(
        "clustered",
        f"""SELECT "System_Type", "Severity", count(*) AS "Count",
        CASE "Severity" WHEN 4 THEN 'P1 - Critical' WHEN 3 THEN 'P2 - High' WHEN 2 THEN 'P3 - Medium' WHEN 1 THEN 'P4 - Low' END AS "Severity_Label"
        FROM clustered WHERE {_TWO} GROUP BY 1, 2""",
    ),
    "reopen_rates": with_views(
        "clustered",
        f"""SELECT *, {_percent('"Reopen_Rate"')} AS "Reopen_Rate_Text" FROM (
        SELECT "System_Type", count(*) FILTER (WHERE "Reopen_Flag") AS "Reopened_Tickets", count("Reopen_Flag") AS "Total_Tickets",
        count(*) FILTER (WHERE "Reopen_Flag")::DOUBLE / count("Reopen_Flag") AS "Reopen_Rate" FROM clustered WHERE {_TWO} GROUP BY 1)""",
    ),
    "reopened_drilldown": with_views(
        "catalog",
        f"""SELECT "Cluster_ID", coalesce("Pattern", 'Noise / Unclustered') AS "Pattern", "Reopened_Tickets", "Legacy_Reopened",
        "DBB_Reopened", "Cluster_Tickets", "Reopen_Rate", {_percent('"Reopen_Rate"')} AS "Reopen_Rate_Text",
        round_even(sev * 100, 0) / 100 AS "Avg_Severity", round_even(ttr * 10, 0) / 10 AS "Avg_MTTR_Hours"
        FROM (SELECT "Cluster_ID", count(*) FILTER (WHERE {_REOPENED}) AS "Reopened_Tickets",
          count(*) FILTER (WHERE {_REOPENED} AND "System_Type" = 'Legacy') AS "Legacy_Reopened",
          count(*) FILTER (WHERE {_REOPENED} AND "System_Type" = 'DBB') AS "DBB_Reopened", count(*) AS "Cluster_Tickets",
          count(*) FILTER (WHERE {_REOPENED})::DOUBLE / count(*) AS "Reopen_Rate",
          avg("Severity") FILTER (WHERE {_REOPENED}) AS sev, avg("Time_to_Resolve") FILTER (WHERE {_REOPENED}) AS ttr
          FROM clustered GROUP BY 1) LEFT JOIN named USING ("Cluster_ID")
        WHERE "Reopened_Tickets" > 0 ORDER BY "Reopened_Tickets" DESC, "Reopen_Rate" DESC, "Cluster_ID" LIMIT 15""",
        _NAMED,
    ),
    "reopened_details": with_views(
        "clustered",
        f"""SELECT "Ticket_ID", "System_Type", "System_Subtype", "Domain", "OpCo", "Short_Description", "Severity", "Reopen_Count",
        "Time_to_Resolve" FROM clustered WHERE {_REOPENED} ORDER BY "Reopen_Count" DESC, "Ticket_ID" LIMIT 100""",
    ),
    "mttr_by_system": with_views(
        "clustered",
        f"""SELECT *, {_hours('"Mean_Hours"')} AS "MTTR", {_hours('"Median_Hours"')} AS "Median_MTTR" FROM (
        SELECT "System_Type", avg("Time_to_Resolve") AS "Mean_Hours", count("Time_to_Resolve") AS "Resolved_Tickets",
        median("Time_to_Resolve") AS "Median_Hours" FROM clustered WHERE {_TWO} GROUP BY 1)""",
    ),
    "domain_heatmap": with_views(
        "clustered",
        """SELECT "Domain", count(*) FILTER (WHERE "System_Type" = 'Legacy') AS "Legacy",
        count(*) FILTER (WHERE "System_Type" = 'DBB') AS "DBB" FROM clustered GROUP BY 1""",
    ),
    "opco_heatmap": with_views(
        "catalog",
        """SELECT p."Pattern", o."OpCo", count(c."Ticket_ID") AS "Count"
        FROM (SELECT "Pattern" FROM opco GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 15) p
        CROSS JOIN (SELECT "OpCo" FROM opco GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 12) o
        LEFT JOIN opco c ON c."Pattern" = p."Pattern" AND c."OpCo" = o."OpCo" GROUP BY 1, 2""",
        _NAMED,
        _OPCO,
    ),
    "opco_recurrence": with_views(
        "catalog",
        """SELECT "Pattern", "OpCo", count(*) FILTER (WHERE "System_Type" = 'Legacy') AS "Legacy",
        count(*) FILTER (WHERE "System_Type" = 'DBB') AS "DBB", count(*) AS "Total" FROM opco GROUP BY 1, 2
        ORDER BY "Total" DESC, "Pattern", "OpCo" LIMIT 100""",
        _NAMED,
        _OPCO,
    ),
    "trend_verdict": with_views(
        "catalog",
        f"""SELECT "Cluster_ID", "Frequency_Legacy", "Frequency_DBB",
        CASE WHEN "Frequency_Legacy" = 0 AND "Frequency_DBB" > 0 THEN 'New in DBB'
             WHEN "Frequency_Legacy" > 0 AND "Frequency_DBB" = 0 THEN 'Eliminated'
             WHEN "Frequency_Legacy" > 0 THEN format('{{:+.0f}}%', round_even({_CHANGE}, 0)) ELSE '-' END AS "Trend" FROM catalog""",
    ),
    "root_cause_map": with_views(
        "catalog",
        """SELECT "Cluster_ID", "Cluster_Name" AS "Pattern", coalesce("Strategic_Persona", '') AS "Persona", "Analysis" AS "Root_Cause",
        coalesce("Recommendation", '') AS "Prevention", "Frequency_Legacy" AS "Legacy_Tickets", "Frequency_DBB" AS "DBB_Tickets"
        FROM catalog WHERE "Analysis" <> ''""",
    ),
    "reappeared_patterns": with_views(
        "catalog",
        f"""SELECT "Cluster_ID", "Cluster_Name" AS "Pattern", "Frequency_Legacy" AS "Legacy_Tickets", "Frequency_DBB" AS "DBB_Tickets",
        round_even({_CHANGE}, 0) AS "Change",
        {_percent('(round_even("Frequency_DBB"::DOUBLE / ("Frequency_Legacy" + "Frequency_DBB") * 1000, 0) / 1000)')} AS "DBB_Share",
        format('{{:+.0f}}%', round_even({_CHANGE}, 0)) AS "Change_vs_Legacy", "Analysis" AS "Root_Cause", "Recommendation" AS "Prevention",
        CASE WHEN round_even({_CHANGE}, 0) > 0 THEN 'worse' ELSE 'lower' END AS "Outcome"
        FROM catalog WHERE "Frequency_Legacy" > 0 AND "Frequency_DBB" > 0""",
    ),
    "introduced_patterns": with_views(
        "catalog",
        'SELECT "Cluster_ID", "Cluster_Name" AS "Pattern", "Frequency_DBB" AS "DBB_Tickets" FROM catalog WHERE "Frequency_Legacy" = 0',
    ),
    "eliminated_patterns": with_views(
        "catalog",
        'SELECT "Cluster_ID", "Cluster_Name" AS "Pattern", "Frequency_Legacy" AS "Legacy_Tickets" FROM catalog WHERE "Frequency_DBB" = 0',
    ),
    "cluster_card": with_views(
        "catalog",
        f"""SELECT c."Cluster_ID", "Cluster_Name" AS "Pattern", coalesce("Strategic_Persona", '') AS "Persona", "Size",
        c."Frequency_Legacy", c."Frequency_DBB", "Top_Keywords", "Primary_Domains", coalesce("Analysis", '') AS "Root_Cause",
        coalesce("Recommendation", '') AS "Prevention", {_hours('"AvgTTR_Legacy_Hours"')} AS "Legacy_MTTR",
        {_hours('"AvgTTR_DBB_Hours"')} AS "DBB_MTTR", {_hours('abs("AvgTTR_Delta_Hours")')} AS "MTTR_Delta",
        CASE WHEN "AvgTTR_Delta_Hours" > 0 THEN 'DBB slower' WHEN "AvgTTR_Delta_Hours" < 0 THEN 'DBB faster' ELSE 'No comparison' END AS "MTTR_Verdict"
        FROM catalog c LEFT JOIN metrics m USING ("Cluster_ID")""",
        METRICS_SQL,
    ),
    "cluster_labels": with_views(
        "catalog",
        """SELECT "Cluster_ID", CASE WHEN "Strategic_Persona" <> '' THEN '[' || "Strategic_Persona" || '] ' || "Cluster_Name"
        ELSE "Cluster_Name" END AS "Label" FROM catalog""",
    ),
    "cluster_samples": with_views(
        "clustered",
        """SELECT * FROM (SELECT "Cluster_ID", CAST(row_number() OVER (PARTITION BY "Cluster_ID" ORDER BY "Ticket_ID") AS INTEGER) AS "Position",
        "Ticket_ID", "System_Type", "System_Subtype", "Domain", "Short_Description", "Severity", "Reopen_Flag" FROM clustered)
        WHERE "Position" <= 5""",
    ),
    "cluster_samples_detail": with_views(
        "clustered",
        """SELECT * FROM (SELECT "Cluster_ID", CAST(row_number() OVER (PARTITION BY "Cluster_ID" ORDER BY "Ticket_ID") AS INTEGER) AS "Position",
        "Ticket_ID", "System_Type", "System_Subtype", "Domain", "Short_Description", "Severity", "Reopen_Flag" FROM clustered)
        WHERE "Position" <= 15""",
    ),
    "verdict_badge": """WITH v AS (SELECT DISTINCT CASE o_orderstatus WHEN 'F' THEN 'DBB_REDUCED_ISSUES' WHEN 'O' THEN 'MIXED_RESULTS'
        ELSE 'NOT_LISTED' END AS verdict FROM orders)
        SELECT verdict AS "Verdict", CASE verdict WHEN 'DBB_REDUCED_ISSUES' THEN 'Green' WHEN 'MIXED_RESULTS' THEN 'Yellow' ELSE 'Grey' END AS "Colour",
        CASE verdict WHEN 'DBB_REDUCED_ISSUES' THEN 'Dbb Reduced Issues' WHEN 'MIXED_RESULTS' THEN 'Mixed Results' ELSE 'Not Listed' END AS "Title" FROM v""",
}
