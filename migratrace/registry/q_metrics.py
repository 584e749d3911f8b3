"""Cluster metrics and summary figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from migratrace import names as N
from migratrace.operators.facts import (
    domain_crosstab,
    headline_totals,
    monthly_crosstab,
    reopen_rate_by_system,
    severity_counts,
    severity_crosstab,
)
from migratrace.operators.metrics import cluster_metrics, domain_module_pivot, refresh_metrics
from migratrace.operators.personas import assign_personas
from migratrace.registry.tickets import clustered_tickets, label_catalog, with_views


def cluster_metrics_query(spark, folder):
    return cluster_metrics(clustered_tickets(spark, folder))


def metrics_refresh(spark, folder):
    """Refreshing a catalog that already carries metrics and join leftovers."""
    tickets = clustered_tickets(spark, folder)
    metrics = cluster_metrics(tickets)
    catalog = label_catalog(tickets).withColumns(
        {"Impact_DBB_old": F.lit(1.0), "Size_x": F.lit(1), "Reduction_Rate": F.lit(9.0)}
    )
    return refresh_metrics(refresh_metrics(catalog, metrics), metrics)


def domain_module_pivot_query(spark, folder):
    return domain_module_pivot(clustered_tickets(spark, folder))


def fifth_system_pivot(spark, folder):
    """Tickets of a system type that the default rules do not know, with its column and without: none is lost."""
    tickets = clustered_tickets(spark, folder)
    hosted = F.when(F.col("OpCo").isNotNull() & F.col("Ticket_ID").endswith("7"), F.lit("Hosted"))
    renamed = tickets.withColumn("System_Type", F.coalesce(hosted, F.col("System_Type")))
    named = domain_crosstab(renamed, (*N.SYSTEM_TYPES, "Hosted"))
    rest = domain_crosstab(renamed).select("Domain", F.col("Other").alias("Not_Listed"))
    return named.join(rest, "Domain")


def severity_crosstab_query(spark, folder):
    table = severity_crosstab(clustered_tickets(spark, folder))
    return table.select("System_Type", *[F.col(f"`{v}`").alias(f"S{v[0]}") for v in ("1.0", "2.0", "3.0", "4.0")], "Other")


def strategic_personas(spark, folder):
    tickets = clustered_tickets(spark, folder)
    catalog = refresh_metrics(label_catalog(tickets).drop("Strategic_Persona"), cluster_metrics(tickets))
    return assign_personas(catalog).select("Cluster_ID", "Strategic_Persona")


QUERIES = {
    "cluster_metrics": cluster_metrics_query,
    "metrics_refresh": metrics_refresh,
    "domain_module_pivot": domain_module_pivot_query,
    "fifth_system_pivot": fifth_system_pivot,
    "headline_totals": lambda s, d: headline_totals(clustered_tickets(s, d)),
    "monthly_crosstab": lambda s, d: monthly_crosstab(clustered_tickets(s, d)),
    "domain_crosstab": lambda s, d: domain_crosstab(clustered_tickets(s, d)),
    "severity_crosstab": severity_crosstab_query,
    "severity_counts": lambda s, d: severity_counts(clustered_tickets(s, d)),
    "reopen_rate_by_system": lambda s, d: reopen_rate_by_system(clustered_tickets(s, d)),
    "strategic_personas": strategic_personas,
}

METRICS_SQL = """
sums AS (
  SELECT "Cluster_ID",
    count(*) FILTER (WHERE "System_Type" = 'Legacy') AS n_old, count(*) FILTER (WHERE "System_Type" = 'DBB') AS n_new,
    avg("Severity") FILTER (WHERE "System_Type" = 'Legacy') AS sev_old, avg("Severity") FILTER (WHERE "System_Type" = 'DBB') AS sev_new,
    avg("Time_to_Resolve") FILTER (WHERE "System_Type" = 'Legacy') AS ttr_old, avg("Time_to_Resolve") FILTER (WHERE "System_Type" = 'DBB') AS ttr_new,
    avg("Reopen_Flag"::INT) FILTER (WHERE "System_Type" = 'Legacy') AS reopen_old, avg("Reopen_Flag"::INT) FILTER (WHERE "System_Type" = 'DBB') AS reopen_new,
    avg(post_migration_noise::INT) AS noise_share
  FROM clustered WHERE "Cluster_ID" <> -1 GROUP BY 1
),
metrics AS (
  SELECT "Cluster_ID", n_old AS "Frequency_Legacy", n_new AS "Frequency_DBB",
    round_even((1 - n_new::DOUBLE / nullif(n_old, 0)) * 1000, 0) / 1000 AS "Reduction_Rate",
    round_even(n_old * coalesce(sev_old, 0) * 10, 0) / 10 AS "Impact_Legacy",
    round_even(n_new * coalesce(sev_new, 0) * 10, 0) / 10 AS "Impact_DBB",
    round_even(ttr_old * 10, 0) / 10 AS "AvgTTR_Legacy_Hours", round_even(ttr_new * 10, 0) / 10 AS "AvgTTR_DBB_Hours",
    round_even((ttr_new - ttr_old) * 10, 0) / 10 AS "AvgTTR_Delta_Hours",
    round_even((reopen_new - reopen_old) * 1000, 0) / 1000 AS "ReopenRate_Delta",
    coalesce(noise_share > 0.2, false) AS "PostMigrationNoiseFlag"
  FROM sums
)"""

_FOUR = """count(*) FILTER (WHERE "System_Type" = 'Both') AS "Both", count(*) FILTER (WHERE "System_Type" = 'DBB') AS "DBB",
count(*) FILTER (WHERE "System_Type" = 'Legacy') AS "Legacy", count(*) FILTER (WHERE "System_Type" = 'Unknown') AS "Unknown",
count(*) FILTER (WHERE coalesce("System_Type" NOT IN ('Both', 'DBB', 'Legacy', 'Unknown'), true)) AS "Other" """

SQL = {
    "cluster_metrics": with_views("clustered", "SELECT * FROM metrics", METRICS_SQL),
    "metrics_refresh": with_views(
        "catalog",
        'SELECT c.* EXCLUDE ("Frequency_Legacy", "Frequency_DBB"), m.* EXCLUDE ("Cluster_ID") FROM catalog c LEFT JOIN metrics m USING ("Cluster_ID")',
        METRICS_SQL,
    ),
    "domain_module_pivot": with_views(
        "clustered",
        f"""SELECT *, 1 - "DBB"::DOUBLE / nullif("Legacy", 0) AS "Reduction_Rate"
        FROM (SELECT "Domain", "Module", {_FOUR} FROM clustered WHERE "Module" IS NOT NULL GROUP BY 1, 2)""",
    ),
    "headline_totals": with_views(
        "clustered",
        """SELECT count(*) AS "Total_Tickets", count(*) FILTER (WHERE "System_Type" = 'Legacy') AS "Legacy_Tickets",
        count(*) FILTER (WHERE "System_Type" = 'DBB') AS "DBB_Tickets",
        count(DISTINCT "Cluster_ID") FILTER (WHERE "Cluster_ID" <> -1) AS "Clusters" FROM clustered""",
    ),
    "monthly_crosstab": with_views(
        "clustered",
        f"""SELECT strftime("Created_Date", '%Y-%m') AS "YearMonth", {_FOUR} FROM clustered GROUP BY 1 ORDER BY 1 DESC LIMIT 12""",
    ),
    "fifth_system_pivot": with_views(
        "clustered",
        f"""SELECT "Domain", {_FOUR.replace('"System_Type"', 's').replace("'Legacy', 'Unknown')", "'Legacy', 'Unknown', 'Hosted')")},
        count(*) FILTER (WHERE s = 'Hosted') AS "Hosted", count(*) FILTER (WHERE s = 'Hosted') AS "Not_Listed"
        FROM (SELECT "Domain", CASE WHEN "Ticket_ID" LIKE '%7' AND "OpCo" IS NOT NULL THEN 'Hosted' ELSE "System_Type" END AS s FROM clustered) GROUP BY 1""",
    ),
    "domain_crosstab": with_views("clustered", f'SELECT "Domain", {_FOUR} FROM clustered GROUP BY 1'),
    "severity_crosstab": with_views(
        "clustered",
        """SELECT "System_Type", count(*) FILTER (WHERE "Severity" = 1) AS "S1", count(*) FILTER (WHERE "Severity" = 2) AS "S2",
        count(*) FILTER (WHERE "Severity" = 3) AS "S3", count(*) FILTER (WHERE "Severity" = 4) AS "S4",
        count(*) FILTER (WHERE coalesce("Severity" NOT IN (1, 2, 3, 4), true)) AS "Other" FROM clustered GROUP BY 1""",
    ),
    "severity_counts": with_views(
        "clustered", 'SELECT "System_Type", "Severity", count(*) AS "Count" FROM clustered GROUP BY 1, 2'
    ),
    "reopen_rate_by_system": with_views(
        "clustered",
        """SELECT "System_Type", avg("Reopen_Flag"::INT) AS "Reopen_Rate" FROM clustered
        WHERE "System_Type" IN ('Legacy', 'DBB') GROUP BY 1""",
    ),
    "strategic_personas": with_views(
        "catalog",
        """, full_catalog AS (SELECT c."Cluster_ID", c."Size", m.* EXCLUDE ("Cluster_ID") FROM catalog c LEFT JOIN metrics m USING ("Cluster_ID")),
        p1 AS (SELECT "Cluster_ID" FROM full_catalog WHERE "Frequency_Legacy" > 5 AND "Frequency_DBB" > 5
               ORDER BY "Reduction_Rate", "Cluster_ID" LIMIT 1),
        p2 AS (SELECT "Cluster_ID" FROM full_catalog WHERE "ReopenRate_Delta" IS NOT NULL AND "Cluster_ID" NOT IN (FROM p1)
               ORDER BY "ReopenRate_Delta" DESC, "Cluster_ID" LIMIT 1),
        p3 AS (SELECT "Cluster_ID" FROM full_catalog WHERE "Cluster_ID" NOT IN (FROM p1 UNION ALL FROM p2)
               ORDER BY "Size" DESC, "Cluster_ID" LIMIT 1),
        p4 AS (SELECT "Cluster_ID" FROM full_catalog WHERE "Frequency_Legacy" = 0 AND "Cluster_ID" NOT IN (FROM p1 UNION ALL FROM p2 UNION ALL FROM p3)
               ORDER BY "Frequency_DBB" DESC, "Cluster_ID" LIMIT 1),
        p5 AS (SELECT "Cluster_ID" FROM full_catalog WHERE "Frequency_DBB" = 0 AND "Cluster_ID" NOT IN (FROM p1 UNION ALL FROM p2 UNION ALL FROM p3 UNION ALL FROM p4)
               ORDER BY "Frequency_Legacy" DESC, "Cluster_ID" LIMIT 1)
        SELECT "Cluster_ID", CASE WHEN "Cluster_ID" IN (FROM p1) THEN 'The DBB Pollutant' WHEN "Cluster_ID" IN (FROM p2) THEN 'The Chronic Defect'
          WHEN "Cluster_ID" IN (FROM p3) THEN 'The Automation Goldmine' WHEN "Cluster_ID" IN (FROM p4) THEN 'The New DBB Headache'
          WHEN "Cluster_ID" IN (FROM p5) THEN 'The Legacy Anchor' ELSE '' END AS "Strategic_Persona"
        FROM full_catalog""",
        METRICS_SQL,
    ),
}
SQL["strategic_personas"] = SQL["strategic_personas"].replace("\n, full_catalog", ", full_catalog")
