"""Ticket views derived from the test tables, in Spark and in SQL.

Every order becomes a ticket: its dates come from the order and its line
items, its texts from documents and conversations, its routing columns from
small value lists that reach every classification rule.  One cluster holds a
third of the tickets, so hot groups occur in every grouped query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from migratrace import names as N
from migratrace.operators.classify import classify, flag_migration_noise
from migratrace.operators.normalize import normalize
from migratrace.operators.rules import DEFAULT_RULES, sql_text
from migratrace.session import materialize

# Values per routing column; the list lengths (with empties) share no factor.
CI_VALUES = (
    "OTD Production", "OMNI Production", "Tiger Tribe App", "SEM Portal", "Assembly Line", "Dynamics 365 CRM",
    "VirtoCommerce Shop", "B2B DOT Store", "D&A Hub Lake", "ERP SAP ECC", "Fiori Launchpad", "PSUB Router",
    "IJKT Switch", "Digital Integration Bus", "Solace Broker",
)
CI_LENGTH = 53
OFFERING_VALUES = (
    "POSM Non-DBB", "Commerce Integration", "Finance Technology Integration", "OTD Glassrun", "OTD Core", "OMNI App",
    "SEM Sales", "DOT Orders", "D&A Hub Reports", "Eazle Shop", "B2Gaas", "ERP SAP Finance", "PTP Desk",
    "IP Networks", "NTW Branch", "SDWAN", "Windows Client", "Download Manager", "Remote Access", "Anti Virus",
    "WPS Scan", "MS Teams", "SharePoint", "IFRS16", "FIN Close", "HeiFund",
)
OFFERING_LENGTH = 47
GROUP_VALUES = (
    "Tiger Tribe L2", "OTD Support Tiger", "OTD Support L1", "OMNI Support", "SEM DevOps", "DOT Infosys",
    "D&A Hub Team", "GIS Orange", "ERP SAP AMS", "T-Systems", "WPL Field", "Commerce Integration Team",
)
GROUP_LENGTH = 29
SERVICE_VALUES = (
    "Middleware", "Market to Order (MTO)", "Demand to Warehouse (DTW)", "Market to Cash (MTC)", "Network",
    "Source to Pay (STP)", "Record to Report (RTR)", "Hosting SAP", "Workplace", "Security Management",
    "Collaboration", "Service Desk Services", "GSD (ITSM) Service", "ServiceNow NextGen - SIAM", "Facilities",
)
SERVICE_LENGTH = 19
TITLE_VALUES = (
    "Glassrun cannot sync", "Omni login fails", "Printer offline", "API interface times out", "Password reset",
    "Invoice missing", "OTD route is empty",
)
TITLE_LENGTH = 11
DOMAIN_VALUES = ("Sales", "Finance", "Supply", "Workplace", "Network")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(values: tuple[str, ...], length: int, key: Column) -> Column:
    """The value at ``key mod length``; null beyond the list."""
    listed = ", ".join(sql_text(v) for v in values)
    return F.get(F.expr(f"array({listed})"), F.pmod(key, F.lit(length)).cast("int"))


def _pick_sql(values: tuple[str, ...], length: int, key: str) -> str:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"([{listed}])[CAST({key} % {length} AS INTEGER) + 1]"


def ticket_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with ship date and return counts of their line items."""
    items = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.max("l_shipdate").alias("closed"),
            F.count_if(F.col("l_returnflag") == "R").alias("returns"),
        )
    )
    return table(spark, folder, "orders").join(items, "o_orderkey", "left")


def _stamp(c: Column) -> Column:
    return c.cast("string")


def raw_tickets(spark: SparkSession, folder: str, texts: bool = False) -> DataFrame:
    """A raw export: text columns only.  ``texts`` adds whole documents and notes."""
    key = F.col("o_orderkey")
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    joined = (
        ticket_keys(spark, folder).join(customers, "o_custkey", "left").join(nations, "c_nationkey", "left")
    )
    columns = [
        F.concat(F.lit("INC"), F.lpad(key.cast("string"), 10, "0")).alias(N.NUMBER),
        _pick(CI_VALUES, CI_LENGTH, key).alias(N.CI),
        _pick(OFFERING_VALUES, OFFERING_LENGTH, key).alias(N.OFFERING),
        _pick(GROUP_VALUES, GROUP_LENGTH, F.col("o_custkey")).alias(N.GROUP),
        _pick(SERVICE_VALUES, SERVICE_LENGTH, key).alias(N.SERVICE),
        F.concat_ws(" ", _pick(TITLE_VALUES, TITLE_LENGTH, key), F.col("o_orderstatus")).alias(N.SHORT),
        F.col("o_orderpriority").alias(N.PRIORITY),
        _stamp(F.col("o_orderdate")).alias(N.CREATED),
        _stamp(F.col("closed")).alias(N.CLOSED),
        F.coalesce(F.col("returns"), F.lit(0)).cast("string").alias(N.REOPENS),
        F.when(F.pmod(key, F.lit(17)) != 0, F.col("n_name")).alias(N.OPCO),
    ]
    if texts:
        docs = table(spark, folder, "documents")
        turns = table(spark, folder, "conversations")
        first = turns.groupBy("conv_id").agg(
            F.min_by(F.when(F.col("role") == "assistant", F.col("text")), F.when(F.col("role") == "assistant", F.col("turn"))).alias("reply"),
            F.min_by(F.when(F.col("role") == "user", F.col("text")), F.when(F.col("role") == "user", F.col("turn"))).alias("question"),
        )
        n_docs = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
        n_convs = first.agg(F.count(F.lit(1)).alias("n")).scalar()
        joined = (
            joined.withColumns({"__n_docs": n_docs, "__n_convs": n_convs})
            .withColumns(
                {"doc_id": F.pmod(key, F.col("__n_docs")), "conv_id": F.pmod(key, F.col("__n_convs"))}
            )
            # tickets are dealt out while they are narrow; the documents, the longest texts, come last and are not moved again
            .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
            .join(first, "conv_id", "left")
            .join(docs.select("doc_id", "text"), "doc_id", "left")
        )
        columns += [
            F.col("text").alias(N.DESCRIPTION),
            F.col("reply").alias(N.CLOSE_NOTES),
            F.col("question").alias(N.COMMENTS),
        ]
    return joined.select(*columns)


def classified_tickets(spark: SparkSession, folder: str, texts: bool = False) -> DataFrame:
    return flag_migration_noise(classify(raw_tickets(spark, folder, texts)))


_STAGES: dict[tuple[str, str, str], DataFrame] = {}


def stage(spark: SparkSession, folder: str, name: str, build) -> DataFrame:
    """A stage table, written once per application: later steps read files, not lineage."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _STAGES:
        _STAGES[key] = materialize(build(), name)
    return _STAGES[key]


def canonical_tickets(spark: SparkSession, folder: str, texts: bool = False) -> DataFrame:
    """Canonical tickets, normalized from the classified stage table."""
    name = "classified-texts" if texts else "classified"
    return normalize(stage(spark, folder, name, lambda: classified_tickets(spark, folder, texts)))


def ticket_number(ticket_id: Column) -> Column:
    return F.substring(ticket_id, 4, 20).cast("long")


def assign_cluster(system: Column, key: Column) -> Column:
    """A third of the tickets in cluster 0, the rest over 1..22 and noise (-1).

    Clusters 3, 7 and 11 lose one or both systems, so that every trend occurs.
    """
    spread = F.pmod(key, F.lit(23)).cast("int") - 1
    base = F.when(F.pmod(key, F.lit(3)) == 0, F.lit(0)).otherwise(spread)
    return (
        F.when((base == 3) & (system == N.LEGACY), F.lit(-1))
        .when((base == 7) & (system == N.NEW), F.lit(-1))
        .when((base == 11) & system.isin(*N.TWO_SYSTEMS), F.lit(-1))
        .otherwise(base)
    )


def clustered_tickets(spark: SparkSession, folder: str, texts: bool = False) -> DataFrame:
    """Canonical tickets with a given cluster, as the stage table that reports read."""

    def build() -> DataFrame:
        return canonical_tickets(spark, folder, texts).withColumn(
            "Cluster_ID", assign_cluster(F.col("System_Type"), ticket_number(F.col("Ticket_ID")))
        )

    return stage(spark, folder, "clustered-texts" if texts else "clustered", build)


def label_catalog(clustered: DataFrame) -> DataFrame:
    """A cluster catalog with text columns in every state (named, unnamed, analysed, not)."""
    c = F.col("Cluster_ID")
    kept = clustered.where(c != -1)
    sizes = kept.groupBy("Cluster_ID").agg(
        F.count(F.lit(1)).alias("Size"),
        F.count_if(F.col("System_Type") == N.LEGACY).alias("Frequency_Legacy"),
        F.count_if(F.col("System_Type") == N.NEW).alias("Frequency_DBB"),
    )
    text = c.cast("string")
    return sizes.select(
        "Cluster_ID",
        "Size",
        F.when(c % 7 != 6, F.concat(F.lit("sync, route "), text)).alias("Top_Keywords"),
        F.concat(F.lit("Sales | Area "), text).alias("Primary_Domains"),
        (F.col("Size") * (c % 5 + 1) / 10.0).alias("Business_Priority"),
        "Frequency_Legacy",
        "Frequency_DBB",
        F.when(c % 4 != 3, F.concat(F.lit("Pattern "), text)).alias("Cluster_Name"),
        F.when(c % 6 == 1, F.lit("The Automation Goldmine")).when(c % 6 == 2, F.lit("")).alias("Strategic_Persona"),
        F.when(c % 3 == 0, F.concat(F.lit("cause "), text)).when(c % 3 == 1, F.lit("")).alias("Analysis"),
        F.when(c % 2 == 0, F.concat(F.lit("fix "), text)).alias("Recommendation"),
    )


# ---- the same views in SQL --------------------------------------------------
KEYS_SQL = """
ticket_keys AS (
  SELECT o.*, i.closed, i.returns
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS closed, count(*) FILTER (WHERE l_returnflag = 'R') AS returns
             FROM lineitem GROUP BY l_orderkey) i ON i.l_orderkey = o.o_orderkey
)"""

CONVERSATION_SQL = """
first_turns AS (
  SELECT conv_id,
         min_by(text, turn) FILTER (WHERE role = 'assistant') AS reply,
         min_by(text, turn) FILTER (WHERE role = 'user') AS question
  FROM conversations GROUP BY conv_id
)"""

RAW_SQL = f"""
raw AS (
  SELECT 'INC' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS "Number",
         {_pick_sql(CI_VALUES, CI_LENGTH, "o_orderkey")} AS "Configuration item",
         {_pick_sql(OFFERING_VALUES, OFFERING_LENGTH, "o_orderkey")} AS "Service offering",
         {_pick_sql(GROUP_VALUES, GROUP_LENGTH, "o_custkey")} AS "Assignment group",
         {_pick_sql(SERVICE_VALUES, SERVICE_LENGTH, "o_orderkey")} AS "Business service",
         concat_ws(' ', {_pick_sql(TITLE_VALUES, TITLE_LENGTH, "o_orderkey")}, o_orderstatus) AS "Short description",
         o_orderpriority AS "Priority",
         o_orderdate AS created_ts, closed AS closed_ts,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "Created",
         strftime(closed, '%Y-%m-%d %H:%M:%S') AS "Closed",
         CAST(coalesce(returns, 0) AS VARCHAR) AS "Reopen count",
         CASE WHEN o_orderkey % 17 <> 0 THEN n_name END AS "Impacted OpCo",
         o_orderkey AS ticket_number
  FROM ticket_keys
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
)"""

_LOWERED = {c: f"coalesce(lower(\"{c}\"), '')" for c in (N.CI, N.OFFERING, N.GROUP, N.SERVICE, N.SHORT)}


def _case(value) -> str:
    branches = " ".join(f"WHEN {r.sql_condition(_LOWERED)} THEN {value(r)}" for r in DEFAULT_RULES)
    return f"CASE {branches}"


CLASSIFIED_SQL = f"""
classified_only AS (
  SELECT *,
    {_case(lambda r: f"'{r.system_type}'")} ELSE 'Unknown' END AS "System_Type",
    {_case(lambda r: f"'{r.subtype}'")} ELSE 'Unknown' END AS "System_Subtype",
    {_case(lambda r: f"'{r.primary}'")} ELSE 'None' END AS "Primary_System",
    CAST({_case(lambda r: r.confidence)} ELSE 0.0 END AS DOUBLE) AS label_confidence,
    {_case(lambda r: f"'{r.source}'")} ELSE 'none' END AS label_source,
    'v2.0' AS mapping_version, false AS human_override_flag
  FROM raw
),
classified AS (
  SELECT *,
    coalesce(CAST("Reopen count" AS INTEGER) > 0
      AND created_ts BETWEEN (SELECT min(created_ts) FROM classified_only WHERE "System_Type" = 'DBB')
      AND (SELECT min(created_ts) FROM classified_only WHERE "System_Type" = 'DBB') + INTERVAL 90 DAY, false) AS post_migration_noise
  FROM classified_only
)"""

CANONICAL_SQL = """
module_dates AS (
  SELECT "System_Subtype" AS module, min(created_ts) AS module_date FROM classified
  WHERE "System_Type" = 'DBB' AND contains("System_Subtype", 'DBB') GROUP BY 1
),
global_date AS (SELECT min(created_ts) AS d FROM classified WHERE "System_Type" = 'DBB'),
canonical AS (
  SELECT "Number" AS "Ticket_ID", "System_Type", "System_Subtype", "Primary_System",
    coalesce("Business service", 'Unknown') AS "Domain", "System_Subtype" AS "Module",
    coalesce("Impacted OpCo", 'Pt Multi Bintang Indonesia Tbk') AS "OpCo",
    coalesce("Short description", '') AS "Short_Description",
    created_ts AS "Created_Date", closed_ts AS "Closed_Date",
    CAST(coalesce(5 - TRY_CAST(nullif(regexp_extract("Priority", '([0-9]+)', 1), '') AS DOUBLE), 1.0) AS DOUBLE) AS "Severity",
    CAST("Reopen count" AS DOUBLE) AS "Reopen_Count",
    CAST("Reopen count" AS DOUBLE) > 0 AS "Reopen_Flag",
    coalesce("Assignment group", 'Unknown') AS "Assignee_Team",
    label_confidence, label_source, post_migration_noise,
    CASE WHEN closed_ts IS NOT NULL AND created_ts IS NOT NULL
         THEN greatest(date_diff('microsecond', created_ts, closed_ts) / 3600000000.0, 0.1) END AS "Time_to_Resolve",
    CAST(date_trunc('week', created_ts) AS TIMESTAMP) AS "Week",
    CAST(date_trunc('month', created_ts) AS TIMESTAMP) AS "Month",
    CAST(floor(date_diff('microsecond', coalesce(module_date, (SELECT d FROM global_date)), created_ts) / 86400000000.0) AS BIGINT) AS "Days_from_Migration",
    ticket_number
  FROM classified LEFT JOIN module_dates ON module = "System_Subtype"
)"""

CLUSTERED_SQL = """
clustered AS (
  SELECT * EXCLUDE (base),
    CAST(CASE WHEN base = 3 AND "System_Type" = 'Legacy' THEN -1
         WHEN base = 7 AND "System_Type" = 'DBB' THEN -1
         WHEN base = 11 AND "System_Type" IN ('Legacy', 'DBB') THEN -1 ELSE base END AS INTEGER) AS "Cluster_ID"
  FROM (SELECT *, CASE WHEN ticket_number % 3 = 0 THEN 0 ELSE ticket_number % 23 - 1 END AS base FROM canonical)
)"""

LABEL_CATALOG_SQL = """
catalog AS (
  SELECT "Cluster_ID", "Size",
    CASE WHEN "Cluster_ID" % 7 <> 6 THEN 'sync, route ' || "Cluster_ID" END AS "Top_Keywords",
    'Sales | Area ' || "Cluster_ID" AS "Primary_Domains",
    "Size" * ("Cluster_ID" % 5 + 1) / 10.0::DOUBLE AS "Business_Priority",
    "Frequency_Legacy", "Frequency_DBB",
    CASE WHEN "Cluster_ID" % 4 <> 3 THEN 'Pattern ' || "Cluster_ID" END AS "Cluster_Name",
    CASE WHEN "Cluster_ID" % 6 = 1 THEN 'The Automation Goldmine' WHEN "Cluster_ID" % 6 = 2 THEN '' END AS "Strategic_Persona",
    CASE WHEN "Cluster_ID" % 3 = 0 THEN 'cause ' || "Cluster_ID" WHEN "Cluster_ID" % 3 = 1 THEN '' END AS "Analysis",
    CASE WHEN "Cluster_ID" % 2 = 0 THEN 'fix ' || "Cluster_ID" END AS "Recommendation"
  FROM (SELECT "Cluster_ID", count(*) AS "Size",
          count(*) FILTER (WHERE "System_Type" = 'Legacy') AS "Frequency_Legacy",
          count(*) FILTER (WHERE "System_Type" = 'DBB') AS "Frequency_DBB"
        FROM clustered WHERE "Cluster_ID" <> -1 GROUP BY 1)
)"""

_CHAIN = (KEYS_SQL, RAW_SQL, CLASSIFIED_SQL, CANONICAL_SQL, CLUSTERED_SQL, LABEL_CATALOG_SQL)
_LEVEL = {"keys": 1, "raw": 2, "classified": 3, "canonical": 4, "clustered": 5, "catalog": 6}


def with_views(level: str, body: str, *more: str) -> str:
    """SQL with the ticket views up to ``level`` and further named subqueries in front."""
    return "WITH " + ",".join(_CHAIN[: _LEVEL[level]] + more) + "\n" + body
