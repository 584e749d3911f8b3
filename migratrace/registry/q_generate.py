"""Prompts, replies and summaries, with deterministic stand-ins for a generator."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from migratrace.operators import generate as G
from migratrace.plans import reports as R
from migratrace.registry.tickets import clustered_tickets, label_catalog, table, with_views


def naming_generator():
    """Replies of every kind, by the cluster number at the end of the keywords."""

    def reply(prompt: str, max_tokens: int) -> str:
        keywords = prompt.split("Keywords: ")[1].split("\n")[0]
        number = int(keywords.split()[-1]) if keywords else 0
        body = json.dumps({"Cluster_Name": f"Name {number}", "Analysis": f"why {number}"})
        kind = number % 5
        if kind == 0:
            return body
        if kind == 1:
            return f"```json\n{body}\n```"
        if kind == 2:
            return f"Here you are: {body} - done"
        if kind == 3:
            return "no json at all {"
        raise RuntimeError("generator unavailable")

    return reply


def cluster_prompt(spark, folder):
    tickets = clustered_tickets(spark, folder)
    return G.naming_prompts(label_catalog(tickets), tickets, task="Name it.")


def catalog_enrichment(spark, folder):
    tickets = clustered_tickets(spark, folder)
    catalog = label_catalog(tickets)
    replies = G.generate(G.naming_prompts(catalog, tickets), naming_generator, "Cluster_ID")
    return G.enrich_catalog(catalog, replies).select(
        "Cluster_ID", "Cluster_Name", "Strategic_Persona", "Analysis", "Recommendation"
    )


def generated_json_parse(spark, folder):
    """Replies built from every document: plain, fenced, inside prose, broken."""
    docs = table(spark, folder, "documents")
    key = F.col("doc_id")
    body = F.to_json(F.struct(F.concat(F.lit("Name "), key).alias("Cluster_Name"), F.col("text").alias("Analysis")))
    kind = F.pmod(key, F.lit(5))
    reply = (
        F.when(kind == 0, body)
        .when(kind == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(kind == 2, F.concat(F.lit("Answer: "), body, F.lit(" as asked")))
        .when(kind == 3, F.concat(F.lit("["), body, F.lit("]")))
        .otherwise(F.concat(F.lit("{ broken "), body))
    )
    parsed = G.parse_reply(docs.select("doc_id", reply.alias("Reply")), G.NAMING_SCHEMA)
    return parsed.select(
        "doc_id", F.col("parsed").isNotNull().alias("ok"), "parsed.Cluster_Name", F.md5("parsed.Analysis").alias("Analysis_Hash"),
        "parsed.Recommendation",
    )


def cluster_lines(spark, folder):
    return G.cluster_lines(label_catalog(clustered_tickets(spark, folder))).drop("Place")


def summary_prompt(spark, folder):
    tickets = clustered_tickets(spark, folder)
    return G.summary_prompt(tickets, label_catalog(tickets), task="Report.")


def _summaries(spark, folder):
    """One reply per customer: a summary, prose, or a failed call."""
    key, name = F.col("c_custkey"), F.col("c_name")
    absent = F.lit(None).cast("string")

    def finding(title, detail, impact):
        return F.struct(title.alias("title"), detail.alias("detail"), F.lit(impact).alias("impact"))

    body = F.to_json(
        F.struct(
            F.concat(F.lit("About "), name).alias("executive_narrative"),
            F.array(finding(name, absent, "high"), finding(absent, F.lit("d"), "huge")).alias("key_findings"),
            F.array(F.struct(name.alias("pattern"))).alias("shift_left_opportunities"),
            F.lit("MIXED_RESULTS").alias("legacy_to_dbb_verdict"),
            F.array(F.struct(name.alias("domain"), F.col("c_nationkey").alias("legacy_tickets"), F.lit("new_in_dbb").alias("verdict"))).alias("domain_health"),
        )
    )
    kind = F.pmod(key, F.lit(3))
    # dealt out while the rows are narrow: parsing costs far more than reading, and a small file is read by one task
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    return customers.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).select(
        "c_custkey",
        F.when(kind == 0, body).when(kind == 1, F.lit("sorry")).alias("Reply"),
        F.when(kind == 2, F.lit("timeout")).alias("Error"),
    )


def summary_parse(spark, folder):
    return G.parse_summary(_summaries(spark, folder)).select(
        "c_custkey", "executive_narrative", "legacy_to_dbb_verdict",
        F.size("key_findings").alias("findings"), F.size("domain_health").alias("domains"),
    )


def key_findings(spark, folder):
    label = R.label_of(F.col("impact"), R.IMPACT_LABELS, F.lit("Unknown"))
    return G.summary_rows(G.parse_summary(_summaries(spark, folder)), "key_findings", {"impact": label})


def shift_left(spark, folder):
    return G.summary_rows(G.parse_summary(_summaries(spark, folder)), "shift_left_opportunities")


def domain_health(spark, folder):
    verdict = R.label_of(F.col("verdict"), R.HEALTH_VERDICTS, F.col("verdict"))
    return G.summary_rows(G.parse_summary(_summaries(spark, folder)), "domain_health", {"verdict": verdict})


QUERIES = {
    "cluster_prompt": cluster_prompt,
    "catalog_enrichment": catalog_enrichment,
    "generated_json_parse": generated_json_parse,
    "cluster_lines": cluster_lines,
    "summary_prompt": summary_prompt,
    "summary_parse": summary_parse,
    "key_findings": key_findings,
    "shift_left": shift_left,
    "domain_health": domain_health,
}

_SELECTED = """
chosen AS (SELECT * FROM catalog ORDER BY "Business_Priority" DESC, "Size" DESC, "Cluster_ID" LIMIT 15)"""
_SAMPLES = """
samples AS (
  SELECT "Cluster_ID", string_agg("Short_Description", chr(10) ORDER BY "Ticket_ID") AS s FROM (
    SELECT * FROM clustered QUALIFY row_number() OVER (PARTITION BY "Cluster_ID" ORDER BY "Ticket_ID") <= 10) GROUP BY 1
)"""
_LINE = """'- Cluster ' || "Cluster_ID" || CASE WHEN "Strategic_Persona" <> '' THEN ' [' || "Strategic_Persona" || ']' ELSE '' END || ': "' ||
coalesce("Cluster_Name", 'nan') || '" | Size=' || "Size" || ', Legacy=' || "Frequency_Legacy" || ', DBB=' || "Frequency_DBB" ||
', Analysis: ' || coalesce("Analysis", 'nan') || ', Recommendation: ' || coalesce("Recommendation", 'nan')"""
_CELLS = "'Both=' || b || ' DBB=' || d || ' Legacy=' || l || ' Unknown=' || u || ' Other=' || o"
_FOUR = """count(*) FILTER (WHERE "System_Type" = 'Both') AS b, count(*) FILTER (WHERE "System_Type" = 'DBB') AS d,
count(*) FILTER (WHERE "System_Type" = 'Legacy') AS l, count(*) FILTER (WHERE "System_Type" = 'Unknown') AS u,
count(*) FILTER (WHERE coalesce("System_Type" NOT IN ('Both', 'DBB', 'Legacy', 'Unknown'), true)) AS o"""


def _rate(system: str) -> str:
    return f"""(SELECT printf('%.1f', round_even(avg("Reopen_Flag"::INT) * 100 * 10, 0) / 10) || '%' FROM clustered WHERE "System_Type" = '{system}')"""


SQL = {
    "cluster_prompt": with_views(
        "catalog",
        """SELECT "Cluster_ID", 'Name it.' || chr(10) || 'Keywords: ' || coalesce("Top_Keywords", '') || chr(10) || 'Domain: ' || "Primary_Domains"
        || chr(10) || chr(10) || 'Samples:' || chr(10) || s || chr(10) AS "Prompt" FROM chosen JOIN samples USING ("Cluster_ID")""",
        _SELECTED,
        _SAMPLES,
    ),
    "catalog_enrichment": with_views(
        "catalog",
        """, kinds AS (SELECT catalog.*, chosen."Cluster_ID" IS NOT NULL AS asked,
          CASE WHEN catalog."Top_Keywords" IS NULL THEN 0 ELSE catalog."Cluster_ID" END AS number
          FROM catalog LEFT JOIN chosen USING ("Cluster_ID"))
        SELECT "Cluster_ID", CASE WHEN asked AND number % 5 < 3 THEN 'Name ' || number ELSE "Top_Keywords" END AS "Cluster_Name",
        coalesce("Strategic_Persona", '') AS "Strategic_Persona",
        CASE WHEN asked AND number % 5 < 3 THEN 'why ' || number ELSE coalesce("Analysis", '') END AS "Analysis",
        CASE WHEN asked AND number % 5 < 3 THEN '' ELSE coalesce("Recommendation", '') END AS "Recommendation" FROM kinds""",
        _SELECTED,
    ).replace("\n, kinds", ", kinds"),
    "generated_json_parse": """SELECT doc_id, doc_id % 5 < 3 AS ok, CASE WHEN doc_id % 5 < 3 THEN 'Name ' || doc_id END AS "Cluster_Name",
        CASE WHEN doc_id % 5 < 3 THEN md5(text) END AS "Analysis_Hash", CAST(NULL AS VARCHAR) AS "Recommendation" FROM documents""",
    "cluster_lines": with_views("catalog", f'SELECT "Cluster_ID", {_LINE} AS "Line" FROM catalog'),
    "summary_prompt": with_views(
        "catalog",
        f"""SELECT concat_ws(chr(10), 'Report.',
        (SELECT count(*) FROM clustered) || ' tickets in all; Legacy ' || (SELECT count(*) FROM clustered WHERE "System_Type" = 'Legacy')
          || ', DBB ' || (SELECT count(*) FROM clustered WHERE "System_Type" = 'DBB'),
        'Share opened again: Legacy ' || {_rate("Legacy")} || ', DBB ' || {_rate("DBB")},
        chr(10) || 'Monthly volume (last 12 months)',
        (SELECT string_agg('YearMonth=' || m || ' ' || {_CELLS}, chr(10) ORDER BY m) FROM
          (SELECT strftime("Created_Date", '%Y-%m') AS m, {_FOUR} FROM clustered GROUP BY 1 ORDER BY 1 DESC LIMIT 12)),
        chr(10) || 'Tickets by domain and system',
        (SELECT string_agg('Domain=' || "Domain" || ' ' || {_CELLS}, chr(10) ORDER BY "Domain") FROM (SELECT "Domain", {_FOUR} FROM clustered GROUP BY 1)),
        chr(10) || 'Severity',
        (SELECT string_agg('System_Type=' || "System_Type" || ' Severity=' || "Severity" || ' Count=' || n, chr(10) ORDER BY "System_Type", "Severity")
          FROM (SELECT "System_Type", "Severity", count(*) AS n FROM clustered GROUP BY 1, 2)),
        chr(10) || 'Recurring patterns',
        (SELECT string_agg({_LINE}, chr(10) ORDER BY "Business_Priority" DESC, "Size" DESC, "Cluster_ID") FROM catalog)) AS "Prompt" """,
    ),
    "summary_parse": """SELECT c_custkey,
        CASE c_custkey % 3 WHEN 0 THEN 'About ' || c_name WHEN 1 THEN 'Executive summary generation returned invalid JSON.'
          ELSE 'Executive summary not generated - API call failed.' END AS executive_narrative,
        CASE c_custkey % 3 WHEN 0 THEN 'MIXED_RESULTS' ELSE 'INSUFFICIENT_DATA' END AS legacy_to_dbb_verdict,
        CAST(CASE c_custkey % 3 WHEN 0 THEN 2 ELSE 0 END AS INTEGER) AS findings,
        CAST(CASE c_custkey % 3 WHEN 0 THEN 1 ELSE 0 END AS INTEGER) AS domains FROM customer""",
    "key_findings": """SELECT c_custkey, 0::INTEGER AS "Position", c_name AS title, '' AS detail, 'High' AS impact FROM customer WHERE c_custkey % 3 = 0
        UNION ALL SELECT c_custkey, 1::INTEGER, '', 'd', 'Unknown' FROM customer WHERE c_custkey % 3 = 0""",
    "shift_left": """SELECT c_custkey, 0::INTEGER AS "Position", c_name AS pattern, '' AS strategy, '?' AS estimated_reduction
        FROM customer WHERE c_custkey % 3 = 0""",
    "domain_health": """SELECT c_custkey, 0::INTEGER AS "Position", c_name AS domain, c_nationkey AS legacy_tickets,
        CAST(NULL AS INTEGER) AS dbb_tickets, 'New in DBB' AS verdict FROM customer WHERE c_custkey % 3 = 0""",
}
