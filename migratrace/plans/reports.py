"""The report tables over clustered tickets and the cluster catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from migratrace import names as N
from migratrace.functions.columns import (
    col,
    fixed,
    half_even,
    hours_text,
    keep_existing,
    percent,
    ratio,
    signed_percent,
    year_month,
)
from migratrace.operators.metrics import count_pivot
from migratrace.operators.quantiles import exact_median
from migratrace.session import materialize

# ---- fixed values: labels --------------------------------------------------
# Severity 4 is the most severe (priority 1), so it gets the critical label.
SEVERITY_LABELS = {4: "P1 - Critical", 3: "P2 - High", 2: "P3 - Medium", 1: "P4 - Low"}
VERDICT_COLOURS = {
    "DBB_REDUCED_ISSUES": "Green",
    "DBB_INCREASED_ISSUES": "Red",
    "MIXED_RESULTS": "Yellow",
    "INSUFFICIENT_DATA": "Grey",
}
HEALTH_VERDICTS = {
    "improved": "Improved",
    "worsened": "Worsened",
    "new_in_dbb": "New in DBB",
    "legacy_only": "Legacy Only",
    "stable": "Stable",
}
IMPACT_LABELS = {"high": "High", "medium": "Medium", "low": "Low"}
UNCLUSTERED = "Noise / Unclustered"
TIMELINE_OVER = 5
TOP_PATTERNS = 15
TOP_OPCOS = 12
TOP_RECURRENCE = 100
TOP_REOPENED_TICKETS = 100
TOP_REOPENED_PATTERNS = 15
CARD_SAMPLES = 5
DETAIL_SAMPLES = 15
# ---- end of fixed values ---------------------------------------------------


def label_of(c: Column, labels: dict, otherwise: Column | None = None) -> Column:
    chain = None
    for key, text in labels.items():
        chain = F.when(c == F.lit(key), F.lit(text)) if chain is None else chain.when(c == F.lit(key), F.lit(text))
    return chain.otherwise(otherwise) if otherwise is not None else chain


def of_two_systems(tickets: DataFrame, systems: Sequence[str] = N.TWO_SYSTEMS) -> DataFrame:
    return tickets.where(F.col("System_Type").isin(*systems))


def valid_catalog(catalog: DataFrame) -> DataFrame:
    return catalog.where(F.col("Cluster_ID") != N.NOISE_CLUSTER)


def filled(c: Column) -> Column:
    """Present and not empty (an empty text counts as missing in a catalog)."""
    return c.isNotNull() & (c != "")


def pattern_name(catalog: DataFrame) -> Column:
    return F.col("Cluster_Name" if "Cluster_Name" in catalog.columns else "Top_Keywords")


def optional(df: DataFrame, name: str) -> Column:
    return col(name) if name in df.columns else F.lit(None).cast("string")


# ---- volumes ---------------------------------------------------------------
def monthly_volume(tickets: DataFrame) -> DataFrame:
    return (
        of_two_systems(tickets)
        .groupBy(year_month(F.col("Created_Date")).alias("YearMonth"), "System_Type")
        .agg(F.count(F.lit(1)).alias("Tickets"))
    )


def cumulative_volume(tickets: DataFrame) -> DataFrame:
    """Running total per system over its months (one row per month and system)."""
    running = Window.partitionBy("System_Type").orderBy("YearMonth").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return monthly_volume(tickets).withColumn("Cumulative", F.sum("Tickets").over(running))


def cluster_timeline(tickets: DataFrame, over: int | None = TIMELINE_OVER) -> DataFrame:
    """Monthly counts of all clusters at once; with ``over``, of clusters larger than that."""
    two = F.col("System_Type").isin(*N.TWO_SYSTEMS)
    counts = (
        tickets.where(F.col("Cluster_ID") != N.NOISE_CLUSTER)
        .groupBy("Cluster_ID", year_month(F.col("Created_Date")).alias("YearMonth"), "System_Type")
        .agg(F.count(F.lit(1)).alias("Count"))
    )
    if over is not None:
        size = F.sum("Count").over(Window.partitionBy("Cluster_ID"))
        counts = counts.withColumn("__size", size).where(F.col("__size") > over).drop("__size")
    return counts.where(two)


def domain_volume(tickets: DataFrame) -> DataFrame:
    return (
        of_two_systems(tickets)
        .where(F.col("Domain").isNotNull())
        .groupBy("Domain", "System_Type")
        .agg(F.count(F.lit(1)).alias("Count"))
    )


def severity_distribution(tickets: DataFrame, labels: dict = SEVERITY_LABELS) -> DataFrame:
    counted = (
        of_two_systems(tickets).groupBy("System_Type", "Severity").agg(F.count(F.lit(1)).alias("Count"))
    )
    return counted.withColumn("Severity_Label", label_of(F.col("Severity"), labels))


def domain_heatmap(tickets: DataFrame, systems: Sequence[str] = N.TWO_SYSTEMS) -> DataFrame:
    """Tickets per domain for the two systems; every domain is listed."""
    keyed = tickets.where(F.col("Domain").isNotNull() & F.col("System_Type").isNotNull())
    return count_pivot(keyed, ["Domain"], "System_Type", systems, F.col("Ticket_ID"))


# ---- reopening and resolution time -----------------------------------------
def reopen_rates(tickets: DataFrame) -> DataFrame:
    rates = (
        of_two_systems(tickets)
        .groupBy("System_Type")
        .agg(
            F.count_if(F.col("Reopen_Flag")).alias("Reopened_Tickets"),
            F.count("Reopen_Flag").alias("Total_Tickets"),
        )
    )
    rate = ratio(F.col("Reopened_Tickets"), F.col("Total_Tickets"))
    return rates.withColumns({"Reopen_Rate": rate, "Reopen_Rate_Text": percent(rate)})


def named_patterns(catalog: DataFrame) -> DataFrame:
    """Cluster_ID and its name: Cluster_Name, else Top_Keywords, else null."""
    names = [
        F.nullif(col(c), F.lit("")) for c in ("Cluster_Name", "Top_Keywords") if c in catalog.columns
    ]
    named = F.coalesce(*names) if names else F.lit(None).cast("string")
    return valid_catalog(catalog).select("Cluster_ID", named.alias("Pattern"))


def reopened_drilldown(tickets: DataFrame, catalog: DataFrame, top: int | None = TOP_REOPENED_PATTERNS) -> DataFrame:
    """Reopened tickets per cluster, unclustered ones included, most reopened first.

    Both counts come from one pass; names join at cluster level only.
    """
    reopened = F.col("System_Type").isin(*N.TWO_SYSTEMS) & F.coalesce(F.col("Reopen_Flag"), F.lit(False))
    has_id = F.col("Ticket_ID").isNotNull()
    per_cluster = (
        tickets.where(F.col("Cluster_ID").isNotNull())
        .groupBy("Cluster_ID")
        .agg(
            F.count_if(reopened).alias("__rows"),
            F.count_if(reopened & has_id).alias("Reopened_Tickets"),
            F.count_if(reopened & (F.col("System_Type") == N.LEGACY)).alias("Legacy_Reopened"),
            F.count_if(reopened & (F.col("System_Type") == N.NEW)).alias("DBB_Reopened"),
            F.avg(F.when(reopened, F.col("Severity"))).alias("Avg_Severity"),
            F.avg(F.when(reopened, F.col("Time_to_Resolve"))).alias("Avg_MTTR_Hours"),
            F.count("Ticket_ID").alias("Cluster_Tickets"),
        )
        .where(F.col("__rows") > 0)
    )
    rate = ratio(F.col("Reopened_Tickets"), F.col("Cluster_Tickets"))
    ordered = (
        per_cluster.join(named_patterns(catalog), "Cluster_ID", "left")
        .select(
            "Cluster_ID",
            F.coalesce("Pattern", F.lit(UNCLUSTERED)).alias("Pattern"),
            "Reopened_Tickets",
            "Legacy_Reopened",
            "DBB_Reopened",
            "Cluster_Tickets",
            rate.alias("Reopen_Rate"),
            percent(rate).alias("Reopen_Rate_Text"),
            half_even(F.col("Avg_Severity"), 2).alias("Avg_Severity"),
            half_even(F.col("Avg_MTTR_Hours"), 1).alias("Avg_MTTR_Hours"),
        )
        .orderBy(F.desc("Reopened_Tickets"), F.desc("Reopen_Rate"), "Cluster_ID")
    )
    return ordered.limit(top) if top is not None else ordered


def reopened_details(tickets: DataFrame, top: int = TOP_REOPENED_TICKETS) -> DataFrame:
    reopened = of_two_systems(tickets).where(F.coalesce(F.col("Reopen_Flag"), F.lit(False)))
    # fixed values: the columns of the report
    wanted = (
        "Ticket_ID", "System_Type", "System_Subtype", "Domain", "OpCo", "Short_Description",
        "Severity", "Reopen_Count", "Time_to_Resolve",
    )
    return keep_existing(reopened.orderBy(F.desc("Reopen_Count"), "Ticket_ID").limit(top), wanted)


def mttr_by_system(tickets: DataFrame) -> DataFrame:
    """Mean and exact median hours to resolve, per system that has tickets."""
    summary = exact_median(of_two_systems(tickets), "System_Type", "Time_to_Resolve").select(
        "System_Type",
        F.col("mean").alias("Mean_Hours"),
        F.col("n").alias("Resolved_Tickets"),
        F.col("median").alias("Median_Hours"),
    )
    return summary.withColumns(
        {"MTTR": hours_text(F.col("Mean_Hours")), "Median_MTTR": hours_text(F.col("Median_Hours"))}
    )


# ---- patterns across operating companies -----------------------------------
def _opco_counts(tickets: DataFrame, catalog: DataFrame) -> DataFrame:
    """Counts per cluster, OpCo and system, then named: the name join sees counts only."""
    counts = (
        of_two_systems(tickets)
        .where((F.col("Cluster_ID") != N.NOISE_CLUSTER) & F.col("OpCo").isNotNull())
        .groupBy("Cluster_ID", "OpCo", "System_Type")
        .agg(F.count(F.lit(1)).alias("rows"), F.count("Ticket_ID").alias("ids"))
    )
    unnamed = F.concat(F.lit("Cluster "), F.col("Cluster_ID").cast("string"))
    return counts.join(named_patterns(catalog), "Cluster_ID", "left").withColumn(
        "Pattern", F.coalesce("Pattern", unnamed)
    )


def opco_heatmap(
    tickets: DataFrame, catalog: DataFrame, patterns: int = TOP_PATTERNS, opcos: int = TOP_OPCOS
) -> DataFrame:
    """Counts of the most frequent patterns in the busiest OpCos, zeros included, in long form."""
    counts = materialize(
        _opco_counts(tickets, catalog).groupBy("Pattern", "OpCo").agg(F.sum("ids").alias("Count")), "opco-counts"
    )
    total = F.sum("Count").alias("total")
    top_opcos = [
        r["OpCo"] for r in counts.groupBy("OpCo").agg(total).orderBy(F.desc("total"), "OpCo").limit(opcos).collect()
    ]
    top_patterns = (
        counts.groupBy("Pattern").agg(total).orderBy(F.desc("total"), "Pattern").limit(patterns).select("Pattern")
    )
    wide = (
        counts.join(top_patterns, "Pattern", "left_semi")
        .groupBy("Pattern")
        .agg(
            F.array(
                *[
                    F.struct(
                        F.lit(o).alias("OpCo"),
                        F.coalesce(F.sum(F.when(F.col("OpCo") == o, F.col("Count"))), F.lit(0)).alias("Count"),
                    )
                    for o in top_opcos
                ]
            ).alias("cells")
        )
    )
    return wide.select("Pattern", F.explode("cells").alias("c")).select("Pattern", "c.OpCo", "c.Count")


def opco_recurrence(tickets: DataFrame, catalog: DataFrame, top: int = TOP_RECURRENCE) -> DataFrame:
    def of(system: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("System_Type") == system, F.col("rows"))), F.lit(0))

    return (
        _opco_counts(tickets, catalog)
        .groupBy("Pattern", "OpCo")
        .agg(of(N.LEGACY).alias("Legacy"), of(N.NEW).alias("DBB"))
        .withColumn("Total", F.col("Legacy") + F.col("DBB"))
        .orderBy(F.desc("Total"), "Pattern", "OpCo")
        .limit(top)
    )


# ---- catalog reports -------------------------------------------------------
def change_percent(old: Column, new: Column) -> Column:
    return ratio(new - old, old) * 100


def trend_verdict(catalog: DataFrame) -> DataFrame:
    old, new = F.col("Frequency_Legacy"), F.col("Frequency_DBB")
    trend = (
        F.when((old == 0) & (new > 0), F.lit("New in DBB"))
        .when((old > 0) & (new == 0), F.lit("Eliminated"))
        .when((old > 0) & (new > 0), signed_percent(change_percent(old, new)))
        .otherwise(F.lit("-"))
    )
    return valid_catalog(catalog).select("Cluster_ID", "Frequency_Legacy", "Frequency_DBB", trend.alias("Trend"))


def root_cause_map(catalog: DataFrame) -> DataFrame:
    valid = valid_catalog(catalog)
    empty = F.lit("")
    return valid.where(filled(optional(valid, "Analysis"))).select(
        "Cluster_ID",
        pattern_name(valid).alias("Pattern"),
        F.coalesce(optional(valid, "Strategic_Persona"), empty).alias("Persona"),
        optional(valid, "Analysis").alias("Root_Cause"),
        F.coalesce(optional(valid, "Recommendation"), empty).alias("Prevention"),
        F.col("Frequency_Legacy").alias("Legacy_Tickets"),
        F.col("Frequency_DBB").alias("DBB_Tickets"),
    )


def reappeared_patterns(catalog: DataFrame) -> DataFrame:
    """Old patterns that came back in the new system, the worst change first."""
    old, new = F.col("Frequency_Legacy"), F.col("Frequency_DBB")
    valid = valid_catalog(catalog).where((old > 0) & (new > 0))
    change = half_even(change_percent(old, new), 0)
    share = half_even(ratio(new, old + new), 3)
    return valid.select(
        "Cluster_ID",
        pattern_name(valid).alias("Pattern"),
        old.alias("Legacy_Tickets"),
        new.alias("DBB_Tickets"),
        change.alias("Change"),
        percent(share).alias("DBB_Share"),
        signed_percent(change).alias("Change_vs_Legacy"),
        optional(valid, "Analysis").alias("Root_Cause"),
        optional(valid, "Recommendation").alias("Prevention"),
        F.when(change > 0, F.lit("worse")).otherwise(F.lit("lower")).alias("Outcome"),
    ).orderBy(F.desc("Change"), "Cluster_ID")


def introduced_patterns(catalog: DataFrame) -> DataFrame:
    valid = valid_catalog(catalog).where(F.col("Frequency_Legacy") == 0)
    return valid.select("Cluster_ID", pattern_name(valid).alias("Pattern"), F.col("Frequency_DBB").alias("DBB_Tickets"))


def eliminated_patterns(catalog: DataFrame) -> DataFrame:
    valid = valid_catalog(catalog).where(F.col("Frequency_DBB") == 0)
    return valid.select(
        "Cluster_ID", pattern_name(valid).alias("Pattern"), F.col("Frequency_Legacy").alias("Legacy_Tickets")
    )


def cluster_card(catalog: DataFrame) -> DataFrame:
    """One card per cluster: name, persona, texts, resolution times and their comparison."""
    valid = valid_catalog(catalog)
    delta = F.col("AvgTTR_Delta_Hours")
    verdict = (
        F.when(delta > 0, F.lit("DBB slower")).when(delta < 0, F.lit("DBB faster")).otherwise(F.lit("No comparison"))
    )
    return valid.select(
        "Cluster_ID",
        pattern_name(valid).alias("Pattern"),
        F.coalesce(optional(valid, "Strategic_Persona"), F.lit("")).alias("Persona"),
        "Size",
        "Frequency_Legacy",
        "Frequency_DBB",
        "Top_Keywords",
        "Primary_Domains",
        F.coalesce(optional(valid, "Analysis"), F.lit("")).alias("Root_Cause"),
        F.coalesce(optional(valid, "Recommendation"), F.lit("")).alias("Prevention"),
        hours_text(F.col("AvgTTR_Legacy_Hours")).alias("Legacy_MTTR"),
        hours_text(F.col("AvgTTR_DBB_Hours")).alias("DBB_MTTR"),
        hours_text(F.abs(delta)).alias("MTTR_Delta"),
        verdict.alias("MTTR_Verdict"),
    )


def cluster_labels(catalog: DataFrame) -> DataFrame:
    valid = valid_catalog(catalog)
    name, persona = pattern_name(valid), optional(valid, "Strategic_Persona")
    label = F.when(filled(persona), F.concat(F.lit("["), persona, F.lit("] "), name)).otherwise(name)
    return valid.select("Cluster_ID", label.alias("Label"))


def first_tickets(tickets: DataFrame, n: int, order: str = "Ticket_ID") -> DataFrame:
    """The first ``n`` tickets per cluster with their position.

    The rank limit is applied in every input partition before the shuffle, so a
    huge cluster sends ``n`` rows per partition, not all of its tickets.
    """
    position = F.row_number().over(Window.partitionBy("Cluster_ID").orderBy(order))
    return tickets.withColumn("Position", position).where(F.col("Position") <= n)


def cluster_samples(tickets: DataFrame, n: int = CARD_SAMPLES) -> DataFrame:
    wanted = (
        "Cluster_ID", "Position", "Ticket_ID", "System_Type", "System_Subtype", "Domain", "Short_Description",
        "Severity", "Reopen_Flag",
    )
    columns = [c for c in wanted if c in tickets.columns]
    return keep_existing(first_tickets(tickets.select(*columns), n), wanted)


def verdict_badge(summary: DataFrame) -> DataFrame:
    verdict = F.col("legacy_to_dbb_verdict")
    return summary.where(filled(verdict)).select(
        verdict.alias("Verdict"),
        label_of(verdict, VERDICT_COLOURS, F.lit("Grey")).alias("Colour"),
        F.initcap(F.replace(verdict, F.lit("_"), F.lit(" "))).alias("Title"),
    )
