"""Exact means and medians without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from migratrace.session import materialize


def exact_median(df: DataFrame, group: str, value: str, width: float = 1.0) -> DataFrame:
    """Mean, exact median and number of values per group: ``mean``, ``median``, ``n``.

    Values are first counted per distinct value (combined before the shuffle).
    Cumulative counts over slots of the given width find the slot of the middle
    ranks; only the distinct values inside those slots are then ordered.  A group
    of any size or skew is thus reduced by aggregation, never sorted as a whole,
    and the table is scanned once.  A group without any value has nulls and 0.
    """
    counts = materialize(
        df.where(F.col(group).isNotNull())
        .groupBy(F.col(group).alias("g"), F.col(value).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("slot", F.floor(F.col("v") / F.lit(width))),
        "value-counts",
    )
    by_slot = Window.partitionBy("g").orderBy("slot")
    slots = (
        counts.where(F.col("v").isNotNull()).groupBy("g", "slot")
        .agg(F.sum("n").alias("n"))
        .withColumn("before", F.sum("n").over(by_slot.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("before", F.coalesce("before", F.lit(0)))
        .withColumn("total", F.sum("n").over(Window.partitionBy("g")))
        .withColumn("low", F.floor((F.col("total") + 1) / 2))
        .withColumn("high", F.floor((F.col("total") + 2) / 2))
    )
    # the slots that hold the lower or the upper middle rank: one or two per group
    middle = slots.where(
        ((F.col("before") < F.col("low")) & (F.col("before") + F.col("n") >= F.col("low")))
        | ((F.col("before") < F.col("high")) & (F.col("before") + F.col("n") >= F.col("high")))
    ).select("g", "slot", "before", "total", "low", "high")
    inside = Window.partitionBy("g", "slot").orderBy("v")
    placed = (
        counts.select("g", "slot", "v", F.col("n").alias("k"))
        .join(middle, ["g", "slot"])
        .withColumn("upto", F.col("before") + F.sum("k").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("from", F.col("upto") - F.col("k"))
    )

    def at(rank: str):
        return F.max(F.when((F.col("from") < F.col(rank)) & (F.col("upto") >= F.col(rank)), F.col("v")))

    medians = placed.groupBy("g").agg(((at("low") + at("high")) / 2).alias("median"))
    present = F.col("v").isNotNull()
    totals = counts.groupBy("g").agg(
        F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("n"), F.sum(F.col("v") * F.col("n")).alias("sum")
    )
    return totals.join(medians, "g", "left").select(
        F.col("g").alias(group), F.try_divide("sum", F.col("n")).alias("mean"), "median", "n"
    )
