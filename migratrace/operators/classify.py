"""Rule-cascade classification of tickets and what follows from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from migratrace import names as N
from migratrace.functions.columns import DATE_FORMATS, col, lower_text, number, parse_timestamp
from migratrace.operators.rules import DEFAULT_RULES, Rule, sql_text


def _case(rules: Sequence[Rule], lowered: dict[str, str], value, otherwise: str) -> str:
    branches = " ".join(f"WHEN {r.sql_condition(lowered)} THEN {value(i, r)}" for i, r in enumerate(rules))
    return f"CASE {branches} ELSE {otherwise} END" if rules else otherwise


def classify(
    df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES, prefix: str = ""
) -> DataFrame:
    """Add the label columns; the first matching rule wins.

    One narrow projection: the tests form a single CASE expression that yields
    a rule number, and the labels are read from constant arrays at that number.
    ``prefix`` is that of the mapped columns when they stand beside originals.
    """
    used = sorted(set().union(*[r.columns for r in rules]))
    present = set(df.columns)
    lowered = {c: f"__lower_{i}" for i, c in enumerate(used)}
    kept = [col(c) for c in df.columns if c not in N.LABEL_COLUMNS]
    prepared = df.select(
        *kept,
        *[
            (lower_text(prefix + c) if prefix + c in present else F.lit("")).alias(t)
            for c, t in lowered.items()
        ],
    )
    position = _case(rules, lowered, lambda i, _: str(i), str(len(rules)))
    picked = prepared.select(*kept, F.expr(position).alias("__rule"))

    def labels(value, default: str) -> str:
        listed = ", ".join([value(r) for r in rules] + [default])
        return f"array({listed})[__rule]"

    fixed = {
        "System_Type": labels(lambda r: sql_text(r.system_type), sql_text(N.UNKNOWN)),
        "System_Subtype": labels(lambda r: sql_text(r.subtype), sql_text(N.UNKNOWN)),
        "Primary_System": labels(lambda r: sql_text(r.primary), sql_text(N.NO_PRIMARY_SYSTEM)),
        "label_confidence": labels(lambda r: f"{r.confidence}D", "0.0D"),
        "label_source": labels(lambda r: sql_text(r.source), sql_text("none")),
        "mapping_version": sql_text(N.MAPPING_VERSION),
        "human_override_flag": "false",
        "post_migration_noise": "false",
    }
    return picked.select(*kept, *[F.expr(e).alias(name) for name, e in fixed.items()])


def first_new_system_ticket(
    df: DataFrame, created: str = N.CREATED, system: str = N.NEW, formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """One row, one column: the earliest creation time among new-system tickets.

    A conditional minimum rather than a filter: pushed below the classification,
    the filter would make every ticket go through the rules twice.
    """
    ts = parse_timestamp(col(created), formats)
    return df.agg(F.min(F.when(F.col("System_Type") == system, ts)).alias("start"))


def noise_condition(
    start: Column, created: str = N.CREATED, reopens: str = N.REOPENS, days: int = 90, formats: Sequence[str] = DATE_FORMATS
) -> Column:
    ts = parse_timestamp(col(created), formats)
    reopened = F.coalesce(number(col(reopens)), F.lit(0.0)) >= 1
    inside = (ts >= start) & (ts <= start + F.make_dt_interval(F.lit(days)))
    return F.coalesce(reopened & inside, F.lit(False))


def flag_migration_noise(
    classified: DataFrame,
    created: str = N.CREATED,
    reopens: str = N.REOPENS,
    days: int = 90,
    formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Flag reopened tickets of any system within ``days`` of the first new-system ticket.

    The start is a scalar subquery over two columns of the table.
    """
    start = first_new_system_ticket(classified, created, formats=formats).scalar()
    return (
        classified.withColumn("__start", start)
        .withColumn("post_migration_noise", noise_condition(F.col("__start"), created, reopens, days, formats))
        .drop("__start")
    )


def class_distribution(classified: DataFrame) -> DataFrame:
    return classified.groupBy("System_Type").agg(F.count(F.lit(1)).alias("count"))


def review_queue(classified: DataFrame, unknown: str = N.UNKNOWN) -> DataFrame:
    """Unlabelled tickets with empty columns for the human reviewer."""
    return classified.where(F.col("System_Type") == unknown).withColumns(
        {c: F.lit("") for c in ("SME_Label", "SME_Notes", "override_date")}
    )
