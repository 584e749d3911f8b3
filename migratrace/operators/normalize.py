"""From classified tickets to the canonical table with its derived metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from migratrace import names as N
from migratrace.functions.columns import (
    DATE_FORMATS,
    Formats,
    col,
    elapsed_micros,
    formats_of,
    month_start,
    number,
    parse_timestamp,
    text_or_empty,
    week_start,
)
from migratrace.session import materialize

# ---- fixed values: priority text to severity -------------------------------
SEVERITY_BY_PRIORITY = {"1 - Critical": 4.0, "2 - High": 3.0, "3 - Moderate": 2.0, "4 - Low": 1.0}
DEFAULT_SEVERITY = 1.0
SHORTEST_RESOLUTION_HOURS = 0.1
MICROS_PER_HOUR = 3_600_000_000.0
MICROS_PER_DAY = 86_400_000_000


def severity_from_dictionary(priority: Column) -> Column:
    """Null where the text is not one of the known priorities."""
    chain = None
    for text, value in SEVERITY_BY_PRIORITY.items():
        chain = F.when(priority == text, F.lit(value)) if chain is None else chain.when(priority == text, F.lit(value))
    return chain


def severity_from_digits(priority: Column) -> Column:
    """5 minus the first number in the text; null where there is none."""
    digits = F.nullif(F.regexp_extract(priority.cast("string"), r"(\d+)", 1), F.lit(""))
    return F.lit(5.0) - digits.try_cast("double")


def with_severity(df: DataFrame, priority: str = N.PRIORITY, out: str = "Severity") -> DataFrame:
    """Dictionary severities, or the digit fallback if no row at all is in the dictionary.

    Whether any row matches is a scalar subquery on the one priority column.
    """
    p = col(priority)
    any_match = df.agg(
        F.coalesce(F.bool_or(p.isin(*SEVERITY_BY_PRIORITY)), F.lit(False)).alias("any_match")
    ).scalar()
    return (
        df.withColumn("__any", any_match)
        .withColumn(
            out,
            F.coalesce(
                F.when(F.col("__any"), severity_from_dictionary(p)).otherwise(severity_from_digits(p)),
                F.lit(DEFAULT_SEVERITY),
            ),
        )
        .drop("__any")
    )


def time_to_resolve(created: Column, closed: Column) -> Column:
    """Hours from creation to closing, at least 0.1; null when either is missing."""
    hours = elapsed_micros(created, closed) / F.lit(MICROS_PER_HOUR)
    return F.when(hours.isNotNull(), F.greatest(hours, F.lit(SHORTEST_RESOLUTION_HOURS)))


def resolution_notes(close_notes: Column, comments: Column) -> Column:
    return F.concat(text_or_empty(close_notes), F.lit(" "), text_or_empty(comments))


def migration_dates(
    df: DataFrame, module: str = "Module", created: str = "Created_Date", system: str = N.NEW
) -> DataFrame:
    """First new-system ticket per module: one pass, one row per module with such tickets."""
    new_only = F.when(F.col("System_Type") == system, col(created))
    return (
        df.groupBy(col(module).alias("Module"))
        .agg(F.min(new_only).alias("Migration_Date"))
        .where(F.col("Migration_Date").isNotNull())
    )


def with_days_from_migration(
    df: DataFrame, module: str = "Module", created: str = "Created_Date", marker: str = N.NEW
) -> DataFrame:
    """Whole days (floor) since the module's migration date, else since the global one.

    The dates are written to a table first, so the lookup join is planned from
    its real size: broadcast while small, a skew-handled shuffle join beyond.
    """
    dates = materialize(migration_dates(df, module, created), "migration-dates")
    global_date = dates.agg(F.min("Migration_Date").alias("d")).scalar()
    per_module = dates.where(F.col("Module").contains(marker)).select(
        F.col("Module").alias("__module"), F.col("Migration_Date").alias("__module_date")
    )
    start = F.coalesce(F.col("__module_date"), F.col("__global_date"))
    return (
        df.join(per_module, col(module) == F.col("__module"), "left")
        .withColumn("__global_date", global_date)
        .withColumn(
            "Days_from_Migration",
            F.floor(elapsed_micros(start, col(created)) / F.lit(float(MICROS_PER_DAY))).cast("long"),
        )
        .drop("__module", "__module_date", "__global_date")
    )


def canonical_projection(df: DataFrame) -> DataFrame:
    """The 23 columns in order; a missing one becomes a null column."""
    present = set(df.columns)
    return df.select(
        *[
            (col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in N.CANONICAL_SCHEMA
        ]
    )


def normalize(
    classified: DataFrame,
    default_opco: str = N.DEFAULT_OPCO,
    formats: Formats = DATE_FORMATS,
) -> DataFrame:
    """Canonical tickets from a classified table with the raw column names."""
    present = set(classified.columns)

    def raw(name: str) -> Column:
        return col(name) if name in present else F.lit(None).cast("string")

    created = parse_timestamp(raw(N.CREATED), formats_of(formats, N.CREATED))
    closed = parse_timestamp(raw(N.CLOSED), formats_of(formats, N.CLOSED))
    reopens = F.coalesce(number(raw(N.REOPENS)), F.lit(0.0))
    base = classified.select(
        raw(N.NUMBER).alias("Ticket_ID"),
        *[raw(c).alias(c) for c in ("System_Type", "System_Subtype", "Primary_System")],
        F.coalesce(raw(N.SERVICE), F.lit(N.DEFAULT_DOMAIN)).alias("Domain"),
        raw("System_Subtype").alias("Module"),
        F.coalesce(raw(N.OPCO), F.lit(default_opco)).alias("OpCo"),
        text_or_empty(raw(N.SHORT)).alias("Short_Description"),
        text_or_empty(raw(N.DESCRIPTION)).alias("Description_Text"),
        resolution_notes(raw(N.CLOSE_NOTES), raw(N.COMMENTS)).alias("Resolution_Notes"),
        created.alias("Created_Date"),
        closed.alias("Closed_Date"),
        raw(N.PRIORITY).alias("__priority"),
        reopens.alias("Reopen_Count"),
        (reopens > 0).alias("Reopen_Flag"),
        F.coalesce(raw(N.GROUP), F.lit(N.DEFAULT_TEAM)).alias("Assignee_Team"),
        *[raw(c).alias(c) for c in ("label_confidence", "label_source", "post_migration_noise")],
    )
    timed = base.withColumns(
        {
            "Time_to_Resolve": time_to_resolve(F.col("Created_Date"), F.col("Closed_Date")),
            "Week": week_start(F.col("Created_Date")),
            "Month": month_start(F.col("Created_Date")),
        }
    )
    return canonical_projection(with_days_from_migration(with_severity(timed, "__priority")))
