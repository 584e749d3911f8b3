"""Data-profiling checks on a raw export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from migratrace import names as N
from migratrace.functions.columns import col, parse_timestamp

# ---- fixed values: search patterns -----------------------------------------
OWNERSHIP_PATTERN = "omni"
GROUP_TEXT = "Tiger Tribe"
TEXT_SIGNATURE = "glassrun|otd"
MIDDLEWARE_CASED = {N.SERVICE: "Middleware"}
MIDDLEWARE = {
    N.OFFERING: "integration|middleware|boomi|sap po|pi/po",
    N.CI: "integration|middleware|boomi|sap po",
    N.GROUP: "integration|middleware|digital integration",
}
NEGATIVE_REFERENCE = "non-dbb"
BOTH_SIGNALS = {
    N.SHORT: "integrat|sync|interface|api|middleware|boomi|sap po",
    N.OFFERING: "integration|digital integration supply chain|commerce integration",
}
# ---- end of fixed values ---------------------------------------------------


def matches(column: str, pattern: str, cased: bool = False) -> Column:
    """Whether the pattern occurs; null never matches."""
    return F.coalesce(col(column).rlike(pattern if cased else f"(?iu){pattern}"), F.lit(False))


def matches_any(patterns: Mapping[str, str], cased: bool = False) -> Column:
    return reduce(lambda a, b: a | b, [matches(c, p, cased) for c, p in patterns.items()])


def value_counts(df: DataFrame, columns: Sequence[str], top: int | None = None) -> DataFrame:
    """Frequency of the value tuples without nulls, most frequent first."""
    keys = [col(c) for c in columns]
    complete = reduce(lambda a, b: a & b, [k.isNotNull() for k in keys])
    counted = df.where(complete).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    ordered = counted.orderBy(F.desc("count"), *keys)
    return ordered.limit(top) if top is not None else ordered


def id_prefixes(df: DataFrame, number: str = N.NUMBER) -> DataFrame:
    """How often each run of leading capitals begins a ticket number."""
    prefix = F.nullif(F.regexp_extract(col(number).cast("string"), "^([A-Z]+)", 1), F.lit(""))
    return value_counts(df.select(prefix.alias("num_prefix")), ["num_prefix"])


def number_range(df: DataFrame, number: str = N.NUMBER) -> DataFrame:
    """Smallest and largest number at the end of a ticket number."""
    digits = F.nullif(F.regexp_extract(col(number).cast("string"), "([0-9]+)$", 1), F.lit("")).try_cast("bigint")
    return df.agg(F.min(digits).alias("min_number"), F.max(digits).alias("max_number"))


def ownership(df: DataFrame, pattern: str = OWNERSHIP_PATTERN, top: int = 20) -> DataFrame:
    return value_counts(df.where(matches(N.CI, pattern)), [N.CI, N.GROUP, N.OFFERING, N.SERVICE], top)


def group_tuples(df: DataFrame, text: str = GROUP_TEXT) -> DataFrame:
    return value_counts(df.where(matches(N.GROUP, text, cased=True)), [N.CI, N.OFFERING, N.SERVICE])


def text_signature(df: DataFrame, pattern: str = TEXT_SIGNATURE, top: int = 10) -> DataFrame:
    return value_counts(df.where(matches(N.SHORT, pattern)), [N.SHORT], top)


def match_count(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(F.count_if(condition).alias("tickets"))


def middleware_condition() -> Column:
    return matches_any(MIDDLEWARE_CASED, cased=True) | matches_any(MIDDLEWARE)


def middleware_signals(df: DataFrame, top: int = 20) -> DataFrame:
    return value_counts(df.where(middleware_condition()), [N.CI, N.OFFERING, N.SERVICE, N.GROUP], top)


def date_ranges(df: DataFrame, columns: Sequence[str] = (N.CREATED, N.CLOSED)) -> DataFrame:
    """Earliest and latest value of the date columns that exist."""
    found = [c for c in columns if c in df.columns]
    stats = []
    for c in found:
        ts = parse_timestamp(col(c))
        stats += [F.min(ts).alias(f"min_{c}"), F.max(ts).alias(f"max_{c}")]
    return df.agg(*stats) if stats else df.select().limit(0)


def negative_references(df: DataFrame, pattern: str = NEGATIVE_REFERENCE) -> DataFrame:
    return df.where(matches(N.OFFERING, pattern)).select(
        *[col(c) for c in (N.NUMBER, N.SHORT, N.OFFERING, N.GROUP)]
    )


def both_candidates(df: DataFrame, top: int = 15) -> DataFrame:
    return value_counts(df.where(matches_any(BOTH_SIGNALS)), [N.OFFERING, N.GROUP, N.SERVICE], top)
