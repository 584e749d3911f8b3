"""Null-safe scalar expressions (ANSI mode is on, so every cast is a try)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted besides ISO 8601 text with a four-digit year; the first pattern that parses wins.
DAY_FIRST = ("d-M-yyyy[ H:mm[:ss]]", "d/M/yyyy[ H:mm[:ss]]", "d-M-yyyy h:mm[:ss] a", "d/M/yyyy h:mm[:ss] a", "MMM d yyyy")
MONTH_FIRST = ("M-d-yyyy[ H:mm[:ss]]", "M/d/yyyy[ H:mm[:ss]]", "M-d-yyyy h:mm[:ss] a", "M/d/yyyy h:mm[:ss] a", "MMM d yyyy")
DATE_FORMATS = DAY_FIRST
ISO_START = r"^\d{4}-\d{1,2}-\d{1,2}"

Formats = Sequence[str] | Mapping[str, Sequence[str]]


def col(name: str) -> Column:
    """A top-level column, whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def lower_text(name: str) -> Column:
    return F.lower(F.coalesce(col(name).cast("string"), F.lit("")))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def parse_timestamp(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Timestamp without zone, or null when no format fits."""
    text = F.trim(c.cast("string"))
    tries = [F.when(text.rlike(ISO_START), text).try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def formats_of(formats: Formats, name: str) -> Sequence[str]:
    """The patterns of one column, where they are given per column."""
    return formats.get(name, DATE_FORMATS) if isinstance(formats, Mapping) else formats


def date_formats(df: DataFrame, names: Sequence[str]) -> dict[str, Sequence[str]]:
    """Day first or month first, one order for all the columns: whichever reads more of their values, month first on a tie.

    An export writes its dates in one way, so a column whose days are all small
    follows the others.  One aggregate over all values of all the columns.
    """
    present = [n for n in dict.fromkeys(names) if n in df.columns]
    if not present:
        return {}
    counts = [
        F.count(parse_timestamp(col(n), f)).alias(f"{kind}{i}")
        for i, n in enumerate(present)
        for kind, f in (("day", DAY_FIRST), ("month", MONTH_FIRST))
    ]
    found = df.agg(*counts).first()
    day, month = (sum(found[f"{kind}{i}"] for i in range(len(present))) for kind in ("day", "month"))
    return dict.fromkeys(present, DAY_FIRST if day > month else MONTH_FIRST)


def number(c: Column) -> Column:
    """The number in a text, or null; a literal suffix such as ``1d`` or NaN is none."""
    text = F.trim(c.cast("string"))
    value = F.when(~text.rlike("[dDfF]$"), text).try_cast("double")
    return F.when(~F.isnan(value), value)


def half_even(c: Column, digits: int) -> Column:
    """Round half to even after scaling, as array libraries do."""
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` in double, null when ``b`` is zero or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def week_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "week").cast("timestamp_ntz")


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month").cast("timestamp_ntz")


def year_month(ts: Column) -> Column:
    """``yyyy-MM``; a missing timestamp becomes the text ``NaT``."""
    text = F.concat_ws(
        "-", F.lpad(F.year(ts).cast("string"), 4, "0"), F.lpad(F.month(ts).cast("string"), 2, "0")
    )
    return F.when(ts.isNull(), F.lit("NaT")).otherwise(text)


def elapsed_micros(start: Column, end: Column) -> Column:
    """Microseconds between two zone-less timestamps."""
    return F.timestamp_diff("MICROSECOND", start, end)


def hours_text(hours: Column) -> Column:
    """``N/A``, ``5.0h`` below a day, else ``2.5d``."""
    return (
        F.when(hours.isNull(), F.lit("N/A"))
        .when(hours < 24, F.concat(fixed(hours, 1), F.lit("h")))
        .otherwise(F.concat(fixed(hours / 24, 1), F.lit("d")))
    )


def fixed(c: Column, digits: int) -> Column:
    """Text with a fixed number of decimals, halves to even; null stays null."""
    return F.when(c.isNotNull(), F.format_string(f"%.{digits}f", half_even(c, digits)))


def percent(c: Column, digits: int = 1) -> Column:
    return F.concat(fixed(c * 100, digits), F.lit("%"))


def signed_percent(c: Column) -> Column:
    """``+13%``, ``-5%``, ``+0%`` of a value already in percent."""
    return F.when(c.isNotNull(), F.concat(F.format_string("%+.0f", half_even(c, 0)), F.lit("%")))


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Projection on those of the wanted columns that exist."""
    present = set(df.columns)
    return df.select(*[col(c) for c in wanted if c in present])


def exclude_noise(df: DataFrame, cluster: str = "Cluster_ID", noise: int = -1) -> DataFrame:
    return df.where(col(cluster) != noise)
