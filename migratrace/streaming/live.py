"""The row-wise operators on a stream of raw tickets.

Classification, parsing, severity by dictionary and text cleaning are plain
column expressions, so they run on a streaming DataFrame as they are.  What the
whole table decides (the first new-system ticket) comes in as a known value.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from migratrace import names as N
from migratrace.functions.columns import DATE_FORMATS, Formats, col, formats_of, parse_timestamp
from migratrace.functions.text import clean_text, error_codes, full_text
from migratrace.operators.classify import classify, noise_condition
from migratrace.operators.normalize import DEFAULT_SEVERITY, severity_from_dictionary, time_to_resolve
from migratrace.operators.rules import DEFAULT_RULES, Rule


def label_stream(
    raw: DataFrame,
    migration_start: datetime | None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    formats: Formats = DATE_FORMATS,
) -> DataFrame:
    """Labels, noise flag, severity, hours to resolve and clean text per incoming ticket."""
    start = F.lit(migration_start).cast("timestamp_ntz")
    created, closed = (parse_timestamp(col(n), formats_of(formats, n)) for n in (N.CREATED, N.CLOSED))
    text = full_text(col(N.SHORT), col(N.DESCRIPTION))
    return classify(raw, rules).withColumns(
        {
            "post_migration_noise": noise_condition(start, formats=formats_of(formats, N.CREATED)),
            "Severity": F.coalesce(severity_from_dictionary(col(N.PRIORITY)), F.lit(DEFAULT_SEVERITY)),
            "Time_to_Resolve": time_to_resolve(created, closed),
            "Clean_Text": clean_text(text),
            "Extracted_Errors": error_codes(text),
        }
    )
