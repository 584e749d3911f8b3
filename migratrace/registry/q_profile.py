"""Profiling checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from migratrace import names as N
from migratrace.functions.columns import col
from migratrace.operators import profile as P
from migratrace.registry.tickets import raw_tickets, with_views


def _plain(df):
    return df.select(*[col(c).alias(c.replace(" ", "_")) for c in df.columns])


def _over_raw(check):
    return lambda spark, folder: _plain(check(raw_tickets(spark, folder)))


QUERIES = {
    "profile_id_prefix": _over_raw(P.id_prefixes),
    "profile_number_range": _over_raw(P.number_range),
    "profile_ownership": _over_raw(P.ownership),
    "profile_group_tuples": _over_raw(P.group_tuples),
    "profile_text_signature": _over_raw(P.text_signature),
    "profile_signature_count": _over_raw(lambda df: P.match_count(df, P.matches(N.SHORT, P.TEXT_SIGNATURE))),
    "profile_signals": _over_raw(P.middleware_signals),
    "profile_signal_count": _over_raw(lambda df: P.match_count(df, P.middleware_condition())),
    "profile_date_range": _over_raw(P.date_ranges),
    "profile_negative_refs": _over_raw(P.negative_references),
    "profile_both_candidates": _over_raw(P.both_candidates),
}


def _counts(condition: str, columns: list[str], limit: int | None) -> str:
    shown = ", ".join(f'"{c}" AS "{c.replace(" ", "_")}"' for c in columns)
    known = " AND ".join(f'"{c}" IS NOT NULL' for c in columns)
    keys = ", ".join(f'"{c}"' for c in columns)
    cut = f"ORDER BY count(*) DESC, {keys} LIMIT {limit}" if limit else ""
    return with_views(
        "raw", f'SELECT {shown}, count(*) AS "count" FROM raw WHERE ({condition}) AND {known} GROUP BY {keys} {cut}'
    )


_SIGNATURE = "regexp_matches(\"Short description\", 'glassrun|otd', 'i')"
_MIDDLEWARE = """coalesce(contains("Business service", 'Middleware'), false)
OR coalesce(regexp_matches("Service offering", 'integration|middleware|boomi|sap po|pi/po', 'i'), false)
OR coalesce(regexp_matches("Configuration item", 'integration|middleware|boomi|sap po', 'i'), false)
OR coalesce(regexp_matches("Assignment group", 'integration|middleware|digital integration', 'i'), false)"""

SQL = {
    "profile_id_prefix": with_views(
        "raw",
        """SELECT regexp_extract("Number", '^([A-Z]+)', 1) AS num_prefix, count(*) AS "count" FROM raw GROUP BY 1""",
    ),
    "profile_number_range": with_views(
        "raw",
        """SELECT min(CAST(regexp_extract("Number", '([0-9]+)$', 1) AS BIGINT)) AS min_number,
        max(CAST(regexp_extract("Number", '([0-9]+)$', 1) AS BIGINT)) AS max_number FROM raw""",
    ),
    "profile_ownership": _counts(
        "regexp_matches(\"Configuration item\", 'omni', 'i')", [N.CI, N.GROUP, N.OFFERING, N.SERVICE], 20
    ),
    "profile_group_tuples": _counts("contains(\"Assignment group\", 'Tiger Tribe')", [N.CI, N.OFFERING, N.SERVICE], None),
    "profile_text_signature": _counts(_SIGNATURE, [N.SHORT], 10),
    "profile_signature_count": with_views("raw", f"SELECT count(*) FILTER (WHERE {_SIGNATURE}) AS tickets FROM raw"),
    "profile_signals": _counts(_MIDDLEWARE, [N.CI, N.OFFERING, N.SERVICE, N.GROUP], 20),
    "profile_signal_count": with_views("raw", f"SELECT count(*) FILTER (WHERE {_MIDDLEWARE}) AS tickets FROM raw"),
    "profile_date_range": with_views(
        "raw",
        """SELECT min(created_ts) AS "min_Created", max(created_ts) AS "max_Created",
        min(closed_ts) AS "min_Closed", max(closed_ts) AS "max_Closed" FROM raw""",
    ),
    "profile_negative_refs": with_views(
        "raw",
        """SELECT "Number", "Short description" AS "Short_description", "Service offering" AS "Service_offering",
        "Assignment group" AS "Assignment_group" FROM raw WHERE regexp_matches("Service offering", 'non-dbb', 'i')""",
    ),
    "profile_both_candidates": _counts(
        """coalesce(regexp_matches("Short description", 'integrat|sync|interface|api|middleware|boomi|sap po', 'i'), false)
        OR coalesce(regexp_matches("Service offering", 'integration|digital integration supply chain|commerce integration', 'i'), false)""",
        [N.OFFERING, N.GROUP, N.SERVICE],
        15,
    ),
}
