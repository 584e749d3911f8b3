"""Normalization queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from migratrace import names as N
from migratrace.functions.columns import col, date_formats, month_start, parse_timestamp, week_start
from migratrace.operators.normalize import (
    migration_dates,
    normalize,
    time_to_resolve,
    with_days_from_migration,
    with_severity,
)
from migratrace.plans.study import classify_export, normalize_export
from migratrace.registry.q_classify import renamed_export
from migratrace.registry.tickets import (
    CONVERSATION_SQL,
    canonical_tickets,
    classified_tickets,
    raw_tickets,
    table,
    with_views,
)

_PRIORITY_TEXTS = ("1 - Critical", "2 - High", "3 - Moderate", "4 - Low")


def _text_free(df):
    return df.drop("Description_Text", "Resolution_Notes")


def normalize_canonical(spark, folder):
    return _text_free(canonical_tickets(spark, folder))


def canonical_export(spark, folder):
    """A labelled foreign export through the canonical column rules, decoy columns beside the real ones."""
    return _text_free(normalize_export(classify_export(renamed_export(spark, folder))))


def canonical_texts(spark, folder):
    """Whole texts of the canonical ticket, null parts included."""
    description, notes = col("Description_Text"), col("Resolution_Notes")
    return canonical_tickets(spark, folder, texts=True).select(
        "Ticket_ID",
        F.length(description).cast("long").alias("Description_Length"),
        F.md5(description).alias("Description_Hash"),
        F.md5(notes).alias("Notes_Hash"),
    )


def severity_dictionary(spark, folder):
    """Priorities of the dictionary kind; the fifth level has no entry and gets the default."""
    raw = raw_tickets(spark, folder)
    level = F.substring(col(N.PRIORITY), 1, 1)
    text = F.lit("5 - Planning")
    for value in _PRIORITY_TEXTS:
        text = F.when(level == value[0], F.lit(value)).otherwise(text)
    typed = raw.select(N.NUMBER, text.alias(N.PRIORITY))
    return with_severity(typed).select(N.NUMBER, N.PRIORITY, "Severity")


def _dates(spark, folder, written):
    """Order dates written in a style of an export and read back, the order of day and month found from the column."""
    orders = table(spark, folder, "orders").select("o_orderkey", written(F.col("o_orderdate").cast("timestamp")).alias(N.CREATED))
    found = date_formats(orders, [N.CREATED])[N.CREATED]
    return orders.select("o_orderkey", parse_timestamp(col(N.CREATED), found).alias("parsed"))


def dates_month_first(spark, folder):
    return _dates(spark, folder, lambda ts: F.date_format(ts, "MM/dd/yyyy HH:mm"))


def dates_day_first(spark, folder):
    return _dates(spark, folder, lambda ts: F.date_format(ts, "d/M/yyyy h:mm a"))


def dates_mixed(spark, folder):
    """ISO text and month-first text in one column, and numbers that are no dates."""
    odd = F.col("o_orderkey") % 3
    return _dates(
        spark,
        folder,
        lambda ts: F.when(odd == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(odd == 1, F.date_format(ts, "M/d/yyyy"))
        .otherwise(F.date_format(ts, "yyyyMMdd")),
    )


def dates_two_columns(spark, folder):
    """An export whose creation dates all have days up to 12 and whose closing dates do not: one order reads both."""
    orders = table(spark, folder, "orders")
    early = F.date_add(F.trunc("o_orderdate", "month"), F.dayofmonth("o_orderdate") % 12).cast("timestamp")
    closed = F.date_add(F.last_day("o_orderdate"), (F.col("o_orderkey") % 20).cast("int")).cast("timestamp")
    written = orders.select(
        F.col("o_orderkey").alias(N.NUMBER),
        F.date_format(early, "dd/MM/yyyy HH:mm").alias(N.CREATED),
        F.date_format(closed, "dd/MM/yyyy").alias(N.CLOSED),
    )
    found = date_formats(written, [N.CREATED, N.CLOSED])
    times = [parse_timestamp(col(n), found[n]) for n in (N.CREATED, N.CLOSED)]
    return written.select(N.NUMBER, times[0].alias("Created_Date"), times[1].alias("Closed_Date"), time_to_resolve(*times).alias("Time_to_Resolve"))


def severity_digit_fallback(spark, folder):
    return with_severity(raw_tickets(spark, folder)).select(N.NUMBER, N.PRIORITY, "Severity")


def ttr_hours(spark, folder):
    raw = raw_tickets(spark, folder)
    hours = time_to_resolve(parse_timestamp(col(N.CREATED)), parse_timestamp(col(N.CLOSED)))
    return raw.select(N.NUMBER, hours.alias("Time_to_Resolve"))


def week_month_buckets(spark, folder):
    created = parse_timestamp(col(N.CREATED))
    return raw_tickets(spark, folder).select(
        N.NUMBER, week_start(created).alias("Week"), month_start(created).alias("Month")
    )


def _dated(spark, folder):
    return classified_tickets(spark, folder).select(
        col(N.NUMBER).alias("Ticket_ID"),
        "System_Type",
        F.col("System_Subtype").alias("Module"),
        parse_timestamp(col(N.CREATED)).alias("Created_Date"),
    )


def migration_dates_query(spark, folder):
    return migration_dates(_dated(spark, folder))


def days_from_migration(spark, folder):
    return with_days_from_migration(_dated(spark, folder)).select("Ticket_ID", "Module", "Days_from_Migration")


def reopen_metrics(spark, folder):
    return canonical_tickets(spark, folder).select("Ticket_ID", "Reopen_Count", "Reopen_Flag")


QUERIES = {
    "dates_month_first": dates_month_first,
    "dates_day_first": dates_day_first,
    "dates_mixed": dates_mixed,
    "dates_two_columns": dates_two_columns,
    "normalize_canonical": normalize_canonical,
    "canonical_export": canonical_export,
    "canonical_texts": canonical_texts,
    "severity_dictionary": severity_dictionary,
    "severity_digit_fallback": severity_digit_fallback,
    "ttr_hours": ttr_hours,
    "week_month_buckets": week_month_buckets,
    "migration_dates": migration_dates_query,
    "days_from_migration": days_from_migration,
    "reopen_metrics": reopen_metrics,
}

SQL = {
    "dates_month_first": "SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS parsed FROM orders",
    "dates_day_first": "SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS parsed FROM orders",
    "dates_mixed": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS TIMESTAMP) END AS parsed FROM orders",
    "dates_two_columns": """
        SELECT o_orderkey AS "Number", created AS "Created_Date", closed AS "Closed_Date",
        CASE WHEN closed > created THEN CAST(epoch(closed - created) AS DOUBLE) / 3600 ELSE 0.1 END AS "Time_to_Resolve"
        FROM (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) + to_days(CAST(day(o_orderdate) % 12 AS INTEGER)) AS TIMESTAMP) AS created,
              CAST(last_day(o_orderdate) + to_days(CAST(o_orderkey % 20 AS INTEGER)) AS TIMESTAMP) AS closed FROM orders)
    """,
    "normalize_canonical": with_views("canonical", "SELECT * EXCLUDE (ticket_number) FROM canonical"),
    "canonical_export": with_views("canonical", "SELECT * EXCLUDE (ticket_number) FROM canonical"),
    "canonical_texts": with_views(
        "raw",
        """SELECT "Number" AS "Ticket_ID", CAST(length(coalesce(d.text, '')) AS BIGINT) AS "Description_Length",
        md5(coalesce(d.text, '')) AS "Description_Hash",
        md5(coalesce(t.reply, '') || ' ' || coalesce(t.question, '')) AS "Notes_Hash"
        FROM raw LEFT JOIN documents d ON d.doc_id = ticket_number % (SELECT count(*) FROM documents)
        LEFT JOIN first_turns t ON t.conv_id = ticket_number % (SELECT count(*) FROM first_turns)""",
        CONVERSATION_SQL,
    ),
    "severity_dictionary": with_views(
        "raw",
        """SELECT "Number", CASE "Priority"[1] WHEN '1' THEN '1 - Critical' WHEN '2' THEN '2 - High'
        WHEN '3' THEN '3 - Moderate' WHEN '4' THEN '4 - Low' ELSE '5 - Planning' END AS "Priority",
        CAST(CASE "Priority"[1] WHEN '1' THEN 4 WHEN '2' THEN 3 WHEN '3' THEN 2 ELSE 1 END AS DOUBLE) AS "Severity"
        FROM raw""",
    ),
    "severity_digit_fallback": with_views(
        "raw",
        """SELECT "Number", "Priority",
        CAST(5 - CAST(regexp_extract("Priority", '([0-9]+)', 1) AS INTEGER) AS DOUBLE) AS "Severity" FROM raw""",
    ),
    "ttr_hours": with_views("canonical", 'SELECT "Ticket_ID" AS "Number", "Time_to_Resolve" FROM canonical'),
    "week_month_buckets": with_views("canonical", 'SELECT "Ticket_ID" AS "Number", "Week", "Month" FROM canonical'),
    "migration_dates": with_views(
        "classified",
        """SELECT "System_Subtype" AS "Module", min(created_ts) AS "Migration_Date" FROM classified
        WHERE "System_Type" = 'DBB' GROUP BY 1""",
    ),
    "days_from_migration": with_views(
        "canonical", 'SELECT "Ticket_ID", "Module", "Days_from_Migration" FROM canonical'
    ),
    "reopen_metrics": with_views("canonical", 'SELECT "Ticket_ID", "Reopen_Count", "Reopen_Flag" FROM canonical'),
}
