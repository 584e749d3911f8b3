"""Classification queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from migratrace import names as N
from migratrace.functions.columns import col
from migratrace.operators.classify import class_distribution, classify, review_queue
from migratrace.operators.schema_map import map_columns
from migratrace.plans.study import classify_export
from migratrace.registry.tickets import classified_tickets, raw_tickets, with_views

_LABELS = (
    '"Number", "System_Type", "System_Subtype", "Primary_System", label_confidence, label_source, '
    "mapping_version, human_override_flag"
)

# A renamed export with decoy columns next to the real ones.
RENAMED = {
    N.NUMBER: "Ticket ID", N.CI: "CI", N.OFFERING: "Product", N.GROUP: "Resolver group", N.SERVICE: "App service",
    N.SHORT: "Title", N.PRIORITY: "Urgency", N.CREATED: "Opened", N.CLOSED: "Resolved", N.REOPENS: "Reopens",
    N.OPCO: "Country",
}


def classify_cascade(spark, folder):
    return classify(raw_tickets(spark, folder)).select(N.NUMBER, *N.LABEL_COLUMNS[:7])


def class_distribution_query(spark, folder):
    return class_distribution(classify(raw_tickets(spark, folder)))


def review_queue_query(spark, folder):
    queue = review_queue(classify(raw_tickets(spark, folder)))
    return queue.select(
        N.NUMBER, col(N.OFFERING).alias("Service_Offering"), "System_Type", "SME_Label", "SME_Notes", "override_date"
    )


def migration_noise_flag(spark, folder):
    return classified_tickets(spark, folder).select(N.NUMBER, "System_Type", "post_migration_noise")


def renamed_export(spark, folder):
    raw = raw_tickets(spark, folder)
    renamed = raw.select(*[col(old).alias(new) for old, new in RENAMED.items()])
    return renamed.withColumns(
        {
            "Opened by": F.lit("someone"),
            "Updated": col("Opened"),
            "Domain": F.lit("decoy"),
            "Translated description": F.lit("decoy"),
            "Identity": F.lit("decoy"),
            "Ticket ID.1": F.lit("decoy"),
            "Opened.1": F.lit("not a date"),
        }
    )


def map_columns_renamed(spark, folder):
    mapped, _ = map_columns(renamed_export(spark, folder))
    return mapped.select(*[col(c).alias(c.replace(" ", "_")) for c in mapped.columns])


def classified_export(spark, folder):
    """A foreign export with its own columns as they are, the labels beside them, and no mapped column left."""
    out = classify_export(renamed_export(spark, folder))
    return out.select(*[col(c).alias(c.replace(" ", "_").replace(".", "_")) for c in out.columns])


QUERIES = {
    "classified_export": classified_export,
    "classify_cascade": classify_cascade,
    "class_distribution": class_distribution_query,
    "review_queue": review_queue_query,
    "migration_noise_flag": migration_noise_flag,
    "map_columns_renamed": map_columns_renamed,
}

SQL = {
    "classified_export": with_views(
        "classified",
        f"""SELECT "Number" AS "Ticket_ID", "Configuration item" AS "CI", "Service offering" AS "Product",
        "Assignment group" AS "Resolver_group", "Business service" AS "App_service", "Short description" AS "Title",
        "Priority" AS "Urgency", "Created" AS "Opened", "Closed" AS "Resolved", "Reopen count" AS "Reopens",
        "Impacted OpCo" AS "Country", 'someone' AS "Opened_by", "Created" AS "Updated", 'decoy' AS "Domain",
        'decoy' AS "Translated_description", 'decoy' AS "Identity", 'decoy' AS "Ticket_ID_1", 'not a date' AS "Opened_1",
        {_LABELS.removeprefix('"Number", ')}, post_migration_noise FROM classified""",
    ),
    "classify_cascade": with_views("classified", f"SELECT {_LABELS} FROM classified"),
    "class_distribution": with_views(
        "classified", 'SELECT "System_Type", count(*) AS "count" FROM classified GROUP BY 1'
    ),
    "review_queue": with_views(
        "classified",
        """SELECT "Number", "Service offering" AS "Service_Offering", "System_Type", '' AS "SME_Label",
        '' AS "SME_Notes", '' AS override_date FROM classified WHERE "System_Type" = 'Unknown'""",
    ),
    "migration_noise_flag": with_views(
        "classified", 'SELECT "Number", "System_Type", post_migration_noise FROM classified'
    ),
    "map_columns_renamed": with_views(
        "raw",
        """SELECT "Number", "Configuration item" AS "Configuration_item", "Service offering" AS "Service_offering",
        "Assignment group" AS "Assignment_group", "Business service" AS "Business_service",
        "Short description" AS "Short_description", CAST(NULL AS VARCHAR) AS "Description",
        CAST(NULL AS VARCHAR) AS "Close_notes", CAST(NULL AS VARCHAR) AS "Additional_comments",
        "Priority", "Created", "Closed", "Reopen count" AS "Reopen_count", "Impacted OpCo" AS "Impacted_OpCo"
        FROM raw""",
    ),
}
