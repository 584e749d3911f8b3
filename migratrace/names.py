"""Column names and fixed values of the ticket data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: system labels -------------------------------------------
LEGACY = "Legacy"
NEW = "DBB"
BOTH = "Both"
UNKNOWN = "Unknown"
SYSTEM_TYPES = (BOTH, NEW, LEGACY, UNKNOWN)
TWO_SYSTEMS = (LEGACY, NEW)
OTHER = "Other"

# ---- fixed values: other defaults ------------------------------------------
NO_PRIMARY_SYSTEM = "None"
MAPPING_VERSION = "v2.0"
DEFAULT_DOMAIN = "Unknown"
DEFAULT_TEAM = "Unknown"
DEFAULT_OPCO = "Pt Multi Bintang Indonesia Tbk"
NOISE_CLUSTER = -1

# ---- fixed values: raw export columns, after mapping -------------------------------------
NUMBER = "Number"
CI = "Configuration item"
OFFERING = "Service offering"
GROUP = "Assignment group"
SERVICE = "Business service"
SHORT = "Short description"
DESCRIPTION = "Description"
CLOSE_NOTES = "Close notes"
COMMENTS = "Additional comments"
PRIORITY = "Priority"
CREATED = "Created"
CLOSED = "Closed"
REOPENS = "Reopen count"
OPCO = "Impacted OpCo"

# ---- fixed values: label columns of a classified ticket ---------------------
LABEL_COLUMNS = (
    "System_Type",
    "System_Subtype",
    "Primary_System",
    "label_confidence",
    "label_source",
    "mapping_version",
    "human_override_flag",
    "post_migration_noise",
)

# ---- fixed values: the canonical ticket, 23 columns in this order ------------------------
CANONICAL_SCHEMA = T.StructType(
    [
        T.StructField("Ticket_ID", T.StringType()),
        T.StructField("System_Type", T.StringType()),
        T.StructField("System_Subtype", T.StringType()),
        T.StructField("Primary_System", T.StringType()),
        T.StructField("Domain", T.StringType()),
        T.StructField("Module", T.StringType()),
        T.StructField("OpCo", T.StringType()),
        T.StructField("Short_Description", T.StringType()),
        T.StructField("Description_Text", T.StringType()),
        T.StructField("Resolution_Notes", T.StringType()),
        T.StructField("Created_Date", T.TimestampNTZType()),
        T.StructField("Closed_Date", T.TimestampNTZType()),
        T.StructField("Severity", T.DoubleType()),
        T.StructField("Reopen_Count", T.DoubleType()),
        T.StructField("Reopen_Flag", T.BooleanType()),
        T.StructField("Assignee_Team", T.StringType()),
        T.StructField("label_confidence", T.DoubleType()),
        T.StructField("label_source", T.StringType()),
        T.StructField("post_migration_noise", T.BooleanType()),
        T.StructField("Time_to_Resolve", T.DoubleType()),
        T.StructField("Week", T.TimestampNTZType()),
        T.StructField("Month", T.TimestampNTZType()),
        T.StructField("Days_from_Migration", T.LongType()),
    ]
)
