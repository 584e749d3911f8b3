"""The ordered classification rules, as data.

A rule holds alternatives; an alternative is a tuple of tests that must all
pass.  The first rule with a passing alternative labels the ticket.  Tests are
made on lowercase text, with null read as empty.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from migratrace.names import BOTH, CI, GROUP, LEGACY, NEW, NO_PRIMARY_SYSTEM, OFFERING, SERVICE, SHORT, UNKNOWN


def sql_text(value: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Contains:
    column: str
    text: str

    def sql(self, lowered: dict[str, str]) -> str:
        return f"contains({lowered[self.column]}, {sql_text(self.text)})"


@dataclass(frozen=True)
class Equals:
    column: str
    text: str

    def sql(self, lowered: dict[str, str]) -> str:
        return f"{lowered[self.column]} = {sql_text(self.text)}"


Test = Contains | Equals


@dataclass(frozen=True)
class Rule:
    alternatives: tuple[tuple[Test, ...], ...]
    system_type: str
    subtype: str
    confidence: float
    source: str
    primary: str = NO_PRIMARY_SYSTEM

    @property
    def columns(self) -> set[str]:
        return {t.column for alternative in self.alternatives for t in alternative}

    def sql_condition(self, lowered: dict[str, str]) -> str:
        """The rule as a SQL condition over expressions for its lowercase columns."""
        return " OR ".join(
            "(" + " AND ".join(t.sql(lowered) for t in alternative) + ")"
            for alternative in self.alternatives
        )


def has(column: str, *texts: str) -> tuple[tuple[Test, ...], ...]:
    return tuple((Contains(column, t),) for t in texts)


def has_all(*pairs: tuple[str, str]) -> tuple[tuple[Test, ...], ...]:
    return (tuple(Contains(c, t) for c, t in pairs),)


def equals(column: str, *texts: str) -> tuple[tuple[Test, ...], ...]:
    return tuple((Equals(column, t),) for t in texts)


# ---- fixed values: default rules, in evaluation order ----------------------
DEFAULT_RULES: tuple[Rule, ...] = (
    # overrides
    Rule(has(OFFERING, "non-dbb"), LEGACY, "Legacy-Other", 1.0, "rule-service"),
    Rule(
        equals(SERVICE, "middleware")
        + has(CI, "digital integration", "solace")
        + has(OFFERING, "commerce integration", "finance technology integration")
        + has(GROUP, "commerce integration"),
        BOTH, "Middleware-ESB", 1.0, "rule-middleware", primary="Integration",
    ),
    # configuration item
    Rule(has_all((CI, "otd production"), (SHORT, "glassrun")), NEW, "DBB-GlassRun", 1.0, "rule-config+text"),
    Rule(has(CI, "otd production"), NEW, "DBB-OTD", 1.0, "rule-config"),
    Rule(has(CI, "omni production", "tiger tribe"), NEW, "DBB-OMNI", 1.0, "rule-config"),
    Rule(has(CI, "sem", "dynamics 365"), NEW, "DBB-SEM", 1.0, "rule-config"),
    Rule(has(CI, "virtocommerce") + has_all((CI, "b2b"), (CI, "dot")), NEW, "DBB-DOT", 1.0, "rule-config"),
    Rule(has(CI, "d&a hub"), NEW, "DBB-DA", 1.0, "rule-config"),
    Rule(has(CI, "erp sap", "heicore", "fiori", "srm", "qualass"), LEGACY, "Legacy-SAP", 1.0, "rule-config"),
    Rule(has(CI, "psub", "pjkt", "ijkt", "isub"), LEGACY, "Legacy-Network", 1.0, "rule-config"),
    # service offering
    Rule(has(OFFERING, "glassrun", "otd "), NEW, "DBB-OTD", 0.95, "rule-service"),
    Rule(has(OFFERING, "omni"), NEW, "DBB-OMNI", 0.95, "rule-service"),
    Rule(has(OFFERING, "sem "), NEW, "DBB-SEM", 0.95, "rule-service"),
    Rule(has(OFFERING, "dot "), NEW, "DBB-DOT", 0.95, "rule-service"),
    Rule(has(OFFERING, "d&a hub"), NEW, "DBB-DA", 0.95, "rule-service"),
    Rule(has(OFFERING, "commerce integration"), NEW, "DBB-Commerce", 0.95, "rule-service"),
    Rule(has(OFFERING, "eazle", "b2gaas"), NEW, "DBB-Eazle", 0.95, "rule-service"),
    Rule(has(OFFERING, "erp sap", "ptp", "rtr", "dtw"), LEGACY, "Legacy-SAP", 0.95, "rule-service"),
    Rule(has(OFFERING, "ip networks", "ntw ", "heinet", "sdwan"), LEGACY, "Legacy-Network", 0.95, "rule-service"),
    Rule(has(OFFERING, "windows ", "hardware", "remote access", "ad "), LEGACY, "Legacy-Workplace", 0.95, "rule-service"),
    Rule(has(OFFERING, "anti virus", "wps "), LEGACY, "Legacy-Security", 0.95, "rule-service"),
    Rule(has(OFFERING, "ms teams", "sharepoint", "onedrive"), LEGACY, "Legacy-Collaboration", 0.95, "rule-service"),
    Rule(has(OFFERING, "ifrs16", "fin ", "heifund"), LEGACY, "Legacy-Finance", 0.95, "rule-service"),
    # assignment group
    Rule(has(GROUP, "tiger tribe") + has_all((GROUP, "otd support"), (GROUP, "tiger")), NEW, "DBB-OMNI", 0.85, "rule-assignment"),
    Rule(has(GROUP, "otd support"), NEW, "DBB-OTD", 0.85, "rule-assignment"),
    Rule(has(GROUP, "omni support"), NEW, "DBB-OMNI", 0.85, "rule-assignment"),
    Rule(has(GROUP, "sem devops"), NEW, "DBB-SEM", 0.85, "rule-assignment"),
    Rule(has(GROUP, "dot infosys"), NEW, "DBB-DOT", 0.85, "rule-assignment"),
    Rule(has(GROUP, "d&a hub"), NEW, "DBB-DA", 0.85, "rule-assignment"),
    Rule(has(GROUP, "gis orange"), LEGACY, "Legacy-Network", 0.85, "rule-assignment"),
    Rule(has(GROUP, "erp sap"), LEGACY, "Legacy-SAP", 0.85, "rule-assignment"),
    Rule(has(GROUP, "t-systems", "wpl "), LEGACY, "Legacy-Workplace", 0.85, "rule-assignment"),
    # business service
    Rule(equals(SERVICE, "market to order (mto)", "demand to warehouse (dtw)", "market to cash (mtc)"), NEW, "DBB-Other", 0.70, "rule-business"),
    Rule(equals(SERVICE, "network"), LEGACY, "Legacy-Network", 0.70, "rule-business"),
    Rule(equals(SERVICE, "source to pay (stp)", "record to report (rtr)", "hosting sap"), LEGACY, "Legacy-SAP", 0.70, "rule-business"),
    Rule(equals(SERVICE, "workplace", "security management", "collaboration"), LEGACY, "Legacy-Workplace", 0.70, "rule-business"),
    Rule(equals(SERVICE, "service desk services", "gsd (itsm) service", "servicenow nextgen - siam"), LEGACY, "Legacy-ITSM", 0.70, "rule-business"),
    # text signature
    Rule(has(SHORT, "glassrun"), NEW, "DBB-GlassRun", 0.60, "rule-text"),
    Rule(has(SHORT, "omni"), NEW, "DBB-OMNI", 0.60, "rule-text"),
)
# ---- end of fixed values ---------------------------------------------------


def system_types(rules: Sequence[Rule] = DEFAULT_RULES) -> tuple[str, ...]:
    """Every system type that the rules can give, sorted: a column each in the counts by system."""
    return tuple(sorted({r.system_type for r in rules} | {UNKNOWN}))
