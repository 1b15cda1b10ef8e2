"""Rule parameters: what counts as a valid event and what counts as a threat.

Everything a rule compares against lives here, so a deployment changes thresholds by passing another
``QualityRules`` / ``DetectionRules`` to the operators, never by editing them.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from tidewatch.functions.text import sql_literal

# Accepted domains.
EVENT_TYPES = ("authentication", "data_access", "api_call", "privilege_change", "config_change")
OUTCOMES = ("success", "failure", "blocked")
HIGH_RISK_COUNTRIES = ("RU", "KP", "IR", "BY", "NG")

# Severity scale, lowest first; the position is the rank.
SEVERITIES = ("NONE", "LOW", "MEDIUM", "HIGH", "CRITICAL")

# Quality failure reasons, in reporting order.
UNKNOWN_EVENT_TYPE = "unknown_event_type"
UNKNOWN_OUTCOME = "unknown_outcome"
MISSING_ACTOR = "missing_actor"
MISSING_TARGET = "missing_target"
BYTES_OUT_OF_RANGE = "bytes_out_out_of_range"
INVALID_HTTP_STATUS = "invalid_http_status"
UNPARSEABLE_EVENT_TIME = "unparseable_event_time"


@dataclass(frozen=True)
class ThreatRule:
    """One catalogue entry. ``condition`` is SQL over the event columns; ``{names}`` are detection parameters."""

    reason: str
    severity: str
    mitre_tactic: str
    action: str
    condition: str

    @property
    def rank(self) -> int:
        return SEVERITIES.index(self.severity)


_PRIVILEGED_SUCCESS = "is_privileged_actor AND outcome = 'success'"

# The threat catalogue in precedence order (reason, severity, ATT&CK code, recommended action) and
# the condition of each rule.
THREAT_CATALOGUE = (
    ThreatRule(
        "credential_brute_force",
        "HIGH",
        "TA0006:T1110",
        "Lock or step-up authentication for the identity, block the source IP, and confirm whether any attempt succeeded.",
        "event_type = 'authentication' AND outcome = 'failure' AND failed_attempts_1h >= {failed_attempts_threshold}",
    ),
    ThreatRule(
        "unauthorized_privilege_escalation",
        "CRITICAL",
        "TA0004:T1078",
        "Revoke the granted role immediately, verify the change against an approved ticket, and review the approver's account.",
        "event_type = 'privilege_change' AND outcome = 'success' AND NOT coalesce(is_privileged_actor, false)",
    ),
    ThreatRule(
        "large_data_egress",
        "CRITICAL",
        "TA0010:T1041",
        "Suspend the export session, quantify what left the environment, and engage data protection review.",
        "event_type = 'data_access' AND bytes_out >= {data_egress_bytes_threshold}",
    ),
    ThreatRule(
        "api_abuse_burst",
        "MEDIUM",
        "TA0040:T1499",
        "Apply rate limiting to the client credential and verify whether the traffic is a misconfigured integration or scripted abuse.",
        "event_type = 'api_call' AND request_rate_1m >= {api_request_rate_threshold}",
    ),
    ThreatRule(
        "unusual_geo_access",
        "HIGH",
        "TA0001:T1078.004",
        "Challenge the session with MFA, confirm travel with the user, and review other activity from the same source.",
        "source_country IN {high_risk_countries} AND outcome = 'success'",
    ),
    ThreatRule(
        "audit_logging_disabled",
        "CRITICAL",
        "TA0005:T1562.008",
        "Re-enable logging, treat the gap window as untrusted, and investigate the account that changed the policy.",
        "event_type = 'config_change' AND action = 'logging_disabled'",
    ),
    ThreatRule(
        "privileged_access_without_mfa",
        "MEDIUM",
        "TA0001:T1078",
        "Enforce MFA on the privileged account and review what actions were taken during the session.",
        f"{_PRIVILEGED_SUCCESS} AND NOT coalesce(mfa_used, false)",
    ),
    ThreatRule(
        "off_hours_privileged_activity",
        "LOW",
        "TA0003:T1078",
        "Confirm the activity with the account owner and check it against the change calendar.",
        _PRIVILEGED_SUCCESS + " AND (event_hour < {off_hours_end} OR event_hour >= {off_hours_start})",
    ),
)
DEFAULT_ACTION = "Review the event against baseline behaviour for this identity and target system."


@dataclass(frozen=True)
class QualityRules:
    """Parameters of the quality gate.

    ``max_bytes_out=None`` removes the upper bound; ``check_http_status=False`` and
    ``allow_blank_target=True`` relax those checks; ``strict_reasons`` also reports a reason when a
    check cannot be decided because its input is null.
    """

    event_types: tuple[str, ...] = EVENT_TYPES
    outcomes: tuple[str, ...] = OUTCOMES
    max_bytes_out: float | None = 10_000_000_000
    check_http_status: bool = True
    http_status_range: tuple[int, int] = (100, 599)
    allow_blank_target: bool = False
    strict_reasons: bool = False


STANDARD_GATE = QualityRules()
LENIENT_GATE = QualityRules(max_bytes_out=None, check_http_status=False, allow_blank_target=True)
STRICT_GATE = replace(STANDARD_GATE, strict_reasons=True)


@dataclass(frozen=True)
class DetectionRules:
    """Thresholds of the detection rules and the reasons that are switched on."""

    failed_attempts_threshold: int = 10
    data_egress_bytes_threshold: int = 500_000_000
    api_request_rate_threshold: int = 300
    high_risk_countries: tuple[str, ...] = HIGH_RISK_COUNTRIES
    off_hours_start: int = 22
    off_hours_end: int = 6
    enabled: tuple[str, ...] = field(default=tuple(rule.reason for rule in THREAT_CATALOGUE))


STANDARD_RULES = DetectionRules()
# The notebook profile: the six event-level rules, without the two that need a privileged actor.
NOTEBOOK_RULES = DetectionRules(enabled=tuple(rule.reason for rule in THREAT_CATALOGUE[:6]))


def catalogue_frame(spark: SparkSession) -> DataFrame:
    """The threat catalogue as a DataFrame of eight rows, for joins and reports.

    It is a literal relation, whose size the optimizer knows.
    """
    columns = "threat_reason, severity, severity_rank, mitre_tactic, recommended_action"
    rows = ((r.reason, r.severity, r.rank, r.mitre_tactic, r.action) for r in THREAT_CATALOGUE)
    values = ", ".join("(" + ", ".join(map(sql_literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS catalogue({columns})")
