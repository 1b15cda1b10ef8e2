from tidewatch.operators.detect import enrich_from_catalogue
from tidewatch.operators.rollups import indicators_by_reason
from tidewatch.rules import NOTEBOOK_RULES, THREAT_CATALOGUE, DetectionRules, catalogue_frame

BRUTE = {"event_type": "authentication", "outcome": "failure"}
PRIVILEGED = {"is_privileged_actor": True, "mfa_used": True}
FIRES = [
    ({**BRUTE, "failed_attempts_1h": 10}, "credential_brute_force", "HIGH"),
    ({"event_type": "privilege_change"}, "unauthorized_privilege_escalation", "CRITICAL"),
    ({"event_type": "privilege_change", "is_privileged_actor": None}, "unauthorized_privilege_escalation", "CRITICAL"),
    ({"event_type": "data_access", "bytes_out": 500_000_000, "outcome": "blocked"}, "large_data_egress", "CRITICAL"),
    ({"event_type": "api_call", "request_rate_1m": 300, "outcome": "failure"}, "api_abuse_burst", "MEDIUM"),
    ({"source_country": " kp "}, "unusual_geo_access", "HIGH"),
    ({"event_type": "config_change", "action": "logging_disabled"}, "audit_logging_disabled", "CRITICAL"),
    ({**PRIVILEGED, "mfa_used": False}, "privileged_access_without_mfa", "MEDIUM"),
    ({**PRIVILEGED, "mfa_used": None}, "privileged_access_without_mfa", "MEDIUM"),
    ({**PRIVILEGED, "event_time": "2031-03-06T05:59:59+00:00"}, "off_hours_privileged_activity", "LOW"),
    ({**PRIVILEGED, "event_time": "2031-03-06T22:00:00+00:00"}, "off_hours_privileged_activity", "LOW"),
    # Precedence: the earlier rule wins.
    ({**BRUTE, "failed_attempts_1h": 99, "source_country": "RU"}, "credential_brute_force", "HIGH"),
    ({"event_type": "privilege_change", "source_country": "RU"}, "unauthorized_privilege_escalation", "CRITICAL"),
    ({"event_type": "data_access", "bytes_out": 10**9, "source_country": "IR"}, "large_data_egress", "CRITICAL"),
    ({"event_type": "api_call", "request_rate_1m": 900, "source_country": "BY"}, "api_abuse_burst", "MEDIUM"),
    ({"event_type": "config_change", "action": "logging_disabled", "source_country": "NG"}, "unusual_geo_access", "HIGH"),
    (
        {**PRIVILEGED, "mfa_used": False, "event_type": "config_change", "action": "logging_disabled"},
        "audit_logging_disabled",
        "CRITICAL",
    ),
    ({**PRIVILEGED, "mfa_used": False, "event_time": "2031-03-06T02:00:00+00:00"}, "privileged_access_without_mfa", "MEDIUM"),
]
QUIET = [
    {**BRUTE, "failed_attempts_1h": 9},
    {**BRUTE, "failed_attempts_1h": None},
    {"event_type": "privilege_change", **PRIVILEGED},
    {"event_type": "privilege_change", "outcome": "blocked"},
    {"event_type": "data_access", "bytes_out": 499_999_999},
    {"event_type": "data_access", "bytes_out": None},
    {"event_type": "api_call", "request_rate_1m": 299},
    {"event_type": "api_call", "request_rate_1m": None},
    {"source_country": "RU", "outcome": "blocked"},
    {"source_country": None},
    {"event_type": "config_change", "action": "policy_update"},
    {**PRIVILEGED, "mfa_used": False, "outcome": "failure"},
    {**PRIVILEGED, "event_time": "2031-03-06T06:00:00+00:00"},
    {**PRIVILEGED, "event_time": "2031-03-06T21:59:59+00:00"},
    {**PRIVILEGED, "event_time": "not-a-time"},
    {"is_privileged_actor": None, "mfa_used": False},
]


def test_rules_fire_with_their_severity_and_code(processed):
    cases = [{**override, "event_id": str(i)} for i, (override, _, _) in enumerate(FIRES)]
    catalogue = {rule.reason: rule for rule in THREAT_CATALOGUE}
    rows = {row.event_id: row for row in processed(*cases).collect()}
    for i, (override, reason, severity) in enumerate(FIRES):
        row = rows[str(i)]
        assert (row.threat_reason, row.severity) == (reason, severity), override
        assert (row.is_anomaly, row.mitre_tactic) == (True, catalogue[reason].mitre_tactic)
        assert row.severity_rank == {"LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}[severity]


def test_rules_stay_quiet_below_thresholds_and_on_nulls(processed):
    cases = [{**override, "event_id": str(i)} for i, override in enumerate(QUIET)]
    fired = processed(*cases).filter("is_anomaly").select("event_id", "threat_reason").collect()
    assert [(QUIET[int(row.event_id)], row.threat_reason) for row in fired] == []


def test_notebook_profile_has_six_rules(processed):
    rows = processed({**PRIVILEGED, "mfa_used": False}, {"source_country": "RU"}, rules=NOTEBOOK_RULES)
    assert [(row.threat_reason, row.severity_rank) for row in rows.collect()] == [(None, 0), ("unusual_geo_access", 3)]


def test_thresholds_are_parameters(processed):
    rules = DetectionRules(failed_attempts_threshold=3, high_risk_countries=("SOURCE_COUNTRY",), off_hours_start=9, off_hours_end=8)
    rows = processed(
        {**BRUTE, "failed_attempts_1h": 3}, {}, {**PRIVILEGED, "source_country": "US"}, rules=rules
    ).collect()
    assert [row.threat_reason for row in rows] == [
        "credential_brute_force",
        "unusual_geo_access",
        "off_hours_privileged_activity",
    ]


def test_catalogue_join_agrees_with_the_flags(spark, processed):
    flagged = processed(*(override for override, _, _ in FIRES)).filter("is_anomaly")
    joined = enrich_from_catalogue(flagged.select("threat_reason", flagged.severity.alias("flagged")), catalogue_frame(spark))
    assert joined.filter("severity IS NULL OR severity <> flagged").count() == 0
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert indicators_by_reason(flagged).count() == len(THREAT_CATALOGUE)
