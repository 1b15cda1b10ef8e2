import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import rollups, triage
from tidewatch.schemas import INSIGHT_SCHEMA, THREAT_SCHEMA

AS_OF = datetime(2031, 3, 6, 12)
BASE = {
    "event_timestamp": datetime(2031, 3, 6, 9),
    "event_id": "row-1",
    "event_type": "authentication",
    "actor_id": "USR-1",
    "actor_role": "contractor",
    "target_system": "admin-console",
    "source_ip": "198.51.100.7",
    "source_country": "IE",
    "outcome": "failure",
    "bytes_out": 1000,
    "failed_attempts_1h": 0,
    "request_rate_1m": 5,
    "threat_reason": "credential_brute_force",
    "severity": "HIGH",
    "mitre_tactic": "TA0006:T1110",
}
ESCALATION = {"threat_reason": "unauthorized_privilege_escalation", "severity": "CRITICAL"}
EGRESS = {"threat_reason": "large_data_egress", "severity": "CRITICAL"}
API = {"threat_reason": "api_abuse_burst", "severity": "MEDIUM"}
SCORES = [
    ({"failed_attempts_1h": 29}, 65, "HIGH"),
    ({"failed_attempts_1h": 30}, 75, "HIGH"),
    ({"failed_attempts_1h": None}, 65, "HIGH"),
    ({"failed_attempts_1h": 30, "outcome": "success"}, 83, "CRITICAL"),
    ({**EGRESS, "bytes_out": 1_999_999_999}, 85, "CRITICAL"),
    ({**EGRESS, "bytes_out": 2_000_000_000}, 95, "CRITICAL"),
    ({**EGRESS, "bytes_out": 2_000_000_000, "outcome": "success"}, 100, "CRITICAL"),
    ({**EGRESS, "outcome": "blocked"}, 75, "HIGH"),
    ({**API, "request_rate_1m": 999}, 50, "MEDIUM"),
    ({**API, "request_rate_1m": 1000}, 58, "MEDIUM"),
    ({**API, "request_rate_1m": 1000, "outcome": "success"}, 66, "HIGH"),
    ({**API, "outcome": "blocked"}, 40, "MEDIUM"),
    ({"threat_reason": "unusual_geo_access", "outcome": "success"}, 75, "HIGH"),
    ({"threat_reason": "audit_logging_disabled", "severity": "CRITICAL"}, 90, "CRITICAL"),
    ({"threat_reason": "privileged_access_without_mfa", "severity": "MEDIUM", "outcome": "SUCCESS"}, 60, "HIGH"),
    ({"threat_reason": "off_hours_privileged_activity", "severity": "LOW", "outcome": "success"}, 33, "LOW"),
    ({**ESCALATION, "outcome": "success"}, 98, "CRITICAL"),
    ({"threat_reason": None, "severity": None, "outcome": "blocked"}, 10, "LOW"),
    ({"threat_reason": "other", "severity": "odd", "outcome": None}, 20, "LOW"),
    # A reason that names two kinds scores both; the sum is cut at 100.
    ({**EGRESS, "threat_reason": "data_egress after privilege_escalation"}, 100, "CRITICAL"),
]


@pytest.fixture(scope="module")
def threats(spark):
    def build(*overrides):
        rows = [tuple({**BASE, **override}[name] for name in THREAT_SCHEMA.names) for override in overrides]
        return spark.createDataFrame(rows, THREAT_SCHEMA)

    return build


def test_scores_and_levels(threats):
    cases = [{**override, "event_id": str(i)} for i, (override, _, _) in enumerate(SCORES)]
    rows = {row.event_id: (row.risk_score, row.risk_level) for row in triage.score_threats(threats(*cases)).collect()}
    assert rows == {str(i): (score, level) for i, (_, score, level) in enumerate(SCORES)}


def test_insight_row(threats):
    row = triage.build_insights(threats({**ESCALATION, "outcome": "success"}), AS_OF).first()
    assert row.__fields__ == INSIGHT_SCHEMA.names
    assert row.insight_id == hashlib.sha256(b"row-1|unauthorized_privilege_escalation").hexdigest()[:32]
    assert (row.generated_at, row.triage_queue) == (AS_OF, "tier2_incident_response")
    assert row.threat_explanation == (
        "Identity USR-1 (contractor) triggered the unauthorized_privilege_escalation rule against admin-console. "
        "The event originated from 198.51.100.7 in IE and the outcome was success. It maps to MITRE ATT&CK "
        "TA0006:T1110 and is assessed as CRITICAL risk based on severity, volume, and whether the activity succeeded."
    )
    assert row.recommended_action.startswith("Revoke the granted role immediately")


def test_nulls_are_spelled_out(threats):
    nothing = dict.fromkeys(THREAT_SCHEMA.names)
    row = triage.build_insights(threats(nothing), AS_OF).first()
    assert row.insight_id == hashlib.sha256(b"None|None").hexdigest()[:32]
    assert row.threat_explanation.startswith("Identity None (None) triggered the unclassified indicator rule against None.")
    assert "MITRE ATT&CK unmapped" in row.threat_explanation
    assert row.recommended_action.startswith("Review the event against baseline behaviour")
    assert row.triage_queue == "monitoring_only"


def test_queues(threats):
    rows = triage.build_insights(threats({**EGRESS}, {}, {**API}, {"severity": "LOW", "threat_reason": "x"}), AS_OF)
    assert {(r.risk_level, r.triage_queue) for r in rows.collect()} == {
        ("CRITICAL", "tier2_incident_response"),
        ("HIGH", "tier2_incident_response"),
        ("MEDIUM", "tier1_soc_review"),
        ("LOW", "monitoring_only"),
    }
    sets = {(r.risk_level, r.triage_queue): r.insight_count for r in rollups.risk_level_queue_sets(rows).collect()}
    assert sets[(None, "tier2_incident_response")] == 2 and sets[("CRITICAL", None)] == 1 and len(sets) == 7


def test_untriaged_are_newest_first_and_match_on_event_only(threats):
    feed = threats(
        {"event_id": "a", "event_timestamp": datetime(2031, 3, 6, 1)},
        {"event_id": "b", "event_timestamp": datetime(2031, 3, 6, 3)},
        {"event_id": "c", "event_timestamp": datetime(2031, 3, 6, 2)},
        {"event_id": None, "event_timestamp": None},
    )
    # An insight for another reason of the same event still counts.
    done = triage.build_insights(threats({"event_id": "b", "threat_reason": "other"}), AS_OF)
    assert [r.event_id for r in triage.untriaged_threats(feed, done).collect()] == ["c", "a", None]
    assert [r.event_id for r in triage.untriaged_threats(feed, done, limit=1).collect()] == ["c"]
    assert triage.untriaged_threats(feed, done, limit=None).count() == 3


def test_new_insights_collapse_duplicates_in_the_batch(threats):
    feed = threats({}, {"event_timestamp": datetime(2031, 3, 6, 10)}, {"event_id": "other"})
    known = triage.build_insights(threats({"event_id": "other"}), AS_OF)
    fresh = triage.new_insights(triage.build_insights(feed, AS_OF), known).collect()
    assert [(r.event_id, r.event_timestamp.hour) for r in fresh] == [("row-1", 10)]


def test_second_run_writes_nothing(spark, threats, tmp_path):
    path = str(tmp_path / "insights")
    spark.createDataFrame([], INSIGHT_SCHEMA).write.parquet(path)
    feed = threats({"event_id": "a"}, {"event_id": "b"}, {"event_id": "b"})

    def run():
        insights = spark.read.schema(INSIGHT_SCHEMA).parquet(path)
        return triage.run_triage(feed, insights, lambda rows: rows.write.mode("append").parquet(path), as_of=AS_OF)

    assert run() == triage.TriageReport(fetched=3, written=2)
    assert run() == triage.TriageReport(fetched=0, written=0)
    assert spark.read.parquet(path).count() == 2


def test_second_run_on_tables_too_large_to_broadcast(spark, threats, tmp_path):
    """The shuffle of the waiting threats is empty then, and adaptive execution drops what comes before it, its counts too."""
    path = str(tmp_path / "insights")
    spark.createDataFrame([], INSIGHT_SCHEMA).write.parquet(path)
    feed = threats({"event_id": "a"}, {"event_id": "b"}, {"event_id": "b"})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit, expected in ((None, (3, 2)), (None, (0, 0)), (100, (0, 0))):
            insights = spark.read.schema(INSIGHT_SCHEMA).parquet(path)
            report = triage.run_triage(feed, insights, lambda rows: rows.write.mode("append").parquet(path), limit, AS_OF)
            assert (report.fetched, report.written) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spark.read.parquet(path).count() == 2


def test_reports_on_insights(threats):
    insights = triage.build_insights(threats({"event_id": "a"}, {**EGRESS, "event_id": "b"}), AS_OF)
    later = insights.withColumn("generated_at", F.expr("generated_at + INTERVAL 1 DAY")).filter("event_id = 'a'")
    assert [r.event_id for r in rollups.newest_insights(insights.unionAll(later), 2).collect()] == ["a", "a"]
    assert rollups.average_risk(insights).first()[0] == (65 + 85) / 2
