"""Triage: score threats, explain and route them, load each insight once."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidewatch.functions.numbers import clamp
from tidewatch.functions.text import digest_key, lookup
from tidewatch.operators.dedup import first_per_key, without_match
from tidewatch.operators.marts import AsOf, report_time
from tidewatch.rules import DEFAULT_ACTION, THREAT_CATALOGUE
from tidewatch.schemas import INSIGHT_SCHEMA

# The scoring model.
BASE_SCORE = {"CRITICAL": 70, "HIGH": 55, "MEDIUM": 40, "LOW": 25}
DEFAULT_BASE_SCORE = 20
# (text in the reason, points, counter, counter value from which the higher points apply, higher points)
REASON_POINTS = (
    ("privilege_escalation", 20, None, None, None),
    ("data_egress", 15, "bytes_out", 2_000_000_000, 25),
    ("brute_force", 10, "failed_attempts_1h", 30, 20),
    ("api_abuse", 10, "request_rate_1m", 1_000, 18),
    ("unusual_geo|without_mfa", 12, None, None, None),
    ("logging_disabled", 20, None, None, None),
)
OUTCOME_POINTS = {"success": 8, "blocked": -10}
# Lowest score of each level, and the queue each level goes to.
LEVEL_FLOORS = (("CRITICAL", 80), ("HIGH", 60), ("MEDIUM", 40))
LOWEST_LEVEL = "LOW"
QUEUES = {
    "CRITICAL": "tier2_incident_response",
    "HIGH": "tier2_incident_response",
    "MEDIUM": "tier1_soc_review",
    "LOW": "monitoring_only",
}
PROVIDER = "rules_based_ai_baseline"
EXPLANATION = (
    "Identity %s (%s) triggered the %s rule against %s. The event originated from %s in %s and the outcome was %s. "
    "It maps to MITRE ATT&CK %s and is assessed as %s risk based on severity, volume, and whether the activity succeeded."
)


def risk_score() -> Column:
    """0..100 from the severity, the kind and size of the threat, and whether it succeeded."""
    score = F.coalesce(lookup(BASE_SCORE, "upper(severity)"), F.lit(DEFAULT_BASE_SCORE))
    reason = F.lower("threat_reason")
    for texts, points, counter, threshold, more_points in REASON_POINTS:
        mentioned = F.lit(False)
        for text in texts.split("|"):
            mentioned = mentioned | reason.contains(text)
        worth = F.lit(points)
        if counter:
            worth = F.when(F.col(counter) >= threshold, F.lit(more_points)).otherwise(worth)
        score = score + F.when(mentioned, worth).otherwise(F.lit(0))
    return clamp(score + F.coalesce(lookup(OUTCOME_POINTS, "lower(outcome)"), F.lit(0)), 0, 100)


def risk_level(score: Column) -> Column:
    reached = [F.when(score >= floor, F.lit(level)) for level, floor in LEVEL_FLOORS]
    return F.coalesce(*reached, F.lit(LOWEST_LEVEL))


def explanation(level: Column) -> Column:
    def shown(name: str, missing: str = "None") -> Column:
        return F.coalesce(F.col(name), F.lit(missing))

    def known(name: str, missing: str) -> Column:
        return F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(missing))

    return F.format_string(
        EXPLANATION,
        shown("actor_id"),
        shown("actor_role"),
        known("threat_reason", "unclassified indicator"),
        shown("target_system"),
        shown("source_ip"),
        shown("source_country"),
        shown("outcome"),
        known("mitre_tactic", "unmapped"),
        level,
    )


def score_threats(threats: DataFrame) -> DataFrame:
    """Add risk_score and risk_level."""
    return threats.withColumn("risk_score", risk_score()).withColumn("risk_level", risk_level(F.col("risk_score")))


def build_insights(threats: DataFrame, as_of: AsOf = None) -> DataFrame:
    """One insight row per threat row."""
    level = F.col("risk_level")
    actions = {entry.reason: entry.action for entry in THREAT_CATALOGUE}
    described = score_threats(threats).withColumns(
        {
            "insight_id": digest_key(F.col("event_id"), F.col("threat_reason")),
            "generated_at": report_time(as_of),
            "threat_explanation": explanation(level),
            "recommended_action": F.coalesce(lookup(actions, "threat_reason"), F.lit(DEFAULT_ACTION)),
            "triage_queue": lookup(QUEUES, "risk_level"),
            "model_provider": F.lit(PROVIDER),
        }
    )
    return described.select(*INSIGHT_SCHEMA.names)


def untriaged_threats(threats: DataFrame, insights: DataFrame, limit: int | None = 100) -> DataFrame:
    """Threats whose event has no insight yet, newest first; ``limit=None`` returns all, unsorted."""
    waiting = without_match(threats, insights, "event_id")
    if limit is None:
        return waiting
    return waiting.orderBy(F.desc_nulls_last("event_timestamp"), F.asc("event_id"), F.asc("threat_reason")).limit(limit)


def new_insights(candidates: DataFrame, target: DataFrame) -> DataFrame:
    """Candidates to insert: the newest event of each insight_id, none that the target already holds."""
    newest = first_per_key(candidates, ["insight_id"], F.desc_nulls_last("event_timestamp"))
    return without_match(newest, target, "insight_id")


@dataclass(frozen=True)
class TriageReport:
    fetched: int
    written: int


def _observed(rows: Observation) -> int:
    """The number of rows seen. Where nothing came, adaptive execution may leave the place out of the plan, and then there are no metrics."""
    try:
        return rows.get.get("n", 0)
    except Py4JJavaError as error:
        # PySpark asserts that the metrics have a schema; the empty row that stands for none has not.
        if "AssertionError" not in str(error.java_exception):
            raise
        return 0


def run_triage(
    threats: DataFrame, insights: DataFrame, append, limit: int | None = 100, as_of: AsOf = None
) -> TriageReport:
    """Score the untriaged threats and append the new insights with ``append(df)``.

    The counts are observed during that one write. Running it again writes nothing new.
    """
    fetched, written = Observation("fetched"), Observation("written")
    waiting = untriaged_threats(threats, insights, limit).observe(fetched, F.count(F.lit(1)).alias("n"))
    fresh = new_insights(build_insights(waiting, as_of), insights).observe(written, F.count(F.lit(1)).alias("n"))
    append(fresh)
    return TriageReport(fetched=_observed(fetched), written=_observed(written))
