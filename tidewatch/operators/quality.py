"""Quality gate: normalise events, mark every failed check, split valid from quarantined."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import rules as R
from tidewatch.functions.text import sql_literal
from tidewatch.rules import LENIENT_GATE, STANDARD_GATE, QualityRules

VALID, INVALID = "valid", "invalid"

# The free-text columns and the case each is folded to.
LOWER_CASED = ("actor_email", "event_type", "outcome", "target_system")
UPPER_CASED = ("source_country",)


@dataclass(frozen=True)
class Check:
    """One gate check: the flag column it fills, the reason it reports, and the SQL condition to pass."""

    flag: str
    reason: str
    passes: str


def normalise(events: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Parse the event time, stamp ingestion and fold the free-text columns to one spelling.

    ``ingested_at`` is evaluated after the event time is known; without it the processing time is used.
    Unparseable times become null (the plain cast throws under ANSI).
    """
    folded = {name: F.expr(f"lower(trim({name}))") for name in LOWER_CASED}
    folded |= {name: F.expr(f"upper(trim({name}))") for name in UPPER_CASED}
    return events.withColumns({"event_timestamp": F.try_to_timestamp("event_time"), **folded}).withColumns(
        {
            "ingestion_timestamp": F.current_timestamp() if ingested_at is None else ingested_at,
            "event_hour": F.hour("event_timestamp"),
        }
    )


def gate_checks(rules: QualityRules = STANDARD_GATE) -> list[Check]:
    """The checks on normalised events, in reporting order.

    A comparison with a null input stays null: the event is then invalid but carries no reason for that
    check unless ``rules.strict_reasons`` is set. Actor and target checks treat null as missing.
    """
    in_range = "bytes_out >= 0"
    if rules.max_bytes_out is not None:
        in_range = f"bytes_out BETWEEN 0 AND {rules.max_bytes_out}"
    low, high = rules.http_status_range
    checks = [
        Check("is_valid_event_type", R.UNKNOWN_EVENT_TYPE, f"event_type IN {sql_literal(rules.event_types)}"),
        Check("is_valid_outcome", R.UNKNOWN_OUTCOME, f"outcome IN {sql_literal(rules.outcomes)}"),
        Check("is_valid_actor", R.MISSING_ACTOR, "coalesce(trim(actor_id), '') <> ''"),
        Check(
            "is_valid_target",
            R.MISSING_TARGET,
            "target_system IS NOT NULL" if rules.allow_blank_target else "coalesce(target_system, '') <> ''",
        ),
        Check("is_valid_bytes", R.BYTES_OUT_OF_RANGE, in_range),
        Check(
            "is_valid_status",
            R.INVALID_HTTP_STATUS,
            f"http_status IS NULL OR http_status BETWEEN {low} AND {high}" if rules.check_http_status else "true",
        ),
    ]
    if rules.strict_reasons:
        checks = [Check(c.flag, c.reason, f"coalesce({c.passes}, false)") for c in checks]
    return checks


def apply_gate(events: DataFrame, rules: QualityRules = STANDARD_GATE) -> DataFrame:
    """Add the flag columns, ``quality_status`` and ``quality_failure_reason`` to normalised events."""
    checks = gate_checks(rules)
    all_pass = " AND ".join(["event_timestamp IS NOT NULL", *(check.flag for check in checks)])
    failures = {f"NOT {check.flag}": check.reason for check in checks}
    failures["event_timestamp IS NULL"] = R.UNPARSEABLE_EVENT_TIME
    reasons = ", ".join(f"CASE WHEN {failed} THEN '{reason}' END" for failed, reason in failures.items())
    return events.withColumns({check.flag: F.expr(check.passes) for check in checks}).withColumns(
        {
            "quality_status": F.expr(f"CASE WHEN {all_pass} THEN '{VALID}' ELSE '{INVALID}' END"),
            "quality_failure_reason": F.expr(f"concat_ws(',', {reasons})"),
        }
    )


def clean_events(
    events: DataFrame, rules: QualityRules = STANDARD_GATE, ingested_at: Column | None = None
) -> DataFrame:
    """Normalise, then gate."""
    return events.transform(normalise, ingested_at).transform(apply_gate, rules)


def lenient_clean(events: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """The relaxed gate: a status only, no flags and no reasons."""
    gated = clean_events(events, LENIENT_GATE, ingested_at)
    flags = [check.flag for check in gate_checks(LENIENT_GATE)]
    return gated.drop(*flags, "quality_failure_reason")


def valid_events(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter(F.col("quality_status") == VALID)


def quarantined_events(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter(F.col("quality_status") == INVALID)
