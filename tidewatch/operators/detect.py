"""Detection: name the first matching threat rule and look up its severity and ATT&CK code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import lookup, sql_literal
from tidewatch.rules import SEVERITIES, STANDARD_RULES, THREAT_CATALOGUE, DetectionRules


def threat_reason(rules: DetectionRules = STANDARD_RULES) -> Column:
    """Reason of the first enabled rule, in catalogue order, that matches; null if none does.

    A condition that cannot be decided because of a null does not match.
    """
    parameters = {name: sql_literal(value) for name, value in vars(rules).items()}
    cases = [
        f"WHEN {entry.condition.format(**parameters)} THEN {sql_literal(entry.reason)}"
        for entry in THREAT_CATALOGUE
        if entry.reason in rules.enabled
    ]
    return F.expr(f"CASE {' '.join(cases)} END")


def flag_threats(events: DataFrame, rules: DetectionRules = STANDARD_RULES) -> DataFrame:
    """Add threat_reason, is_anomaly, severity, severity_rank and mitre_tactic to normalised events."""
    severities = {entry.reason: entry.severity for entry in THREAT_CATALOGUE}
    ranks = {entry.reason: entry.rank for entry in THREAT_CATALOGUE}
    tactics = {entry.reason: entry.mitre_tactic for entry in THREAT_CATALOGUE}
    return events.withColumn("threat_reason", threat_reason(rules)).withColumns(
        {
            "is_anomaly": F.expr("threat_reason IS NOT NULL"),
            "severity": F.coalesce(lookup(severities, "threat_reason"), F.lit(SEVERITIES[0])),
            "severity_rank": F.coalesce(lookup(ranks, "threat_reason"), F.lit(0)),
            "mitre_tactic": lookup(tactics, "threat_reason"),
        }
    )


def enrich_from_catalogue(events: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Look severity, rank, tactic and action up by join, for a catalogue kept as a table.

    The catalogue is one row per rule; the optimizer broadcasts it by its size.
    """
    return events.join(catalogue, "threat_reason", "left")
