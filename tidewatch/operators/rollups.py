"""Dashboard roll-ups and top-n reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.numbers import safe_ratio


def counts_by(rows: DataFrame, *keys: str, name: str) -> DataFrame:
    """Row counts per key combination, largest first."""
    return rows.groupBy(*keys).agg(F.count("*").alias(name)).orderBy(F.desc(name), *keys)


def rule_fire_counts(threats: DataFrame) -> DataFrame:
    return counts_by(threats, "threat_reason", "severity", name="indicator_count")


def indicators_by_reason(threats: DataFrame) -> DataFrame:
    return counts_by(threats, "threat_reason", name="indicator_count")


def indicators_by_severity_target(threats: DataFrame) -> DataFrame:
    return counts_by(threats, "severity", "target_system", name="indicator_count")


def events_by_country(fact: DataFrame) -> DataFrame:
    return counts_by(fact, "source_country", name="event_count")


def quarantine_counts(quarantine: DataFrame) -> DataFrame:
    """Quarantined events per reason list, as reported."""
    return counts_by(quarantine, "quality_failure_reason", name="quarantined")


def quarantine_reason_counts(quarantine: DataFrame) -> DataFrame:
    """Quarantined events per single reason; an event with two reasons counts under both.

    Counted per reason list first: there are few lists, so splitting them costs nothing afterwards.
    """
    lists = quarantine.groupBy("quality_failure_reason").agg(F.count("*").alias("n"))
    return (
        lists.select(F.explode(F.split("quality_failure_reason", ",")).alias("reason"), "n")
        .groupBy("reason")
        .agg(F.sum("n").alias("quarantined"))
        .orderBy(F.desc("quarantined"), "reason")
    )


def events_by_window(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("window_start").agg(F.sum("event_count").alias("event_count")).orderBy("window_start")


def egress_by_window(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("window_start").agg(F.sum("total_bytes_out").alias("total_bytes_out")).orderBy("window_start")


def trend_slice(
    metrics: DataFrame,
    event_types: Sequence[str] | None = None,
    target_systems: Sequence[str] | None = None,
    source_countries: Sequence[str] | None = None,
) -> DataFrame:
    """Metric rows matching every given slicer; a slicer left out does not filter."""
    slicers = {"event_type": event_types, "target_system": target_systems, "source_country": source_countries}
    for column, values in slicers.items():
        if values is not None:
            metrics = metrics.filter(F.col(column).isin(*values))
    return metrics


def _per_actor(fact: DataFrame) -> DataFrame:
    """Events and failures per (event type, target, actor).

    Distinct actors do not add up across groups, so the matrices start from this table. It is far smaller
    than the fact table, and a dominant actor is one row per cell in it.
    """
    return fact.groupBy("event_type", "target_system", "actor_id").agg(
        F.count("*").alias("events"),
        F.count_if(F.col("outcome") == "failure").alias("failures"),
    )


def _matrix_cells() -> list:
    return [
        F.sum("events").alias("event_count"),
        safe_ratio(F.sum("failures"), F.sum("events"), 4).alias("failure_rate"),
    ]


def event_target_matrix(fact: DataFrame) -> DataFrame:
    """Events, failure rate and distinct actors per event type and target system."""
    cells = _per_actor(fact).groupBy("event_type", "target_system")
    # One row per actor and cell, so counting the non-null actors counts them distinct.
    return cells.agg(*_matrix_cells(), F.count("actor_id").alias("unique_actors"))


def event_target_rollup(fact: DataFrame) -> DataFrame:
    """The matrix with totals per event type and overall; null marks "all"."""
    return (
        _per_actor(fact)
        .rollup("event_type", "target_system")
        .agg(
            *_matrix_cells(),
            F.count_distinct("actor_id").alias("unique_actors"),
            F.grouping_id().cast("int").alias("total_level"),
        )
    )


def top_failed_auth_actors(fact: DataFrame, n: int | None = None) -> DataFrame:
    """Actors with most failed authentications, the first ``n`` or all of them."""
    failed = fact.filter((F.col("event_type") == "authentication") & (F.col("outcome") == "failure"))
    counts = failed.groupBy("actor_id").agg(F.count("*").alias("failed_count"))
    ranked = counts.orderBy(F.desc("failed_count"), "actor_id")
    return ranked if n is None else ranked.limit(n)


def recent_quarantine(quarantine_rows: DataFrame, n: int | None = None) -> DataFrame:
    """Quarantined records, newest ingestion first, the first ``n`` or all of them."""
    ranked = quarantine_rows.orderBy(F.desc_nulls_last("ingestion_timestamp"), F.desc("event_id"))
    return ranked if n is None else ranked.limit(n)


def newest_insights(insights: DataFrame, n: int = 20) -> DataFrame:
    return insights.orderBy(
        F.desc("generated_at"), F.desc_nulls_last("event_timestamp"), F.asc("event_id"), F.asc("threat_reason")
    ).limit(n)


def average_risk(insights: DataFrame) -> DataFrame:
    return insights.agg(F.avg("risk_score").alias("average_risk_score"))


def risk_level_queue_sets(insights: DataFrame) -> DataFrame:
    """Insight counts per risk level and per triage queue from one pass over the insights."""
    pairs = insights.groupBy("risk_level", "triage_queue").agg(F.count("*").alias("n"))
    level, queue = F.col("risk_level"), F.col("triage_queue")
    return pairs.groupingSets([[level], [queue]], level, queue).agg(F.sum("n").alias("insight_count"))


def curated_row_counts(**tables: DataFrame) -> DataFrame:
    """One row per table: its name and its number of rows."""
    counted = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    stacked = counted[0]
    for one in counted[1:]:
        stacked = stacked.unionAll(one)
    return stacked
