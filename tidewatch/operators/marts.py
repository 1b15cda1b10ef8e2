"""Reporting marts over the curated tables.

Every "last hour" mart takes ``as_of``. Left out, it means now and the hour has no upper bound, as in a
live dashboard; given, rows after ``as_of`` are left out too, so that a past report can be repeated.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.numbers import safe_ratio
from tidewatch.schemas import AGGREGATE_SCHEMA, INSIGHT_VIEW_COLUMNS, QUARANTINE_VIEW_COLUMNS, THREAT_SCHEMA

AsOf = datetime | None
EVENT_DATE = "event_date"


def report_time(as_of: AsOf) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def last_hour(rows: DataFrame, time_column: str, as_of: AsOf = None) -> DataFrame:
    """Rows of the hour before ``as_of`` by ``time_column``.

    On a table partitioned by event date, event and window times also bound the partitions read; the day
    before is included because a window may start on one date and end on the next.
    """
    end = report_time(as_of)
    start = end - F.expr("INTERVAL 1 HOUR")
    recent = rows.filter(F.col(time_column) >= start)
    if as_of is not None:
        recent = recent.filter(F.col(time_column) <= end)
    if EVENT_DATE in rows.columns and time_column != "ingestion_timestamp":
        recent = recent.filter(F.col(EVENT_DATE) >= F.date_sub(F.to_date(start), 1))
        if as_of is not None:
            recent = recent.filter(F.col(EVENT_DATE) <= F.to_date(end))
    return recent


def threat_events(fact: DataFrame) -> DataFrame:
    return fact.filter("is_anomaly").select(*THREAT_SCHEMA.names)


def security_trends(metrics: DataFrame) -> DataFrame:
    return metrics.select(*(name for name in AGGREGATE_SCHEMA.names if name != "batch_id"))


def quarantine_view(quarantine: DataFrame) -> DataFrame:
    return quarantine.select(*QUARANTINE_VIEW_COLUMNS)


def insights_view(insights: DataFrame) -> DataFrame:
    return insights.select(*INSIGHT_VIEW_COLUMNS)


def realtime_kpis(metrics: DataFrame, as_of: AsOf = None) -> DataFrame:
    """One row of last-hour totals. ``metrics`` must hold one version per key (``current_metrics``)."""
    totals = last_hour(metrics, "window_end", as_of).agg(
        F.max("window_end").alias("latest_window"),
        F.sum("event_count").alias("events_last_hour"),
        F.sum("failure_count").alias("failed_events_last_hour"),
        F.sum("blocked_count").alias("blocked_events_last_hour"),
        F.sum("total_bytes_out").alias("bytes_egressed_last_hour"),
        F.sum("anomaly_count").alias("threat_indicators_last_hour"),
        F.max("max_severity_rank").alias("peak_severity_rank"),
    )
    return totals.select(
        "latest_window",
        "events_last_hour",
        "failed_events_last_hour",
        "blocked_events_last_hour",
        safe_ratio(F.col("failed_events_last_hour"), F.col("events_last_hour"), 4).alias("failure_rate"),
        "bytes_egressed_last_hour",
        "threat_indicators_last_hour",
        "peak_severity_rank",
    )


def quality_scorecard(fact: DataFrame, quarantine: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Last-hour valid and quarantined counts and the valid share in percent, by ingestion time."""
    valid = last_hour(fact, "ingestion_timestamp", as_of).select(F.lit(True).alias("is_valid"))
    rejected = last_hour(quarantine, "ingestion_timestamp", as_of).select(F.lit(False).alias("is_valid"))
    counts = valid.unionAll(rejected).agg(
        F.count_if(F.col("is_valid")).alias("valid_events"),
        F.count_if(~F.col("is_valid")).alias("quarantined_events"),
        F.count("*").alias("total_events"),
    )
    return counts.select(
        report_time(as_of).alias("generated_at"),
        "valid_events",
        "quarantined_events",
        "total_events",
        safe_ratio(F.col("valid_events"), F.col("total_events"), 2, factor=100).alias("quality_score_pct"),
    )


def top_threat(fact: DataFrame, as_of: AsOf = None, n: int = 1) -> DataFrame:
    """Most frequent threat reasons of the last hour; ties go to the first name."""
    return (
        last_hour(fact, "event_timestamp", as_of)
        .filter("is_anomaly")
        .groupBy("threat_reason")
        .agg(F.count("*").alias("indicator_count"))
        .orderBy(F.desc("indicator_count"), "threat_reason")
        .limit(n)
    )


def top_target(metrics: DataFrame, as_of: AsOf = None, n: int = 1) -> DataFrame:
    """Systems with most indicators in the last hour, which may be none; ties go to the first name."""
    return (
        last_hour(metrics, "window_end", as_of)
        .groupBy("target_system")
        .agg(F.sum("anomaly_count").alias("target_indicators"))
        .orderBy(F.desc("target_indicators"), "target_system")
        .limit(n)
    )


def hourly_counts(fact: DataFrame, as_of: AsOf = None) -> DataFrame:
    return last_hour(fact, "event_timestamp", as_of).agg(
        F.count("*").alias("total_events"),
        F.count_distinct("actor_id").alias("distinct_actors"),
        F.count_if(F.col("outcome") == "failure").alias("failed_events"),
        F.count_if("is_anomaly").alias("threat_indicators"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical_indicators"),
    )


def security_summary(fact: DataFrame, metrics: DataFrame, as_of: AsOf = None) -> DataFrame:
    """One row: the last hour in figures and in a sentence.

    The counts, the top threat and the top target are one row each; they are stacked and folded, so the
    row exists even when there is no threat and no target.
    """
    counts = hourly_counts(fact, as_of)
    threat = top_threat(fact, as_of).select(F.col("threat_reason").alias("top_threat_pattern"))
    target = top_target(metrics, as_of).select(F.col("target_system").alias("top_targeted_system"))
    stacked = counts.unionByName(threat, allowMissingColumns=True).unionByName(target, allowMissingColumns=True)
    row = stacked.agg(*(F.max(name).alias(name) for name in stacked.columns))

    def number(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    def label(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("n/a"))

    # The sentence.
    sentence = F.format_string(
        "In the last hour, the platform processed %d security events across %d identities, with %d failed "
        "outcomes. Detection rules raised %d threat indicators, of which %d were critical. The most frequent "
        "pattern was %s and the most targeted system was %s.",
        number("total_events"),
        number("distinct_actors"),
        number("failed_events"),
        number("threat_indicators"),
        number("critical_indicators"),
        label("top_threat_pattern"),
        label("top_targeted_system"),
    )
    return row.select(report_time(as_of).alias("generated_at"), sentence.alias("security_summary"), *row.columns)
