"""One-minute security metrics and the current version of each metric row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.numbers import safe_ratio
from tidewatch.operators.dedup import first_per_key
from tidewatch.operators.distinct import merged_sketch, sketch, sketched_count
from tidewatch.schemas import AGGREGATE_SCHEMA, METRIC_KEYS, SKETCHES

WINDOW_LENGTH = "1 minute"
#: What the metrics read of an event beside its time.
METRIC_INPUTS = (
    "event_type", "target_system", "source_country", "outcome", "actor_id", "source_ip", "bytes_out", "is_anomaly", "severity_rank",
)


def metric_measures(distinct: Callable[[str], Column]) -> list[Column]:
    return [
        F.count("*").alias("event_count"),
        F.count_if(F.col("outcome") == "failure").alias("failure_count"),
        F.count_if(F.col("outcome") == "blocked").alias("blocked_count"),
        distinct("actor_id").alias("unique_actors"),
        distinct("source_ip").alias("unique_source_ips"),
        F.sum("bytes_out").alias("total_bytes_out"),
        F.count_if(F.col("is_anomaly")).alias("anomaly_count"),
        F.max("severity_rank").alias("max_severity_rank"),
    ]


def security_metrics(
    events: DataFrame,
    watermark_delay: str | None = None,
    exact: bool = False,
    extra: tuple[Column, ...] = (),
    keep_sketches: bool = False,
) -> DataFrame:
    """Tumbling one-minute metrics per event type, target system and source country.

    ``watermark_delay`` is for a stream that has no watermark yet: Spark allows one definition per
    lineage, so leave it out after a de-duplication step. Actors and addresses are counted with
    mergeable sketches, which ``keep_sketches`` keeps beside the counts; ``exact=True`` counts them exactly and is for batch input only.
    """
    if watermark_delay:
        events = events.withWatermark("event_timestamp", watermark_delay)
    minute = F.window("event_timestamp", WINDOW_LENGTH)
    # A stream needs the window itself as a key to expire its state; a batch groups faster on a plain start.
    key = minute.alias("window") if events.isStreaming else minute["start"].alias("window_start")
    sketches = [] if exact else [sketch(column).alias(name) for name, (column, _) in SKETCHES.items()]
    grouped = events.groupBy(key, "event_type", "target_system", "source_country").agg(
        *metric_measures(F.count_distinct if exact else lambda column: sketched_count(sketch(column))), *(sketches if keep_sketches else []), *extra
    )
    if events.isStreaming:
        grouped = grouped.withColumn("window_start", F.col("window.start")).drop("window")
    derived = {
        "window_end": F.col("window_start") + F.expr(f"INTERVAL {WINDOW_LENGTH}"),
        "failure_rate": safe_ratio(F.col("failure_count"), F.col("event_count"), 4),
    }
    wanted = [name for name in AGGREGATE_SCHEMA.names if name != "batch_id"]
    kept = [name for name in grouped.columns if name not in wanted]
    return grouped.withColumns(derived).select(*wanted, *kept)


def current_metrics(metric_log: DataFrame) -> DataFrame:
    """Latest version of every metric row.

    Update-mode output appended to a table holds one row per micro-batch and key; summing it would count
    an event once per version. The last written version wins, where the log says when that was, then the
    newest ``batch_id``: batch numbers start again with a new checkpoint. The event date, where the log is stored by
    it, follows from the window and joins the keys, so that filters on it reach the scan.
    """
    keys = [*METRIC_KEYS, *(name for name in ("event_date",) if name in metric_log.columns)]
    newest = [F.desc_nulls_last(name) for name in ("written_at", "batch_id") if name in metric_log.columns]
    return first_per_key(metric_log, keys, *newest)


def sketched_actors(metrics: DataFrame, *keys: str | Column) -> DataFrame:
    """Distinct actors and addresses over coarser keys, from the sketches kept with the minutes.

    Counts of minutes do not add up, as an actor is seen in many of them; the sketches are united instead. ``metrics`` must hold one
    version per minute (``current_metrics``) with its sketches.
    """
    united = {name: merged_sketch(name) for name in SKETCHES}
    return metrics.groupBy(*keys).agg(*(sketched_count(united[name]).alias(count) for name, (_, count) in SKETCHES.items()))
