"""The streaming pipeline: decode, clean, flag, then facts, quarantine and metrics."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.dedup import EVENT_KEY, dedup_by_id, dedup_by_key, keyed_rows, unseen_by_key
from tidewatch.operators.detect import flag_threats
from tidewatch.operators.metrics import METRIC_INPUTS, security_metrics
from tidewatch.operators.quality import INVALID, VALID, clean_events, valid_events
from tidewatch.rules import STANDARD_GATE, STANDARD_RULES, DetectionRules, QualityRules
from tidewatch.schemas import SKETCHES
from tidewatch.streaming.progress import ProgressLog
from tidewatch.sources.curated import EVENT_DATE, FACT, METRICS, QUARANTINE, CuratedStore

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class PipelineConfig:
    checkpoint_base: str
    trigger: dict = field(default_factory=lambda: {"processingTime": "15 seconds"})
    watermark_delay: str = "10 minutes"
    gate: QualityRules = STANDARD_GATE
    rules: DetectionRules = STANDARD_RULES
    # What watermark state drops: "key" repeats of (event_id, event time), "id" repeats of event_id alone.
    dedup: str = "key"
    # True: facts are de-duplicated against the stored ones and late facts are kept.
    # False: by watermark state; cheaper on a large feed, and facts later than the watermark are dropped.
    look_back: bool = True
    # Above 1: spread the copies of one event over this many tasks in watermark state (key de-duplication).
    hot_key_salts: int = 1


def enrich(events: DataFrame, config: PipelineConfig) -> DataFrame:
    """Clean and flag decoded events; a narrow plan, the same for a batch and a stream."""
    return events.transform(clean_events, config.gate).transform(flag_threats, config.rules)


def unique_events(events: DataFrame, config: PipelineConfig) -> DataFrame:
    """The stream without repeats, by watermark state; this sets the watermark of the query."""
    if config.dedup == "id":
        return dedup_by_id(events, config.watermark_delay)
    return dedup_by_key(events, config.watermark_delay, config.hot_key_salts)


def stream_metrics(enriched: DataFrame, config: PipelineConfig) -> DataFrame:
    """One-minute metrics of the valid, de-duplicated stream.

    De-duplication keeps every column it is given, so it gets those alone that the metrics read. Salts go by the source position
    of a copy, which would be gone then.
    """
    events = valid_events(enriched)
    if config.hot_key_salts == 1:
        events = events.select(*EVENT_KEY, *METRIC_INPUTS)
    return security_metrics(unique_events(events, config), keep_sketches=True)


@contextmanager
def _cached(frame: DataFrame) -> Iterator[DataFrame]:
    """The frame, cached; a micro-batch used twice would run its stateful plan twice."""
    frame.persist()
    try:
        yield frame
    finally:
        frame.unpersist()


def _batch_key(batch: DataFrame, batch_id: int) -> str:
    """Names a batch across restarts: the id of the streaming query, kept in its checkpoint, and the batch."""
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query_id or 'batch'}-{batch_id}"


@contextmanager
def _adaptive(batch: DataFrame) -> Iterator[None]:
    """Adaptive execution for what is made of a batch: Spark turns it off for stateful streams, and each of their tasks would write a file per date.

    The plan of the batch itself is made before and stays as it is.
    """
    conf, name = batch.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        yield
    finally:
        conf.set(name, before)


def _unseen(batch: DataFrame, store: CuratedStore, batch_key: str) -> DataFrame:
    """One row per key of the batch that no earlier batch has stored as fact or quarantine.

    Equal keys have equal event times, so the look-back reads two columns of the parts whose dates and event times overlap those of the
    batch, by their manifests. Rows stored by a first attempt at this same batch do not count: they are about to be replaced.
    """
    day = F.to_date("event_timestamp").alias(EVENT_DATE)
    spans = keyed_rows(batch).groupBy(day).agg(F.min("event_timestamp"), F.max("event_timestamp")).collect()
    if not spans:
        return dedup_by_key(batch)
    first, last = min(s[1] for s in spans), max(s[2] for s in spans)
    keys = [
        store.read(table, [s[0] for s in spans], (first, last), without_batch=batch_key).select(*EVENT_KEY) for table in (FACT, QUARANTINE)
    ]
    stored = keys[0].unionAll(keys[1]).filter(F.col("event_timestamp").between(F.lit(first), F.lit(last)))
    return unseen_by_key(batch, stored)


def events_writer(store: CuratedStore, look_back: bool = True) -> Callable[[DataFrame, int], None]:
    """Batch writer that splits one micro-batch into fact and quarantine.

    With ``look_back`` repeats are dropped inside the batch and against what is stored, so a late event is
    kept whatever its delay; without it the stream must have been de-duplicated before. Rows without a
    key are all kept. Nothing is cached: both tables are written in one pass, and the look-back reads the event times in a pass of its own.
    """
    table = F.when(F.col("quality_status") == VALID, FACT).when(F.col("quality_status") == INVALID, QUARANTINE)

    def write(batch: DataFrame, batch_id: int) -> None:
        key = _batch_key(batch, batch_id)
        with _adaptive(batch):
            rows = _unseen(batch, store, key) if look_back else batch
            store.log.commit(key, store.write_split(rows, table, (FACT, QUARANTINE), key, batch_id))

    return write


def table_writer(store: CuratedStore, table: str) -> Callable[[DataFrame, int], None]:
    """Batch writer that appends a micro-batch, with its batch id, to one table.

    The stateful plan of the batch runs once, in the write itself; a batch without rows leaves no commit.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        key = _batch_key(batch, batch_id)
        with _adaptive(batch):
            if parts := store.write(table, batch, key, batch_id):
                store.log.commit(key, parts)

    return write


def connector_writer(columns: Sequence[str], fmt: str, **options: str) -> Callable[[DataFrame, int], None]:
    """Batch writer for any Spark data source (a warehouse connector, JDBC): project, add batch id, append."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with _cached(batch):
            if not batch.isEmpty():
                rows = batch.withColumn("batch_id", F.lit(batch_id)).select(*columns)
                rows.write.format(fmt).options(**options).mode("append").save()

    return write


def start_events(enriched: DataFrame, store: CuratedStore, config: PipelineConfig) -> StreamingQuery:
    """Facts and quarantine from one query: the source is read once for both."""
    events = enriched if config.look_back else unique_events(enriched, config)
    return (
        events.writeStream.queryName("security_events")
        .foreachBatch(events_writer(store, config.look_back))
        .option("checkpointLocation", f"{config.checkpoint_base}/security_events")
        .trigger(**config.trigger)
        .start()
    )


def start_metrics(enriched: DataFrame, store: CuratedStore, config: PipelineConfig) -> StreamingQuery:
    """Metric versions, update mode: a key is written again in every micro-batch that changes it."""
    return (
        stream_metrics(enriched, config)
        .writeStream.queryName("security_metrics")
        .foreachBatch(table_writer(store, METRICS))
        .outputMode("update")
        .option("checkpointLocation", f"{config.checkpoint_base}/{METRICS}")
        .trigger(**config.trigger)
        .start()
    )


def start_console(enriched: DataFrame, config: PipelineConfig) -> StreamingQuery:
    """Metrics to the console, untruncated."""
    return (
        stream_metrics(enriched, config).drop(*SKETCHES)
        .writeStream.queryName("security_metrics_console")
        .format("console")
        .outputMode("update")
        .option("truncate", "false")
        .option("checkpointLocation", f"{config.checkpoint_base}/console")
        .trigger(**config.trigger)
        .start()
    )


def start_pipeline(events: DataFrame, store: CuratedStore | None, config: PipelineConfig) -> list[StreamingQuery]:
    """Start the pipeline on decoded events; without a store the metrics go to the console."""
    enriched = enrich(events, config)
    if store is None:
        return [start_console(enriched, config)]
    return [start_events(enriched, store, config), start_metrics(enriched, store, config)]


def supervise(queries: Sequence[StreamingQuery], poll_seconds: int = 15, progress: ProgressLog | None = None) -> None:
    """Wait until every query has ended; raise the failure of the first one that fails.

    Each round waits at most ``poll_seconds`` for one of the running queries, then logs their status and writes the progress noted so far.
    """
    running = list(queries)
    while running:
        if progress:
            progress.flush()
        for query in list(running):
            # Raises the query's own exception if it has failed.
            if query.awaitTermination(poll_seconds / len(running)):
                log.info("query %s has ended", query.name)
                running.remove(query)
            else:
                log.info("query %s: %s", query.name, query.status["message"])
