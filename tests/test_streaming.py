"""Replay tests: JSON-line files as the message log, one file per micro-batch."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import BASE_EVENT
from tidewatch.operators.metrics import current_metrics, security_metrics
from tidewatch.operators.quality import valid_events
from tidewatch.operators.dedup import dedup_by_id, dedup_by_key
from tidewatch.plans.mart_views import register_marts, triage_store
from tidewatch.sources.curated import FACT, INSIGHTS, METRICS, QUARANTINE, CuratedStore
from tidewatch.sources.messages import decode_messages, read_kafka_stream
from tidewatch.streaming.progress import ProgressLog
from tidewatch.session import TUNING, tune
from tidewatch.streaming import pipeline
from tidewatch.streaming.pipeline import (
    PipelineConfig,
    connector_writer,
    enrich,
    start_events,
    start_metrics,
    start_pipeline,
    supervise,
    table_writer,
)


def _event(event_id, clock, **override):
    return json.dumps({**BASE_EVENT, "event_id": event_id, "event_time": f"2031-03-06T{clock}+00:00", **override})


# One list per micro-batch.
BATCHES = [
    [
        _event("a", "09:00:10"),
        _event("a", "09:00:10"),
        _event("b", "09:00:20", source_country="RU"),
        "{broken one",
        "{broken two",
        _event("bad", "09:00:30", actor_id=""),
        json.dumps({**BASE_EVENT, "event_id": None, "event_time": "2031-03-06T09:00:40+00:00"}),
    ],
    [
        _event("a", "09:00:10"),
        _event("a", "09:00:50"),
        _event("c", "09:40:00", event_type="privilege_change"),
        _event("bad", "09:00:30", actor_id=""),
        _event("untimed", "x"),
        _event("untimed", "x"),
    ],
    # Later than the watermark, which is 09:30 by now.
    [_event("late", "09:00:15"), _event("d", "09:41:00"), _event("c", "09:40:00", event_type="privilege_change")],
]


@pytest.fixture
def log(spark, tmp_path):
    """Stream of decoded messages; each call of ``add`` appends one file."""
    folder = tmp_path / "log"
    folder.mkdir()
    added = []

    def add(lines):
        path = folder / f"{len(added):03}.txt"
        # Each line is "<offset> <message>"; copies of a message differ in their offset, as in a real log.
        path.write_text("\n".join(f"{100 * len(added) + n} {line}" for n, line in enumerate(lines)))
        # The file source orders by modification time.
        os.utime(path, (1_700_000_000 + len(added), 1_700_000_000 + len(added)))
        added.append(path)

    def stream():
        text = spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder))
        return decode_messages(
            text.select(
                F.expr("encode(regexp_extract(value, '^[0-9]+ (.*)$', 1), 'UTF-8') AS value"),
                F.lit("security-events").alias("topic"),
                F.lit(0).alias("partition"),
                F.expr("CAST(regexp_extract(value, '^[0-9]+', 0) AS BIGINT) AS offset"),
                F.lit("2031-03-06 10:00:00").cast("timestamp").alias("timestamp"),
            )
        )

    return add, stream


@pytest.fixture
def config(tmp_path):
    return PipelineConfig(str(tmp_path / "checkpoints"), trigger={"availableNow": True})


def _stored(store, table):
    return sorted((r.event_id or "-", str(r.event_timestamp)[11:]) for r in store.read(table).collect())


FACTS = [("-", "09:00:40"), ("a", "09:00:10"), ("a", "09:00:50"), ("b", "09:00:20"), ("c", "09:40:00"), ("d", "09:41:00")]
REJECTED = [("-", ""), ("-", ""), ("bad", "09:00:30"), ("untimed", ""), ("untimed", "")]


def test_facts_and_quarantine_with_look_back(spark, log, config, tmp_path):
    add, stream = log
    for lines in BATCHES:
        add(lines)
    store = CuratedStore(spark, str(tmp_path / "curated"))
    start_events(enrich(stream(), config), store, config).awaitTermination()
    # The late event is kept, every repeat is dropped, every malformed message is kept.
    assert _stored(store, FACT) == sorted([*FACTS, ("late", "09:00:15")])
    assert _stored(store, QUARANTINE) == REJECTED
    assert {r.batch_id for r in store.read(FACT).collect()} == {0, 1, 2}


@pytest.mark.parametrize("salts", [1, 3])
def test_facts_by_watermark_state_drop_late_events(spark, log, tmp_path, salts):
    add, stream = log
    config = PipelineConfig(
        str(tmp_path / "checkpoints"), trigger={"availableNow": True}, look_back=False, hot_key_salts=salts
    )
    store = CuratedStore(spark, str(tmp_path / "curated"))
    for lines in BATCHES:
        add(lines)
        start_events(enrich(stream(), config), store, config).awaitTermination()
    assert _stored(store, FACT) == FACTS
    assert _stored(store, QUARANTINE) == REJECTED


def test_metrics_versions_and_watermark(spark, log, config, tmp_path):
    add, stream = log
    store = CuratedStore(spark, str(tmp_path / "curated"))
    for lines in BATCHES:
        add(lines)
        query = start_metrics(enrich(stream(), config), store, config)
        query.awaitTermination()
    # The third run drops the late event by watermark.
    dropped = [op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]]
    assert sum(dropped) == 1
    versions = store.read(METRICS).filter("source_country = 'SOURCE_COUNTRY' AND minute(window_start) = 0").orderBy("batch_id")
    assert [r.event_count for r in versions.collect()] == [2, 3]
    current = current_metrics(store.read(METRICS))
    assert sorted((r.window_start.minute, r.source_country, r.event_count) for r in current.collect()) == [
        (0, "RU", 1),
        (0, "SOURCE_COUNTRY", 3),
        (40, "SOURCE_COUNTRY", 1),
        (41, "SOURCE_COUNTRY", 1),
    ]


@pytest.mark.parametrize("salts", [1, 2])
def test_metrics_deduplicate_what_they_read_alone(processed, monkeypatch, salts):
    seen = []
    monkeypatch.setattr(pipeline, "unique_events", lambda events, config: seen.append(events.columns) or events)
    pipeline.stream_metrics(processed({}), PipelineConfig("unused", hot_key_salts=salts))
    # Copies are dealt to salts by their source position, so that has to be there.
    assert (len(seen[0]) == 11) == (salts == 1) and ("user_agent" in seen[0]) == (salts > 1)


def test_a_batch_is_written_once_without_a_cache(spark, processed, tmp_path, monkeypatch):
    store, cached = CuratedStore(spark, str(tmp_path / "curated")), []
    monkeypatch.setattr(pipeline, "_cached", cached.append)
    minutes, write = security_metrics(valid_events(processed({}, {})), keep_sketches=True), table_writer(store, METRICS)
    write(minutes.limit(0), 0)
    assert store.log.version() == -1 and store.read(METRICS).count() == 0
    write(minutes, 1)
    write(minutes, 1)
    assert not cached and [(r.batch_id, r.event_count) for r in store.read(METRICS).collect()] == [(1, 2)]


@pytest.mark.parametrize("look_back", [True, False])
def test_fact_and_quarantine_are_written_in_one_pass(spark, processed, tmp_path, monkeypatch, look_back):
    """Without a cache, and a file per table and date also where adaptive execution is off, as in stateful streams."""
    store, cached = CuratedStore(spark, str(tmp_path / "curated")), []
    monkeypatch.setattr(pipeline, "_cached", cached.append)
    made = [{"event_id": str(n), "actor_id": "" if n % 3 == 0 else "x"} for n in range(30)]
    rows = processed(*made, {"event_id": "undecided", "bytes_out": None}).repartition(8)
    write = pipeline.events_writer(store, look_back)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write(rows.limit(0), 0)
        write(rows.filter("quality_status = 'invalid'").filter("event_id = '3'"), 1)
        write(rows, 2)
        write(rows, 2)
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert not cached
    assert store.read(FACT).count() == 20
    rejected = sorted((r.event_id, r.batch_id) for r in store.read(QUARANTINE).collect())
    expected = [("3", 1), *((str(n), 2) for n in range(0, 30, 3)), ("undecided", 2)]
    assert rejected == sorted(e for e in expected if not look_back or e != ("3", 2))
    assert len(store.read(FACT).inputFiles()) == 1 and len(store.read(QUARANTINE).inputFiles()) == 2
    assert not list((tmp_path / "curated" / "_together").iterdir())


def test_a_given_session_gets_the_codegen_limit(spark):
    (name, limit), = TUNING.items()
    spark.conf.set(name, "65535")
    tune(spark)
    assert spark.conf.get(name) == limit


@pytest.mark.parametrize("mode,batch_dedup", [("key", dedup_by_key), ("id", dedup_by_id)])
def test_stream_metrics_equal_batch_metrics(spark, log, tmp_path, mode, batch_dedup):
    add, stream = log
    lines = [line for batch in BATCHES for line in batch]
    add(lines)
    config = PipelineConfig(str(tmp_path / "checkpoints"), trigger={"availableNow": True}, dedup=mode)
    store = CuratedStore(spark, str(tmp_path / "curated"))
    start_metrics(enrich(stream(), config), store, config).awaitTermination()
    messages = spark.createDataFrame([(line,) for line in lines], "value string").select(
        "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(0).alias("offset"), F.lit(None).alias("timestamp")
    )
    batch = security_metrics(batch_dedup(valid_events(enrich(decode_messages(messages), config))))
    columns = batch.columns
    got = store.read(METRICS).select(*columns)
    if mode == "id":
        # The stream keeps the first copy to arrive, the batch the earliest; both keep one per id.
        assert got.groupBy().sum("event_count").first() == batch.groupBy().sum("event_count").first()
    else:
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_a_repeated_batch_replaces_its_first_attempt(spark, log, config, tmp_path):
    add, stream = log
    add(BATCHES[0])
    store = CuratedStore(spark, str(tmp_path / "curated"))
    start_events(enrich(stream(), config), store, config).awaitTermination()
    before = (_stored(store, FACT), _stored(store, QUARANTINE))
    # As after a crash between the write and the commit of batch 0.
    for commit in (tmp_path / "checkpoints" / "security_events" / "commits").glob("*0*"):
        commit.unlink()
    start_events(enrich(stream(), config), store, config).awaitTermination()
    assert (_stored(store, FACT), _stored(store, QUARANTINE)) == before


def test_pipeline_marts_and_triage(spark, log, config, tmp_path):
    add, stream = log
    for lines in BATCHES:
        add(lines)
    store = CuratedStore(spark, str(tmp_path / "curated"))
    supervise(start_pipeline(stream(), store, config), poll_seconds=2)
    as_of = datetime(2031, 3, 6, 9, 45)
    assert triage_store(store, as_of=as_of).written == 2
    assert triage_store(store, as_of=as_of).written == 0
    names = register_marts(store, as_of)
    assert len(names) == 7
    rows = {name: spark.table(name).count() for name in names}
    assert rows["vw_threat_events"] == rows["vw_ai_threat_insights"] == store.read(INSIGHTS).count() == 2
    assert rows["vw_quarantined_events"] == 5
    assert rows["vw_realtime_kpis"] == rows["vw_data_quality_scorecard"] == rows["vw_ai_security_summary"] == 1
    summary = spark.table("vw_ai_security_summary").first()
    assert (summary.total_events, summary.threat_indicators) == (7, 2)


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka_stream(spark, "broker:9092", "security-events", maxOffsetsPerTrigger="1000")


def test_supervise_raises_the_failure(spark, log, config):
    add, stream = log
    add(BATCHES[0])

    def fail(batch, batch_id):
        raise ValueError("sink is down")

    query = stream().writeStream.foreachBatch(fail).option("checkpointLocation", config.checkpoint_base).start()
    with pytest.raises(Exception, match="sink is down"):
        supervise([query], poll_seconds=1)


def test_progress_of_queries(spark, log, config, tmp_path):
    """One row per micro-batch with the late rows it dropped; a failed run is named; nothing is noted after detaching."""
    add, stream = log
    store = CuratedStore(spark, str(tmp_path / "curated"))
    progress = ProgressLog(spark, str(tmp_path / "progress")).attach()
    assert progress.frame().count() == 0
    for lines in BATCHES:
        add(lines)
        query = start_metrics(enrich(stream(), config), store, config)
        supervise([query], poll_seconds=1, progress=progress)
        assert progress.wait_for(query.runId)

    def fail(batch, batch_id):
        raise ValueError("sink is down")

    broken = stream().writeStream.foreachBatch(fail).option("checkpointLocation", f"{config.checkpoint_base}/broken").start()
    with pytest.raises(Exception, match="sink is down"):
        supervise([broken], poll_seconds=1, progress=progress)
    assert progress.wait_for(broken.runId)
    progress.detach()
    rows = progress.frame().filter("name = 'security_metrics' AND input_rows > 0").orderBy("batch_id").collect()
    assert [r.dropped_late_rows for r in rows] == [0, 0, 1] and len({r.query_id for r in rows}) == 1 and len({r.run_id for r in rows}) == 3
    assert all(r.state_rows > 0 and r.batch_ms > 0 for r in rows)
    (failure,) = progress.failures()
    assert failure[0] == str(broken.id) and "sink is down" in failure[1]


def test_console_and_connector_sinks(spark, log, config, tmp_path):
    add, stream = log
    add(BATCHES[0])
    supervise(start_pipeline(stream(), None, config), poll_seconds=1)
    out = str(tmp_path / "out")
    writer = connector_writer(["event_id", "batch_id"], "json", path=out)
    query = stream().writeStream.foreachBatch(writer).option("checkpointLocation", f"{out}-cp").trigger(availableNow=True)
    query.start().awaitTermination()
    assert spark.read.json(out).filter("batch_id = 0").count() == len(BATCHES[0])
