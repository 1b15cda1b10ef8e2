import pytest
from pyspark.sql import functions as F

from tidewatch.operators.dedup import dedup_by_id, dedup_by_key, unseen_by_key, without_match
from tidewatch.operators.lateness import mark_late
from tidewatch.operators.metrics import current_metrics, security_metrics
from tidewatch.operators.quality import valid_events
from tidewatch.schemas import AGGREGATE_SCHEMA

T0, T30 = "2031-03-06T09:15:00+00:00", "2031-03-06T09:15:30+00:00"
FEED = [
    {"event_id": "a", "event_time": T0},
    {"event_id": "a", "event_time": T0},
    {"event_id": "a", "event_time": T30},
    {"event_id": "b", "event_time": T30},
    {"event_id": None, "event_time": T0},
    {"event_id": None, "event_time": T0},
    {"event_id": "c", "event_time": "not-a-time"},
    {"event_id": "c", "event_time": "not-a-time"},
]


def _keys(df):
    return sorted((row.event_id or "-", str(row.event_timestamp)[-8:]) for row in df.collect())


def test_dedup_by_key_keeps_rows_without_a_key(processed):
    assert _keys(dedup_by_key(processed(*FEED))) == [
        ("-", "09:15:00"),
        ("-", "09:15:00"),
        ("a", "09:15:00"),
        ("a", "09:15:30"),
        ("b", "09:15:30"),
        ("c", "None"),
        ("c", "None"),
    ]


def test_dedup_by_id_keeps_the_earliest(processed):
    assert _keys(dedup_by_id(processed(*FEED))) == [
        ("-", "09:15:00"),
        ("-", "09:15:00"),
        ("a", "09:15:00"),
        ("b", "09:15:30"),
        ("c", "None"),
    ]


def test_without_match_follows_not_exists(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 4)], "id string, n int")
    existing = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    assert sorted(row.n for row in without_match(rows, existing, "id").collect()) == [3, 4, 4]
    both = spark.createDataFrame([("a", 1), ("b", None)], "id string, n int")
    assert sorted((row.id or "-", row.n) for row in without_match(rows, both, "id", "n").collect()) == [
        ("-", 4),
        ("-", 4),
        ("a", 2),
        ("b", 3),
    ]


def test_match_keys_do_not_run_together(spark):
    rows = spark.createDataFrame([("a", "bc")], "x string, y string")
    existing = spark.createDataFrame([("ab", "c")], "x string, y string")
    assert without_match(rows, existing, "x", "y").count() == 1


METRIC_FEED = [{"event_type": "authentication", **row} for row in (
    {"event_id": "1", "event_time": "2031-03-06T09:15:00+00:00", "actor_id": "A", "bytes_out": 10},
    {"event_id": "2", "event_time": "2031-03-06T09:15:59.999+00:00", "actor_id": "A", "source_ip": "x", "bytes_out": 5, "outcome": "failure", "failed_attempts_1h": 20},
    {"event_id": "3", "event_time": "2031-03-06T09:15:20+00:00", "actor_id": "B", "bytes_out": 1, "outcome": "blocked"},
    {"event_id": "4", "event_time": "2031-03-06T09:16:00+00:00", "actor_id": "B"},
    {"event_id": "5", "event_time": "2031-03-06T09:15:20+00:00", "actor_id": "B", "target_system": "other"},
)]


@pytest.mark.parametrize("exact", [True, False])
def test_minute_metrics(processed, exact):
    metrics = security_metrics(valid_events(processed(*METRIC_FEED)), exact=exact)
    assert metrics.columns == AGGREGATE_SCHEMA.names[:-1]
    assert metrics.count() == 3
    row = metrics.filter("target_system = 'target_system' AND minute(window_start) = 15").first()
    assert (row.event_count, row.failure_count, row.blocked_count, row.failure_rate) == (3, 1, 1, 0.3333)
    assert (row.unique_actors, row.unique_source_ips, row.total_bytes_out) == (2, 2, 16)
    assert (row.anomaly_count, row.max_severity_rank) == (1, 3)
    assert (row.window_end - row.window_start).total_seconds() == 60


def test_current_metrics_keeps_the_newest_version(spark, processed):
    metrics = security_metrics(valid_events(processed(*METRIC_FEED)))
    log = metrics.withColumn("batch_id", F.lit(1)).unionByName(
        metrics.filter("event_count = 3").withColumn("event_count", F.lit(7).cast("bigint")).withColumn("batch_id", F.lit(2))
    )
    assert sorted(row.event_count for row in current_metrics(log).collect()) == [1, 1, 7]


@pytest.mark.parametrize("chunk,levels", [(1_000_000, 2), (7, 2), (3, 3), (50, 1), (10, 0)])
def test_late_marking_is_the_same_for_every_chunking(spark, chunk, levels):
    rows = [(n, (n * 37) % 101 if n % 5 else None) for n in range(200)]
    feed = spark.createDataFrame(rows, "n bigint, minute int").withColumn(
        "t", F.expr("timestamp '2024-01-01 00:00:00' + make_dt_interval(0, 0, minute)")
    )
    late = {row.n: row.is_late for row in mark_late(feed, "n", "t", chunk=chunk, levels=levels).collect()}
    seen, expected = None, {}
    for n, minute in rows:
        expected[n] = minute is not None and seen is not None and minute < seen - 10
        seen = minute if seen is None or (minute is not None and minute > seen) else seen
    assert late == expected


def test_unseen_by_key_is_dedup_then_look_back(processed):
    rows = processed(*FEED, *FEED, {"event_id": "stored"}, {"event_id": "stored", "actor_id": "copy"}, {"event_id": None}, {"event_time": "x"}, {"event_time": "x"})
    stored = processed({"event_id": "stored"}, {"event_id": "stored"}, {"event_id": None}, {"event_time": "x"}, {"event_id": "other"}).select("event_id", "event_timestamp")
    expected = without_match(dedup_by_key(rows), stored, "event_id", "event_timestamp")
    got = unseen_by_key(rows, stored)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.columns == rows.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    assert plan.count("Exchange hashpartitioning") == 1 and "row_number(), 1, Partial" in plan
