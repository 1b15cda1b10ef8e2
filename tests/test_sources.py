import json

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.quality import clean_events, quarantined_events
from tidewatch.schemas import AGGREGATE_SCHEMA, EVENT_SCHEMA, FACT_SCHEMA, INSIGHT_SCHEMA
from tidewatch.sources import curated
from tidewatch.sources.curated import FACT, INSIGHTS, METRICS, CuratedStore
from tidewatch.sources.messages import decode_messages, keyed_messages, log_partition, ordered_messages
from tests.conftest import BASE_EVENT


def test_schema_sizes():
    assert len(EVENT_SCHEMA.names) == 26
    assert len(FACT_SCHEMA.names) == 47
    assert len(AGGREGATE_SCHEMA.names) == 15
    assert len(INSIGHT_SCHEMA.names) == 23


def test_decode_keeps_position_and_malformed_text(spark):
    payloads = [json.dumps(BASE_EVENT), "{broken", None]
    messages = spark.createDataFrame(
        [(bytearray(p, "utf-8") if p else None, "t", 1, n) for n, p in enumerate(payloads)],
        "value binary, topic string, partition int, offset bigint",
    ).withColumn("timestamp", F.lit("2031-03-06 09:00:00").cast("timestamp"))
    rows = decode_messages(messages).orderBy("kafka_offset").collect()
    assert rows[0].event_id == "row-1" and rows[0].bytes_out == 1 and rows[0].is_privileged_actor is False
    assert [r.event_id for r in rows[1:]] == [None, None]
    assert [r.raw_value for r in rows[1:]] == ["{broken", None]
    assert [r.kafka_offset for r in rows] == [0, 1, 2]
    rejected = quarantined_events(clean_events(decode_messages(messages))).collect()
    assert {r.quality_failure_reason for r in rejected} == {"missing_actor,missing_target,unparseable_event_time"}


def test_keyed_messages(events):
    rows = keyed_messages(events({}, {"actor_id": ""}, {"actor_id": None, "mfa_used": None})).collect()
    assert [r.key for r in rows] == ["actor_id", "row-1", "row-1"]
    assert json.loads(rows[0].value) == BASE_EVENT
    assert json.loads(rows[2].value) == {**BASE_EVENT, "actor_id": None, "mfa_used": None}


def test_log_partitions_are_those_of_the_log(spark):
    """Published values of the hash."""
    known = {"21": -973932308, "foobar": -790332482, "a-little-bit-long-string": -985981536, "a-little-bit-longer-string": -1486304829, "abc": 479470107}
    rows = spark.createDataFrame([(k,) for k in known], "k string").select("k", log_partition(F.col("k"), 1 << 31).alias("p"), log_partition(F.col("k"), 7).alias("q"))
    assert {r.k: (r.p, r.q) for r in rows.collect()} == {k: (h & 0x7FFFFFFF, (h & 0x7FFFFFFF) % 7) for k, h in known.items()}


def test_each_actor_is_published_in_order(spark, events):
    """A hot actor among others, arriving out of order: one writer a log partition, times in order, the same numbers at a replay."""
    made = [{"event_id": f"{n:04}", "event_time": f"2031-03-06T{n * 7 % 24:02}:{n % 60:02}:00+00:00", "actor_id": "hot" if n % 3 else f"a{n % 11}"} for n in range(400)]
    rows = events(*made, {"actor_id": None}, {"actor_id": "", "event_time": None})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sent = ordered_messages(rows.repartition(5), 6).select("*", F.spark_partition_id().alias("task"), F.get_json_object("value", "$.event_time").alias("time")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sent) == 402 and len({r.partition for r in sent}) > 2
    for partition in {r.partition for r in sent}:
        own = [r for r in sent if r.partition == partition]
        assert len({r.task for r in own}) == 1 and [r.sequence for r in own] == list(range(1, len(own) + 1))
    for key in {r.key for r in sent}:
        own = [r for r in sent if r.key == key]
        assert len({r.partition for r in own}) == 1 and [r.time or "" for r in own] == sorted(r.time or "" for r in own)
    again = ordered_messages(rows.repartition(3), 6).collect()
    assert {tuple(r) for r in again} == {tuple(r)[:4] for r in sent}


def test_store_reads_empty_and_replaces_a_repeated_batch(spark, processed, tmp_path):
    store = CuratedStore(spark, str(tmp_path))
    assert store.read(FACT).count() == 0
    assert store.read(FACT).columns[:47] == FACT_SCHEMA.names
    rows = processed({}, {"event_id": "2", "event_time": "2031-03-07T00:00:00+00:00"})
    store.append(FACT, rows, 0, "q-0")
    store.append(FACT, rows.filter("event_id = '2'"), 0, "q-0")
    store.append(FACT, rows, 1, "q-1")
    assert sorted((r.event_id, r.batch_id) for r in store.read(FACT).collect()) == [
        ("2", 0), ("2", 1), ("row-1", 1),
    ]
    day = spark.sql("SELECT DATE '2031-03-07' d").first().d
    assert store.read(FACT, [day]).count() == 2
    assert store.read(FACT, [day.replace(year=1999)]).count() == 0


def test_tables_can_be_declared_over_the_store(spark, processed, tmp_path):
    store = CuratedStore(spark, str(tmp_path / "tables"))
    curated.create_layers(spark, "t_")
    for _ in range(2):
        curated.create_curated_tables(spark, "t_curated", store.location)
    store.append(FACT, processed({}), 0)
    curated.recover_partitions(store, "t_curated")
    assert spark.table(f"t_curated.{FACT}").select("event_id", "batch_id").collect() == [("row-1", 0)]
    assert spark.table(f"t_curated.{METRICS}").columns[:15] == AGGREGATE_SCHEMA.names
    assert spark.table(f"t_curated.{INSIGHTS}").columns[:23] == INSIGHT_SCHEMA.names


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from tidewatch.session import scratch_dir

    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Cluster, "x")
