"""The physical plans: what is read, where rows meet, and what happens to a dominant key."""

import re

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import dedup, evidence, marts, rollups, triage
from tidewatch.operators.metrics import security_metrics
from tidewatch.operators.quality import valid_events
from tidewatch.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# These run their job while the query is built, or stage files for it.
STAGED = {"stream_fact_quarantine", "stream_dedup", "stream_metrics", "stream_progress", "triage_job", "curated_tables", "distinct_rollup", "evidence_csv", "evidence_json", "evidence_jsonl"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STAGED))
def test_no_query_leaves_the_jvm_or_multiplies_rows(spark, name):
    plan = _plan(QUERIES[name](spark, SF_DIR))
    for banned in ("Python", "ArrowEval", "MapInArrow", "MapInPandas", "FlatMap", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan, plan


def test_scans_read_only_the_columns_they_need(spark):
    def columns(df):
        return sorted(set(re.findall(r"(\w+):", " ".join(re.findall(r"ReadSchema: struct<(.*?)>", _plan(df))))))

    assert columns(QUERIES["evidence_profile"](spark, SF_DIR)) == ["o_orderpriority", "o_orderstatus", "o_totalprice"]
    assert columns(QUERIES["evidence_profile_no_amount"](spark, SF_DIR)) == []
    assert columns(QUERIES["text_evidence"](spark, SF_DIR)) == ["doc_id", "text"]


@pytest.fixture(scope="module")
def stored_fact(spark, processed, tmp_path_factory):
    """A stored fact table in which one event id, actor and reason hold most rows."""
    path = str(tmp_path_factory.mktemp("fact") / "fact")
    hot = [{"event_time": f"2031-03-06T09:{n // 60:02}:{n % 60:02}+00:00", "source_country": "RU"} for n in range(900)]
    rest = [{"event_id": str(n), "actor_id": str(n), "event_time": "2031-03-06T09:30:00+00:00"} for n in range(300)]
    valid_events(processed(*hot, *rest)).write.parquet(path)
    return spark.read.parquet(path)


def test_filters_reach_the_stored_fact_table(stored_fact):
    assert "PushedFilters: [IsNotNull(is_anomaly), EqualTo(is_anomaly,true)]" in _plan(marts.threat_events(stored_fact))


def test_top_n_reports_do_not_sort_everything(stored_fact):
    for report in (
        rollups.top_failed_auth_actors(stored_fact, 10),
        rollups.recent_quarantine(stored_fact, 10),
        marts.top_threat(stored_fact),
    ):
        assert "TakeOrderedAndProject" in _plan(report)
    # Without n the whole ranking is asked for: a sort by ranges over all tasks.
    assert "rangepartitioning" in _plan(rollups.recent_quarantine(stored_fact))


def test_groups_are_reduced_before_they_are_shuffled(stored_fact):
    # Each aggregate has a partial step below its exchange; keep-one filters have a partial group limit.
    for report in (rollups.event_target_matrix(stored_fact), security_metrics(stored_fact), rollups.events_by_country(stored_fact)):
        assert "partial_count" in _plan(report)
    assert "row_number(), 1, Partial" in _plan(dedup.dedup_by_id(stored_fact))
    insights = triage.build_insights(marts.threat_events(stored_fact))
    assert "row_number(), 1, Partial" in _plan(triage.new_insights(insights, insights))


def test_profile_scans_once(stored_fact):
    plan = _plan(evidence.review(stored_fact.withColumnRenamed("bytes_out", "amount"), "x"))
    assert plan.count("FileScan parquet") == 1
    assert "row_number(), 6, Partial" in plan


def test_anti_join_splits_a_dominant_key(spark, stored_fact):
    """With small thresholds AQE has to cut the partition that holds the dominant event id."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        threats = marts.threat_events(stored_fact.repartition(6))
        known = stored_fact.select(F.concat("event_id", F.lit("-done")).alias("event_id"))
        waiting = dedup.without_match(threats, known, "event_id")
        assert len(waiting.collect()) == 900
        assert "isSkew=true" in _plan(waiting) or "skewed" in _plan(waiting)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_null_keys_are_spread_over_tasks(spark):
    rows = spark.range(2000).select(F.lit(None).cast("string").alias("event_id"), "id")
    known = spark.createDataFrame([("a",)], "event_id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        kept = dedup.without_match(rows, known, "event_id")
        sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 2000 and len(sizes) == 4 and max(sizes) < 1000


@pytest.mark.parametrize("name", ["decoded_messages", "valid_events"])
def test_messages_are_parsed_once(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
