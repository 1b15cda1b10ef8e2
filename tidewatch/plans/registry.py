"""Named queries over the driver tables. Each takes (spark, folder of Parquet tables) and reads whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import suppress
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tidewatch.operators import dedup, evidence, marts, quality, rollups, triage
from tidewatch.operators.detect import enrich_from_catalogue, flag_threats
from tidewatch.operators.heavy import TRACKED, combined_states, hitter_states, top_values
from tidewatch.operators.lateness import mark_late
from tidewatch.operators.distinct import distinct_sets, extended_dictionary, merged_sets, set_sizes
from tidewatch.operators.metrics import current_metrics, security_metrics, sketched_actors
from tidewatch.plans.mart_views import triage_store
from tidewatch.rules import NOTEBOOK_RULES, STRICT_GATE, catalogue_frame
from tidewatch.schemas import FACT_SCHEMA, SKETCHES, conform
from tidewatch.session import scratch_dir, tune
from tidewatch.sources import activity as feed
from tidewatch.sources.commits import CommitConflict
from tidewatch.sources.curated import FACT, INSIGHTS, METRICS, QUARANTINE, CuratedStore, create_curated_tables, recover_partitions
from tidewatch.sources.evidence_files import load_evidence
from tidewatch.sources.messages import decode_messages, keyed_messages, ordered_messages
from tidewatch.streaming.pipeline import PipelineConfig, enrich, start_events, start_metrics
from tidewatch.streaming.progress import ProgressLog

Query = Callable[[SparkSession, str], DataFrame]

# Report time of the last-hour marts, inside the month the activity table covers.
AS_OF = datetime(2024, 1, 15, 12)
# Threats before this time count as triaged in the triage queries.
TRIAGED_UNTIL = datetime(2024, 1, 10)
OBJECTIVE = "weekly order review"

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function name, in UTC and with zone-free timestamps in its result."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = build(tune(spark), sf_dir)
        zoned = [f.name for f in result.schema.fields if isinstance(f.dataType, TimestampType)]
        return result.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})

    QUERIES[build.__name__] = run
    return run


# --- inputs -----------------------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.security_events(feed.read_activity(spark, sf_dir))


def _cleaned(spark: SparkSession, sf_dir: str, **gate) -> DataFrame:
    # The stored feed has no ingestion time of its own; the event time stands in.
    return quality.clean_events(_events(spark, sf_dir), ingested_at=F.col("event_timestamp"), **gate)


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_threats(_cleaned(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.valid_events(_enriched(spark, sf_dir))


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quarantined_events(_enriched(spark, sf_dir))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return security_metrics(_fact(spark, sf_dir), exact=True)


def _threats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.threat_events(_fact(spark, sf_dir))


def _insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.build_insights(_threats(spark, sf_dir), AS_OF)


def _replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    replayed = feed.replayed_activity(feed.read_activity(spark, sf_dir))
    return quality.clean_events(feed.security_events(replayed), ingested_at=F.col("event_timestamp"))


def _orders_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"o_totalprice": "Order Amount", "o_orderpriority": "Sales-Channel", "o_orderstatus": "category"}
    return _table(spark, sf_dir, "orders").withColumnsRenamed(names)


def _activity_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text quantities, some zero, and a status flag, so that every anomaly test can fire."""
    return feed.read_activity(spark, sf_dir).select(
        "event_id",
        F.col("value").alias("Value"),
        F.get_json_object("props", "$.k").alias("Qty"),
        F.concat(F.lit("user-"), (F.col("user_id") % 9).cast("string")).alias("source"),
        F.col("event_type").alias("type"),
        F.when(F.col("event_type") == "error", " Error ").otherwise("ok").alias("status"),
    )


# --- quality gate -----------------------------------------------------------------------------------

CLEAN_COLUMNS = (
    "event_id", "event_timestamp", "ingestion_timestamp", "actor_email", "event_type", "outcome",
    "target_system", "source_country", "event_hour",
)
FLAG_COLUMNS = (
    "is_valid_event_type", "is_valid_outcome", "is_valid_actor", "is_valid_target", "is_valid_bytes",
    "is_valid_status",
)


@query
def decoded_messages(spark, sf_dir):
    messages = feed.event_messages(feed.read_activity(spark, sf_dir))
    return decode_messages(messages)


@query
def malformed_messages(spark, sf_dir):
    decoded = decode_messages(feed.event_messages(feed.read_activity(spark, sf_dir)))
    rejected = quality.quarantined_events(quality.clean_events(decoded, ingested_at=F.col("kafka_timestamp")))
    return rejected.filter(F.col("event_id").isNull()).select("raw_value", "kafka_offset", "quality_failure_reason")


@query
def clean_events(spark, sf_dir):
    return _cleaned(spark, sf_dir).select(*CLEAN_COLUMNS)


@query
def quality_flags(spark, sf_dir):
    return _cleaned(spark, sf_dir).select("event_id", *FLAG_COLUMNS, "quality_status")


@query
def failure_reasons(spark, sf_dir):
    return _cleaned(spark, sf_dir).select("event_id", "quality_status", "quality_failure_reason")


@query
def strict_failure_reasons(spark, sf_dir):
    strict = _cleaned(spark, sf_dir, rules=STRICT_GATE)
    return strict.select("event_id", "quality_status", "quality_failure_reason")


@query
def lenient_gate(spark, sf_dir):
    return quality.lenient_clean(_events(spark, sf_dir)).select("event_id", "event_timestamp", "quality_status")


@query
def valid_events(spark, sf_dir):
    decoded = decode_messages(feed.event_messages(feed.read_activity(spark, sf_dir)))
    cleaned = quality.clean_events(decoded, ingested_at=F.col("kafka_timestamp"))
    fact = quality.valid_events(flag_threats(cleaned))
    return conform(fact.withColumn("batch_id", F.lit(0)), FACT_SCHEMA)


@query
def quarantined_events(spark, sf_dir):
    return marts.quarantine_view(_quarantine(spark, sf_dir))


@query
def quarantine_reason_counts(spark, sf_dir):
    return rollups.quarantine_counts(_quarantine(spark, sf_dir))


@query
def quarantine_reason_exploded(spark, sf_dir):
    return rollups.quarantine_reason_counts(_quarantine(spark, sf_dir))


@query
def recent_quarantine(spark, sf_dir):
    return rollups.recent_quarantine(marts.quarantine_view(_quarantine(spark, sf_dir)))


# --- detection --------------------------------------------------------------------------------------

THREAT_COLUMNS = ("event_id", "threat_reason", "is_anomaly", "severity", "severity_rank")


@query
def threat_flags(spark, sf_dir):
    return _enriched(spark, sf_dir).select(*THREAT_COLUMNS, "mitre_tactic")


@query
def threat_flags_notebook(spark, sf_dir):
    return flag_threats(quality.lenient_clean(_events(spark, sf_dir)), NOTEBOOK_RULES).select(*THREAT_COLUMNS)


@query
def threat_events(spark, sf_dir):
    return _threats(spark, sf_dir)


@query
def rule_fire_counts(spark, sf_dir):
    return rollups.rule_fire_counts(_threats(spark, sf_dir))


@query
def rule_catalogue_counts(spark, sf_dir):
    counts = rollups.indicators_by_reason(_threats(spark, sf_dir))
    return enrich_from_catalogue(counts, catalogue_frame(spark))


@query
def indicators_by_reason(spark, sf_dir):
    return rollups.indicators_by_reason(_threats(spark, sf_dir))


@query
def indicators_by_severity_target(spark, sf_dir):
    return rollups.indicators_by_severity_target(_threats(spark, sf_dir))


# --- de-duplication and lateness --------------------------------------------------------------------


@query
def dedup_by_key(spark, sf_dir):
    return dedup.dedup_by_key(_replayed(spark, sf_dir)).select("event_id", "event_timestamp", "quality_status")


@query
def dedup_by_id(spark, sf_dir):
    return dedup.dedup_by_id(_replayed(spark, sf_dir)).select("event_id", "event_timestamp", "quality_status")


@query
def late_events(spark, sf_dir):
    delayed = feed.delayed_activity(feed.read_activity(spark, sf_dir))
    return mark_late(delayed, "event_id", "ts").select("event_id", "ts", "watermark", "is_late")


@query
def keyed_publish(spark, sf_dir):
    return keyed_messages(_events(spark, sf_dir))


@query
def ordered_publish(spark, sf_dir):
    """Where and as which each event goes into a log of 12 partitions."""
    return ordered_messages(_events(spark, sf_dir), 12).select("key", "partition", "sequence", F.get_json_object("value", "$.event_id").alias("event_id"))


# --- metrics and marts ------------------------------------------------------------------------------


@query
def metrics_1m_exact(spark, sf_dir):
    return _metrics(spark, sf_dir)


@query
def metrics_1m_approx(spark, sf_dir):
    """The counts that the sketches give."""
    return security_metrics(_fact(spark, sf_dir))


def _hour() -> Column:
    return F.date_trunc("hour", "window_start").alias("hour")


@query
def hourly_actors_sketched(spark, sf_dir):
    """Actors and addresses per hour and event type from the sketches of the minutes, and how far they are from the exact numbers."""
    fact = _fact(spark, sf_dir)
    united = sketched_actors(security_metrics(fact, keep_sketches=True), _hour(), "event_type")
    exact = fact.groupBy(F.date_trunc("hour", "event_timestamp").alias("hour"), "event_type").agg(F.count_distinct("actor_id").alias("exact"))
    error = F.abs(F.col("unique_actors") - F.col("exact")) / F.col("exact")
    return united.join(exact, ["hour", "event_type"]).select("hour", "event_type", "unique_actors", "unique_source_ips", error.alias("actors_error"))


@query
def distinct_rollup(spark, sf_dir):
    """Exact distinct actors per hour, and of the whole matrix, added up from bitmaps of the minutes. A null hour is the whole time."""
    base, fact = scratch_dir(spark, "distinct"), _fact(spark, sf_dir)
    extended_dictionary(fact.select("actor_id")).write.parquet(f"{base}/actors")
    minute = F.window("event_timestamp", "1 minute")["start"].alias("window_start")
    sets = distinct_sets(fact, [minute, "event_type", "target_system"], "actor_id", spark.read.parquet(f"{base}/actors"))
    hours = merged_sets(sets, _hour(), "event_type", "target_system")
    hours.write.parquet(f"{base}/hours")
    hours = spark.read.parquet(f"{base}/hours")
    keys = ("event_type", "target_system")
    cells = set_sizes(merged_sets(hours, *keys), *keys, name="unique_actors").withColumn("hour", F.lit(None).cast("timestamp"))
    return set_sizes(hours, "hour", *keys, name="unique_actors").unionByName(cells)


def _metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric versions as two micro-batches per minute append them.

    Batch 0 has seen the first half of each minute; batch 1 has seen all of it and repeats only the keys
    that changed, as update mode does.
    """
    fact = _fact(spark, sf_dir)
    second_half = F.second("event_timestamp") >= 30
    first = security_metrics(fact.filter(~second_half), exact=True)
    changed = F.max(second_half).alias("changed")
    second = security_metrics(fact, exact=True, extra=(changed,)).filter("changed").drop("changed")
    return first.withColumn("batch_id", F.lit(0)).unionByName(second.withColumn("batch_id", F.lit(1)))


@query
def metrics_current(spark, sf_dir):
    return current_metrics(_metric_log(spark, sf_dir))


@query
def security_trends(spark, sf_dir):
    return marts.security_trends(_metrics(spark, sf_dir))


@query
def trend_slice(spark, sf_dir):
    chosen = {"event_types": ["authentication", "api_call"], "source_countries": ["RU", "KP"]}
    return rollups.trend_slice(_metrics(spark, sf_dir), **chosen)


@query
def events_by_window(spark, sf_dir):
    return rollups.events_by_window(_metrics(spark, sf_dir))


@query
def egress_by_window(spark, sf_dir):
    return rollups.egress_by_window(_metrics(spark, sf_dir))


@query
def events_by_country(spark, sf_dir):
    return rollups.events_by_country(_fact(spark, sf_dir))


@query
def event_target_matrix(spark, sf_dir):
    return rollups.event_target_matrix(_fact(spark, sf_dir))


@query
def event_target_rollup(spark, sf_dir):
    return rollups.event_target_rollup(_fact(spark, sf_dir))


@query
def top_failed_auth_actors(spark, sf_dir):
    return rollups.top_failed_auth_actors(_fact(spark, sf_dir))


@query
def failed_auth_hitters(spark, sf_dir):
    """Actors with at least a thousandth of all failed authentications, from states kept per minute and combined over the whole time."""
    fact = _fact(spark, sf_dir)
    failed = fact.filter((F.col("event_type") == "authentication") & (F.col("outcome") == "failure"))
    minutes = hitter_states(failed, [F.window("event_timestamp", "1 minute")["start"].alias("window_start")], "actor_id")
    found = top_values(combined_states(combined_states(minutes, _hour())), TRACKED, "n_rows")
    return found.filter(F.col("count") >= F.col("n_rows") / 1000).select(F.col("value").alias("actor_id"), F.col("count").alias("failed_count"))


@query
def realtime_kpis(spark, sf_dir):
    return marts.realtime_kpis(current_metrics(_metric_log(spark, sf_dir)), AS_OF)


@query
def quality_scorecard(spark, sf_dir):
    return marts.quality_scorecard(_fact(spark, sf_dir), _quarantine(spark, sf_dir), AS_OF)


@query
def hourly_counts(spark, sf_dir):
    return marts.hourly_counts(_fact(spark, sf_dir), AS_OF)


@query
def security_summary(spark, sf_dir):
    return marts.security_summary(_fact(spark, sf_dir), _metrics(spark, sf_dir), AS_OF)


@query
def top_threat(spark, sf_dir):
    return marts.top_threat(_fact(spark, sf_dir), AS_OF)


@query
def top_target(spark, sf_dir):
    return marts.top_target(_metrics(spark, sf_dir), AS_OF)


@query
def curated_row_counts(spark, sf_dir):
    return rollups.curated_row_counts(
        fact_security_events=_fact(spark, sf_dir),
        error_security_events=_quarantine(spark, sf_dir),
        agg_security_metrics_1m=_metrics(spark, sf_dir),
        ai_threat_insights=_insights(spark, sf_dir),
    )


# --- triage -----------------------------------------------------------------------------------------


def _triaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier = _threats(spark, sf_dir).filter(F.col("event_timestamp") < F.lit(TRIAGED_UNTIL).cast("timestamp"))
    return triage.build_insights(earlier, TRIAGED_UNTIL)


@query
def risk_scores(spark, sf_dir):
    return triage.score_threats(_threats(spark, sf_dir)).select("event_id", "threat_reason", "risk_score", "risk_level")


@query
def triage_insights(spark, sf_dir):
    return _insights(spark, sf_dir)


@query
def insights_view(spark, sf_dir):
    return marts.insights_view(_insights(spark, sf_dir))


@query
def untriaged_threats(spark, sf_dir):
    return triage.untriaged_threats(_threats(spark, sf_dir), _triaged(spark, sf_dir))


@query
def untriaged_threats_all(spark, sf_dir):
    return triage.untriaged_threats(_threats(spark, sf_dir), _triaged(spark, sf_dir), limit=None)


@query
def insight_upsert(spark, sf_dir):
    replayed = quality.valid_events(flag_threats(_replayed(spark, sf_dir)))
    candidates = triage.build_insights(marts.threat_events(replayed), AS_OF)
    added = triage.new_insights(candidates, _triaged(spark, sf_dir))
    return added.select("insight_id", "event_id", "event_timestamp", "threat_reason", "risk_score")


def _filled_store(spark: SparkSession, sf_dir: str) -> CuratedStore:
    """A store that got the whole feed in two commits."""
    store = CuratedStore(spark, f"{scratch_dir(spark, 'store')}/curated")
    enriched = _enriched(spark, sf_dir)
    early = F.coalesce(F.col("event_timestamp") < F.lit(TRIAGED_UNTIL).cast("timestamp"), F.lit(True))
    for number, rows in enumerate((enriched.filter(early), enriched.filter(~early))):
        store.commit({FACT: quality.valid_events(rows), QUARANTINE: quality.quarantined_events(rows)}, number)
    return store


@query
def triage_job(spark, sf_dir):
    """The insights after the job ran on a store, ran again, and a job that had read the store before both of them tried to commit."""
    store = _filled_store(spark, sf_dir)
    stale = store.log.version()
    triage_store(store, limit=None, as_of=AS_OF)
    triage_store(store, limit=None, as_of=AS_OF)
    with suppress(CommitConflict):
        store.append(INSIGHTS, _insights(spark, sf_dir), after=stale)
    return store.read(INSIGHTS).drop("batch_key")


@query
def curated_tables(spark, sf_dir):
    """Rows and days of the declared tables by SQL, in a database of their own."""
    store, database = _filled_store(spark, sf_dir), f"curated_{uuid.uuid4().hex}"
    create_curated_tables(spark, database, store.location)
    recover_partitions(store, database)
    counts = [f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(DISTINCT event_date) AS n_days FROM {database}.{t}" for t in (FACT, QUARANTINE)]
    return spark.sql(" UNION ALL ".join(counts))


@query
def newest_insights(spark, sf_dir):
    both = _triaged(spark, sf_dir).unionByName(_insights(spark, sf_dir))
    return rollups.newest_insights(both)


@query
def average_risk(spark, sf_dir):
    return rollups.average_risk(_insights(spark, sf_dir))


@query
def risk_level_queue_sets(spark, sf_dir):
    return rollups.risk_level_queue_sets(_insights(spark, sf_dir))


# --- evidence ---------------------------------------------------------------------------------------

PROFILE_COLUMNS = ("event_count", "total_revenue", "top_channel", "anomaly_count")


def _shown_profile(profiled: DataFrame) -> DataFrame:
    """Profile row with its maps and the detected columns as text."""

    def pairs(name: str):
        entries = F.transform(F.map_entries(name), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
        return F.array_join(F.array_sort(entries), ";").alias(name)

    detected = F.concat_ws(
        ";",
        *(
            F.coalesce(F.col(f"detected_columns.{role}"), F.lit("-"))
            for role in evidence.ROLE_CANDIDATES
        ),
    )
    return profiled.select(
        *PROFILE_COLUMNS, pairs("channel_breakdown"), pairs("category_breakdown"), detected.alias("detected_columns")
    )


@query
def evidence_profile(spark, sf_dir):
    return _shown_profile(evidence.profile(_orders_evidence(spark, sf_dir)))


@query
def evidence_profile_activity(spark, sf_dir):
    return _shown_profile(evidence.profile(_activity_evidence(spark, sf_dir)))


@query
def evidence_profile_no_amount(spark, sf_dir):
    return _shown_profile(evidence.profile(_table(spark, sf_dir, "lineitem")))


@query
def evidence_breakdown(spark, sf_dir):
    return evidence.value_breakdown(_activity_evidence(spark, sf_dir))


@query
def evidence_split(spark, sf_dir):
    return evidence.anomaly_split(evidence.profile(_activity_evidence(spark, sf_dir)))


@query
def evidence_risk(spark, sf_dir):
    rated = evidence.rate_risk(evidence.profile(_activity_evidence(spark, sf_dir)))
    return rated.select("anomaly_rate_percent", "risk_level", "review_note")


@query
def evidence_actions(spark, sf_dir):
    rated = evidence.rate_risk(evidence.profile(_activity_evidence(spark, sf_dir)))
    return evidence.recommend_actions(rated).select(F.posexplode("actions").alias("step", "action"))


@query
def evidence_summary(spark, sf_dir):
    return evidence.review(_orders_evidence(spark, sf_dir), OBJECTIVE).select("final_summary")


@query
def evidence_csv(spark, sf_dir):
    path = f"{scratch_dir(spark, 'evidence')}/orders.csv"
    note = F.concat(F.lit('say "hi", ok\nC:\\dir\\ '), "o_orderkey", F.lit("\\"))
    quoted = _orders_evidence(spark, sf_dir).select(note.alias("remark"), "*")
    quoted.write.option("header", True).option("escape", '"').csv(path)
    return _shown_profile(evidence.profile(load_evidence(spark, path)))


@query
def evidence_jsonl(spark, sf_dir):
    path = f"{scratch_dir(spark, 'evidence')}/activity.jsonl"
    _activity_evidence(spark, sf_dir).write.json(path)
    return _shown_profile(evidence.profile(load_evidence(spark, path)))


def _as_documents(rows: DataFrame, opening: str, closing: str) -> DataFrame:
    """The lines of one JSON document a partition: what opens it, the records with commas between, what closes it."""

    def run(batches):
        first = True
        yield pa.RecordBatch.from_pydict({"value": [opening]})
        for batch in batches:
            texts = batch.column(0).to_pylist()
            if texts:
                yield pa.RecordBatch.from_pydict({"value": [f"{'' if first and not i else ', '}{text}" for i, text in enumerate(texts)]})
                first = False
        yield pa.RecordBatch.from_pydict({"value": [closing]})

    return rows.select(F.to_json(F.struct("*"))).mapInArrow(run, "value string")


@query
def evidence_json(spark, sf_dir):
    """JSON documents of both shapes: an array, and an object with the records and something else beside them."""
    base = scratch_dir(spark, "evidence")
    remark = F.concat(F.lit('}{"events": [ \\'), "event_id", F.lit('"')).alias("remark")
    rows = _activity_evidence(spark, sf_dir).select(remark, F.create_map(F.lit("{"), F.col("event_id")).alias("extra"), "*")
    even = F.pmod(F.col("event_id"), F.lit(2)) == 0
    _as_documents(rows.filter(even), "[", "]").write.text(f"{base}/both.json/arrays")
    _as_documents(rows.filter(~even | F.col("event_id").isNull()), '{"from": {"a": [{"b": 1}]}, "events":\n[', '], "also": [{"c": 2}]}').write.text(f"{base}/both.json/objects")
    shapes = [load_evidence(spark, f"{base}/both.json/{name}", fmt="json") for name in ("arrays", "objects")]
    return _shown_profile(evidence.profile(shapes[0].unionByName(shapes[1], allowMissingColumns=True)))


@query
def evidence_first_n(spark, sf_dir):
    """The first records of several files, in file order."""
    path = f"{scratch_dir(spark, 'evidence')}/first.jsonl"
    ordered = feed.read_activity(spark, sf_dir).select("event_id", "user_id", "event_type")
    ordered.repartitionByRange(4, "event_id").sortWithinPartitions("event_id").write.json(path)
    return load_evidence(spark, path, limit=500).select("event_id", "user_id", "event_type")


@query
def text_evidence(spark, sf_dir):
    return evidence.text_records(_table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def text_evidence_pages(spark, sf_dir):
    return evidence.text_records(_table(spark, sf_dir, "pages"), "page_id", "html")


@query
def text_evidence_profile(spark, sf_dir):
    line = F.concat(
        F.lit("  "), F.initcap("event_type"), F.lit(" by user: £ "), F.format_number("value", 2), F.lit("\n")
    )
    lines = feed.read_activity(spark, sf_dir).select("event_id", line.alias("line"))
    return _shown_profile(evidence.profile(evidence.text_records(lines, "event_id", "line")))


# --- streaming --------------------------------------------------------------------------------------


# The feed arrives in slices of event time; every 23rd event comes one slice late.
SLICES = ("2024-01-08", "2024-01-16", "2024-01-24")
# Rows of a file of the feed: the tasks that read a slice are dealt whole files, so small ones give them equal shares.
FEED_FILE_ROWS = 100_000


def _arrival_slice():
    own = sum((F.col("ts") >= F.lit(start).cast("timestamp")).cast("int") for start in SLICES)
    return F.least(F.lit(len(SLICES)), own + (F.col("event_id") % 23 == 0).cast("int"))


def _run_to_end(start, spark: SparkSession, sf_dir: str, look_back: bool = True, progress: ProgressLog | None = None) -> CuratedStore:
    """Run a stream over the replayed activity feed, whole, as it grows by a slice at a time; one checkpoint for all."""
    base = scratch_dir(spark, "stream")
    config = PipelineConfig(f"{base}/checkpoints", trigger={"availableNow": True}, look_back=look_back)
    store = CuratedStore(spark, f"{base}/curated")
    arriving = feed.replayed_activity(feed.read_activity(spark, sf_dir)).withColumn("_slice", _arrival_slice())
    for number in range(len(SLICES) + 1):
        arriving.filter(F.col("_slice") == number).drop("_slice").write.option("maxRecordsPerFile", FEED_FILE_ROWS).mode("append").parquet(f"{base}/feed")
        stream = spark.readStream.schema(arriving.drop("_slice").schema).parquet(f"{base}/feed")
        running = start(enrich(feed.security_events(stream), config), store, config)
        running.awaitTermination()
        if progress and not progress.wait_for(running.runId):
            raise RuntimeError("the end of the query was not reported")
    return store


@query
def stream_progress(spark, sf_dir):
    """Micro-batches with data, and rows that the watermark dropped, by the reported progress of the metrics query."""
    log = ProgressLog(spark, f"{scratch_dir(spark, 'progress')}/rows").attach()
    try:
        _run_to_end(start_metrics, spark, sf_dir, progress=log)
    finally:
        log.detach()
    return log.frame().groupBy("name").agg(
        F.count_if(F.col("input_rows") > 0).alias("batches"), F.sum("dropped_late_rows").alias("dropped_late_rows")
    )


def _stored_events(store: CuratedStore) -> DataFrame:
    columns = ("event_id", "event_timestamp", "quality_status", "quality_failure_reason", "threat_reason")
    fact = store.read(FACT).select(F.lit(FACT).alias("table_name"), *columns)
    return fact.unionAll(store.read(QUARANTINE).select(F.lit(QUARANTINE).alias("table_name"), *columns))


@query
def stream_fact_quarantine(spark, sf_dir):
    return _stored_events(_run_to_end(start_events, spark, sf_dir))


@query
def stream_dedup(spark, sf_dir):
    return _stored_events(_run_to_end(start_events, spark, sf_dir, look_back=False))


@query
def stream_metrics(spark, sf_dir):
    store = _run_to_end(start_metrics, spark, sf_dir)
    return current_metrics(store.read(METRICS)).drop(*SKETCHES, "event_date", "batch_key", "batch_id", "written_at")
