from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import marts, rollups
from tidewatch.operators.metrics import security_metrics
from tidewatch.operators.quality import quarantined_events, valid_events

AS_OF = datetime(2031, 3, 6, 10)
RU = {"source_country": "RU"}
HOUR = [
    {"event_id": "1", "event_time": "2031-03-06T08:59:59+00:00"},
    {"event_id": "2", "event_time": "2031-03-06T09:00:00+00:00", **RU},
    {"event_id": "3", "event_time": "2031-03-06T09:30:00+00:00", "event_type": "privilege_change", "actor_id": "B"},
    {"event_id": "4", "event_time": "2031-03-06T09:40:00+00:00", "event_type": "authentication", "outcome": "failure", "target_system": "hr-portal"},
    {"event_id": "5", "event_time": "2031-03-06T10:00:01+00:00", **RU},
    {"event_id": "6", "event_time": "2031-03-06T09:10:00+00:00", "bytes_out": -1},
]


@pytest.fixture(scope="module")
def tables(processed):
    rows = processed(*HOUR).cache()
    fact = valid_events(rows)
    return fact, quarantined_events(rows), security_metrics(fact, exact=True)


def test_kpis_cover_the_hour_only(tables):
    row = marts.realtime_kpis(tables[2], AS_OF).first()
    # The 08:59 window ends at 09:00 and still counts.
    assert (row.events_last_hour, row.failed_events_last_hour, row.threat_indicators_last_hour) == (4, 1, 2)
    assert (row.failure_rate, row.peak_severity_rank) == (0.25, 4)
    assert row.latest_window == datetime(2031, 3, 6, 9, 41)


def test_scorecard(tables):
    row = marts.quality_scorecard(tables[0], tables[1], AS_OF).first()
    assert (row.valid_events, row.quarantined_events, row.total_events, row.quality_score_pct) == (3, 1, 4, 75.0)


def test_summary_breaks_ties_by_name(tables):
    row = marts.security_summary(tables[0], tables[2], AS_OF).first()
    assert (row.total_events, row.distinct_actors, row.failed_events) == (3, 2, 1)
    assert (row.threat_indicators, row.critical_indicators) == (2, 1)
    assert (row.top_threat_pattern, row.top_targeted_system) == ("unauthorized_privilege_escalation", "target_system")
    assert row.security_summary == (
        "In the last hour, the platform processed 3 security events across 2 identities, with 1 failed outcomes. "
        "Detection rules raised 2 threat indicators, of which 1 were critical. The most frequent pattern was "
        "unauthorized_privilege_escalation and the most targeted system was target_system."
    )


def test_live_reports_have_no_upper_bound(tables):
    # Event times lie before or after the real clock; only the lower bound may filter.
    ahead = tables[0].withColumn("event_timestamp", F.expr("current_timestamp() + INTERVAL 5 MINUTE"))
    assert marts.hourly_counts(ahead).first().total_events == tables[0].count()


def test_empty_hour(tables):
    long_ago = datetime(2020, 1, 1)
    kpis = marts.realtime_kpis(tables[2], long_ago).first()
    assert (kpis.latest_window, kpis.events_last_hour, kpis.failure_rate) == (None, None, None)
    card = marts.quality_scorecard(tables[0], tables[1], long_ago).first()
    assert (card.total_events, card.quality_score_pct) == (0, None)
    row = marts.security_summary(tables[0], tables[2], long_ago).first()
    assert (row.total_events, row.top_threat_pattern, row.top_targeted_system) == (0, None, None)
    assert row.security_summary.endswith("pattern was n/a and the most targeted system was n/a.")
    assert "processed 0 security events across 0 identities" in row.security_summary


def test_last_hour_prunes_event_dates(spark, tables, tmp_path):
    path = str(tmp_path / "fact")
    tables[0].withColumn("event_date", F.to_date("event_timestamp")).write.partitionBy("event_date").parquet(path)
    recent = marts.last_hour(spark.read.parquet(path), "event_timestamp", AS_OF)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "PushedFilters: [IsNotNull(event_timestamp)" in plan
    assert recent.count() == 3


def test_views_have_the_documented_columns(tables):
    assert len(marts.threat_events(tables[0]).columns) == 15
    assert len(marts.security_trends(tables[2]).columns) == 14
    assert len(marts.quarantine_view(tables[1]).columns) == 10


def test_reports(tables):
    fact, quarantine, metrics = tables
    assert rollups.top_failed_auth_actors(fact).collect() == [("actor_id", 1)]
    assert [r.total_bytes_out for r in rollups.egress_by_window(metrics).collect()] == [1] * 5
    assert rollups.trend_slice(metrics, event_types=["privilege_change"], source_countries=["SOURCE_COUNTRY"]).count() == 1
    assert rollups.trend_slice(metrics).count() == metrics.count()
    assert rollups.quarantine_reason_counts(quarantine).collect() == [("bytes_out_out_of_range", 1)]
    assert rollups.recent_quarantine(quarantine, 5).count() == 1
    counts = rollups.curated_row_counts(fact=fact, quarantine=quarantine, metrics=metrics)
    assert dict(counts.collect()) == {"fact": 5, "quarantine": 1, "metrics": 5}


def test_matrix_counts_actors_once(processed):
    fact = valid_events(processed({"event_id": "1"}, {"event_id": "2"}, {"event_id": "3", "target_system": "x", "outcome": "failure"}))
    cells = {(r.target_system): (r.event_count, r.failure_rate, r.unique_actors) for r in rollups.event_target_matrix(fact).collect()}
    assert cells == {"target_system": (2, 0.0, 1), "x": (1, 1.0, 1)}
    total = rollups.event_target_rollup(fact).filter("total_level = 3").first()
    assert (total.event_count, total.failure_rate, total.unique_actors) == (3, 0.3333, 1)
