"""Commits of a curated store: what is visible when, and to whom."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.test_triage import threats  # noqa: F401 - a fixture
from tidewatch.operators import triage
from tidewatch.plans.mart_views import LiveMarts, mart_frames, triage_store
from tidewatch.sources.commits import CommitConflict, CommitLog, Part
from tidewatch.sources.curated import FACT, INSIGHTS, QUARANTINE, CuratedStore, create_curated_tables, recover_partitions

AS_OF = datetime(2031, 3, 6, 9, 45)


@pytest.fixture
def store(spark, tmp_path):
    return CuratedStore(spark, str(tmp_path / "curated"))


def _halves(processed, *rows):
    events = processed(*rows)
    return {FACT: events.filter("quality_status = 'valid'"), QUARANTINE: events.filter("quality_status = 'invalid'")}


def _ids(store, table):
    return sorted(r.event_id for r in store.read(table).collect())


GOOD, BAD = {"event_id": "good", "source_country": "RU"}, {"event_id": "bad", "actor_id": ""}


def test_a_crash_between_the_tables_shows_neither(store, processed):
    tables = _halves(processed, GOOD, BAD)
    broken = tables | {QUARANTINE: tables[QUARANTINE].withColumn("actor_id", F.raise_error(F.lit("disk is full")))}
    with pytest.raises(Exception, match="disk is full"):
        store.commit(broken, 0, "q-0")
    assert store.read(FACT).count() == store.read(QUARANTINE).count() == 0
    assert store.commit(tables, 0, "q-0") == 0
    assert (_ids(store, FACT), _ids(store, QUARANTINE)) == (["good"], ["bad"])
    # The batch again, with other rows: both tables are replaced, at once.
    store.commit(_halves(processed, {**GOOD, "event_id": "other"}), 0, "q-0")
    assert (_ids(store, FACT), _ids(store, QUARANTINE)) == (["other"], [])
    assert [r.event_id for r in store.read(FACT, version=0).collect()] == ["good"]


def test_rows_without_date_and_empty_commits(store, processed):
    store.commit(_halves(processed, {"event_id": "untimed", "event_time": "x"}), 0)
    store.commit(_halves(processed), 1)
    assert _ids(store, QUARANTINE) == ["untimed"] and store.read(FACT).count() == 0
    assert store.read(QUARANTINE, events=(datetime(1999, 1, 1), None)).count() == 0


def test_reading_asks_for_parts_by_their_bounds(store, processed):
    for hour in range(3, 9):
        store.commit(_halves(processed, {"event_id": str(hour), "event_time": f"2031-03-06T0{hour}:30:00+00:00"}), hour)
    assert len(store.read(FACT).inputFiles()) == 6
    recent = store.read(FACT, stored=(datetime(2031, 3, 6, 7), datetime(2031, 3, 6, 9)))
    assert len(recent.inputFiles()) == 2 and sorted(r.event_id for r in recent.collect()) == ["7", "8"]
    frames = mart_frames(store, datetime(2031, 3, 6, 8, 45))
    assert len(frames["vw_data_quality_scorecard"].inputFiles()) == 1
    assert frames["vw_data_quality_scorecard"].first().valid_events == 1


def test_many_commits_cost_one_listing(store, processed, tmp_path):
    store.commit(_halves(processed, GOOD), 0)
    for number in range(1, 1500):
        (tmp_path / "curated" / "commits" / f"{number:020}.json").write_text('{"key": "k%d", "clears": [], "parts": []}' % number)
    assert store.log.version() == 1499 and _ids(store, FACT) == ["good"]
    assert store.commit(_halves(processed, BAD), 1) == 1500 and _ids(store, QUARANTINE) == ["bad"]


def test_every_writer_gets_a_number_of_its_own(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "commits"))
    part = [Part(FACT, "f", "k", None, 1, None, None, None, None)]
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda i: log.commit(f"k{i}", part), range(12)))
    assert sorted(numbers) == list(range(12)) and log.parts().count() == 12


def test_a_commit_fails_if_its_table_was_written_since(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "commits"))

    def part(table):
        return [Part(table, "f", "k", None, 1, None, None, None, None)]

    seen = log.commit("a", part(INSIGHTS))
    log.commit("b", part(FACT))
    assert log.commit("c", part(INSIGHTS), after=seen) == 2  # facts in between do no harm
    with pytest.raises(CommitConflict):
        log.commit("d", part(INSIGHTS), after=seen)
    assert log.version() == 2 and not list((tmp_path / "commits").glob("_*"))


def test_compaction_and_declared_tables(spark, store, processed):
    create_curated_tables(spark, "c_curated", store.location)
    spark.table(f"c_curated.{FACT}").createOrReplaceTempView("c_facts")
    for number in range(3):
        store.commit(_halves(processed, {"event_id": str(number)}, BAD), number)
    recover_partitions(store, "c_curated")
    # A view from before the first commit shows them.
    assert sorted(r.event_id for r in spark.table("c_facts").collect()) == ["0", "1", "2"]
    store.compact(FACT, "all")
    assert _ids(store, FACT) == ["0", "1", "2"] and len(store.read(FACT).inputFiles()) == 1
    assert _ids(store, QUARANTINE) == ["bad"] * 3 and {r.batch_id for r in store.read(FACT).collect()} == {0, 1, 2}
    store.commit(_halves(processed, {"event_id": "3"}), 3)
    recover_partitions(store, "c_curated")
    assert sorted(r.event_id for r in spark.table("c_facts").collect()) == ["0", "1", "2", "3"]
    assert spark.sql(f"SHOW PARTITIONS c_curated.{FACT}").count() == 2


@dataclass(frozen=True)
class Interrupted(CuratedStore):
    """Before its first commit another job runs."""

    other: list = None

    def append(self, table, rows, *args, **kwargs):
        if self.other:
            self.other.pop()()
        return super().append(table, rows, *args, **kwargs)


def test_two_triage_jobs_at_a_time_insert_each_insight_once(spark, store, processed):
    store.commit(_halves(processed, GOOD, {**GOOD, "event_id": "second"}, BAD), 0)
    reports = []
    first = Interrupted(spark, store.location, [lambda: reports.append(triage_store(store, limit=1, as_of=AS_OF))])
    reports.append(triage_store(first, as_of=AS_OF))
    assert [(r.fetched, r.written) for r in reports] == [(1, 1), (1, 1)]
    assert _ids(store, INSIGHTS) == ["good", "second"]
    assert triage_store(store, as_of=AS_OF).written == 0


def test_a_failed_triage_leaves_nothing(spark, store, processed, threats):  # noqa: F811
    store.commit(_halves(processed, GOOD), 0)
    failing = triage.build_insights(threats({"event_id": "a"}), AS_OF).withColumn("risk_level", F.raise_error(F.lit("task failed")))
    with pytest.raises(Exception, match="task failed"):
        store.append(INSIGHTS, failing, after=store.log.version())
    assert store.read(INSIGHTS).count() == 0
    assert triage_store(store, as_of=AS_OF).written == 1


def test_marts_are_as_of_each_call(spark, store, processed):
    marts = LiveMarts(store, AS_OF)
    assert marts("vw_threat_events").count() == 0
    store.commit(_halves(processed, GOOD), 0)
    assert marts("vw_threat_events").count() == marts.sql("SELECT * FROM vw_threat_events").count() == 1
