"""The marts as temporary views over a curated store, and the triage job on it."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame

from tidewatch.operators import marts
from tidewatch.operators.marts import AsOf
from tidewatch.operators.metrics import current_metrics
from tidewatch.operators.triage import TriageReport, run_triage
from tidewatch.sources.commits import CommitConflict
from tidewatch.sources.curated import BATCH_KEY, FACT, INSIGHTS, METRICS, QUARANTINE, CuratedStore


def mart_frames(store: CuratedStore, as_of: AsOf = None) -> dict[str, DataFrame]:
    """View name to DataFrame, of what is committed now. Metric marts read the current version of each metric row.

    Last-hour marts read the parts alone whose times, by their manifests, reach into that hour.
    """
    start = (as_of or datetime.now(timezone.utc).replace(tzinfo=None)) - timedelta(hours=1)
    hour = (start, as_of)
    fact, recent = store.read(FACT), store.read(FACT, events=hour)
    metrics, minutes = current_metrics(store.read(METRICS)), current_metrics(store.read(METRICS, events=(start - timedelta(minutes=1), as_of)))
    scored = (store.read(table, stored=hour) for table in (FACT, QUARANTINE))
    return {
        "vw_realtime_kpis": marts.realtime_kpis(minutes, as_of),
        "vw_security_trends": marts.security_trends(metrics),
        "vw_threat_events": marts.threat_events(fact),
        "vw_quarantined_events": marts.quarantine_view(store.read(QUARANTINE)),
        "vw_data_quality_scorecard": marts.quality_scorecard(*scored, as_of),
        "vw_ai_threat_insights": marts.insights_view(store.read(INSIGHTS)),
        "vw_ai_security_summary": marts.security_summary(recent, minutes, as_of),
    }


def register_marts(store: CuratedStore, as_of: AsOf = None) -> list[str]:
    """Create or replace the seven temporary views; returns their names."""
    frames = mart_frames(store, as_of)
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)


class LiveMarts:
    """The marts as of each call: ``marts("vw_threat_events")`` reads what is committed then."""

    def __init__(self, store: CuratedStore, as_of: AsOf = None):
        self.store, self.as_of = store, as_of

    def __call__(self, name: str) -> DataFrame:
        return mart_frames(self.store, self.as_of)[name]

    def sql(self, text: str) -> DataFrame:
        """A query over the views, registered anew for it."""
        register_marts(self.store, self.as_of)
        return self.store.spark.sql(text)


def triage_store(store: CuratedStore, limit: int | None = 100, as_of: AsOf = None) -> TriageReport:
    """Triage the newest waiting threats of the fact table into the insights table.

    Each insight is inserted once, however many such jobs run at a time and however often one fails: the insights become visible by a commit that
    fails if another one added insights since they were read, and then all is done again.
    """
    while True:
        version = store.log.version()
        threats, insights = marts.threat_events(store.read(FACT, version=version)), store.read(INSIGHTS, version=version)
        try:
            return run_triage(threats, insights.drop(BATCH_KEY), lambda rows: store.append(INSIGHTS, rows, after=version), limit, as_of)
        except CommitConflict:
            continue
