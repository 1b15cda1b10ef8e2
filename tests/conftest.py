from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.detect import flag_threats
from tidewatch.operators.quality import clean_events
from tidewatch.rules import STANDARD_GATE, STANDARD_RULES
from tidewatch.schemas import EVENT_SCHEMA
from tidewatch.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        4,
        **{
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(scratch / "checkpoints"),
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


#: By type: a text is its column's name, a flag is false, a number is 1; beyond that what makes the event valid.
BY_TYPE = {"string": lambda name: name, "boolean": lambda name: False, "integer": lambda name: 1, "long": lambda name: 1}
BASE_EVENT = {f.name: BY_TYPE[f.dataType.typeName()](f.name) for f in EVENT_SCHEMA.fields} | {
    "event_id": "row-1",
    "event_time": "2031-03-06T09:15:00+00:00",
    "event_type": "api_call",
    "outcome": "success",
    "http_status": 204,
}


@pytest.fixture(scope="session")
def events(spark):
    """Build an event DataFrame from overrides of one ordinary event, one dict per row."""

    def build(*overrides: dict):
        rows = [tuple({**BASE_EVENT, **override}[name] for name in EVENT_SCHEMA.names) for override in overrides]
        schema = EVENT_SCHEMA.jsonValue()
        for field in schema["fields"]:
            field["nullable"] = True
        return spark.createDataFrame(rows, EVENT_SCHEMA.fromJson(schema))

    return build


@pytest.fixture(scope="session")
def processed(events):
    """Clean and flag events built from overrides; the event time is the ingestion time."""

    def build(*overrides: dict, gate=STANDARD_GATE, rules=STANDARD_RULES):
        cleaned = clean_events(events(*overrides), gate, ingested_at=F.col("event_timestamp"))
        return flag_threats(cleaned, rules)

    return build
