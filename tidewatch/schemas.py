"""Schemas of the event, the curated tables and the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, FLAG, INT, LONG, DOUBLE, TIME = (
    StringType(),
    BooleanType(),
    IntegerType(),
    LongType(),
    DoubleType(),
    TimestampType(),
)


def _struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in columns.items()])


EVENT_SCHEMA = StructType(
    [StructField("event_id", TEXT, nullable=False), StructField("event_time", TEXT, nullable=False)]
    + _struct(
        event_type=TEXT,
        action=TEXT,
        actor_id=TEXT,
        actor_email=TEXT,
        actor_role=TEXT,
        actor_department=TEXT,
        is_privileged_actor=FLAG,
        session_id=TEXT,
        source_ip=TEXT,
        source_country=TEXT,
        device_type=TEXT,
        user_agent=TEXT,
        target_system=TEXT,
        target_resource=TEXT,
        auth_method=TEXT,
        mfa_used=FLAG,
        outcome=TEXT,
        http_status=INT,
        bytes_out=LONG,
        failed_attempts_1h=INT,
        request_rate_1m=INT,
        detection_source=TEXT,
        is_test_event=FLAG,
        source_system=TEXT,
    ).fields
)

_STAMPS = _struct(event_timestamp=TIME, ingestion_timestamp=TIME)
_QUALITY = _struct(
    event_hour=INT,
    is_valid_event_type=FLAG,
    is_valid_outcome=FLAG,
    is_valid_actor=FLAG,
    is_valid_target=FLAG,
    is_valid_bytes=FLAG,
    is_valid_status=FLAG,
    quality_status=TEXT,
    quality_failure_reason=TEXT,
)
_THREAT = _struct(threat_reason=TEXT, is_anomaly=FLAG, severity=TEXT, severity_rank=INT, mitre_tactic=TEXT)
SOURCE_METADATA = _struct(topic=TEXT, kafka_partition=INT, kafka_offset=LONG, kafka_timestamp=TIME)
_BATCH = _struct(batch_id=LONG)

# Identity and clock columns first, then the rest of the event, then what the pipeline derived.
FACT_SCHEMA = StructType(
    EVENT_SCHEMA.fields[:2]
    + _STAMPS.fields
    + EVENT_SCHEMA.fields[2:]
    + _QUALITY.fields
    + _THREAT.fields
    + SOURCE_METADATA.fields
    + _BATCH.fields
)

AGGREGATE_SCHEMA = _struct(
    window_start=TIME,
    window_end=TIME,
    event_type=TEXT,
    target_system=TEXT,
    source_country=TEXT,
    event_count=LONG,
    failure_count=LONG,
    blocked_count=LONG,
    failure_rate=DOUBLE,
    unique_actors=LONG,
    unique_source_ips=LONG,
    total_bytes_out=LONG,
    anomaly_count=LONG,
    max_severity_rank=INT,
    batch_id=LONG,
)
# Sketches kept with the stored minutes: name to (event column, count column).
SKETCHES = {"actors_sketch": ("actor_id", "unique_actors"), "source_ips_sketch": ("source_ip", "unique_source_ips")}
METRIC_KEYS = ("window_start", "window_end", "event_type", "target_system", "source_country")

THREAT_SCHEMA = _struct(
    event_timestamp=TIME,
    event_id=TEXT,
    event_type=TEXT,
    actor_id=TEXT,
    actor_role=TEXT,
    target_system=TEXT,
    source_ip=TEXT,
    source_country=TEXT,
    outcome=TEXT,
    bytes_out=LONG,
    failed_attempts_1h=INT,
    request_rate_1m=INT,
    threat_reason=TEXT,
    severity=TEXT,
    mitre_tactic=TEXT,
)

_SCORE = _struct(
    risk_score=INT,
    risk_level=TEXT,
    threat_explanation=TEXT,
    recommended_action=TEXT,
    triage_queue=TEXT,
    model_provider=TEXT,
)
INSIGHT_SCHEMA = StructType(
    _struct(insight_id=TEXT, generated_at=TIME).fields + THREAT_SCHEMA.fields + _SCORE.fields
)

# The insights mart hides the join key and the raw counters.
INSIGHT_VIEW_COLUMNS = tuple(
    name
    for name in INSIGHT_SCHEMA.names
    if name not in ("insight_id", "bytes_out", "failed_attempts_1h", "request_rate_1m")
)

QUARANTINE_VIEW_COLUMNS = (
    "event_timestamp",
    "ingestion_timestamp",
    "event_id",
    "event_type",
    "actor_id",
    "target_system",
    "outcome",
    "http_status",
    "bytes_out",
    "quality_failure_reason",
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` to the columns of ``schema`` in order, with typed nulls for absent ones."""
    present = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )
