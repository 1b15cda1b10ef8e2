"""Security events derived from the plain ``events`` activity table.

The activity table (event_id, ts, user_id, event_type, value, props) has none of the security columns, so
each is computed from what is there. The derivation covers every row and is deterministic; it spreads
defects and threat patterns over the table so that every quality reason and every rule occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.text import sql_literal
from tidewatch.schemas import EVENT_SCHEMA

# Values chosen so that trimming, case and the country rule all have something to do.
COUNTRIES = ("SE", "JP", "BR", "PL", "CA", "ZA", "ru", " KP ", "NZ", "se")
TARGETS = ("billing-core", " Staff-Desk ", "ledger", "crm-east", "object-store", "ops-panel")
EVENT_TYPE_OF = {
    "click": "api_call",
    "view": " Data_Access ",
    "signup": "privilege_change",
    "purchase": "config_change",
    "error": "authentication",
}
CONSTANTS = {
    "actor_department": "security",
    "device_type": "tablet",
    "user_agent": "agent",
    "auth_method": "password",
    "detection_source": "sensor",
    "source_system": "feed-a",
}
TOPIC = "security-events"


def read_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


# Where a defect is planted, the first branch; otherwise the regular value.
_OUTCOME = """
    CASE WHEN event_id % 109 = 0 THEN 'weird' WHEN event_type = 'error' THEN 'failure'
         WHEN event_id % 10 = 0 THEN 'blocked' WHEN event_id % 10 = 1 THEN 'failure' ELSE 'success' END"""
_DERIVED = {
    "event_id": "concat('EVT-', event_id)",
    "event_time": """CASE WHEN event_id % 97 = 0 THEN 'not-a-time'
        ELSE date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'") END""",
    "event_type": """CASE WHEN event_id % 103 = 0 THEN 'syslog_blob'
        WHEN event_id % 107 <> 0 THEN try_element_at({event_types}, event_type) END""",
    "action": "CASE WHEN event_type = 'purchase' AND {k} % 5 = 0 THEN 'logging_disabled' ELSE event_type END",
    "actor_id": "CASE WHEN event_id % 79 = 0 THEN '' ELSE concat('USR-', user_id) END",
    "actor_email": "concat(' User', user_id, '@Example.COM ')",
    "actor_role": "CASE WHEN user_id % 7 = 0 THEN 'domain_admin' ELSE 'analyst' END",
    "is_privileged_actor": "CASE WHEN user_id % 11 <> 0 THEN user_id % 7 = 0 END",
    "session_id": "concat('SES-', event_id div 10)",
    "source_ip": "concat('10.0.', user_id % 256, '.', {k})",
    "source_country": "array{countries}[CAST(user_id % {n_countries} AS INT)]",
    "target_system": "CASE WHEN event_id % 101 <> 0 THEN array{targets}[CAST(user_id % {n_targets} AS INT)] END",
    "target_resource": "concat('res', {k} % 6)",
    "mfa_used": "CASE WHEN event_id % 13 <> 0 THEN event_id % 3 <> 0 END",
    "outcome": _OUTCOME,
    "http_status": f"""CASE WHEN event_id % 89 = 0 THEN 999
        WHEN event_id % 17 <> 0 THEN CASE WHEN {_OUTCOME} = 'success' THEN 200 ELSE 403 END END""",
    "bytes_out": """CASE WHEN event_id % 83 = 0 THEN -1
        WHEN event_id % 113 <> 0 THEN floor(value * CASE WHEN event_type = 'view' THEN 5e6 ELSE 100D END) END""",
    "failed_attempts_1h": "CASE WHEN event_type = 'error' THEN {k} % 40 ELSE 0 END",
    "request_rate_1m": "CASE WHEN event_type = 'click' THEN {k} * 15 ELSE {k} % 40 END",
    "is_test_event": "false",
    **{name: f"'{value}'" for name, value in CONSTANTS.items()},
}


def security_events(activity: DataFrame, *keep: str) -> DataFrame:
    """The 26 event columns for every activity row, and the named activity columns."""
    parts = {
        "k": "CAST(get_json_object(props, '$.k') AS INT)",
        "event_types": "map" + sql_literal(tuple(item for pair in EVENT_TYPE_OF.items() for item in pair)),
        "countries": sql_literal(COUNTRIES),
        "n_countries": len(COUNTRIES),
        "targets": sql_literal(TARGETS),
        "n_targets": len(TARGETS),
    }
    return activity.selectExpr(
        *(f"CAST({_DERIVED[f.name].format(**parts)} AS {f.dataType.simpleString()}) AS {f.name}" for f in EVENT_SCHEMA.fields),
        *keep,
    )


def replayed_activity(activity: DataFrame) -> DataFrame:
    """The whole activity table as an at-least-once source would deliver it.

    Every row arrives; some arrive again unchanged, some again with a time 30 seconds later.
    """
    return activity.selectExpr(
        "* EXCEPT (ts)",
        """explode(filter(
            array(ts, CASE WHEN event_id % 20 = 0 THEN ts END, CASE WHEN event_id % 50 = 0 THEN ts + INTERVAL 30 SECOND END),
            delivered -> delivered IS NOT NULL)) AS ts""",
    )


def delayed_activity(activity: DataFrame) -> DataFrame:
    """The whole activity table with some rows stamped 1 to 20 minutes before they arrive."""
    minutes = "CASE WHEN event_id % 23 = 0 THEN event_id % 20 + 1 ELSE 0 END"
    return activity.withColumn("ts", F.expr(f"ts - make_dt_interval(0, 0, CAST({minutes} AS INT))"))


def event_messages(activity: DataFrame) -> DataFrame:
    """The activity table as the message log would hold it: JSON value, topic, partition, offset, timestamp.

    A few messages are cut short, as a broken producer would leave them.
    """
    tagged = activity.selectExpr("*", "event_id AS _n", "ts AS _ts", "user_id AS _user")
    whole = F.to_json(F.struct(*EVENT_SCHEMA.names), {"ignoreNullFields": "false"})
    cut_short = F.expr("""concat('{"event_id": "EVT-', _n, '", "event_time"')""")
    return security_events(tagged, "_n", "_ts", "_user").select(
        F.encode(F.when(F.col("_n") % 211 == 0, cut_short).otherwise(whole), "UTF-8").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.expr("CAST(_user % 8 AS INT) AS partition"),
        F.expr("_n AS offset"),
        F.expr("CAST(_ts AS TIMESTAMP) AS timestamp"),
    )
