"""DuckDB SQL twins of the registered queries, written independently of the operators."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-15 12:00:00'"
TRIAGED_UNTIL = "TIMESTAMP '2024-01-10 00:00:00'"

# The activity table, plainly, with repeated deliveries, and with delayed rows.
PLAIN = "SELECT * FROM events"
REPLAYED = """
SELECT * FROM events
UNION ALL SELECT * FROM events WHERE event_id % 20 = 0
UNION ALL SELECT * REPLACE (ts + INTERVAL 30 SECOND AS ts) FROM events WHERE event_id % 50 = 0
"""
DELAYED = """
SELECT * REPLACE (CASE WHEN event_id % 23 = 0 THEN ts - to_minutes(event_id % 20 + 1) ELSE ts END AS ts) FROM events
"""

RAW = """
src AS (
  SELECT event_id AS n, ts, user_id AS u, event_type AS kind, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM feed
),
outcomes AS (
  SELECT *,
    CASE WHEN n % 109 = 0 THEN 'weird' WHEN kind = 'error' THEN 'failure' WHEN n % 10 = 0 THEN 'blocked'
         WHEN n % 10 = 1 THEN 'failure' ELSE 'success' END AS outcome0
  FROM src
),
raw AS (
  SELECT n, ts, u,
    'EVT-' || n AS event_id,
    CASE WHEN n % 97 = 0 THEN 'not-a-time' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS event_time,
    CASE WHEN n % 103 = 0 THEN 'syslog_blob' WHEN n % 107 = 0 THEN NULL
         WHEN kind = 'click' THEN 'api_call' WHEN kind = 'view' THEN ' Data_Access '
         WHEN kind = 'signup' THEN 'privilege_change' WHEN kind = 'purchase' THEN 'config_change'
         WHEN kind = 'error' THEN 'authentication' END AS event_type,
    CASE WHEN kind = 'purchase' AND k % 5 = 0 THEN 'logging_disabled' ELSE kind END AS action,
    CASE WHEN n % 79 = 0 THEN '' ELSE 'USR-' || u END AS actor_id,
    ' User' || u || '@Example.COM ' AS actor_email,
    CASE WHEN u % 7 = 0 THEN 'domain_admin' ELSE 'analyst' END AS actor_role,
    'security' AS actor_department,
    CASE WHEN u % 11 = 0 THEN NULL ELSE u % 7 = 0 END AS is_privileged_actor,
    'SES-' || (n // 10) AS session_id,
    '10.0.' || (u % 256) || '.' || k AS source_ip,
    (['SE','JP','BR','PL','CA','ZA','ru',' KP ','NZ','se'])[u % 10 + 1] AS source_country,
    'tablet' AS device_type,
    'agent' AS user_agent,
    CASE WHEN n % 101 = 0 THEN NULL ELSE
      (['billing-core',' Staff-Desk ','ledger','crm-east','object-store','ops-panel'])[u % 6 + 1]
    END AS target_system,
    'res' || (k % 6) AS target_resource,
    'password' AS auth_method,
    CASE WHEN n % 13 = 0 THEN NULL ELSE n % 3 <> 0 END AS mfa_used,
    outcome0 AS outcome,
    CASE WHEN n % 89 = 0 THEN 999 WHEN n % 17 = 0 THEN NULL WHEN outcome0 = 'success' THEN 200 ELSE 403 END AS http_status,
    CASE WHEN n % 83 = 0 THEN -1 WHEN n % 113 = 0 THEN NULL
         WHEN kind = 'view' THEN CAST(floor(value * 5e6) AS BIGINT) ELSE CAST(floor(value * 100) AS BIGINT) END AS bytes_out,
    CASE WHEN kind = 'error' THEN k % 40 ELSE 0 END AS failed_attempts_1h,
    CASE WHEN kind = 'click' THEN k * 15 ELSE k % 40 END AS request_rate_1m,
    'sensor' AS detection_source,
    false AS is_test_event,
    'feed-a' AS source_system
  FROM outcomes
)"""

EVENT_COLUMNS = (
    "event_id, event_time, event_type, action, actor_id, actor_email, actor_role, actor_department, "
    "is_privileged_actor, session_id, source_ip, source_country, device_type, user_agent, target_system, "
    "target_resource, auth_method, mfa_used, outcome, http_status, bytes_out, failed_attempts_1h, request_rate_1m, "
    "detection_source, is_test_event, source_system"
)

CLEAN = """
clean AS (
  SELECT * REPLACE (
      lower(trim(actor_email)) AS actor_email, lower(trim(event_type)) AS event_type, lower(trim(outcome)) AS outcome,
      lower(trim(target_system)) AS target_system, upper(trim(source_country)) AS source_country),
    CASE WHEN n % 97 = 0 THEN NULL ELSE ts END AS event_timestamp
  FROM raw
),
flagged AS (
  SELECT *, event_timestamp AS ingestion_timestamp, CAST(hour(event_timestamp) AS INTEGER) AS event_hour,
    event_type IN ('authentication','data_access','api_call','privilege_change','config_change') AS is_valid_event_type,
    outcome IN ('success','failure','blocked') AS is_valid_outcome,
    actor_id IS NOT NULL AND trim(actor_id) <> '' AS is_valid_actor,
    target_system IS NOT NULL AND target_system <> '' AS is_valid_target,
    bytes_out >= 0 AND bytes_out <= 10000000000 AS is_valid_bytes,
    http_status IS NULL OR (http_status >= 100 AND http_status <= 599) AS is_valid_status
  FROM clean
),
gated AS (
  SELECT *,
    CASE WHEN is_valid_event_type AND is_valid_outcome AND is_valid_actor AND is_valid_target AND is_valid_bytes
          AND is_valid_status AND event_timestamp IS NOT NULL THEN 'valid' ELSE 'invalid' END AS quality_status,
    concat_ws(',',
      CASE WHEN NOT is_valid_event_type THEN 'unknown_event_type' END,
      CASE WHEN NOT is_valid_outcome THEN 'unknown_outcome' END,
      CASE WHEN NOT is_valid_actor THEN 'missing_actor' END,
      CASE WHEN NOT is_valid_target THEN 'missing_target' END,
      CASE WHEN NOT is_valid_bytes THEN 'bytes_out_out_of_range' END,
      CASE WHEN NOT is_valid_status THEN 'invalid_http_status' END,
      CASE WHEN event_timestamp IS NULL THEN 'unparseable_event_time' END) AS quality_failure_reason
  FROM flagged
)"""

_SIX_RULES = """
      WHEN event_type = 'authentication' AND outcome = 'failure' AND failed_attempts_1h >= 10 THEN 'credential_brute_force'
      WHEN event_type = 'privilege_change' AND outcome = 'success' AND NOT coalesce(is_privileged_actor, false)
        THEN 'unauthorized_privilege_escalation'
      WHEN event_type = 'data_access' AND bytes_out >= 500000000 THEN 'large_data_egress'
      WHEN event_type = 'api_call' AND request_rate_1m >= 300 THEN 'api_abuse_burst'
      WHEN source_country IN ('RU','KP','IR','BY','NG') AND outcome = 'success' THEN 'unusual_geo_access'
      WHEN event_type = 'config_change' AND action = 'logging_disabled' THEN 'audit_logging_disabled'"""
_PRIVILEGED_RULES = """
      WHEN is_privileged_actor AND outcome = 'success' AND NOT coalesce(mfa_used, false) THEN 'privileged_access_without_mfa'
      WHEN is_privileged_actor AND outcome = 'success' AND (event_hour < 6 OR event_hour >= 22)
        THEN 'off_hours_privileged_activity'"""


def _flagging(source: str, rules: str) -> str:
    return f"""
reasons AS (SELECT *, CASE {rules} END AS threat_reason FROM {source}),
enriched AS (
  SELECT *,
    threat_reason IS NOT NULL AS is_anomaly,
    CASE WHEN threat_reason IS NULL THEN 'NONE'
         WHEN threat_reason IN ('unauthorized_privilege_escalation','large_data_egress','audit_logging_disabled') THEN 'CRITICAL'
         WHEN threat_reason IN ('credential_brute_force','unusual_geo_access') THEN 'HIGH'
         WHEN threat_reason IN ('api_abuse_burst','privileged_access_without_mfa') THEN 'MEDIUM' ELSE 'LOW' END AS severity,
    CASE WHEN threat_reason IS NULL THEN 0
         WHEN threat_reason IN ('unauthorized_privilege_escalation','large_data_egress','audit_logging_disabled') THEN 4
         WHEN threat_reason IN ('credential_brute_force','unusual_geo_access') THEN 3
         WHEN threat_reason IN ('api_abuse_burst','privileged_access_without_mfa') THEN 2 ELSE 1 END AS severity_rank,
    CASE threat_reason
      WHEN 'credential_brute_force' THEN 'TA0006:T1110' WHEN 'unauthorized_privilege_escalation' THEN 'TA0004:T1078'
      WHEN 'large_data_egress' THEN 'TA0010:T1041' WHEN 'api_abuse_burst' THEN 'TA0040:T1499'
      WHEN 'unusual_geo_access' THEN 'TA0001:T1078.004' WHEN 'audit_logging_disabled' THEN 'TA0005:T1562.008'
      WHEN 'privileged_access_without_mfa' THEN 'TA0001:T1078' WHEN 'off_hours_privileged_activity' THEN 'TA0003:T1078'
    END AS mitre_tactic
  FROM reasons
),
fact AS (SELECT * FROM enriched WHERE quality_status = 'valid'),
quarantine AS (SELECT * FROM enriched WHERE quality_status = 'invalid')"""


_MEASURES = """
    count(*) AS event_count,
    count(*) FILTER (WHERE outcome = 'failure') AS failure_count,
    count(*) FILTER (WHERE outcome = 'blocked') AS blocked_count,
    round(count(*) FILTER (WHERE outcome = 'failure') / count(*)::DOUBLE, 4) AS failure_rate,
    count(DISTINCT actor_id) AS unique_actors,
    count(DISTINCT source_ip) AS unique_source_ips,
    CAST(sum(bytes_out) AS BIGINT) AS total_bytes_out,
    count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
    max(severity_rank) AS max_severity_rank"""
_METRIC_KEY = "date_trunc('minute', event_timestamp), event_type, target_system, source_country"


def _metrics(source: str, extra: str = "") -> str:
    return f"""
  SELECT date_trunc('minute', event_timestamp) AS window_start,
    date_trunc('minute', event_timestamp) + INTERVAL 1 MINUTE AS window_end,
    event_type, target_system, source_country, {_MEASURES} {extra}
  FROM {source} GROUP BY {_METRIC_KEY}"""


THREAT_COLUMNS = (
    "event_timestamp, event_id, event_type, actor_id, actor_role, target_system, source_ip, source_country, outcome, "
    "bytes_out, failed_attempts_1h, request_rate_1m, threat_reason, severity, mitre_tactic"
)

SCORING = """
threats AS (SELECT * FROM fact WHERE is_anomaly),
points AS (
  SELECT *,
    CASE severity WHEN 'CRITICAL' THEN 70 WHEN 'HIGH' THEN 55 WHEN 'MEDIUM' THEN 40 WHEN 'LOW' THEN 25 ELSE 20 END
    + CASE WHEN contains(threat_reason, 'privilege_escalation') THEN 20 ELSE 0 END
    + CASE WHEN contains(threat_reason, 'data_egress') THEN CASE WHEN bytes_out >= 2000000000 THEN 25 ELSE 15 END ELSE 0 END
    + CASE WHEN contains(threat_reason, 'brute_force') THEN CASE WHEN failed_attempts_1h >= 30 THEN 20 ELSE 10 END ELSE 0 END
    + CASE WHEN contains(threat_reason, 'api_abuse') THEN CASE WHEN request_rate_1m >= 1000 THEN 18 ELSE 10 END ELSE 0 END
    + CASE WHEN contains(threat_reason, 'unusual_geo') OR contains(threat_reason, 'without_mfa') THEN 12 ELSE 0 END
    + CASE WHEN contains(threat_reason, 'logging_disabled') THEN 20 ELSE 0 END
    + CASE outcome WHEN 'success' THEN 8 WHEN 'blocked' THEN -10 ELSE 0 END AS total
  FROM threats
),
scored AS (
  SELECT *, least(greatest(total, 0), 100) AS risk_score,
    CASE WHEN total >= 80 THEN 'CRITICAL' WHEN total >= 60 THEN 'HIGH' WHEN total >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM points
),
insights AS (
  SELECT
    substr(sha256(event_id || '|' || threat_reason), 1, 32) AS insight_id, @AS_OF@ AS generated_at,
    @THREAT_COLUMNS@, risk_score, risk_level,
    'Identity ' || actor_id || ' (' || actor_role || ') triggered the ' || threat_reason || ' rule against '
      || target_system || '. The event originated from ' || source_ip || ' in ' || source_country
      || ' and the outcome was ' || outcome || '. It maps to MITRE ATT&CK ' || mitre_tactic || ' and is assessed as '
      || risk_level || ' risk based on severity, volume, and whether the activity succeeded.' AS threat_explanation,
    CASE threat_reason
      WHEN 'credential_brute_force' THEN 'Lock or step-up authentication for the identity, block the source IP, and confirm whether any attempt succeeded.'
      WHEN 'unauthorized_privilege_escalation' THEN 'Revoke the granted role immediately, verify the change against an approved ticket, and review the approver''s account.'
      WHEN 'large_data_egress' THEN 'Suspend the export session, quantify what left the environment, and engage data protection review.'
      WHEN 'api_abuse_burst' THEN 'Apply rate limiting to the client credential and verify whether the traffic is a misconfigured integration or scripted abuse.'
      WHEN 'unusual_geo_access' THEN 'Challenge the session with MFA, confirm travel with the user, and review other activity from the same source.'
      WHEN 'audit_logging_disabled' THEN 'Re-enable logging, treat the gap window as untrusted, and investigate the account that changed the policy.'
      WHEN 'privileged_access_without_mfa' THEN 'Enforce MFA on the privileged account and review what actions were taken during the session.'
      WHEN 'off_hours_privileged_activity' THEN 'Confirm the activity with the account owner and check it against the change calendar.'
    END AS recommended_action,
    CASE WHEN risk_level IN ('CRITICAL','HIGH') THEN 'tier2_incident_response'
         WHEN risk_level = 'MEDIUM' THEN 'tier1_soc_review' ELSE 'monitoring_only' END AS triage_queue,
    'rules_based_ai_baseline' AS model_provider
  FROM scored
),
triaged AS (SELECT * REPLACE (@TRIAGED_UNTIL@ AS generated_at) FROM insights WHERE event_timestamp < @TRIAGED_UNTIL@)
""".replace("@AS_OF@", AS_OF).replace("@TRIAGED_UNTIL@", TRIAGED_UNTIL).replace("@THREAT_COLUMNS@", THREAT_COLUMNS)


# 32-bit Murmur2 of an ASCII text ``key``; 1540483477 multiplies, 2538058380 is the seed.
_TIMES = "CAST((CAST({} AS HUGEINT) * 1540483477) % 4294967296 AS BIGINT)"
_BYTE = "CAST(ascii(substr(key, CAST({} AS INTEGER), 1)) AS BIGINT)"
_WORDS = "[" + " + ".join(f"({_BYTE.format(f'4 * w + {i + 1}')} << {8 * i})" for i in range(4)) + " FOR w IN range(length(key) // 4)]"
_MIXED = f"[{_TIMES.format('xor(k, k >> 24)')} FOR k IN [{_TIMES.format('k')} FOR k IN {_WORDS}]]"
_BODY = f"list_reduce(list_prepend(xor(CAST(2538058380 AS BIGINT), length(key)), {_MIXED}), lambda h, k: xor({_TIMES.format('h')}, k))"
_TAIL = " + ".join(f"CASE WHEN length(key) % 4 > {i} THEN {_BYTE.format(f'length(key) // 4 * 4 + {i + 1}')} << {8 * i} ELSE 0 END" for i in range(3))
_TAILED = f"[CASE WHEN length(key) % 4 = 0 THEN h ELSE {_TIMES.format(f'xor(h, {_TAIL})')} END FOR h IN [{_BODY}]]"
_MURMUR2 = f"[xor(h, h >> 15) FOR h IN [{_TIMES.format('xor(h, h >> 13)')} FOR h IN {_TAILED}]][1]"


def _with(*ctes: str, feed: str = PLAIN) -> str:
    return "WITH feed AS (" + feed + "),\n" + ",\n".join(ctes) + "\n"


_BASE = (RAW, CLEAN, _flagging("gated", _SIX_RULES + _PRIVILEGED_RULES))


def _sql(select: str, *ctes: str, feed: str = PLAIN) -> str:
    return _with(*_BASE, *ctes, feed=feed) + select


def _on_time(source: str) -> str:
    """Rows of the sliced feed that no watermark drops: it trails the largest event time of the slices before by ten minutes."""
    own = " + ".join(f"CAST(ts >= TIMESTAMP '{start}' AS INTEGER)" for start in ("2024-01-08", "2024-01-16", "2024-01-24"))
    return f"""
arrived AS (SELECT *, least(3, {own} + CAST(n % 23 = 0 AS INTEGER)) AS slice FROM {source}),
slices AS (SELECT slice, max(max(event_timestamp)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  - INTERVAL 10 MINUTE AS watermark FROM arrived GROUP BY slice),
on_time AS (SELECT arrived.* FROM arrived JOIN slices USING (slice)
  WHERE event_timestamp IS NULL OR watermark IS NULL OR event_timestamp > watermark)"""


_M = f"metrics AS ({_metrics('fact')})"
_LAST_HOUR = f"BETWEEN {AS_OF} - INTERVAL 1 HOUR AND {AS_OF}"
_METRIC_LOG = f"""
metric_log AS (
  SELECT *, CAST(0 AS INTEGER) AS batch_id FROM ({_metrics("(SELECT * FROM fact WHERE second(event_timestamp) < 30)")})
  UNION ALL
  SELECT * EXCLUDE (changed), 1 FROM ({_metrics("fact", ", bool_or(second(event_timestamp) >= 30) AS changed")}) WHERE changed
),
metrics AS (
  SELECT * FROM metric_log
  QUALIFY row_number() OVER (PARTITION BY window_start, event_type, target_system, source_country ORDER BY batch_id DESC) = 1
)"""


def _counts(keys: str, source: str, name: str) -> str:
    return f"SELECT {keys}, count(*) AS {name} FROM {source} GROUP BY {keys}"


# --- evidence ---------------------------------------------------------------------------------------

ORDERS_EVIDENCE = """
ev AS (SELECT o_totalprice AS amount, o_orderpriority AS channel, o_orderstatus AS category, o_totalprice <= 0 AS bad FROM orders)
"""
ACTIVITY_EVIDENCE = """
ev AS (
  SELECT value AS amount, 'user-' || (user_id % 9) AS channel, event_type AS category,
    value <= 0 OR CAST(json_extract_string(props, '$.k') AS INTEGER) <= 0 OR event_type = 'error' AS bad
  FROM events
)"""
NO_AMOUNT_EVIDENCE = "ev AS (SELECT 0.0::DOUBLE AS amount, 'unknown' AS channel, 'unknown' AS category, true AS bad FROM lineitem)"

EVIDENCE = """
channels AS (
  SELECT channel AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, channel) AS place
  FROM ev GROUP BY channel QUALIFY place <= 6
),
categories AS (
  SELECT category AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, category) AS place
  FROM ev GROUP BY category QUALIFY place <= 6
),
prof AS (
  SELECT count(*) AS event_count, round(sum(amount), 2) AS total_revenue,
    (SELECT value FROM channels WHERE place = 1) AS top_channel,
    count(*) FILTER (WHERE bad) AS anomaly_count,
    (SELECT string_agg(value || '=' || n, ';' ORDER BY value || '=' || n) FROM channels) AS channel_breakdown,
    (SELECT string_agg(value || '=' || n, ';' ORDER BY value || '=' || n) FROM categories) AS category_breakdown
  FROM ev
),
rated AS (
  SELECT *, round(100.0::DOUBLE * anomaly_count / event_count, 2) AS anomaly_rate_percent,
    CASE WHEN round(100.0::DOUBLE * anomaly_count / event_count, 2) >= 10 THEN 'high'
         WHEN anomaly_count > 0 THEN 'medium' ELSE 'low' END AS risk_level
  FROM prof
)
"""


def _profile(source: str, detected: str) -> str:
    return f"WITH {source}, {EVIDENCE} SELECT *, '{detected}' AS detected_columns FROM prof"


def _text_records(table: str, id_column: str, text_column: str) -> str:
    return rf"""
  SELECT {id_column} AS document_page, 'pdf_evidence' AS category, 'document' AS sales_channel, 1 AS quantity,
    coalesce(TRY_CAST(replace(regexp_extract(t, '(?:[$£€]\s*)?(\d{{1,3}}(?:,\d{{3}})*(?:\.\d{{2}})|\d+(?:\.\d{{2}})?)', 1),
      ',', '') AS DOUBLE), 0.0) AS order_amount,
    contains(lower(t), 'anomaly') OR contains(lower(t), 'incident') OR contains(lower(t), 'failed')
      OR contains(lower(t), 'error') OR contains(lower(t), 'risk') OR contains(lower(t), 'urgent') AS is_anomaly,
    substring(t, 1, 900) AS text_excerpt
  FROM (
    SELECT {id_column}, CASE WHEN regexp_matches({text_column}, '[^ \t\n\r\v\f]')
      THEN regexp_replace(regexp_replace({text_column}, '^[ \t\n\r\v\f]+', ''), '[ \t\n\r\v\f]+$', '')
      ELSE 'No text could be extracted from this PDF page.' END AS t
    FROM {table}
  )"""


_LOG_LINES = """
(SELECT event_id, '  ' || upper(event_type[1]) || event_type[2:] || ' by user: £ ' || format('{:,.2f}', value) || chr(10) AS line
 FROM events)"""
TEXT_EVIDENCE = f"""
ev AS (
  SELECT order_amount AS amount, sales_channel AS channel, category, order_amount <= 0 OR is_anomaly AS bad
  FROM ({_text_records(_LOG_LINES, "event_id", "line")})
)"""

_FINAL = """(
  SELECT *, row_number() OVER (PARTITION BY event_id, event_timestamp) AS nth FROM enriched
)"""
_STORED = f"""
SELECT CASE quality_status WHEN 'valid' THEN 'fact_security_events' ELSE 'error_security_events' END AS table_name,
  event_id, event_timestamp, quality_status, quality_failure_reason, threat_reason
FROM {_FINAL} WHERE nth = 1 OR event_timestamp IS NULL"""

_JSON = "to_json(struct_pack(" + ", ".join(f"{c} := {c}" for c in EVENT_COLUMNS.split(", ")) + "))::VARCHAR"
_KAFKA = """'security-events' AS topic, CAST(u % 8 AS INTEGER) AS kafka_partition, n AS kafka_offset, ts AS kafka_timestamp"""


def oracles() -> dict[str, str]:
    decoded = ", ".join(f"CASE WHEN n % 211 <> 0 THEN {c} END AS {c}" for c in EVENT_COLUMNS.split(", "))
    cut_short = "'{\"event_id\": \"EVT-' || n || '\", \"event_time\"'"
    insight_view = (
        "generated_at, event_timestamp, event_id, event_type, actor_id, actor_role, target_system, source_ip, "
        "source_country, outcome, threat_reason, severity, mitre_tactic, risk_score, risk_level, threat_explanation, "
        "recommended_action, triage_queue, model_provider"
    )
    fact_columns = EVENT_COLUMNS.replace("event_time, ", "event_time, event_timestamp, ts AS ingestion_timestamp, ")
    flags = "is_valid_event_type, is_valid_outcome, is_valid_actor, is_valid_target, is_valid_bytes, is_valid_status"
    matrix = """count(*) AS event_count, round(count(*) FILTER (WHERE outcome = 'failure') / count(*)::DOUBLE, 4) AS failure_rate,
      count(DISTINCT actor_id) AS unique_actors"""
    quarantine_columns = (
        "event_timestamp, ingestion_timestamp, event_id, event_type, actor_id, target_system, outcome, http_status, "
        "bytes_out, quality_failure_reason"
    )
    lenient = """
gated AS (
  SELECT * FROM (
    SELECT * REPLACE (lower(trim(event_type)) AS event_type, lower(trim(outcome)) AS outcome,
      lower(trim(target_system)) AS target_system, upper(trim(source_country)) AS source_country),
      CASE WHEN n % 97 = 0 THEN NULL ELSE ts END AS event_timestamp FROM raw)
), lenient AS (
  SELECT *, CASE WHEN event_type IN ('authentication','data_access','api_call','privilege_change','config_change')
      AND outcome IN ('success','failure','blocked') AND length(trim(coalesce(actor_id, ''))) > 0
      AND target_system IS NOT NULL AND bytes_out >= 0 AND event_timestamp IS NOT NULL
    THEN 'valid' ELSE 'invalid' END AS quality_status
  FROM gated
)"""
    stream_feed = _with(*_BASE, feed=REPLAYED)
    return {
        "decoded_messages": _with(RAW)
        + f"SELECT {decoded}, {_KAFKA}, CASE WHEN n % 211 = 0 THEN {cut_short} ELSE {_JSON} END AS raw_value FROM raw",
        "malformed_messages": _with(RAW)
        + f"""SELECT {cut_short} AS raw_value, n AS kafka_offset,
          'missing_actor,missing_target,unparseable_event_time' AS quality_failure_reason FROM raw WHERE n % 211 = 0""",
        "clean_events": _sql(
            "SELECT event_id, event_timestamp, ingestion_timestamp, actor_email, event_type, outcome, target_system, "
            "source_country, event_hour FROM enriched"
        ),
        "quality_flags": _sql(f"SELECT event_id, {flags}, quality_status FROM enriched"),
        "failure_reasons": _sql("SELECT event_id, quality_status, quality_failure_reason FROM enriched"),
        "strict_failure_reasons": _sql(
            """SELECT event_id, quality_status, concat_ws(',',
              CASE WHEN is_valid_event_type IS NOT TRUE THEN 'unknown_event_type' END,
              CASE WHEN is_valid_outcome IS NOT TRUE THEN 'unknown_outcome' END,
              CASE WHEN is_valid_actor IS NOT TRUE THEN 'missing_actor' END,
              CASE WHEN is_valid_target IS NOT TRUE THEN 'missing_target' END,
              CASE WHEN is_valid_bytes IS NOT TRUE THEN 'bytes_out_out_of_range' END,
              CASE WHEN is_valid_status IS NOT TRUE THEN 'invalid_http_status' END,
              CASE WHEN event_timestamp IS NULL THEN 'unparseable_event_time' END) AS quality_failure_reason
            FROM enriched"""
        ),
        "lenient_gate": _with(RAW, lenient) + "SELECT event_id, event_timestamp, quality_status FROM lenient",
        "valid_events": _sql(
            f"""SELECT {fact_columns}, event_hour, {flags}, quality_status, quality_failure_reason, threat_reason,
              is_anomaly, severity, severity_rank, mitre_tactic, {_KAFKA}, CAST(0 AS BIGINT) AS batch_id
            FROM fact WHERE n % 211 <> 0"""
        ),
        "quarantined_events": _sql(f"SELECT {quarantine_columns} FROM quarantine"),
        "quarantine_reason_counts": _sql(_counts("quality_failure_reason", "quarantine", "quarantined")),
        "quarantine_reason_exploded": _sql(
            "SELECT reason, count(*) AS quarantined FROM "
            "(SELECT unnest(string_split(quality_failure_reason, ',')) AS reason FROM quarantine) GROUP BY reason"
        ),
        "recent_quarantine": _sql(
            f"SELECT {quarantine_columns} FROM quarantine "
        ),
        "threat_flags": _sql(
            "SELECT event_id, threat_reason, is_anomaly, severity, severity_rank, mitre_tactic FROM enriched"
        ),
        "threat_flags_notebook": _with(RAW, lenient, _flagging("lenient", _SIX_RULES))
        + "SELECT event_id, threat_reason, is_anomaly, severity, severity_rank FROM enriched",
        "threat_events": _sql(f"SELECT {THREAT_COLUMNS} FROM fact WHERE is_anomaly"),
        "rule_fire_counts": _sql(_counts("threat_reason, severity", "fact WHERE is_anomaly", "indicator_count")),
        "rule_catalogue_counts": _sql(
            """SELECT i.threat_reason, count(*) AS indicator_count, severity, severity_rank, mitre_tactic, recommended_action
            FROM insights i JOIN (SELECT DISTINCT threat_reason, severity_rank FROM fact) r USING (threat_reason)
            GROUP BY ALL""",
            SCORING,
        ),
        "indicators_by_reason": _sql(_counts("threat_reason", "fact WHERE is_anomaly", "indicator_count")),
        "indicators_by_severity_target": _sql(
            _counts("severity, target_system", "fact WHERE is_anomaly", "indicator_count")
        ),
        "dedup_by_key": _sql(
            f"SELECT event_id, event_timestamp, quality_status FROM {_FINAL} WHERE nth = 1 OR event_timestamp IS NULL",
            feed=REPLAYED,
        ),
        "dedup_by_id": _sql(
            "SELECT event_id, min(event_timestamp) AS event_timestamp, first(quality_status) AS quality_status "
            "FROM enriched GROUP BY event_id",
            feed=REPLAYED,
        ),
        "late_events": f"""
          WITH feed AS ({DELAYED}), seen AS (
            SELECT event_id, ts, max(ts) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
              - INTERVAL 10 MINUTE AS watermark FROM feed)
          SELECT event_id, ts, watermark, coalesce(ts < watermark, false) AS is_late FROM seen""",
        "keyed_publish": _with(RAW) + f"SELECT coalesce(nullif(actor_id, ''), event_id) AS key, {_JSON} AS value FROM raw",
        "ordered_publish": _with(RAW) + f"""
          SELECT key, partition, CAST(row_number() OVER (PARTITION BY partition ORDER BY event_time NULLS FIRST, event_id) AS INTEGER) AS sequence, event_id
          FROM (SELECT *, CAST(({_MURMUR2}) & 2147483647 AS INTEGER) % 12 AS partition
                FROM (SELECT event_id, event_time, coalesce(nullif(actor_id, ''), event_id) AS key FROM raw))""",
        "metrics_1m_exact": _sql("SELECT * FROM metrics", _M),
        # Sketches of up to a few hundred values are exact, so the sketched counts have to be the exact ones.
        "metrics_1m_approx": _sql("SELECT * FROM metrics", _M),
        "hourly_actors_sketched": _sql(
            "SELECT date_trunc('hour', event_timestamp) AS hour, event_type, count(DISTINCT actor_id) AS unique_actors, "
            "count(DISTINCT source_ip) AS unique_source_ips, CAST(0 AS DOUBLE) AS actors_error FROM fact GROUP BY 1, 2"
        ),
        "distinct_rollup": _sql(
            "SELECT hour, event_type, target_system, count(DISTINCT actor_id) AS unique_actors "
            "FROM (SELECT *, date_trunc('hour', event_timestamp) AS hour FROM fact) "
            "GROUP BY GROUPING SETS ((hour, event_type, target_system), (event_type, target_system))"
        ),
        "metrics_current": _sql("SELECT * FROM metrics", _METRIC_LOG),
        "security_trends": _sql("SELECT * FROM metrics", _M),
        "trend_slice": _sql(
            "SELECT * FROM metrics WHERE event_type IN ('authentication', 'api_call') AND source_country IN ('RU', 'KP')", _M
        ),
        "events_by_window": _sql(
            "SELECT date_trunc('minute', event_timestamp) AS window_start, count(*) AS event_count FROM fact GROUP BY 1"
        ),
        "egress_by_window": _sql(
            "SELECT date_trunc('minute', event_timestamp) AS window_start, CAST(sum(bytes_out) AS BIGINT) AS total_bytes_out "
            "FROM fact GROUP BY 1"
        ),
        "events_by_country": _sql(_counts("source_country", "fact", "event_count")),
        "event_target_matrix": _sql(f"SELECT event_type, target_system, {matrix} FROM fact GROUP BY event_type, target_system"),
        "event_target_rollup": _sql(
            f"SELECT event_type, target_system, {matrix}, CAST(grouping(event_type, target_system) AS INTEGER) AS total_level "
            "FROM fact GROUP BY ROLLUP (event_type, target_system)"
        ),
        "top_failed_auth_actors": _sql(
            """SELECT actor_id, count(*) AS failed_count FROM fact WHERE event_type = 'authentication' AND outcome = 'failure'
            GROUP BY actor_id"""
        ),
        "failed_auth_hitters": _sql(
            "SELECT actor_id, count(*) AS failed_count FROM fact WHERE event_type = 'authentication' AND outcome = 'failure' GROUP BY actor_id "
            "HAVING count(*) >= (SELECT count(actor_id) FROM fact WHERE event_type = 'authentication' AND outcome = 'failure') / 1000.0"
        ),
        "realtime_kpis": _sql(
            f"""SELECT max(window_end) AS latest_window, CAST(sum(event_count) AS BIGINT) AS events_last_hour,
              CAST(sum(failure_count) AS BIGINT) AS failed_events_last_hour,
              CAST(sum(blocked_count) AS BIGINT) AS blocked_events_last_hour,
              round(sum(failure_count) / nullif(sum(event_count), 0)::DOUBLE, 4) AS failure_rate,
              CAST(sum(total_bytes_out) AS BIGINT) AS bytes_egressed_last_hour,
              CAST(sum(anomaly_count) AS BIGINT) AS threat_indicators_last_hour, max(max_severity_rank) AS peak_severity_rank
            FROM metrics WHERE window_end {_LAST_HOUR}""",
            _M,
        ),
        "quality_scorecard": _sql(
            f"""SELECT {AS_OF} AS generated_at, v AS valid_events, q AS quarantined_events, v + q AS total_events,
              round(v / nullif(v + q, 0)::DOUBLE * 100, 2) AS quality_score_pct
            FROM (SELECT (SELECT count(*) FROM fact WHERE ingestion_timestamp {_LAST_HOUR}) AS v,
              (SELECT count(*) FROM quarantine WHERE ingestion_timestamp {_LAST_HOUR}) AS q)"""
        ),
        "hourly_counts": _sql(
            f"""SELECT count(*) AS total_events, count(DISTINCT actor_id) AS distinct_actors,
              count(*) FILTER (WHERE outcome = 'failure') AS failed_events,
              count(*) FILTER (WHERE is_anomaly) AS threat_indicators,
              count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_indicators
            FROM fact WHERE event_timestamp {_LAST_HOUR}"""
        ),
        "security_summary": _sql(
            f"""SELECT {AS_OF} AS generated_at,
              'In the last hour, the platform processed ' || total_events || ' security events across ' || distinct_actors
              || ' identities, with ' || failed_events || ' failed outcomes. Detection rules raised ' || threat_indicators
              || ' threat indicators, of which ' || critical_indicators || ' were critical. The most frequent pattern was '
              || coalesce(threat_reason, 'n/a') || ' and the most targeted system was ' || coalesce(target_system, 'n/a')
              || '.' AS security_summary,
              total_events, distinct_actors, failed_events, threat_indicators, critical_indicators,
              threat_reason AS top_threat_pattern, target_system AS top_targeted_system
            FROM (SELECT count(*) AS total_events, count(DISTINCT actor_id) AS distinct_actors,
                count(*) FILTER (WHERE outcome = 'failure') AS failed_events,
                count(*) FILTER (WHERE is_anomaly) AS threat_indicators,
                count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_indicators
              FROM fact WHERE event_timestamp {_LAST_HOUR})
            LEFT JOIN (SELECT threat_reason FROM fact WHERE is_anomaly AND event_timestamp {_LAST_HOUR}
              GROUP BY threat_reason ORDER BY count(*) DESC, threat_reason LIMIT 1) ON true
            LEFT JOIN (SELECT target_system FROM metrics WHERE window_end {_LAST_HOUR}
              GROUP BY target_system ORDER BY sum(anomaly_count) DESC, target_system LIMIT 1) ON true""",
            _M,
        ),
        "top_threat": _sql(
            f"""SELECT threat_reason, count(*) AS indicator_count FROM fact
            WHERE is_anomaly AND event_timestamp {_LAST_HOUR} GROUP BY threat_reason
            QUALIFY row_number() OVER (ORDER BY count(*) DESC, threat_reason) = 1"""
        ),
        "top_target": _sql(
            f"""SELECT target_system, CAST(sum(anomaly_count) AS BIGINT) AS target_indicators FROM metrics
            WHERE window_end {_LAST_HOUR} GROUP BY target_system
            QUALIFY row_number() OVER (ORDER BY sum(anomaly_count) DESC, target_system) = 1""",
            _M,
        ),
        "curated_row_counts": _sql(
            """SELECT 'fact_security_events' AS table_name, count(*) AS row_count FROM fact
            UNION ALL SELECT 'error_security_events', count(*) FROM quarantine
            UNION ALL SELECT 'agg_security_metrics_1m', count(*) FROM metrics
            UNION ALL SELECT 'ai_threat_insights', count(*) FROM fact WHERE is_anomaly""",
            _M,
        ),
        "risk_scores": _sql("SELECT event_id, threat_reason, risk_score, risk_level FROM scored", SCORING),
        "triage_insights": _sql("SELECT * FROM insights", SCORING),
        "insights_view": _sql(f"SELECT {insight_view} FROM insights", SCORING),
        "untriaged_threats": _sql(
            f"""SELECT {THREAT_COLUMNS} FROM threats t
            WHERE NOT EXISTS (SELECT 1 FROM triaged i WHERE i.event_id = t.event_id)
            ORDER BY event_timestamp DESC, event_id, threat_reason LIMIT 100""",
            SCORING,
        ),
        "untriaged_threats_all": _sql(
            f"""SELECT {THREAT_COLUMNS} FROM threats t
            WHERE NOT EXISTS (SELECT 1 FROM triaged i WHERE i.event_id = t.event_id)""",
            SCORING,
        ),
        "insight_upsert": _sql(
            """SELECT insight_id, event_id, event_timestamp, threat_reason, risk_score FROM insights
            WHERE n_id NOT IN (SELECT n_id FROM first_load)
            QUALIFY row_number() OVER (PARTITION BY insight_id ORDER BY event_timestamp DESC) = 1""".replace(
                "n_id", "insight_id"
            ),
            SCORING,
            f"""first_load AS (
              SELECT i.insight_id FROM insights i JOIN events e ON i.event_id = 'EVT-' || e.event_id AND i.event_timestamp = e.ts
              WHERE e.ts < {TRIAGED_UNTIL})""",
            feed=REPLAYED,
        ),
        "triage_job": _sql("SELECT * FROM insights", SCORING),
        "curated_tables": _sql(
            "SELECT 'fact_security_events' AS table_name, count(*) AS n_rows, count(DISTINCT CAST(event_timestamp AS DATE)) AS n_days FROM fact "
            "UNION ALL SELECT 'error_security_events', count(*), count(DISTINCT CAST(event_timestamp AS DATE)) FROM quarantine"
        ),
        "newest_insights": _sql(
            """SELECT * FROM (SELECT * FROM triaged UNION ALL SELECT * FROM insights)
            ORDER BY generated_at DESC, event_timestamp DESC NULLS LAST, event_id, threat_reason LIMIT 20""",
            SCORING,
        ),
        "average_risk": _sql("SELECT avg(risk_score) AS average_risk_score FROM scored", SCORING),
        "risk_level_queue_sets": _sql(
            """SELECT risk_level, triage_queue, count(*) AS insight_count FROM insights
            GROUP BY GROUPING SETS ((risk_level), (triage_queue))""",
            SCORING,
        ),
        "evidence_profile": _profile(ORDERS_EVIDENCE, "Order Amount;-;Sales-Channel;category;-"),
        "evidence_profile_activity": _profile(ACTIVITY_EVIDENCE, "Value;Qty;source;type;status"),
        "evidence_profile_no_amount": _profile(NO_AMOUNT_EVIDENCE, "-;-;-;-;-"),
        "evidence_breakdown": f"""WITH {ACTIVITY_EVIDENCE}, {EVIDENCE}
          SELECT 'channel' AS role, value, n AS value_count, CAST(place AS INTEGER) AS place FROM channels
          UNION ALL SELECT 'category', value, n, CAST(place AS INTEGER) FROM categories""",
        "evidence_split": f"""WITH {ACTIVITY_EVIDENCE}, {EVIDENCE}
          SELECT greatest(event_count - anomaly_count, 0) AS normal_events, anomaly_count AS anomaly_events FROM prof""",
        "evidence_risk": f"""WITH {ACTIVITY_EVIDENCE}, {EVIDENCE}
          SELECT anomaly_rate_percent, risk_level, CASE risk_level WHEN 'high' THEN 'Escalate before publishing KPIs.'
            ELSE 'Continue monitoring and keep human review available.' END AS review_note FROM rated""",
        "evidence_actions": f"""WITH {ACTIVITY_EVIDENCE}, {EVIDENCE}, steps AS (
            SELECT 1 AS o, 'Pause automated downstream reporting until risk review is complete.' AS action
              FROM rated WHERE risk_level = 'high'
            UNION ALL SELECT 2, 'Investigate anomalous transactions before publishing KPIs.' FROM rated WHERE anomaly_count > 0
            UNION ALL SELECT 3, 'Create a one-page operations summary for stakeholders.'
            UNION ALL SELECT 4, 'Route high-risk anomalies to a human reviewer before escalation.'
            UNION ALL SELECT 5, 'Increase sample size before making production decisions.' FROM rated WHERE event_count < 10)
          SELECT CAST(row_number() OVER (ORDER BY o) - 1 AS INTEGER) AS step, action FROM steps""",
        "evidence_summary": f"""WITH {ORDERS_EVIDENCE}, {EVIDENCE}
          SELECT 'Completed workflow for: weekly order review. Key findings: processed ' || event_count
            || ' events; total revenue was '
            || regexp_replace(CAST(CAST(total_revenue AS DECIMAL(38,2)) AS VARCHAR), '0$', '')
            || '; top channel was ' || top_channel || '.' AS final_summary FROM prof""",
        "evidence_csv": _profile(ORDERS_EVIDENCE, "Order Amount;-;Sales-Channel;category;-"),
        "evidence_jsonl": _profile(ACTIVITY_EVIDENCE, "Value;Qty;source;type;status"),
        "evidence_json": _profile(ACTIVITY_EVIDENCE, "Value;Qty;source;type;status"),
        "evidence_first_n": "SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 500",
        "text_evidence": _text_records("documents", "doc_id", "text"),
        "text_evidence_pages": _text_records("pages", "page_id", "html"),
        "text_evidence_profile": _profile(TEXT_EVIDENCE, "order_amount;quantity;sales_channel;category;is_anomaly"),
        "stream_fact_quarantine": stream_feed + _STORED,
        "stream_dedup": _with(*_BASE, _on_time("enriched"), feed=REPLAYED) + _STORED.replace("FROM enriched", "FROM on_time"),
        "stream_progress": _sql(
            "SELECT 'security_metrics' AS name, (SELECT count(DISTINCT slice) FROM arrived) AS batches, "
            "(SELECT count(*) FROM arrived JOIN slices USING (slice) WHERE event_timestamp <= watermark) AS dropped_late_rows",
            _on_time("fact"),
            feed=REPLAYED,
        ),
        "stream_metrics": _sql(
            "SELECT * FROM metrics",
            _on_time("fact"),
            f"""unique_facts AS (SELECT * FROM (
              SELECT *, row_number() OVER (PARTITION BY event_id, event_timestamp) AS nth FROM on_time) WHERE nth = 1),
            metrics AS ({_metrics("unique_facts")})""",
            feed=REPLAYED,
        ),
    }
