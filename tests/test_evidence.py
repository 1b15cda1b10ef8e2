import json

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.numbers import safe_float, safe_int
from tidewatch.functions.text import truthy
from tidewatch.operators import evidence
from tidewatch.sources.evidence_files import first_records, load_evidence

CSV = "﻿amount,qty,channel,segment,status\n10.5,2,web,books,ok\n-5,1,web,hardware,error\n7,,store,books,\n"


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_loose_csv(spark, tmp_path):
    table = load_evidence(spark, _write(tmp_path / "loose.csv", CSV))
    assert table.columns == ["amount", "qty", "channel", "segment", "status"]
    assert {f.dataType.simpleString() for f in table.schema.fields} == {"string"}
    assert table.filter("qty = ''").count() == 1
    row = evidence.review(table, "demo").first()
    assert (row.event_count, row.total_revenue, row.anomaly_count, row.top_channel) == (3, 12.5, 1, "web")
    assert row.channel_breakdown == {"web": 2, "store": 1}
    assert row.detected_columns.asDict() == {
        "amount": "amount",
        "quantity": "qty",
        "channel": "channel",
        "category": "segment",
        "anomaly": "status",
    }
    assert (row.anomaly_rate_percent, row.risk_level) == (33.33, "high")
    assert row.actions == [
        evidence.PAUSE_ACTION,
        evidence.INVESTIGATE_ACTION,
        *evidence.STANDING_ACTIONS,
        evidence.SAMPLE_ACTION,
    ]
    assert row.final_summary == (
        "Completed workflow for: demo. Key findings: processed 3 events; total revenue was 12.5; top channel was web."
    )


RECORDS = [{"amount": 1, "source": "b"}, {"amount": 2, "source": "a"}, {"amount": None, "source": "a"}]


@pytest.mark.parametrize(
    "name,text",
    [
        ("array.json", json.dumps(RECORDS, indent=1)),
        ("wrapped.json", json.dumps({"events": RECORDS}, indent=1)),
        ("lines.jsonl", "\n\n".join(map(json.dumps, RECORDS)) + "\n\n"),
        ("lines.log", "\n".join(map(json.dumps, RECORDS))),
    ],
)
def test_json_shapes(spark, tmp_path, name, text):
    table = load_evidence(spark, _write(tmp_path / name, text))
    row = evidence.profile(table).first()
    assert (row.event_count, row.total_revenue, row.anomaly_count, row.top_channel) == (3, 3.0, 1, "a")


def test_format_can_be_forced_and_malformed_lines_fail(spark, tmp_path):
    path = _write(tmp_path / "data.csv", json.dumps(RECORDS[0]))
    assert load_evidence(spark, path, fmt="jsonl").count() == 1
    broken = _write(tmp_path / "broken.jsonl", '{"amount": 1}\n{"amount": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        load_evidence(spark, broken).collect()


def test_limit_takes_the_first_records(spark, tmp_path):
    lines = "\n".join(json.dumps({"n": n}) for n in range(500))
    path = _write(tmp_path / "many.jsonl", lines)
    assert [r.n for r in load_evidence(spark, path, limit=3).collect()] == [0, 1, 2]
    spread = spark.range(0, 1000, 1, 8)
    assert sorted(r.id for r in first_records(spread, 5).collect()) == [0, 1, 2, 3, 4]


def test_empty_evidence(spark):
    row = evidence.review(spark.createDataFrame([], "amount double, channel string"), "x").first()
    assert (row.event_count, row.total_revenue, row.top_channel, row.anomaly_count) == (0, 0.0, "unknown", 0)
    assert (row.anomaly_rate_percent, row.risk_level, row.channel_breakdown) == (0.0, "low", {})
    assert row.actions == [*evidence.STANDING_ACTIONS, evidence.SAMPLE_ACTION]


def test_role_detection_prefers_earlier_candidates(spark):
    table = spark.createDataFrame([], "`Value` int, `Order-Amount` int, `Sales Channel` string, `Type` string, UNITS int")
    roles = evidence.detect_roles(table)
    assert (roles.amount, roles.channel, roles.category, roles.quantity, roles.anomaly) == (
        "Order-Amount",
        "Sales Channel",
        "Type",
        "UNITS",
        None,
    )


def test_without_an_amount_every_row_is_anomalous(spark):
    row = evidence.rate_risk(evidence.profile(spark.range(4).withColumn("channel", F.lit("x")))).first()
    assert (row.anomaly_count, row.risk_level) == (4, "high")


def test_breakdown_keeps_six_and_breaks_ties_by_value(spark):
    names = ["g", "f", "e", "d", "c", "b", "a", "a"]
    table = spark.createDataFrame([(1, n) for n in names], "amount int, channel string")
    row = evidence.profile(table).first()
    assert list(row.channel_breakdown.items()) == [("a", 2), ("b", 1), ("c", 1), ("d", 1), ("e", 1), ("f", 1)]
    assert row.category_breakdown == {"unknown": 8}


def test_medium_risk_and_split(spark):
    table = spark.range(20).select(F.lit(1).alias("amount"), (F.col("id") == 3).alias("is_error"))
    profiled = evidence.profile(table)
    rated = evidence.rate_risk(profiled).first()
    assert (rated.anomaly_rate_percent, rated.risk_level, rated.review_note) == (5.0, "medium", evidence.MONITOR_NOTE)
    assert evidence.anomaly_split(profiled).first() == (19, 1)


NUMBERS = [
    ("12", 12.0, 12),
    (" -3.9 ", -3.9, -3),
    ("1e3", 1000.0, 1000),
    ("1_000", 1000.0, 1000),
    ("5d", 0.0, 7),
    ("abc", 0.0, 7),
    ("", 0.0, 7),
    (None, 0.0, 7),
    ("inf", float("inf"), 7),
]


def test_lenient_numbers(spark):
    table = spark.createDataFrame([(n[0],) for n in NUMBERS], "v string")
    dtype = table.schema["v"].dataType
    row = table.select(safe_float(F.col("v"), dtype).alias("f"), safe_int(F.col("v"), dtype, 7).alias("i")).collect()
    assert [(r.f, r.i) for r in row] == [(f, i) for _, f, i in NUMBERS]


def test_truthy(spark):
    table = spark.createDataFrame([(" Yes\t",), ("1",), ("1.0",), ("ANOMALY",), ("no",), (None,)], "v string")
    flags = [r[0] for r in table.select(truthy(F.col("v"), table.schema["v"].dataType)).collect()]
    assert flags == [True, True, False, True, False, False]


TEXTS = [
    ("Total due: $1,234.50 and 99", 1234.5, False),
    ("paid 1,234 today", 1.0, False),
    ("€ 12.345 URGENT", 12.34, True),
    ("reference 20240115", 20240115.0, False),
    ("no number, some Risk", 0.0, True),
    (" \n\t", 0.0, False),
    (None, 0.0, False),
]


def test_text_records(spark):
    table = spark.createDataFrame([(i, t[0]) for i, t in enumerate(TEXTS)], "id int, body string")
    rows = evidence.text_records(table, "id", "body").orderBy("document_page").collect()
    assert [(r.order_amount, r.is_anomaly) for r in rows] == [(amount, risky) for _, amount, risky in TEXTS]
    assert rows[5].text_excerpt == rows[6].text_excerpt == evidence.NO_TEXT_NOTE
    assert rows[0].text_excerpt == TEXTS[0][0]


def test_signals_read_the_whole_text_and_the_excerpt_does_not(spark):
    text = "  " + "x" * 2000 + " 42.00 failed"
    row = evidence.text_records(spark.createDataFrame([(1, text)], "id int, body string"), "id", "body").first()
    assert (row.order_amount, row.is_anomaly, row.text_excerpt) == (42.0, True, "x" * 900)
