import pytest

from tidewatch.operators.quality import lenient_clean, quarantined_events, valid_events
from tidewatch.rules import STRICT_GATE, QualityRules

REASON_CASES = [
    ({"event_type": "syslog_blob"}, "unknown_event_type"),
    ({"event_type": ""}, "unknown_event_type"),
    ({"outcome": "weird"}, "unknown_outcome"),
    ({"actor_id": ""}, "missing_actor"),
    ({"actor_id": "   "}, "missing_actor"),
    ({"actor_id": None}, "missing_actor"),
    ({"target_system": None}, "missing_target"),
    ({"target_system": "  "}, "missing_target"),
    ({"bytes_out": -1}, "bytes_out_out_of_range"),
    ({"bytes_out": 10_000_000_001}, "bytes_out_out_of_range"),
    ({"http_status": 99}, "invalid_http_status"),
    ({"http_status": 600}, "invalid_http_status"),
    ({"event_time": "not-a-time"}, "unparseable_event_time"),
    ({"event_time": None}, "unparseable_event_time"),
]


def test_normalises_and_accepts_an_ordinary_event(processed):
    row = processed({"actor_email": " Sam@Mail.TEST ", "target_system": " Vault-7 ", "source_country": "pt "}).first()
    assert (row.quality_status, row.quality_failure_reason) == ("valid", "")
    assert row.actor_email == "sam@mail.test"
    assert row.target_system == "vault-7"
    assert row.source_country == "PT"
    assert row.event_hour == 9
    assert (row.is_anomaly, row.severity, row.severity_rank, row.mitre_tactic) == (False, "NONE", 0, None)


def test_every_reason(processed):
    cases = [{**override, "event_id": str(i)} for i, (override, _) in enumerate(REASON_CASES)]
    rows = {row.event_id: row for row in processed(*cases).collect()}
    for i, (_, reason) in enumerate(REASON_CASES):
        assert (rows[str(i)].quality_status, rows[str(i)].quality_failure_reason) == ("invalid", reason)


@pytest.mark.parametrize(
    "override",
    [{"bytes_out": 0}, {"bytes_out": 10_000_000_000}, {"http_status": 100}, {"http_status": 599}, {"http_status": None}],
)
def test_bounds_are_inclusive_and_status_is_optional(processed, override):
    assert processed(override).first().quality_status == "valid"


def test_reasons_keep_their_order(processed):
    row = processed(
        {"event_type": "x", "outcome": "x", "actor_id": None, "target_system": "", "bytes_out": -1, "http_status": 0, "event_time": ""}
    ).first()
    assert row.quality_failure_reason == (
        "unknown_event_type,unknown_outcome,missing_actor,missing_target,bytes_out_out_of_range,"
        "invalid_http_status,unparseable_event_time"
    )


@pytest.mark.parametrize(
    "column,flag,reason",
    [
        ("event_type", "is_valid_event_type", "unknown_event_type"),
        ("outcome", "is_valid_outcome", "unknown_outcome"),
        ("bytes_out", "is_valid_bytes", "bytes_out_out_of_range"),
    ],
)
def test_null_input_is_invalid_without_a_reason_unless_strict(processed, column, flag, reason):
    row = processed({column: None}).first()
    assert (row[flag], row.quality_status, row.quality_failure_reason) == (None, "invalid", "")
    strict = processed({column: None}, gate=STRICT_GATE).first()
    assert (strict[flag], strict.quality_status, strict.quality_failure_reason) == (False, "invalid", reason)


def test_split_is_complete(processed):
    rows = processed({}, {"bytes_out": None}, {"actor_id": ""})
    assert valid_events(rows).count() == 1
    assert quarantined_events(rows).count() == 2


@pytest.mark.parametrize(
    "override,status",
    [
        ({"bytes_out": 10_000_000_001}, "valid"),
        ({"http_status": 999}, "valid"),
        ({"target_system": ""}, "valid"),
        ({"target_system": None}, "invalid"),
        ({"actor_id": None}, "invalid"),
        ({"bytes_out": None}, "invalid"),
        ({"event_time": "x"}, "invalid"),
    ],
)
def test_lenient_gate(events, override, status):
    row = lenient_clean(events(override)).first()
    assert row.quality_status == status
    assert "quality_failure_reason" not in row


def test_parameters_replace_the_defaults(processed):
    gate = QualityRules(event_types=("login's",), max_bytes_out=10)
    row = processed({"event_type": "Login's", "bytes_out": 11}, gate=gate).first()
    assert row.quality_failure_reason == "bytes_out_out_of_range"
