"""Evidence files read in many splits, against Spark's own reader of whole files and Python's."""

import csv
import io
import json
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidewatch.sources import splits
from tidewatch.sources.evidence_files import load_evidence, read_csv_evidence, read_json_evidence


@pytest.fixture
def small_splits(spark):
    """Files are cut into splits of this many bytes."""

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield cut
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


BODIES = ["q", "two\nlines", 'say ""hi""', "a,b", "\n\n", '""', 'tail ""', 'l1\nl2,""x""\nl3\n' * 8, "", "\\"]


def _csv_text(rng, n, end):
    def field():
        if rng.random() < 0.5:
            return rng.choice(["a", "b c", "", "x\\", "1.5", "é", 'mid"dle'])
        return f'"{rng.choice(BODIES)}"'

    return end.join(["h1,h2,\"h,3\"", *(",".join(field() for _ in range(3)) for _ in range(n))])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [300, 4000])
def test_csv_in_splits_equals_whole_files(spark, tmp_path, small_splits, end, size):
    path = str(tmp_path / "x.csv")
    n = 60 if size < 1000 else 800
    with open(path, "w", newline="") as file:
        file.write(("﻿" if end == "\n" else "") + _csv_text(random.Random(size), n, end) + end)
    expected = [tuple(r) for r in spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).na.fill("").collect()]
    small_splits(size)
    assert splits.chunks(spark, path, "\n").rdd.getNumPartitions() > 4
    found = read_csv_evidence(spark, path)
    assert found.columns == ["h1", "h2", "h,3"] and len(expected) == n
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert [tuple(r) for r in load_evidence(spark, path, limit=25).collect()] == expected[:25]


def test_csv_of_several_files(spark, tmp_path, small_splits):
    """Each file has its header; blank lines are no records; one field is longer than many splits; the last line has no end."""
    long = "line\n" * 400
    for name, text in {"a.csv": f'k,v\n\n1,"{long}"\n\n2,b', "b.csv": 'k,v\n3,"x\n"\n', "c.csv": "k,v\n"}.items():
        (tmp_path / name).write_text(text)
    small_splits(100)
    assert sorted(map(tuple, read_csv_evidence(spark, str(tmp_path)).collect())) == [("1", long), ("2", "b"), ("3", "x\n")]


@given(st.lists(st.lists(st.text(alphabet='a"\n, ', max_size=6), min_size=1, max_size=3), min_size=1, max_size=6), st.integers(0, 60))
def test_quote_maps_compose(rows, cut):
    """The map of a file is the maps of its parts, one after the other, and properly quoted text ends outside."""
    text = io.StringIO()
    csv.writer(text, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows(rows)
    lines = text.getvalue().split("\n")
    first, second = splits._csv_map(iter(lines[:cut])), splits._csv_map(iter(lines[cut:]))
    whole = splits._csv_map(iter(lines))
    assert whole == tuple(second[state] for state in first)
    assert whole[0] is False


def _document(rng, n):
    odd = ["a", "}{][", 'q"uo\\te', "\\", 'x"}]', "é\n", '"events": [', "\\\\}"]
    return [{"id": i, "t": rng.choice(odd), "n": {"x": [{"y": 1}, {"y": rng.choice(odd)}]}, "f": rng.choice([None, 1.5])} for i in range(n)]


@pytest.mark.parametrize("shape", ["array", "indented", "object", "object only"])
def test_json_in_splits_equals_whole_documents(spark, tmp_path, small_splits, shape):
    records = _document(random.Random(7), 400)
    whole = {"meta": {"a": {"b": [{"z": 1}, {"z": 2}]}, "events": [{"id": -3}]}, "events": records, "tail": [{"id": -1}, {"id": -2}]}
    text = {"array": json.dumps(records), "indented": json.dumps(records, indent=1) + "\n", "object": json.dumps(whole), "object only": json.dumps({"events": records}) + "\n\n"}[shape]
    path = tmp_path / "x.json"
    path.write_text(text)
    expected = spark.read.option("multiLine", True).json(str(path))
    if shape.startswith("object"):
        expected = expected.selectExpr("inline(events)")
    expected = expected.toJSON().collect()
    small_splits(3000)
    assert splits.chunks(spark, str(path), "}").rdd.getNumPartitions() > 4
    assert read_json_evidence(spark, str(path)).toJSON().collect() == expected
    assert load_evidence(spark, str(path), limit=30).toJSON().collect() == expected[:30]


def test_a_record_longer_than_a_split(spark, tmp_path, small_splits):
    records = [{"id": i, "n": [{"k": j, "s": "}" * (j % 3)} for j in range(200)]} for i in range(3)]
    (tmp_path / "x.json").write_text(json.dumps({"events": records}))
    small_splits(400)
    assert [r.asDict(True) for r in read_json_evidence(spark, str(tmp_path / "x.json")).collect()] == records


def test_documents_without_records(spark, tmp_path):
    for name, text in {"one": '{"a": 1, "b": {"c": 2}}', "none": "[]", "no events": '{"events": []}'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    assert [r.asDict(True) for r in read_json_evidence(spark, str(tmp_path / "one.json")).collect()] == [{"a": 1, "b": {"c": 2}}]
    assert read_json_evidence(spark, str(tmp_path / "none.json")).count() == 0
    assert read_json_evidence(spark, str(tmp_path / "no events.json")).count() == 0


GOOD = json.dumps([{"a": 1}, {"a": 2, "b": {"c": [1, 2]}}])


@pytest.mark.parametrize("text", [GOOD[:-1], GOOD[:-9], '[{"a":1} {"a":2}]', '[{"a":1},{"a":}]', '[{"a":1}]]', '[{"a":1},5]', '{"events": [{"a":1}', '[{"a":1},]', '{"events": [{"a":1}]} x'])
def test_malformed_documents_are_errors(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(Exception, match="(?i)json|malformed|balanced|objects"):
        read_json_evidence(spark, str(tmp_path / "x.json")).collect()
