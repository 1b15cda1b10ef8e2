"""Just beyond limits that the operators once had."""

import gzip
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR
from tests.oracle import connect, differences
from tidewatch.llm import decontam, langid, pii, queries, toxicity, warc
from tidewatch.llm.sql import ORACLE_SQL


@pytest.mark.parametrize("text,letter", [("½", False), ("² ①", False), ("12 ٣ Ⅷ", False), ("_", False), ("½ a", True), ("漢", True), ("", False), (None, False)])
def test_numerals_are_no_letters(text, letter):
    assert langid.has_letter(text) is letter


def _record(number, size):
    body = np.random.default_rng(number).bytes(size)
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:{number}>\r\nContent-Length: {len(body)}\r\n\r\n"
    return gzip.compress(head.encode() + body + b"\r\n\r\n", 1)


def test_reading_archives_is_linear():
    def seconds(n):
        raw = b"".join(_record(i, 10_000) for i in range(n))
        start = time.perf_counter()
        assert len(warc.salvage(raw).records) == n
        return time.perf_counter() - start

    seconds(50)
    assert seconds(1600) <= 6 * seconds(400) + 0.2


def test_members_of_many_chunks():
    raw = _record(1, 3 * warc.CHUNK + 7) + _record(2, 10) + _record(3, warc.CHUNK)
    assert [len(block) for _, _, block in warc.salvage(raw).records] == [3 * warc.CHUNK + 7, 10, warc.CHUNK]
    assert warc.salvage(raw[:-1]).records[-1][1]["warc-record-id"] == "<urn:2>"


@pytest.mark.parametrize("words,shingles", [(5, 1), (6, 2), (9, 5)])
def test_short_items_are_found_in_long_texts(words, shingles):
    rng = np.random.default_rng(words)
    items, texts = [], []
    for i in range(150):
        item = [f"i{i}x{j}" for j in range(words)]
        filler = [f"w{x}" for x in rng.integers(0, 10**6, 400)]
        at = int(rng.integers(0, 400))
        items.append((i, " ".join(item)))
        texts.append(" ".join([*filler[:at], *item, *filler[at:]]))
    index = decontam.Index.of(items)
    hashes = decontam._Hashes()
    assert [index.matches(t, hashes, decontam.CONTAINMENT) for t in texts] == [[(i, shingles, shingles)] for i in range(150)]


def test_long_secrets_are_covered_whole(spark):
    token, digits, number = "aB3" * 40, "0123456789abcdef" * 6, "1234 " * 9 + "56"
    text = f"token={token} and {digits} and {number}."
    found = spark.createDataFrame([(text,)], "text string").select(F.expr(f"regexp_extract_all(text, {pii_literal(pii.CANDIDATE)}, 0)")).first()[0]
    assert [f"token={token}", digits, number] == found


def pii_literal(pattern):
    return "r'" + pattern.replace("'", "\\x27") + "'"


def test_missing_texts_and_labels_of_one_kind_drop_nothing(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    odd = docs.limit(1).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(10**6).cast("long"))
    mostly = labels.withColumn("toxic", F.when(F.col("doc_id") % 9 == 0, 0).otherwise(1))
    kept = toxicity.without_toxic(docs.unionByName(odd), toxicity.train(docs, mostly))
    assert kept.filter("doc_id = 1000000").count() == 1
    for label in (0, 1):
        one = toxicity.train(docs, labels.withColumn("toxic", F.lit(label)))
        assert toxicity.without_toxic(docs, one).count() == docs.count()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    result = queries.QUERIES[name](spark, SF_DIR).toArrow()
    assert differences(result, connect(SF_DIR).sql(ORACLE_SQL[name]).to_arrow_table()) == []
