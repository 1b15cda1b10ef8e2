"""Repeated byte strings against a brute-force version."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from tidewatch.llm import repeats


def brute_force(rows, length):
    first = {}
    for doc_id, text in rows:
        data, doc_id = (text or "").encode(), float("inf") if doc_id is None else doc_id
        for i in range(len(data) - length + 1):
            first[data[i : i + length]] = min(first.get(data[i : i + length], doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        data, gone = (text or "").encode(), set()
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < (float("inf") if doc_id is None else doc_id):
                gone.update(range(i, i + length))
        spans = sum(1 for i in gone if i - 1 not in gone)
        out.append((doc_id, len(data), len(gone), spans, bytes(b for i, b in enumerate(data) if i not in gone)))
    return sorted(out, key=repr)


def symbols(*texts):
    return np.array(sorted(bytes(b + 1 for b in t) for t in texts), "S90")


def test_merged_transforms_sort_all_suffixes():
    rng = random.Random(3)
    strings = symbols(*{bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40))) for _ in range(60)})
    shards = [repeats.transform(strings[a : a + 13], a) for a in range(0, len(strings), 13)]
    row, block, common = repeats.merge(shards, 12)
    name = [np.concatenate([getattr(s, k) for s in shards])[row] for k in ("string", "at")]
    prefixes = [(bytes(strings[i]) + b"\0" * 90)[a:][:12] for i, a in zip(*name)]
    cut = [p.split(b"\0")[0] for p in prefixes]
    whole = [i for i, p in enumerate(cut) if len(p) == 12]
    assert [cut[i] for i in whole] == sorted(cut[i] for i in whole)
    for i, j in zip(whole, whole[1:]):
        assert (block[i] == block[j]) == (cut[i] == cut[j])
        if j == i + 1:
            shared = next((k for k in range(12) if cut[i][k] != cut[j][k]), 12)
            assert common[j] == shared


def test_interval_minima(monkeypatch):
    monkeypatch.setattr(repeats, "SHARD", 100)
    rng = random.Random(5)
    texts = sorted({bytes(rng.choice(b"ab") for _ in range(rng.randint(8, 30))) for _ in range(40)})
    strings, values = symbols(*texts), np.arange(len(texts))[::-1].copy()
    for find in (repeats.interval_minima, repeats.window_minima):
        for text, low in zip(texts, find(strings, values, 8), strict=True):
            for i, value in enumerate(low):
                assert value == min(v for t, v in zip(texts, values) if text[i : i + 8] in t)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(repeats, "STRETCH", 100)
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(20) for _ in range(6)]
    rows = [(None, passages[0]), (None, "x" * 200), (3, "x" * 120), (900, ""), (901, None), (902, "short")]
    for i in range(60):
        parts = [prose(rng.randint(1, 15)) if rng.random() < 0.6 else rng.choice(passages)[rng.randint(0, 20) :] for _ in range(rng.randint(1, 6))]
        rows.append((i * 7 % 61, "\n".join(parts)))
    rows += [rows[10], (500, rows[10][1]), (501, rows[10][1][5:]), (502, "ab " * 300), (499, "ab " * 200)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, batch long")
    got = repeats.remove_repeats(docs).collect()
    found = [(r.doc_id, len(r.kept) + sum(s.end - s.start for s in r.removed), sum(s.end - s.start for s in r.removed), len(r.removed), bytes(r.kept)) for r in got]
    assert sorted(found, key=repr) == brute_force(rows, repeats.LENGTH)


def _in_own_contexts(n, rng):
    """A passage in each of n documents, with a context of its own on both sides."""
    prose = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    passage = prose(150)
    return [(i, prose(rng.randint(60, 90)) + passage[rng.randint(0, 3) :] + prose(rng.randint(60, 90))) for i in range(n)]


@pytest.mark.parametrize("hot", [1, 12])
def test_cut_up_anchors_against_brute_force(spark, monkeypatch, hot):
    """Anchors with more segments than ``HOT`` give the same spans window by window."""
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = _in_own_contexts(60, random.Random(4))
    rows += [(None, rows[3][1][40:]), (None, rows[3][1]), (7, rows[9][1]), (70, None), (71, rows[5][1] * 2)]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = [(r.doc_id, len(r.kept) + sum(s.end - s.start for s in r.removed), sum(s.end - s.start for s in r.removed), len(r.removed), bytes(r.kept)) for r in got]
    assert sorted(found, key=repr) == brute_force(rows, repeats.LENGTH)


def test_a_common_passage_is_spread_over_buckets():
    """The segments at the edges of a passage, one a document, do not all go to the buckets of a few anchors."""
    rows, buckets = _in_own_contexts(1200, random.Random(6)), 64
    tables = [
        pa.table({"batch": pa.array([b] * 150, pa.int64()), "doc_id": [r[0] for r in part], "body": pa.array([r[1].encode() for r in part], pa.binary())})
        for b, part in enumerate(rows[i : i + 150] for i in range(0, 1200, 150))
    ]

    def largest(hot):
        said = pa.concat_tables(repeats._announce(buckets, 50)(t) for t in tables)
        by_bucket = [said.filter(pa.compute.equal(said["bucket"], b)) for b in range(buckets)]
        shared = pa.concat_tables(repeats._find_shared(hot)(t) for t in by_bucket if t.num_rows)
        sizes = np.zeros(buckets)
        for b, t in enumerate(tables):
            sent = repeats._send_segments(buckets, 50)(t, shared.filter(pa.compute.equal(shared["batch"], b)))
            np.add.at(sizes, sent["bucket"].to_numpy(), [len(p) for p in sent["payload"].to_pylist()])
        return sizes.max() / sizes.mean()

    assert largest(1 << 40) > 8
    assert largest(100) < 2


def test_runs_do_not_depend_on_how_many_strings_are_looked_at_together(monkeypatch):
    """Strings of different keys share no window; a key's strings are looked at together."""
    rng = random.Random(8)
    strings = symbols(*{bytes(97 + 2 * k + rng.randint(0, 1) for _ in range(rng.randint(8, 30))) for k in range(6) for _ in range(rng.choice([1, 5, 100]))})
    values, keys = np.arange(len(strings))[::-1].copy(), np.array([(s[0] - 98) // 2 for s in strings.tolist()], np.uint32)
    whole = repeats._runs(strings, values, keys, 8)
    for chunk, size, sorted_at_once in ((1, 3, 50), (30, 7, 1000), (70, 1000, 7)):
        for name, value in (("CHUNK", chunk), ("ROWS", size), ("SORTED", sorted_at_once)):
            monkeypatch.setattr(repeats, name, value)
        assert all((a == b).all() for a, b in zip(whole, repeats._runs(strings, values, keys, 8), strict=True))
    low = repeats.window_minima(strings, values, 8)
    assert len(low) == len(strings)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove_repeats(docs).count() == 0
