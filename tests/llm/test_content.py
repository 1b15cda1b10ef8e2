"""Packing, archives, language, personal data and toxicity."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.llm import langid, packing, pii, tokens, toxicity, warc
from tests.llm.conftest import SF_DIR


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def _ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


@settings(deadline=None, max_examples=150)
@given(st.text(alphabet=st.sampled_from(list("aZé ß'\n\t 0.!- 　漢😀st")), max_size=60))
def test_ids_are_those_of_the_tokenizer(text):
    names = [public_tokenizers.path(n) for n in packing.VOCABULARY]
    encoder = tokens.encoder(*names)
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == encoder.slow.encode(text, add_special_tokens=False).ids


def test_packing(corpus, rows, nothing, tokenizer):
    found = packing.pack(corpus).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    expected = Counter()
    for doc_id, text in rows:
        expected[doc_id] += len(_ids(tokenizer, text))
    assert {d: sum(r.length for r in p) for d, p in by_doc.items()} == expected
    for doc_id, text in rows:
        ids = np.array(_ids(tokenizer, text), "<u4")
        parts = sorted({(r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[doc_id]})
        assert sum(n for _, n, _, _ in parts) == len(ids)
        for start, length, crc, n in parts:
            assert n == len(ids) and crc == zlib.crc32(ids[start : start + length].tobytes())
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= packing.SEQUENCE
    assert len(by_sequence) <= 1.01 * sum(expected.values()) / packing.SEQUENCE + 1
    assert packing.pack(nothing).count() == 0


def test_column_generation_beats_the_first_patterns():
    lengths, counts = np.array([51, 37, 27]), np.array([97, 610, 395])
    basis, times = packing.solve(lengths, counts, 100, 0.0)
    assert np.allclose(basis @ times, counts) and (lengths @ basis <= 100).all()
    assert times.sum() <= packing.first_patterns(lengths, counts, 100)[1].dot(counts).sum() + 1e-9
    todo = packing.plan(dict(zip(lengths.tolist(), counts.tolist())), 100)
    assert todo.sequences <= np.ceil(times.sum()) + 1


# --- archives ---


def test_round_trip(spark):
    pages = spark.createDataFrame(
        [(1, "http://a", "x"), (2, "http://b", "x"), (3, None, None), (4, "u v", ""), (5, "c", "é\r\n\r\nWARC/1.1\r\n"), (2, "again", "x"), (None, "n", "x"), (None, "n", "alone")],
        "page_id long, url string, html string",
    ).withColumn("size", F.lit(1))
    got = Counter(tuple(r) for r in warc.round_trip(pages).collect())
    expected = Counter()
    for r in pages.collect():
        body = (r.html or "").encode()
        newest = max((p.page_id for p in pages.collect() if (p.html or "") == (r.html or "") and p.page_id is not None), default=None)
        older = newest is not None and newest != r.page_id
        expected[r.page_id, len(body), warc.digest(body), "revisit" if older else "response", newest if older else None] += 1
    assert got == expected
    assert warc.round_trip(pages.limit(0)).count() == 0
    assert {r.record_type for r in warc.round_trip(pages, min_bytes=100).collect()} == {"response"}


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    made = [warc.record("response", i, f"u{i}", f"body {i} ".encode() * 50, warc.digest(f"body {i} ".encode() * 50), None) for i in range(6)]
    parts = [warc.member(r) if packed else r for r in made]
    whole = b"".join(parts)
    assert len(warc.salvage(whole).records) == 6 and not warc.salvage(whole).gaps
    starts = np.cumsum([0, *map(len, parts)])
    hurt = bytearray(whole)
    middle = (starts[2] + starts[3]) // 2
    hurt[middle] ^= 0xFF
    found = warc.salvage(bytes(hurt))
    assert [h["warc-record-id"] for _, h, _ in found.records] == [f"<urn:page:{i}>" for i in (0, 1, 3, 4, 5)]
    assert [(a, b) for a, b, _ in found.gaps] == [(starts[2], starts[3])]
    cut = warc.salvage(whole[: starts[5] + 10])
    assert len(cut.records) == 5 and cut.gaps[0][:2] == (starts[5], starts[5] + 10)
    junk = warc.salvage(b"junk" + whole[: starts[1]] + b"\x1f\x8b\x08more" + whole[starts[1] :])
    assert len(junk.records) == 6 and len(junk.gaps) == 2


def test_quarantine(spark, tmp_path):
    good = warc.member(warc.record("response", 1, "u", b"x", warc.digest(b"x"), None))
    (tmp_path / "a.warc.gz").write_bytes(b"bad" + good)
    assert [(r.start, r.end) for r in warc.quarantine(spark, str(tmp_path)).collect()] == [(0, 3)]
    assert warc.read_archives(spark, str(tmp_path)).head().payload == b"x"


# --- language ---


def test_forward_algorithm_sums_all_segmentations():
    pieces = ["", "▁", "a", "b", "ab", "▁a", "▁ab", "ba"]
    model = langid.build(pieces, {"x": np.array([0, 5, 4, 3, 2, 2, 1, 6]), "y": np.array([0, 1, 9, 1, 1, 1, 1, 1])}, {"x": 1, "y": 3})

    def total(word, language):
        p = {piece: model.probabilities[i, language] for i, piece in enumerate(pieces) if piece}
        sums = [1.0] + [0.0] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(end):
                piece = word[start:end]
                sums[end] += sums[start] * p.get(piece, langid.UNKNOWN if len(piece) == 1 else 0)
        return np.log(sums[-1])

    words = ["▁ab", "▁abba", "▁", "▁aQb", "ba"]
    assert np.allclose(model.word_scores(words), [[total(w, j) for j in range(2)] for w in words])


def test_languages(corpus, rows, nothing):
    model = langid.train(corpus)
    found = langid.predict(corpus, model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    undetermined = {r.doc_id for r in found if r.lang_pred == "und"}
    assert undetermined == {100_000, 100_001, 100_002}
    truth = {r.doc_id: r.lang for r in corpus.collect()}
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 100_000]
    assert held and np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found if r.doc_id is not None)
    assert langid.identify(nothing).count() == 0
    assert {r.lang_pred for r in langid.identify(corpus.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# --- personal data ---

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def _plain_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            passes = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and _luhn(digits), "phone": 10 <= len(digits) <= 15,
            }
            if passes[kind]:
                found.append((m.start(), rank, kind, m.end()))
    return sorted(found)


def test_personal_data(spark, corpus, nothing):
    awkward = [
        "a@b.c_d@e.f.g x@y @z.w a@b..c 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3.99999999999999999999",
        "4111 1111 1111 1111, 4111-1111-1111-1111 5 4111111111111111 41111111111111111111111 4111  1111 1111 1111",
        "+1 (234) 555-0000. ++12 34567890 +123 +1234567890123456 +49-30-1234567-", "é😀 a@b.de 😀1.1.1.1 password=abc123def", "%%@@a.b@c.d@e.f-.g", "1" * 500 + "." + "2." * 50, None, "",
    ]
    docs = corpus.select("doc_id", "text", "fp").unionByName(spark.createDataFrame([(200_000 + i, t, 1) for i, t in enumerate(awkward)], "doc_id long, text string, fp long"))
    found = pii.find(docs, pii.train(docs)).collect()
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text)
    assert len(found) == docs.count()
    for r in found:
        base = [tuple(s) for s in r.base]
        assert base in [_plain_spans(t) for t in texts[r.doc_id]]
        assert [tuple(s) for s in r.spans if s.rank < 4] == base
    assert any(s.rank == 4 for r in found for s in r.spans)
    assert pii.find(nothing, pii.train(nothing)).count() == 0


def test_estimate_finds_the_reliable_labeler():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.3
    good = np.where(rng.random(4000) < 0.95, truth, ~truth) * 2 - 1
    fair = np.where(rng.random(4000) < 0.8, truth, ~truth) * 2 - 1
    poor = np.where(rng.random(4000) < 0.7, truth, ~truth) * 2 - 1
    noise = rng.choice([-1, 0, 1], 4000)
    votes, counts = np.unique(np.stack([good, fair, poor, noise], axis=1), axis=0, return_counts=True)
    chance, prior, posterior = pii.estimate(votes, counts.astype(float))
    assert abs(prior - 0.3) < 0.1 and chance[1, 0, 2] > chance[1, 1, 2] > chance[1, 2, 2] > chance[1, 3, 2]


# --- toxicity ---


def test_block_max_search_is_exact():
    rng = np.random.default_rng(4)
    idf = rng.uniform(0.5, 3, 40)
    counts = [{int(t): int(n) for t, n in zip(rng.choice(40, rng.integers(0, 8), replace=False), rng.integers(1, 5, 8))} for _ in range(500)]
    vectors = [toxicity.weights(c, idf) for c in counts]
    index = toxicity.Index.of(vectors, np.arange(500), rng.integers(0, 2, 500), 40)
    ranked = [vectors[i] for i in index.ids]
    for query in vectors[:60]:
        plain = sorted(((round(sum(w * v.get(t, 0) for t, w in query.items()), 9), -p) for p, v in enumerate(ranked)), reverse=True)
        expected = [s for s, _ in plain if s > 0][: toxicity.NEIGHBOURS]
        assert np.allclose([c for c, _ in index.nearest(query)], expected, atol=1e-8)


def test_toxicity(spark, corpus, rows, nothing):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(3000).cache(), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.train(docs, labels)
    found = toxicity.score(docs, model).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    hits = sum(r.predicted and r.toxic for r in held)
    assert hits >= 0.75 * sum(r.toxic for r in held) and hits >= 0.75 * sum(r.predicted for r in held)
    scored = toxicity.score(corpus, model).collect()
    assert Counter(r.doc_id for r in scored) == Counter(d for d, _ in rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored)
    clean = toxicity.without_toxic(corpus, model)
    assert clean.columns == corpus.columns and Counter(r.doc_id for r in clean.collect()) == Counter(r.doc_id for r in scored if not r.predicted)
    unlabelled = toxicity.train(corpus, spark.read.parquet(f"{SF_DIR}/labels.parquet").limit(0))
    assert {r.score for r in toxicity.score(corpus, unlabelled).collect()} == {0.0}
    assert toxicity.score(nothing, model).count() == 0


# --- pipeline ---


def test_pipeline_stages(spark, rows):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing"]
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, corpus_pipeline.staged(stage(spark, kept, SF_DIR), "test")
        assert kept.columns == docs.columns and kept.count() <= before.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR)
    columns = packed.columns
    assert Counter(map(tuple, packed.collect())) == Counter(map(tuple, corpus_pipeline.run(spark, SF_DIR).select(columns).collect()))
