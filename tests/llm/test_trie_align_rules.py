"""The conversation trie, token alignment and quality rules against brute force."""

import bisect
import hashlib
import random
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

from tests.llm.conftest import SF_DIR
from tests.oracle import connect, differences
from tidewatch.llm import align, quality_rules, queries, tries
from tidewatch.llm.common import table

# --- conversation trie ---


def _conversations(rows):
    """Turns (role, text) of each conversation, in order."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, digest, role, text))
    return {conv: [t[3:] for t in sorted(found)] for conv, found in turns.items()}


def _grafted(turns):
    out = {}
    for conv, own in turns.items():
        heads = zlib.crc32(str(conv).encode()) % 6
        base = conv - (abs(conv) % 100) * (1 if conv >= 0 else -1)
        out[conv] = turns.get(base, [])[:heads] + own[heads:]
    return out


def _trie(paths):
    members, ended = defaultdict(list), defaultdict(list)
    for conv, path in paths.items():
        path = tuple(path)
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
        ended[path].append(conv)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for path, convs in members.items():
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += children[path] == 0
            saved[path[:depth]] += (len(convs) - 1) * (len(path[-1][1]) if path else 0)
    return Counter(
        (
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), children[path], leaves[path], saved[path],
            hashlib.sha256(",".join(map(str, sorted(ended[path]))).encode()).hexdigest(),
        )
        for path, convs in members.items()
    )


def _made(seed, n, depth=6, letters="ab"):
    """Conversations that share much: many equal ones, prefixes of each other, two long ones that part late."""
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        length = rng.choice([1, 1, 2, 3, depth])
        rows += [(conv, t, rng.choice(["user", "user", None]), rng.choice([*letters, "", None, "longer text é"])) for t in range(length)]
    for conv in range(n, 2 * n):
        rows += [(conv, t, "user", "same") for t in range(3)]
    for conv in (2 * n, 2 * n + 1):
        rows += [(conv, t, "user", "deep") for t in range(300)] + [(conv, 300, "user", str(conv))]
    rng.shuffle(rows)
    return rows


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("batch", [7, 10_000])
def test_trie(spark, batch):
    rows = _made(3, 150)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        assert _rows(tries.prefix_trie(tries.turn_lists(frame))) == _trie(_conversations(rows))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_trie_merges_many_partitions(spark):
    """More partitions than are merged in one step, most of them inside one group of equal conversations."""
    rows = _made(4, 120)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "70")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _rows(tries.prefix_trie(tries.turn_lists(frame))) == _trie(_conversations(rows))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_trie_of_awkward_rows(spark):
    schema = "conv_id long, turn long, role string, text string, path long, turns string, part int, head int"
    rows = [
        (1, 0, "user", "a"), (1, None, "user", "first"), (1, 0, "user", "a"), (None, 0, "user", "a"), (2, None, None, None), (2, None, "", ""),
        (-7, 5, "x", "ab"), (-8, 5, "xa", "b"), (3, 1, None, "long " * 20_000), (4, 1, None, "long " * 20_000), (300, 0, "u", "only"), (301, 0, "u", "x"), (306, 9, "u", "y"),
    ]
    frame = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], schema)
    turns = _conversations(rows)
    assert _rows(tries.prefix_trie(tries.turn_lists(frame))) == _trie(turns)
    c = F.col("conv_id")
    grafted = tries.grafted(tries.turn_lists(frame), c - c % 100, F.crc32(c.cast("string").cast("binary")) % 6, 5)
    assert any(not path for path in _grafted(turns).values())
    assert _rows(tries.prefix_trie(grafted)) == _trie(_grafted(turns))
    assert tries.prefix_trie(tries.turn_lists(frame.limit(0))).count() == 0


def test_trie_query(spark):
    rows = [tuple(r) for r in table(spark, SF_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert _rows(queries.QUERIES["op11_conversation_trie"](spark, SF_DIR)) == _trie(_grafted(_conversations(rows)))


def test_trie_matches_sql(spark):
    result = queries.QUERIES["op11_conversation_trie"](spark, SF_DIR).toArrow()
    assert differences(result, connect(SF_DIR).sql(queries.ORACLE_SQL["op11_conversation_trie"]).to_arrow_table()) == []


# --- token alignment ---


@pytest.fixture(scope="module")
def tools():
    return align._pair(*map(align.vocabulary, align.FIRST), align.vocabulary(align.SECOND))


@pytest.fixture(scope="module")
def plain():
    """The vocabularies as their own libraries read them, and the bytes of each id."""
    import sentencepiece

    first = Tokenizer.from_file(public_tokenizers.path(align.FIRST[0]))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(align.SECOND))
    return first, second


SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_OF = {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in SHOWN)}


def _groups(text, plain):
    """Groups as lists of ids of A and B, by the set of common byte offsets; none where the bytes differ."""
    if not text:
        return []
    first, second = plain
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    bytes_a = [bytes(map(BYTE_OF.get, first.id_to_token(i))) for i in a]
    pieces = [second.id_to_piece(i) for i in b]
    bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return []
    ends = [np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b)]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    out = [([], []) for _ in cuts]
    for side, ids in enumerate((a, b)):
        for number, end in zip(ids, ends[side]):
            out[bisect.bisect_left(cuts, end)][side].append(number)
    return out


def _aligned(texts, plain):
    grouped = [_groups(t, plain) for t in texts]
    linked = [Counter((a, b) for x, y in groups for a in x for b in y) for groups in grouped]
    held = Counter(pair for pairs in linked for pair in pairs)
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = []
    for groups, pairs in zip(grouped, linked):
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(pairs.values()),
            sum(n for p, n in pairs.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in pairs.items()),
            hashlib.sha256(shown.encode()).hexdigest() if groups else "",
        ))
    return out


AWKWARD = ["", None, " ", "  x  y ", "a\n\nb", "▁", "a▁b", "日本語😀", "\x00a", "½ ß ﬁ", "<|endoftext|> <s>", "</s>", "a b", "😀" * 60, "ab" * 3000, "é" * 500, "\t\r\n", "<0x41>", "..." * 50]


@settings(deadline=None, max_examples=150)
@given(st.text(alphabet=st.sampled_from(list("aZé ß'\n\t 0.!- 漢😀st▁")), max_size=60))
def test_groups_of_any_text(tools, plain, text):
    found = align.align([text, "next one", text], tools)
    groups = _groups(text, plain)
    assert found["n_groups"].tolist() == [len(groups), len(_groups("next one", plain)), len(groups)]
    assert found["groups_sha256"][0] == _aligned([text], plain)[0][-1]


def test_long_groups_make_no_more_links_than_pairs():
    a, b = np.array([1, 2] * 500 + [7]), np.array([3, 4, 3] * 300 + [8])
    docs, pairs, times = align._links(a, b, np.array([0, 1]), np.array([1000, 1]), np.array([900, 1]), 10)
    assert list(zip(docs.tolist(), pairs.tolist(), times.tolist())) == [(0, 13, 300_000), (0, 14, 150_000), (0, 23, 300_000), (0, 24, 150_000), (1, 78, 1)]


@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.lists(st.integers(1, 4), min_size=1, max_size=60))
def test_common_cuts(x, y):
    ends = [np.cumsum(side).tolist() for side in (x, y)]
    for side, other in ((0, 1), (1, 0)):  # both sides end at one place
        if ends[side][-1] < ends[other][-1]:
            ends[side].append(ends[other][-1])
    cut_a, cut_b = align.common_cuts(*ends)
    assert [ends[0][i] for i in cut_a] == [ends[1][j] for j in cut_b] == sorted(set(ends[0]) & set(ends[1]))


@pytest.mark.parametrize("broadcast", [align.BROADCAST_PAIRS, 0])
def test_alignment(spark, corpus, rows, nothing, plain, monkeypatch, broadcast):
    """The whole corpus, awkward rows included; the counts by broadcast and by shuffle."""
    monkeypatch.setattr(align, "BROADCAST_PAIRS", broadcast)
    extra = spark.createDataFrame([(200_000 + i, t) for i, t in enumerate(AWKWARD)], "doc_id long, text string")
    every = corpus.withColumn("row", F.lit(1)).withColumn("pairs", F.lit("x")).unionByName(extra, allowMissingColumns=True)
    listed = rows + [(200_000 + i, t) for i, t in enumerate(AWKWARD)]
    expected = Counter((doc, *numbers) for (doc, _), numbers in zip(listed, _aligned([t for _, t in listed], plain)))
    assert _rows(align.alignment(every)) == expected
    assert align.alignment(nothing).count() == 0


def test_alignment_query(spark):
    got = queries.QUERIES["op12_token_alignment"](spark, SF_DIR)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got.filter("n_links = 0").count() == table(spark, SF_DIR, "documents").filter("coalesce(text, '') = ''").count()


# --- quality rules ---


def _statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) if windows[words[i], words[i + 1], words[i + 2]] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(repeated)


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet=st.sampled_from(list("ab \n\t\v\r#*é  😀|")), max_size=80))
def test_statistics_of_any_text(text):
    assert quality_rules.statistics(text)[:5] == _statistics(text)


def test_judged_statistics(spark, corpus, rows, nothing):
    rules = (quality_rules.Rule((quality_rules.Condition("symbols_a_word", True, 0.2), quality_rules.Condition("word_length", False, 90.0)), 1, 0),)
    got = _rows(quality_rules.judge(corpus, rules).select("doc_id", *quality_rules.COUNTS, "base_failed", "kept"))
    expected = Counter()
    for doc_id, text in rows:
        n, chars, symbols, again, repeated = _statistics(text)
        failed = n < 50 or 100 * repeated > 50 * n
        expected[doc_id, n, chars, symbols, again, repeated, failed, not failed and not (symbols / n >= 0.2 and chars / n <= 90)] += 1
    assert got == expected
    assert quality_rules.judge(nothing, rules).count() == 0


def test_sequential_covering():
    """Two kinds of bad rows need two rules; a few wrong labels do not make a rule; the order of the list counts."""
    rng = np.random.default_rng(1)
    numbers = np.zeros((4000, len(quality_rules.COUNTS) + len(quality_rules.MORE)), np.int64)
    at = {name: i for i, name in enumerate((*quality_rules.COUNTS, *quality_rules.MORE))}
    numbers[:, at["n_words"]] = 100
    numbers[:, at["word_chars"]] = rng.integers(400, 700, 4000)
    numbers[:, at["n_letters"]] = 400
    numbers[:, at["n_lines"]] = 10
    numbers[:, at["n_symbols"]] = np.where(np.arange(4000) % 5 == 0, rng.integers(60, 90, 4000), rng.integers(0, 50, 4000))
    numbers[:, at["n_upper"]] = np.where(np.arange(4000) % 7 == 0, rng.integers(200, 400, 4000), rng.integers(0, 100, 4000))
    truth = (np.arange(4000) % 5 == 0) | (np.arange(4000) % 7 == 0)
    labels = truth.copy()
    labels[rng.choice(4000, 40, replace=False)] ^= True
    rules = quality_rules.learn(numbers, labels, np.arange(4000) % 3 == 1)
    assert 2 <= len(rules) <= 4 and {c.ratio for r in rules for c in r.conditions} >= {"symbols_a_word", "upper_share"}
    values = quality_rules._ratios(numbers)
    rejected = np.any([r.holds(values) for r in rules], axis=0)
    assert (rejected == truth).mean() > 0.995
    assert quality_rules.learn(numbers, np.zeros(4000, bool), np.arange(4000) % 3 == 1) == ()
    assert quality_rules.learn(numbers, np.ones(4000, bool), np.arange(4000) % 3 == 1) == ()


def test_a_conjunction_is_grown_and_pruned():
    rng = np.random.default_rng(2)
    numbers = np.ones((6000, len(quality_rules.COUNTS) + len(quality_rules.MORE)), np.int64)
    numbers[:, 0] = 1000
    numbers[:, 1] = rng.integers(3000, 9000, 6000)
    numbers[:, 2] = rng.integers(0, 1000, 6000)
    bad = (numbers[:, 1] > 6000) & (numbers[:, 2] > 500)
    rules = quality_rules.learn(numbers, bad, np.arange(6000) % 3 == 0)
    assert len(rules[0].conditions) >= 2
    rejected = np.any([r.holds(quality_rules._ratios(numbers)) for r in rules], axis=0)
    assert (rejected == bad).mean() > 0.99


def test_rules_as_one_conditional_expression(spark):
    rules = tuple(quality_rules.Rule((quality_rules.Condition("symbols_a_word", True, t),), 1, 0) for t in (0.5, 0.1))
    rows = [(1, 10, 50, 6), (2, 10, 50, 2), (3, 10, 50, 0), (4, 0, 0, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, n_words long, word_chars long, n_symbols long")
    assert dict(map(tuple, frame.select("doc_id", quality_rules.fired(rules)).collect())) == {1: 1, 2: 2, 3: None, 4: None}
    assert [r[0] for r in frame.select(quality_rules.fired(())).collect()] == [None] * 4


def test_held_out_quality(spark):
    """Rules learned at sf0.01; documents that the learning rows leave out, and labels that are null, in conflict or of unknown documents."""
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    odd = spark.createDataFrame([(1, None, 0), (None, 0, 0), (9_999_999, 0, 1), (6, 0, 0)], "doc_id long, quality int, toxic int")
    rules = quality_rules.train(docs, labels.select(*odd.columns).unionByName(odd))
    judged = quality_rules.judge(docs, rules).join(labels, "doc_id").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    counts = {(r.quality, r.kept): r["count"] for r in judged.filter("not base_failed").groupBy("quality", "kept").count().collect()}
    assert counts.get((0, False), 0) > 0 and counts.get((0, True), 0) <= 0.1 * counts[0, False]
    assert counts.get((1, False), 0) <= 0.01 * counts[1, True]
    assert quality_rules.train(docs, labels.filter("quality = 1")) == () and quality_rules.train(docs.limit(0), labels) == () and quality_rules.train(docs, labels.limit(0)) == ()
