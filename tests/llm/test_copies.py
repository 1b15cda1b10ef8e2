"""Fingerprints, SimHash, lines and decontamination against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

import corpus_pipeline
from tidewatch.llm import decontam, fingerprint, lines, similar, simhash
from tidewatch.llm.common import components


def _classes(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 3), (7, 8), (5, 5), (20, 19), (19, 18), (18, 17), (17, 16), (None, 4)] + [(100, 100 + i) for i in range(1, 40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 7: 7, 8: 7, **{i: 16 for i in range(16, 21)}, **{100 + i: 100 for i in range(40)}}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


# --- fingerprints ---


def test_edited_fingerprints(corpus, rows, nothing):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [t or "" for _, t in ordered]
    expected = Counter()
    for i, text in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        own, changed, other = (fingerprint.vector(t) for t in (text, edited, following))
        expected[
            ordered[i][0], len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprint.encode(*own), fingerprint.encode(*changed),
            fingerprint.likeness(own, changed), fingerprint.likeness(own, other),
        ] += 1
    assert Counter(tuple(r) for r in fingerprint.edited_fingerprints(corpus).collect()) == expected
    assert fingerprint.edited_fingerprints(nothing).count() == 0


def test_fingerprints_add_up():
    whole = fingerprint.encode(*fingerprint.vector("first line of it\nsecond one\nthird"))
    assert whole == fingerprint.encode(*fingerprint.vector("third\nfirst line of it\nsecond one"))
    part = fingerprint.encode(*fingerprint.vector("first line of it\nthird"))
    assert fingerprint.inserted(part, "second one") == whole and fingerprint.deleted(whole, "second one") == part
    assert fingerprint.vector(None)[0].tolist() == fingerprint.vector("")[0].tolist()
    text = "\n".join(f"line number {i} has words of its own, {i * i}" for i in range(60))
    half = text[: len(text) // 2] + "".join(chr(97 + i % 7) + chr(97 + i % 11) for i in range(len(text) // 4))
    a, b = fingerprint.vector(text), fingerprint.vector(half)
    assert 0.25 < fingerprint.likeness(a, b) < 0.75 and fingerprint.likeness(a, a) == 1
    assert fingerprint.likeness(a, fingerprint.vector("nothing in common here at all " * 30)) < 0.3


# --- SimHash ---


def _plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(corpus, rows, nothing):
    fps = [_plain_fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    smallest = defaultdict(lambda: float("inf"))
    classes = _classes(len(rows), links)
    for (doc_id, _), c in zip(rows, classes):
        smallest[c] = min(smallest[c], float("inf") if doc_id is None else doc_id)
    expected = Counter((d, f, None if smallest[c] == float("inf") else smallest[c]) for (d, _), f, c in zip(rows, fps, classes))
    got = Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(corpus).collect())
    assert got == expected
    kept = simhash.one_per_group(corpus)
    known = {smallest[c] for c in classes} - {float("inf")}
    assert kept.columns == corpus.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([*known, *(None for d, _ in rows if d is None)])
    assert simhash.near_duplicates(nothing).count() == 0


def test_covering_masks_and_hot_keys(spark, monkeypatch):
    masks = simhash.covering_masks()
    assert len(masks) == 7
    assert all(any(not (m >> i & 1 or m >> j & 1) for m in masks) for i in range(64) for j in range(64))
    rng = np.random.default_rng(1)
    base = [int(x) for x in rng.integers(0, 1 << 63, 6, np.uint64)]
    fps = sorted({b ^ (1 << int(i)) ^ (1 << int(j)) ^ (1 << int(k)) for b in base for i, j, k in rng.integers(0, 64, (150, 3))})
    expected = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 2}
    monkeypatch.setattr(simhash, "HOT_KEY", 20)
    monkeypatch.setattr(simhash, "PAIRWISE_RUN", 8)
    frame = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    got = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.near_links(frame).collect()]
    assert {tuple(sorted(p)) for p in got} == expected


def _kept(rows):
    fps = [_plain_fingerprint(t) for _, t in rows]
    smallest = defaultdict(lambda: float("inf"))
    classes = _classes(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    for (doc_id, _), c in zip(rows, classes):
        smallest[c] = min(smallest[c], float("inf") if doc_id is None else doc_id)
    return Counter([*(set(smallest.values()) - {float("inf")}), *(None for d, _ in rows if d is None)])


def test_pipeline_drops_near_copies(spark, corpus, rows):
    rng = np.random.default_rng(3)
    made = []
    for i in range(20):
        words = [f"w{x}" for x in rng.integers(0, 5000, 1500)]
        edited = [*words[:-1], "other"]
        made += [(200_000 + 2 * i, " ".join(words), "en", "x", 0, 1, 1, 1, None), (200_001 + 2 * i, " ".join(edited), "en", "x", 0, 1, 1, 1, None)]
    docs = corpus.unionByName(spark.createDataFrame(made, corpus.schema))
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == corpus.columns
    expected = _kept(rows + [r[:2] for r in made])
    assert Counter(r.doc_id for r in kept.collect()) == expected
    assert sum(d is not None and d >= 200_000 for d in expected) < 40


# --- sets that meet in buckets ---


def test_large_buckets_keep_every_link(spark):
    """A hub whose variants are similar to it alone, a chain, a group of copies and dissimilar sets, all in one bucket."""
    hub = set(range(200))
    sets = [hub, *(hub - {2 * i, 2 * i + 1, 100 + i} | {1000 + 40 * i + j for j in range(30)} for i in range(40))]
    sets += [set(range(30_000 + 8 * i, 30_100 + 8 * i)) for i in range(30)] + [set(range(7000, 7100)) | {8000 + i} for i in range(50)]
    sets += [set(range(9000, 9080)) | {20_000 + 100 * i + j for j in range(20)} for i in range(60)]
    n = len(sets)
    links = {(i, j) for j in range(n) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    members = spark.createDataFrame([(1, i) for i in range(n)], "bucket long, id long")
    bodies = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "id long, body array<long>")
    got = {(r.a, r.b) for r in similar.similar_pairs(members, bodies, similar.F.col).collect()}
    assert got <= links and _classes(n, got) == _classes(n, links)
    assert not any((i, j) in links for j in range(2, 41) for i in range(1, j))
    alone = spark.createDataFrame([(i, i) for i in range(n)], "id long, root long")
    assert links <= {tuple(r) for r in similar.prefix_pairs(alone, bodies, similar.F.col, 0.8, "t").collect()}


def test_pairs_of_one_group_are_made_once(spark):
    """Sets that share nearly all elements of their prefixes meet at the first shared one, not at each; short sets have few elements before that."""
    sets = [set(range(100)) | {1000 + 10 * i + j for j in range(10)} for i in range(30)] + [{5000, 5001}, {5000, 5001}, {6000}, {6000}]
    bodies = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "id long, body array<long>")
    alone = spark.createDataFrame([(i, i) for i in range(len(sets))], "id long, root long")
    met = [tuple(r) for r in similar.prefix_meetings(alone, bodies, similar.F.col, 0.8, "t").collect()]
    links = {(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert len(links) == 30 * 29 // 2 + 2 and links <= set(met)
    assert len(met) <= 1.1 * len(set(met))


def test_rounds_carry_ids_alone(spark, monkeypatch):
    """What is written and shuffled by bucket in each round are ids, not outlines; signatures go to their buckets without a table between."""
    written = {}

    def recorded(df, purpose, staged=similar.staged):
        written[purpose] = df.dtypes
        return staged(df, purpose)

    monkeypatch.setattr(similar, "staged", recorded)
    monkeypatch.setattr(lines, "staged", recorded)
    text = "a rather long line that very many documents hold with a small change at its very end, number "
    made = [(i, f"{text}{i}\n{'xyz' * i} own line {i}") for i in range(60)]
    assert lines.deduplicated(spark.createDataFrame(made, "doc_id long, text string")).count() == 60
    assert {"lines-met", "lines-heads", "lines-rooted"} <= written.keys() and "lines-bands" not in written
    assert {kind for purpose, columns in written.items() for name, kind in columns if any(c == "bucket" for c, _ in columns)} <= {"bigint", "boolean"}


def test_few_pairs_move_few_sets(spark):
    """A round with few pairs reads the bodies and outlines of these alone; many pairs take the whole tables."""
    bodies = spark.range(1000).selectExpr("id", "array(id, id + 1, id + 2) AS body", "3 AS n")
    few, none = spark.createDataFrame([(1, 2), (2, 900)], "a long, b long"), spark.createDataFrame([], "a long, b long")
    assert sorted(r.id for r in similar.needed(bodies, few).collect()) == [1, 2, 900]
    assert similar.needed(bodies, none).count() == 0
    many = spark.range(similar.FEW_PAIRS + 1).selectExpr("id AS a", "id + 1 AS b")
    assert similar.needed(bodies, many).count() == 1000


def test_sizes_of_sets_are_worked_out_once(spark, monkeypatch):
    """A comparison takes the sizes of its sets as they were staged with the bodies, and repeats do not count."""
    written = {}
    monkeypatch.setattr(similar, "staged", lambda df, purpose, staged=similar.staged: written.setdefault(purpose, staged(df, purpose)))
    bodies = spark.createDataFrame([(1, [1, 1, 2, 3, 4, 5]), (2, [1, 2, 3, 4]), (3, [9, 9])], "id long, body array<long>")
    members = spark.createDataFrame([(7, 1), (7, 2), (8, 3)], "bucket long, id long")
    held, _ = similar.outlined(bodies, members, similar.F.col, lambda df: df.select("id", similar.F.explode("body").alias("h")), "t")
    assert sorted((r.id, r.n) for r in held.collect()) == [(1, 5), (2, 4), (3, 1)]
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long")
    assert [tuple(r) for r in similar.verified(pairs, held, similar.F.col, 0.8, "t").collect()] == [(1, 2)]


def test_many_pairs_move_no_row_they_do_not_name(spark, monkeypatch):
    """However many the pairs are, a comparison reads the rows that they name alone, by bitmaps or, if these are too large, by a shuffle."""
    rows = spark.range(-1000, 400_000).selectExpr("id", "id * 2 AS twice")
    many = spark.range(0, 2 * similar.FEW_PAIRS + 2, 2).selectExpr("id AS a", "-1 AS b")
    assert many.count() > similar.FEW_PAIRS
    expected = [-1, *range(0, 2 * similar.FEW_PAIRS + 2, 2)]
    by_bitmap = similar.needed(rows, many)
    assert "Exchange hashpartitioning(id" not in by_bitmap._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in by_bitmap.collect()) == expected
    monkeypatch.setattr(similar, "MOST_WORDS", 10)
    assert sorted(r.id for r in similar.needed(rows, many).collect()) == expected


def test_bounds_decide_as_sizes_do(spark, monkeypatch):
    """Pairs with bounds of their sizes are judged as by the sizes themselves, also where a body lists elements again and again."""
    rng = np.random.default_rng(11)
    made = []
    for i in range(40):
        base = rng.integers(0, 200, 60)
        made += [[int(x) for x in base], [int(x) for x in np.concatenate((base[: rng.integers(30, 60)], rng.integers(0, 200, rng.integers(1, 30))))]]
    bodies = spark.createDataFrame(list(enumerate(made)), "id long, body array<long>")
    members = spark.createDataFrame([(i // 2, i) for i in range(80)], "bucket long, id long")
    held, outlines = similar.outlined(bodies, members, similar.F.col, lambda df: df.select("id", similar.F.explode("body").alias("h")), "t")
    pairs = spark.createDataFrame([(i, i + 1) for i in range(0, 80, 2)], "a long, b long")
    near = similar.alike(pairs, outlines, 0.6)
    bounds = {r.a: (r.least, r.most) for r in near.collect()}
    links = {i for i in range(0, 80, 2) if len({*made[i]} & {*made[i + 1]}) >= 0.6 * len({*made[i]} | {*made[i + 1]})}
    assert 5 < len(links) < 40 and links <= bounds.keys()
    assert all(low <= len({*made[i]}) + len({*made[i + 1]}) <= high for i, (low, high) in bounds.items())
    assert {r.a for r in similar.verified(near, held, similar.F.col, 0.6, "t").collect()} == links


def test_rare_pairs_are_compared_by_their_outlines_first(spark, monkeypatch):
    """Pairs of the rare-element search that cannot be similar by their outlines do not reach the exact comparison."""
    read = []
    monkeypatch.setattr(similar, "verified", lambda pairs, *rest, verified=similar.verified: read.append(pairs.columns) or verified(pairs, *rest))
    sets = [set(range(0, 100)) | {1000 + 100 * i + j for j in range(30)} for i in range(60)] + [set(range(7000, 7100)) | {8000 + i // 2} for i in range(40)]
    members = spark.createDataFrame([(1, i) for i in range(len(sets))], "bucket long, id long")
    bodies = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "id long, body array<long>")
    similar.similar_pairs(members, bodies, similar.F.col).collect()
    assert len(read) > 2 and all({"most", "least"} <= {*columns} for columns in read)


# --- lines ---


def test_signature_rows_hold_several_shingles(spark):
    """The numbers are those of every shingle on its own, for lines that end anywhere in a row of shingles; the lines are exploded into a fourth of the rows."""
    texts = ["", "a", "short", *["line of any length whatsoever " * 3 + "x" * n for n in range(9)], "é" * 40]
    made = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "line_id long, bytes binary")
    each = lines._exploded_shingles(made, "line_id", "bytes").groupBy("line_id")
    expected = each.agg(*[lines.F.min(lines.F.col("h").bitwiseXOR(lines.F.lit(lines._constant(i)))).alias(f"m{i}") for i in range(24)])
    got = lines.signatures(made)
    assert got.columns == expected.columns and sorted(got.collect()) == sorted(expected.collect())
    assert lines.STRIDE > 1 and f"Some({lines.STRIDE})" in got._jdf.queryExecution().optimizedPlan().toString()


def _plain_lines(rows, similarity):
    rows = [(float("inf") if d is None else d, t) for d, t in rows]
    holders = defaultdict(list)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if line.strip(" "):
                holders[line].append(d)
    names = list(holders)
    sets = [{b[i : i + 8] for i in range(max(1, len(b) - 7))} for b in (n.encode() for n in names)]
    links = [
        (i, j) for i in range(len(names)) for j in range(i)
        if min(len(sets[i]), len(sets[j])) >= similarity * max(len(sets[i]), len(sets[j])) and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])
    ]
    classes = dict(zip(names, _classes(len(names), links)))
    first = defaultdict(lambda: float("inf"))
    for line, docs in holders.items():
        first[classes[line]] = min(first[classes[line]], *docs)
    out = []
    for d, t in rows:
        gone, seen = [], set()
        for i, line in enumerate((t or "").split("\n")):
            if line.strip(" "):
                if first[classes[line]] != d or classes[line] in seen:
                    gone.append(i)
                seen.add(classes[line])
        out.append((None if d == float("inf") else d, gone, None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)))
    return out


def test_lines(corpus, rows, nothing):
    got = lines.deduplicated(corpus)
    assert got.columns == [*corpus.columns, "n_lines", "removed"]
    found = sorted(((r.doc_id, r.removed, r.text) for r in got.collect()), key=repr)
    assert found == sorted(_plain_lines(rows, lines.SIMILARITY), key=repr)
    assert lines.deduplicated(nothing).count() == 0


def test_lines_of_one_large_class(spark, monkeypatch):
    monkeypatch.setattr(lines, "ALL_PAIRS", 4)
    text = "a rather long line that very many documents hold with a small change at its very end, number "
    made = [(i, f"{text}{i}\n{'xyz' * i} own line {i}") for i in range(60)]
    got = lines.deduplicated(spark.createDataFrame(made, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.removed, r.text) for r in got.collect()), key=repr) == sorted(_plain_lines(made, lines.SIMILARITY), key=repr)


def test_lines_around_a_hub(spark):
    """Copies of a frequent line, each with edits of its own: all are similar to that line, few to each other."""
    rng = np.random.default_rng(7)
    hub = "".join(chr(97 + x) for x in rng.integers(0, 26, 300))
    texts = [hub]
    for _ in range(150):
        line = list(hub)
        for at in rng.choice(300, 3, replace=False):
            line[at] = chr(65 + int(rng.integers(0, 26)))
        texts.append("".join(line))
    made = [(i, f"{t}\n{rng.bytes(20).hex()}") for i, t in enumerate(texts)]
    got = lines.deduplicated(spark.createDataFrame(made, "doc_id long, text string"))
    expected = _plain_lines(made, lines.SIMILARITY)
    assert sorted(((r.doc_id, r.removed, r.text) for r in got.collect()), key=repr) == sorted(expected, key=repr)
    assert sum(gone == [0] for _, gone, _ in expected) == 150


def test_lines_that_repeat_themselves(spark):
    """Lines of very different lengths whose shingles are the same few: repeats count once."""
    made = [(i, "\n".join([c * n, f"{c}{c.upper()}{i % 4}" * n, f"{c} own {i}"])) for i, (c, n) in enumerate((c, n) for c in "xyz" for n in (9, 30, 300, 4000))]
    got = lines.deduplicated(spark.createDataFrame(made, "doc_id long, text string"))
    expected = _plain_lines(made, lines.SIMILARITY)
    assert sorted(((r.doc_id, r.removed, r.text) for r in got.collect()), key=repr) == sorted(expected, key=repr)
    assert sum(len(gone) for _, gone, _ in expected) >= 9


def test_many_removed_lines_of_one_text(spark):
    """What stays is cut out run by run, so a text of very many removed lines takes linear time."""
    made = [(1, "\n".join(["first", *["the same line again and again"] * 60_000, "", "last of all"])), (2, "the same line again and again\nown words"), (3, "first")]
    got = lines.deduplicated(spark.createDataFrame(made, "doc_id long, text string"))
    kept = [(1, list(range(2, 60_001)), "first\nthe same line again and again\n\nlast of all"), (2, [0], "own words"), (3, [0], "")]
    assert sorted((r.doc_id, r.removed, r.text) for r in got.collect()) == kept


# --- decontamination ---


def test_contained_items(spark, corpus, rows, nothing):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()] + [(900, "brown Fox, jumps!"), (901, None), (902, " ... "), (903, "one")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    expected = Counter()
    for doc_id, text in rows:
        words = decontam.words_of(text)
        for item_id, item in items:
            own = decontam.words_of(item)
            width = min(5, len(own))
            want = decontam.shingles(own, width) if own else set()
            shared = len(want & decontam.shingles(words, width)) if own else 0
            if own and shared >= 0.8 * len(want):
                expected[doc_id, item_id, shared, len(want)] += 1
    got = Counter((r.doc_id, r.item_id, r.shared, r.item_shingles) for r in decontam.contained_items(corpus, frame).collect())
    assert got == expected and len(expected) >= 5
    clean = decontam.without_contaminated(corpus, frame)
    assert clean.columns == corpus.columns
    leaking = {doc_id for doc_id, *_ in expected}
    assert Counter(r.doc_id for r in clean.collect()) == Counter(d for d, _ in rows if d not in leaking)
    assert decontam.contained_items(nothing, frame).count() == 0
    assert decontam.contained_items(corpus, frame.limit(0)).count() == 0


def test_items_in_several_blocks(spark, corpus, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = {tuple(r) for r in decontam.contained_items(corpus, bench).collect()}
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 3000)
    assert {tuple(r) for r in decontam.contained_items(corpus, bench).collect()} == whole
