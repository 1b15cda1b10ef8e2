"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import give_back, shuffle_partitions, staged, training_row

#: The examples are about this many labelled rows of either label (all, if there are fewer), chosen by a hash of the id.
SAMPLE_PER_LABEL = 4000
#: Terms are kept if the labels of the examples that have them differ from the others' with this z-score, the best MAX_TERMS of them.
MIN_Z, MAX_TERMS = 4.0, 20_000
NEIGHBOURS = 25
BLOCK = 64
#: Weight of the base rate in a vote, in units of squared cosine.
DOUBT = 0.25
THRESHOLD = 0.3
PREFIXES = (4, 5)
REPEATS = (2, 3, 5)
DENSE = 100
#: Different left neighbours that a term's form must have had among the examples.
MIN_CONTEXTS = 12
MEMORY = 300_000
#: Texts of an Arrow batch that are Python strings at a time.
BATCH_ROWS = 500
_WORD = re.compile(r"\w+")
#: Stands for all pairs of neighbouring words; no word looks like it.
EVERY = "* *"


def word_terms(word: str) -> tuple[str, ...]:
    """A word's forms: itself, and its beginnings (marked by a star), which inflected and compound words share."""
    return (word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n))


def text_terms(forms: Counter, words: int) -> dict[str, int]:
    """The terms of a text of ``words`` words: its forms with their counts, and how they repeat.

    A form that occurs REPEATS times or more, or in one of DENSE words, is a further term for each of these levels.
    """
    found = dict(forms)
    for form, n in forms.items():
        found |= {f"{form}#{k}": 1 for k in REPEATS if n >= k}
        if n * DENSE >= words:
            found[f"{form}#dense"] = 1
    return found


class _Forms(dict):
    """The known forms of a word, worked out once; bounded."""

    def __init__(self, terms: Iterable[str]):
        super().__init__()
        self.known = {t.partition("#")[0] for t in terms}

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) >= MEMORY:
            self.clear()
        found = self[word] = tuple(f for f in word_terms(word) if f in self.known)
        return found


def term_counts(text: str | None, forms: _Forms, ids: dict[str, int]) -> dict[int, int]:
    """How often each known term occurs in the whole text."""
    words = _WORD.findall(text.lower()) if text and ids else []
    found = Counter()
    for known in filter(None, map(forms.__getitem__, words)):
        found.update(known)
    return {ids[t]: n for t, n in text_terms(found, len(words)).items() if t in ids}


def weights(counts: dict[int, int], idf: np.ndarray) -> dict[int, float]:
    """Unit vector of (1 + log tf) x idf; empty if no term has weight."""
    raw = {t: (1 + np.log(n)) * idf[t] for t, n in counts.items() if idf[t] > 0}
    norm = np.sqrt(sum(w * w for w in raw.values()))
    return {t: w / norm for t, w in sorted(raw.items())} if norm > 0 else {}


@dataclass
class Index:
    """Block-max inverted index of unit vectors: postings by term and block, and the largest weight in each block."""

    ids: np.ndarray
    labels: np.ndarray
    starts: np.ndarray  # (terms, blocks + 1): where a block's postings of a term begin
    examples: np.ndarray
    values: np.ndarray
    peaks: np.ndarray  # (terms, blocks)

    @classmethod
    def of(cls, vectors: list[dict[int, float]], ids: np.ndarray, labels: np.ndarray, terms: int) -> Index:
        # Examples with the same strongest term are put together: it tightens the block maxima.
        order = sorted(range(len(vectors)), key=lambda i: (max(vectors[i], key=vectors[i].get, default=-1), i))
        blocks = -(-len(vectors) // BLOCK)
        posting = sorted((t, place, w) for place, i in enumerate(order) for t, w in vectors[i].items())
        term, place = (np.array([p[k] for p in posting], np.int64) for k in (0, 1))
        value = np.array([p[2] for p in posting])
        cell = term * blocks + place // BLOCK
        starts = np.searchsorted(cell, np.arange(terms)[:, None] * blocks + np.arange(blocks + 1)[None, :])
        peaks = np.zeros(terms * blocks)
        np.maximum.at(peaks, cell, value)
        return cls(ids[order], labels[order], starts, place, value, peaks.reshape(terms, blocks))

    def nearest(self, vector: dict[int, float], k: int = NEIGHBOURS, leave_out: int = -1) -> list[tuple[float, int]]:
        """The ``k`` examples of highest positive cosine as (cosine, place), ties to the smaller place.

        Blocks are taken by falling bound, the sum of their maxima, in steps of growing size, and only while the bound reaches the k-th best
        cosine so far: the result is exact.
        """
        if not vector or not len(self.ids):
            return []
        terms, query = np.fromiter(vector, np.int64), np.fromiter(vector.values(), float)
        bounds = query @ self.peaks[terms]
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        scores, places = np.zeros(0), np.zeros(0, np.int64)
        done, step = 0, 4
        while done < len(order):
            if len(scores) == k:
                order = order[: np.searchsorted(-bounds[order] * (1 + 1e-9), -scores[-1], side="right")]
            blocks = order[done : done + step]
            done, step = done + step, 2 * step
            first = self.starts[terms[:, None], blocks].ravel()
            count = self.starts[terms[:, None], blocks + 1].ravel() - first
            at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            # The blocks of a step lie side by side; an example's products are added in the order of the terms.
            slot = np.zeros(self.peaks.shape[1], np.int64)
            slot[blocks] = np.arange(len(blocks))
            example = self.examples[at]
            cell = slot[example // BLOCK] * BLOCK + example % BLOCK
            summed = np.bincount(cell, self.values[at] * np.repeat(np.repeat(query, len(blocks)), count), minlength=len(blocks) * BLOCK)
            hit = np.flatnonzero(summed)
            found = blocks[hit // BLOCK] * BLOCK + hit % BLOCK
            scores, places = np.append(scores, np.round(summed[hit], 12)[found != leave_out]), np.append(places, found[found != leave_out])
            best = np.lexsort((places, -scores))[:k]
            scores, places = scores[best], places[best]
        return list(zip(scores.tolist(), places.tolist()))


def vote(found: list[tuple[float, int]], labels: np.ndarray) -> float:
    """Share of label 1 among the neighbours, weighted by squared cosine, with some doubt in favour of 0."""
    total = sum(c * c for c, _ in found)
    return sum(c * c * labels[p] for c, p in found) / (total + DOUBT) if found else 0.0


def calibration(votes: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of labels on votes by pooling adjacent violators: (vote, probability) knots."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []  # vote of the first and last member, weight, weighted labels
    for v, y, w in zip(votes[order], labels[order], weight[order]):
        pools.append([v, v, w, w * y])
        while len(pools) > 1 and (pools[-2][3] * pools[-1][2] >= pools[-1][3] * pools[-2][2] or pools[-2][1] == pools[-1][0]):
            last = pools.pop()
            pools[-1][1] = last[1]
            pools[-1][2] += last[2]
            pools[-1][3] += last[3]
    knots = [(v, p[3] / p[2]) for p in pools for v in dict.fromkeys(p[:2])]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


@dataclass
class Model:
    """Everything a scoring task needs. Its size is bounded by the sample and the number of terms."""

    terms: dict[str, int]
    idf: np.ndarray
    index: Index
    knots: tuple[np.ndarray, np.ndarray]

    def score(self, counts: dict[int, int]) -> tuple[float, list[tuple[int, float]]]:
        found = self.index.nearest(weights(counts, self.idf))
        chance = float(np.interp(vote(found, self.index.labels), *self.knots)) if len(self.knots[0]) else 0.0
        return min(1.0, max(0.0, chance)), [(int(self.index.ids[p]), c) for c, p in found[:3]]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _z(one: float, zero: float) -> Column:
    """Absolute z-score of the difference between the shares a / one and b / zero; 0 if all or none have the term."""
    pooled = (F.col("a") + F.col("b")) / (one + zero)
    return F.coalesce(F.try_divide(F.abs(F.col("a") / one - F.col("b") / zero), F.sqrt(F.greatest(F.lit(0.0), pooled * (1 - pooled)) * (1 / one + 1 / zero))), F.lit(0.0))


def term_table(docs: DataFrame, terms: dict[str, int]) -> DataFrame:
    """(doc_id, held_out, terms, counts): the known terms of every whole text by number, and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Forms(terms)
        for batch in batches:
            found = [sorted(term_counts(t, cache, terms).items()) for t in batch.column(2).to_pylist()]
            lists = [pa.array([[pair[k] for pair in f] for f in found], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["doc_id", "held_out", "terms", "counts"])

    rows = _texts(docs).select("doc_id", (~training_row()).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, terms array<int>, counts array<int>")


def train(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Model:
    """The model alone, see ``fit``."""
    return fit(docs, labels, per_label)[0]


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> tuple[Model, DataFrame]:
    """A model, and the term table of ``docs`` it was fitted on.

    Fit on a bounded sample of the learning rows that have label 0 or 1; count document frequencies over all of ``docs``.

    A term is kept if its share of examples differs between the labels, and so does its form's share of all distinct pairs of neighbouring
    words: words that copies of one text share come with one context and fail the second test.
    If a document has several label rows, the largest label holds. Of rows that share an id, the least text is the example.
    """
    spark = docs.sparkSession
    rows = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & training_row()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    share = {y: min(1.0, per_label / n) for y, n in sizes.items()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 20)) / float(1 << 20)
    chosen = rows.filter(draw < F.when(F.col("toxic") == 1, F.lit(share.get(1, 0.0))).otherwise(F.lit(share.get(0, 0.0))))
    # At most about 2 x per_label rows of two numbers: safe to broadcast, whatever the size of the corpus.
    examples = staged(_texts(docs).filter(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "toxicity-examples")

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = (Counter(), Counter())
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _WORD.findall(text.lower())
                held[label].update(text_terms(Counter(f for w in words for f in word_terms(w)), len(words)).keys())
            found = list(held[0].keys() | held[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), *(pa.array([h[t] for t in found], pa.int64()) for h in (held[1], held[0]))], ["term", "a", "b"])

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Forms(candidates)
        for batch in batches:
            held = (set(), set())
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _WORD.findall(text.lower())
                after = [(crc32(b.encode("utf-8", "replace")), w) for b, w in zip(["", *words], words)]
                held[label].update((f, b) for b, w in after for f in cache[w])
                held[label].update((EVERY, crc32(f"{b} {w}".encode("utf-8", "replace"))) for b, w in after)
            for label, found in enumerate(held):
                pairs = list(found)
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in pairs], pa.string()), pa.array([label] * len(pairs), pa.int32()), pa.array([b for _, b in pairs], pa.int64())], ["term", "toxic", "before"])

    size = {r["toxic"]: r["count"] for r in examples.groupBy("toxic").count().collect()}
    one, zero = size.get(1, 0), size.get(0, 0)
    terms: dict[str, int] = {}
    if one and zero:
        texts = examples.select("toxic", "text").repartition(shuffle_partitions(spark))
        seen = texts.mapInArrow(present, "term string, a long, b long").groupBy("term").agg(F.sum("a").cast("double").alias("a"), F.sum("b").cast("double").alias("b"))
        best = seen.withColumn("z", _z(one, zero)).filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "term").limit(MAX_TERMS)
        candidates = [r["term"] for r in best.collect()]
        spread = texts.mapInArrow(contexts, "term string, toxic int, before long").distinct().groupBy("term").agg(
            F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b")
        )
        whole = spread.filter(F.col("term") == EVERY).head()
        kept = spread.filter(F.col("term") != EVERY).withColumn("z", _z(whole["a"], whole["b"])).filter((F.col("z") >= MIN_Z) & (F.col("a") + F.col("b") >= MIN_CONTEXTS)).collect() if whole and whole["a"] and whole["b"] else []
        forms = {r["term"] for r in kept}
        terms = {t: i for i, t in enumerate(sorted(t for t in candidates if t.partition("#")[0] in forms))}

    counted = staged(term_table(docs, terms), "toxicity-terms")
    df = {r["term"]: r["count"] for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    rows_in_all = counted.count() if terms else 0
    idf = np.array([np.log((rows_in_all + 1) / (df.get(t, 0) + 1)) for t in range(len(terms))])

    # The examples are a bounded sample: their vectors are the index, which every task gets.
    vectors = staged(term_table(examples.repartition(shuffle_partitions(spark)), terms).join(F.broadcast(examples.select("doc_id", "toxic")), "doc_id"), "toxicity-vectors")
    held = sorted(vectors.collect(), key=lambda r: r["doc_id"])
    ids, label = np.array([r["doc_id"] for r in held], np.int64), np.array([r["toxic"] for r in held], np.int64)
    index = Index.of([weights(dict(zip(r["terms"], r["counts"])), idf) for r in held], ids, label, len(terms))
    place = {int(i): p for p, i in enumerate(index.ids)}

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            found = [vote(index.nearest(weights(dict(zip(r["terms"], r["counts"])), idf), leave_out=place[r["doc_id"]]), index.labels) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "vote"])

    spread_out = vectors.select("doc_id", "terms", "counts").repartition(shuffle_partitions(spark))
    voted = {r["doc_id"]: r["vote"] for r in spread_out.mapInArrow(left_out, "doc_id long, vote double").collect()}
    votes = np.array([voted[int(i)] for i in index.ids])
    prevalence = np.array([sizes.get(y, 0) / max(1, size.get(y, 0)) for y in (0, 1)])
    knots = calibration(votes, index.labels, prevalence[index.labels]) if len(held) else (np.array([]), np.array([]))
    return Model(terms, idf, index, knots), counted


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) of every whole text; evidence: the three nearest examples.

    A text without a known term (null and empty ones too) has no neighbour and gets the calibrated score of a zero vote; without any labels all scores
    are 0. Repeated rows and rows without id are scored like any other; an empty table gives no rows.
    """
    return score_terms(term_table(docs, model.terms), model)


def score_terms(counted: DataFrame, model: Model) -> DataFrame:
    """``score`` of the documents in a term table of the model's terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {}
        for batch in batches:
            out = []
            for doc_id, held_out, *pair in zip(*(c.to_pylist() for c in batch.columns)):
                key = tuple(map(tuple, pair))
                if key not in known:
                    if len(known) >= MEMORY // 10:
                        known.clear()
                    known[key] = model.score(dict(zip(*key)))
                chance, evidence = known[key]
                out.append({"doc_id": doc_id, "held_out": held_out, "score": chance, "predicted": int(chance >= THRESHOLD), "evidence": [{"doc_id": i, "cosine": c} for i, c in evidence]})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()),
        ("evidence", pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())]))),
    ])
    return counted.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, evidence array<struct<doc_id: long, cosine: double>>")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns kept, that ``score`` does not predict to be toxic. A missing text stays, and so does everything if the labels are not of both kinds."""
    if len(set(model.index.labels.tolist())) < 2:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Forms(model.terms)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.string())
            stays: list[bool] = []
            for at in range(0, len(texts), BATCH_ROWS):
                some = texts.slice(at, BATCH_ROWS).to_pylist()
                stays += [t is None or model.score(term_counts(t, cache, model.terms))[0] < THRESHOLD for t in some]
            yield batch.filter(pa.array(stays, pa.bool_()))
        # The worker stays for later tasks and stages: what this one held goes back.
        cache.clear()
        give_back()

    return docs.mapInArrow(run, docs.schema)
