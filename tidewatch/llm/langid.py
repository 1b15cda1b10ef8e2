"""Language identification by unigram pieces, summed over all segmentations of each word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import training_row
from tidewatch.llm.tokens import vocabulary

VOCABULARY = "piece_bpe_32k.model"
#: The classifier is fitted on about this many labelled rows per language (all of a smaller one), chosen by a hash of the id.
SAMPLE_PER_LANGUAGE = 3000
#: Added to every count, so that no piece is impossible.
SMOOTHING = 0.05
#: Probability of a character that no piece has, the same for all languages.
UNKNOWN = 1e-6
#: Words are scored in parts of this many code points, which keeps their probabilities within a double.
WORD_PART = 32
#: Words a worker remembers.
MEMORY = 200_000
UNDETERMINED = "und"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    """Lower-case words, each with the vocabulary's word-start mark, long ones in parts."""
    words = ["▁" + w for w in text.lower().split()]
    if max(map(len, words), default=0) <= WORD_PART:
        return words
    return [w[i : i + WORD_PART] for w in words for i in range(0, len(w), WORD_PART)]


def has_letter(text: str | None) -> bool:
    """Whether a character is of a letter category; numerals such as ½ and ² are not."""
    return any(map(str.isalpha, text or ""))


def _points(words: list[str], width: int) -> np.ndarray:
    flat = "".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(flat, np.uint32).reshape(len(words), width).astype(np.uint64)


def _prefix_hashes(points: np.ndarray) -> np.ndarray:
    out = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
    for i in range(points.shape[1]):
        out[:, i + 1] = out[:, i] * _BASE + points[:, i] + np.uint64(1)
    return out


@dataclass
class Model:
    """Piece probabilities per language; its size is the vocabulary times the languages."""

    languages: list[str]
    priors: np.ndarray
    hashes: list[np.ndarray]  # by piece length: sorted hashes of the pieces
    rows: list[np.ndarray]  # by piece length: the row of each in ``probabilities``
    probabilities: np.ndarray  # a row per piece, then a row of zeros, then that of an unknown character

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word per language: the forward algorithm over all its segmentations into pieces."""
        scores = np.zeros((len(words), len(self.languages)))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        nothing, unknown = len(self.probabilities) - 2, len(self.probabilities) - 1
        for n in np.unique(lengths):
            chosen = np.flatnonzero(lengths == n)
            for at in range(0, len(chosen), 4096):
                which = chosen[at : at + 4096]
                prefix = _prefix_hashes(_points([words[i] for i in which], int(n)))
                forward = np.zeros((n + 1, len(which), len(self.languages)))
                forward[0] = 1
                for end in range(1, n + 1):
                    for size in range(1, min(end, len(self.hashes) - 1) + 1):
                        table = self.hashes[size]
                        missing = unknown if size == 1 else nothing
                        if not len(table):
                            if size > 1:
                                continue
                            row = np.full(len(which), missing)
                        else:
                            h = prefix[:, end] - prefix[:, end - size] * _BASE ** np.uint64(size)
                            spot = np.minimum(np.searchsorted(table, h), len(table) - 1)
                            row = np.where(table[spot] == h, self.rows[size][spot], missing)
                            if size > 1 and (row == nothing).all():
                                continue
                        forward[end] += forward[end - size] * self.probabilities[row]
                scores[which] = np.log(forward[n])
        return scores


def vocabulary_pieces(name: str = VOCABULARY) -> list[str]:
    """The ordinary pieces of a public vocabulary, with '' in place of control, unknown and byte pieces."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=vocabulary(name))
    return ["" if pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i) else pieces.id_to_piece(i) for i in range(pieces.vocab_size())]


def build(pieces: list[str], counts: dict[str, np.ndarray], rows: dict[str, int]) -> Model:
    """The model from piece counts per language and the number of learning rows per language."""
    languages = sorted(counts)
    table = np.array([counts[x] for x in languages], float).T.reshape(len(pieces), len(languages)) + SMOOTHING
    table[[i for i, p in enumerate(pieces) if not p]] = 0
    table /= table.sum(axis=0, keepdims=True)
    probabilities = np.concatenate([table, np.zeros((1, len(languages))), np.full((1, len(languages)), UNKNOWN)])
    longest = min(max(map(len, pieces)), WORD_PART)
    hashes, places = [np.array([], np.uint64)], [np.array([], np.int64)]
    for size in range(1, longest + 1):
        ids = np.array([i for i, p in enumerate(pieces) if len(p) == size], np.int64)
        h = _prefix_hashes(_points([pieces[i] for i in ids], size))[:, -1] if len(ids) else np.array([], np.uint64)
        order = np.argsort(h)
        hashes.append(h[order])
        places.append(ids[order])
    total = sum(rows.values())
    return Model(languages, np.log([rows[x] / total for x in languages]), hashes, places, probabilities)


def train(docs: DataFrame, name: str = VOCABULARY, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Piece counts of the labelled rows; see ``SAMPLE_PER_LANGUAGE``. None if no row has a label and a letter."""
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & training_row()
    )
    rows = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not rows:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in rows.items() for x in (lang, min(1.0, per_language / n))])
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * float(1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=vocabulary(name))
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                ids = pieces.encode(text.lower(), num_threads=1)
                counts[lang] = counts.get(lang, 0) + np.bincount(ids, minlength=pieces.vocab_size())
        for lang, n in counts.items():
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen)), pa.array(seen), pa.array(n[seen])], ["lang", "piece", "n"])

    found = sample.select("text", "lang").mapInArrow(run, "lang string, piece long, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    pieces = vocabulary_pieces(name)
    counts = {lang: np.bincount(g["piece"], g["n"], len(pieces)) for lang, g in found.groupby("lang")}
    counts |= {lang: np.zeros(len(pieces)) for lang in rows if lang not in counts}
    return build(pieces, counts, rows)


class Scorer:
    """Scores texts with a model, remembering words."""

    def __init__(self, model: Model):
        self.model, self.places, self.scores, self.used = model, {}, np.zeros((1024, len(model.languages))), 0

    def _learn(self, words: set[str]) -> None:
        if self.used + len(words) > MEMORY:
            self.places, self.used = {}, 0
            raise KeyError
        while self.used + len(words) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        new = sorted(words)
        self.scores[self.used : self.used + len(new)] = self.model.word_scores(new)
        self.places.update(zip(new, range(self.used, self.used + len(new))))
        self.used += len(new)

    def batch(self, texts: list[str | None]) -> list[tuple[str, float]]:
        split = [words_of(t) if has_letter(t) else None for t in texts]
        unknown = {w for words in split if words for w in words}.difference(self.places)
        if len(unknown) > MEMORY // 2 and len(texts) > 1:
            half = len(texts) // 2
            return self.batch(texts[:half]) + self.batch(texts[half:])
        try:
            self._learn(unknown)
        except KeyError:
            every = {w for words in split if words for w in words}
            if len(every) > MEMORY:
                return [x for t in texts for x in (self.batch([t]) if len(texts) > 1 else [self.result(self.model.word_scores(split[0]).sum(axis=0))])]
            self._learn(every)
        return [
            (UNDETERMINED, 0.0) if words is None else self.result(self.scores[np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))].sum(axis=0))
            for words in split
        ]

    def result(self, scores: np.ndarray) -> tuple[str, float]:
        """The most probable language and its posterior probability; the first by name in a tie."""
        scores = scores + self.model.priors
        chance = np.exp(scores - scores.max())
        best = int(np.argmax(scores))
        return self.model.languages[best], float(chance[best] / chance.sum())


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every whole text.

    Null texts, texts without a letter, and all texts if there was nothing to learn from, are 'und' with score 0. Rows
    without id and repeated rows are rows like any other; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for batch in batches:
            texts = batch.column(2).to_pylist()
            found = [x for at in range(0, len(texts), 256) for x in scorer.batch(texts[at : at + 256])] if scorer else [(UNDETERMINED, 0.0)] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.select("doc_id", (~training_row()).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the learning rows of ``docs`` and predict the language of every row."""
    return predict(docs, train(docs))
