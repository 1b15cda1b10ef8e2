"""Quality rules: statistics of a text, and an ordered decision list over them learned by sequential covering."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import training_row

#: Fixed values of the base rules: characters that count as symbols, the least number of words, the most repeated words in a hundred.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Labelled rows that the rules are learned from, at most so many a label; chosen by a hash of the id.
SAMPLE = 5_000
#: A share of the sample, by another hash, that rules are pruned on.
PRUNE_SHARE = 3
#: A rule is kept if so large a part of what it covers, among the rows it was not grown on too, was labelled for rejection.
PRECISION = 0.9
#: Rules and conditions a rule, at most; the covering ends long before on separable labels.
MAX_RULES, MAX_CONDITIONS = 64, 6

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_distinct_words", "n_letters", "n_upper", "n_digits", "n_marks")
STATISTICS = ", ".join(f"{name} long" for name in (*COUNTS, *MORE))
#: What conditions compare: ratios, so that a threshold means the same for a short and for a long text.
RATIOS = {
    "word_length": ("word_chars", "n_words"),
    "symbols_a_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "words_a_line": ("n_words", "n_lines"),
    "upper_share": ("n_upper", "n_letters"),
    "letter_share": ("n_letters", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "mark_share": ("n_marks", "word_chars"),
}
_BLANK, _LETTER, _UPPER, _DIGIT, _MARK = 0, 1, 2, 3, 4


@cache
def _classes() -> np.ndarray:
    """The class of every code point, by its general category."""
    kinds = {"Lu": _UPPER, "Lt": _UPPER, "Nd": _DIGIT}
    by_first = {"L": _LETTER, "M": _LETTER, "P": _MARK, "S": _MARK}
    names = (unicodedata.category(chr(c)) for c in range(0x110000))
    return np.fromiter((kinds.get(n, by_first.get(n[0], _BLANK)) for n in names), np.uint8, 0x110000)


def _repeated(words: list[bytes]) -> tuple[int, int]:
    """Number of different words, and of words inside windows of three that occur twice or more."""
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    if len(codes) < 4:
        return len(numbers), 0
    pairs = codes[:-1] * len(numbers) + codes[1:]
    if len(numbers) >= 1 << 21:  # then three numbers do not fit into one
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(numbers) + codes[2:]
    order = np.argsort(windows, kind="stable")
    equal = windows[order[1:]] == windows[order[:-1]]
    twice = np.zeros(len(windows) + 4, bool)
    twice[order[1:][equal] + 2] = True
    twice[order[:-1][equal] + 2] = True
    return len(numbers), int((twice[:-2] | twice[1:-1] | twice[2:]).sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """The numbers of ``COUNTS`` and ``MORE`` of a whole text; all 0 for a null one.

    Words are runs of characters other than blank, tab, line feed, vertical tab, form feed and carriage return; lines end at a line feed and
    count if they have a word.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return (0,) * (len(COUNTS) + len(MORE))
    chars = len(text) - sum(data.count(c) for c in b" \t\n\v\f\r")
    lines = [line for line in data.split(b"\n") if line.strip()]
    different, repeated = _repeated(words)
    kinds = np.bincount(_classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")], minlength=5).tolist()
    base = (len(words), chars, sum(data.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated)
    return (*base, len(lines), different, kinds[_LETTER] + kinds[_UPPER], kinds[_UPPER], kinds[_DIGIT], kinds[_MARK])


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and the statistics of ``text``, row by row."""
    kept = docs.select(*keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = np.array([statistics(text) for text in batch.column(len(keep)).to_pylist()], np.int64).reshape(-1, len(COUNTS) + len(MORE))
            arrays = [*batch.columns[: len(keep)], *(pa.array(column) for column in numbers.T)]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, *COUNTS, *MORE])

    return docs.select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(run, f"{fields}, {STATISTICS}")


def base_failed() -> Column:
    """Too few words, or too many of them repeated."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """A ratio of two statistics against a threshold; a ratio by 0 is 0."""

    ratio: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return self._compared(_ratio(self.ratio))

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return self._compared(values[self.ratio])

    def _compared(self, value):
        return value >= self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.ratio} {'>=' if self.above else '<='} {self.threshold:.6g}"


def _ratio(name: str) -> Column:
    over, under = (F.col(c).cast("double") for c in RATIOS[name])
    return F.when(under == 0, F.lit(0.0)).otherwise(over / under)


@dataclass(frozen=True)
class Rule:
    """A conjunction that rejects, with the labelled rows it covered when it was learned: rightly, wrongly."""

    conditions: tuple[Condition, ...]
    rejected: int
    wrong: int

    def column(self) -> Column:
        whole = self.conditions[0].column()
        for condition in self.conditions[1:]:
            whole = whole & condition.column()
        return whole

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return np.all([c.holds(values) for c in self.conditions], axis=0)

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def fired(rules: tuple[Rule, ...]) -> Column:
    """The number of the first rule that holds, from 1; null if none does: one conditional expression, in the order of the list."""
    if not rules:
        return F.lit(None).cast("int")
    chain = F.when(rules[0].column(), F.lit(1))
    for number, rule in enumerate(rules[1:], 2):
        chain = chain.when(rule.column(), F.lit(number))
    return chain


def _ratios(numbers: np.ndarray) -> dict[str, np.ndarray]:
    columns = dict(zip((*COUNTS, *MORE), numbers.T.astype(float)))
    out = {}
    for name, (over, under) in RATIOS.items():
        out[name] = np.divide(columns[over], columns[under], out=np.zeros(len(numbers)), where=columns[under] > 0)
    return out


def _best_condition(values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, Condition | None]:
    """The condition with most gain: rows for rejection covered, times the information gained about a covered row's label."""
    n, p = len(bad), int(bad.sum())
    before, best, chosen = np.log2(p / n), 1e-9, None
    for name, column in values.items():
        order = np.argsort(column, kind="stable")
        x, hit = column[order], np.cumsum(bad[order])
        cuts = np.flatnonzero(x[1:] > x[:-1])
        for above in (False, True):
            pos = p - hit[cuts] if above else hit[cuts]
            all_ = n - cuts - 1 if above else cuts + 1
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(pos > 0, pos * (np.log2(pos / all_) - before), 0)
            if len(gain) and gain.max() > best:
                at = cuts[int(np.argmax(gain))]
                # Between two neighbours, so that neither side depends on the last bit of a quotient.
                best, chosen = float(gain.max()), Condition(name, above, float((x[at] + x[at + 1]) / 2))
    return best, chosen


def _grown(values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Condition, ...]:
    """Conditions added one by one, each with most gain, until only rows for rejection are covered or none gains."""
    conditions: list[Condition] = []
    rows = np.ones(len(bad), bool)
    while len(conditions) < MAX_CONDITIONS and bad[rows].any() and not bad[rows].all():
        _, condition = _best_condition({k: v[rows] for k, v in values.items()}, bad[rows])
        if condition is None:
            break
        conditions.append(condition)
        rows &= condition.holds(values)
    return tuple(conditions)


def _pruned(conditions: tuple[Condition, ...], values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Condition, ...]:
    """The shortest beginning of the rule that does best on rows it was not grown on."""
    def worth(k: int) -> float:
        rows = Rule(conditions[:k], 0, 0).holds(values)
        right, wrong = int(bad[rows].sum()), int((~bad[rows]).sum())
        return (right - wrong) / (right + wrong) if right + wrong else -1.0

    return conditions[: max(range(1, len(conditions) + 1), key=lambda k: (round(worth(k), 12), -k))]


def learn(numbers: np.ndarray, bad: np.ndarray, pruning: np.ndarray) -> tuple[Rule, ...]:
    """An ordered list of rejecting rules from statistics, labels (True: reject) and the rows set aside for pruning.

    Sequential covering: grow a rule on the rows left, prune it on the rows set aside, keep it if it is precise on both, take
    away what it covers, and go on until no row for rejection is left or a rule fails. With labels of one kind there is no rule.
    """
    rules: list[Rule] = []
    values, left = _ratios(numbers), np.ones(len(bad), bool)
    while len(rules) < MAX_RULES:
        grow, prune = (left & ~pruning), (left & pruning)
        if not bad[grow].any() or bad[grow].all():
            break
        conditions = _grown({k: v[grow] for k, v in values.items()}, bad[grow])
        if not conditions:
            break
        if prune.any():
            conditions = _pruned(conditions, {k: v[prune] for k, v in values.items()}, bad[prune])
        covers = Rule(conditions, 0, 0).holds(values) & left
        parts = [(int((covers & part & bad).sum()), int((covers & part & ~bad).sum())) for part in (grow, prune)]
        if parts[0][0] == 0 or any(right < PRECISION * (right + wrong) for right, wrong in parts):
            break
        rules.append(Rule(conditions, parts[0][0] + parts[1][0], parts[0][1] + parts[1][1]))
        left &= ~covers
    return tuple(rules)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Rule, ...]:
    """Rules from the labelled learning rows (see ``training_row``) that the base rules pass, at most ``sample`` a label.

    Documents whose labels disagree, and null labels, are left out. Only the sampled documents are read in Python; the driver gets
    eleven numbers for each.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter("quality is not null and doc_id is not null")
    agreed = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).filter("quality = other")
    hashed = agreed.filter(training_row()).select("doc_id", "quality", F.xxhash64(F.lit("rules"), "doc_id").alias("h"))
    chosen = hashed.filter("quality = 0").orderBy("h", "doc_id").limit(sample).unionByName(hashed.filter("quality = 1").orderBy("h", "doc_id").limit(sample))
    # Bounded by the sample.
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen.select("doc_id", "quality")), "doc_id")
    counted = with_statistics(labelled, "doc_id", "quality").filter(~base_failed())
    # An id that many rows share counts once a different outcome, so the sample's bound holds for the rows too.
    rows = counted.groupBy("doc_id", "quality").agg(F.min(F.struct(*COUNTS, *MORE)).alias("s")).select("doc_id", "quality", "s.*").orderBy("doc_id").collect()
    if not rows:
        return ()
    numbers = np.array([r[2:] for r in rows], np.int64)
    pruning = np.array([(r["doc_id"] * 0x9E3779B97F4A7C15 >> 32) % PRUNE_SHARE == 0 for r in rows])
    return learn(numbers, np.array([r["quality"] == 0 for r in rows]), pruning)


def judge(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rule.

    ``rule`` is the number of the rule that rejects it, null if none does or the base rules did. Null, empty and blank texts
    have no words and fail the base rules; repeated rows and rows without id are judged each; an empty table gives an empty result.
    """
    counted = with_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    judged = counted.withColumn("base_failed", base_failed())
    rule = F.when(~F.col("base_failed"), fired(rules))
    return judged.select("doc_id", *COUNTS, "base_failed", rule.alias("rule")).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).select("doc_id", *COUNTS, "base_failed", "kept", "rule")
