"""Personal data by weak supervision, in DataFrame operations only.

Four base detectors (email, ip, card, phone) find spans by pattern and check. Around them, labelers of three sorts (patterns, gazetteers, words
nearby) vote on a wider set of candidate spans; expectation-maximisation estimates how reliable each labeler is from their
agreement alone, and a logistic classifier trained on its posteriors decides which candidates become spans as well.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: the base kinds in order, and their patterns ------------------------------------------------
# Each starts where no earlier match could have begun, so one pass over a text is linear; the matches are the leftmost ones of the plain pattern.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

#: Candidate spans, beyond the base ones: anything shaped like an address, a number to reach someone by, or a credential.
CANDIDATE = "|".join([
    rf"(?<!{LOCAL}){LOCAL}++@[A-Za-z0-9][A-Za-z0-9.-]*+",
    r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|secret|token|api[_-]?key)[\"']?[ ]?[=:][ ]?[\"']?[^\s\"',;]{6,}+",
    r"(?<![A-Za-z0-9])[A-Z]{4}[0-9A-Z]{16}(?![A-Za-z0-9])",
    r"(?<![A-Za-z0-9])[0-9a-f]{32,}+(?![A-Za-z0-9])",
    r"(?<![0-9A-Za-z.+])\+?\(?[0-9][0-9 ().-]{7,}[0-9](?![0-9A-Za-z])",
])
TRIGGER = r"[0-9@=:]"
EXTRA_KINDS = ("email", "number", "secret")

# --- Fixed values: gazetteers and words nearby ----------------------------------------------------------------
DOMAINS = "com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au ch at be se no dk pl pt ru jp cn in br mx"
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 98"
KEY_PREFIXES = "AKIA ASIA ghp_ gho_ xoxb xoxp"
CUES = "mail tel phone call mobile fax contact card visa account iban address host password passwd pwd secret key token login"
COUNTER_CUES = "version isbn page figure chapter section table article no nr vol id"

CONTEXT = 24
THRESHOLD = 0.5
EM_ROUNDS, FIT_ROUNDS = 60, 400
LABELERS = ("pattern", "check", "gazetteer", "cue", "counter_cue", "form")
FEATURES = ("length", "digits", "classes", "line_end")


# --- spans ----------------------------------------------------------------------------------------------------


def _spans(text: Column, pattern: str, when: Column) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, value), in code points. The text between matches gives the places."""
    found = F.when(when, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    between = F.when(when, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>"))
    pairs = F.slice(F.arrays_zip(found.alias("value"), between.alias("gap")), F.lit(1), F.size(found))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["value"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value")))).alias("out"))

    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _ip_parts(value: Column) -> Column:
    def small(part: Column) -> Column:
        plain = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return (F.length(plain) <= 3) & (F.lpad(plain, 3, "0") <= "255")

    return F.forall(F.split(value, r"\."), small)


def base_spans(text: Column) -> dict[str, Column]:
    """By kind the spans that pass their check; failing matches are dropped and not tried again."""
    size = lambda s, low, high: F.length(_digits(s["value"])).between(low, high)
    return {
        "email": _spans(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(_spans(text, IP, text.rlike(r"[0-9]\.[0-9]")), lambda s: _ip_parts(s["value"])),
        "card": F.filter(_spans(text, CARD, text.rlike("[0-9]")), lambda s: size(s, 14, 19) & F.call_function("luhn_check", _digits(s["value"]))),
        "phone": F.filter(_spans(text, PHONE, F.contains(text, F.lit("+"))), lambda s: size(s, 10, 15)),
    }


# --- candidates and votes -------------------------------------------------------------------------------------


def _one_of(words: str) -> str:
    return "(?:" + "|".join(w.replace("_", "[_]") for w in words.split()) + ")"


def _vote(yes: Column, no: Column | None = None) -> Column:
    vote = F.when(yes, 1)
    return F.coalesce((vote if no is None else vote.when(no, -1)).otherwise(0), F.lit(0))


def described(text: Column, span: Column) -> Column:
    """A candidate's kind, the labelers' votes (1 for, -1 against, 0 abstaining) and the classifier's features."""
    value = span["value"]
    digits = _digits(value)
    left = F.lower(F.substring(text, F.greatest(F.lit(1), span["start"] + 1 - CONTEXT), F.least(span["start"], F.lit(CONTEXT))))
    right = F.substring(text, span["end"] + 1, F.lit(2))
    email, number = F.contains(value, F.lit("@")), value.rlike(r"^[+(]?[0-9][0-9 ().-]*$")
    kind = F.when(email, "email").when(number, "number").otherwise("secret")
    long_number = number & F.length(digits).between(13, 19)
    named = value.rlike(r"[=:]")
    votes = {
        "pattern": _vote(
            (email & value.rlike(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$")) | (number & value.rlike(r"^(\+[0-9]|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$|[0-9]{4}([ -][0-9]{4}){3}$)")) | (~email & ~number & (named | value.rlike("^[A-Z0-9]+$"))),
            email | (number & value.rlike(r"^[0-9]{1,4}[.-][0-9]{1,2}[.-][0-9]{1,4}$")),
        ),
        "check": _vote((long_number & F.call_function("luhn_check", digits)) | (number & value.rlike(r"^[0-9]+(\.[0-9]+){3}$") & _ip_parts(value)), long_number),
        "gazetteer": _vote(
            (email & F.lower(value).rlike(rf"\.{_one_of(DOMAINS)}$")) | (number & value.rlike(rf"^\+{_one_of(CALLING_CODES)}[^0-9]|^\+{_one_of(CALLING_CODES)}")) | value.rlike(rf"^{_one_of(KEY_PREFIXES)}")
            | (long_number & digits.rlike("^(4|5[1-5]|3[47]|6011)")),
            email | (number & F.startswith(value, F.lit("+"))),
        ),
        "cue": _vote(left.rlike(rf"{_one_of(CUES)}[^a-z]*$") | (named & ~email & ~number)),
        "counter_cue": _vote(F.lit(False), left.rlike(rf"(^|[^a-z]){_one_of(COUNTER_CUES)}[.:]?\s*$|[$€£]\s*$")),
        "form": _vote((email & (F.length(value) <= 100)) | (number & (F.length(digits) >= 10)) | (~email & ~number & value.rlike("[0-9]") & value.rlike("[A-Za-z]")), number & (F.length(digits) < 7)),
    }
    share = F.length(digits) / F.length(value)
    features = {
        "length": F.least(F.lit(6), F.floor(F.length(value) / 8)).cast("int"),
        "digits": F.floor(share * 4).cast("int"),
        "classes": value.rlike("[a-z]").cast("int") + 2 * value.rlike("[A-Z]").cast("int") + 4 * value.rlike("[^A-Za-z0-9]").cast("int"),
        "line_end": (right.rlike(r"^(\s|$)")).cast("int"),
    }
    return F.struct(
        span["start"].alias("start"), span["end"].alias("end"), kind.alias("kind"), *[votes[n].alias(n) for n in LABELERS], *[features[n].alias(n) for n in FEATURES]
    )


def candidates(text: Column) -> Column:
    return F.transform(_spans(text, CANDIDATE, text.rlike(TRIGGER)), lambda s: described(text, s))


# --- model ----------------------------------------------------------------------------------------------------


@dataclass
class Model:
    """Reliabilities of the labelers by kind, from EM, and the weights of the span classifier; a few hundred numbers."""

    reliability: dict[str, np.ndarray]  # by kind: (class, labeler, vote + 1)
    prior: dict[str, float]
    weights: dict[str, float]  # by "kind name=value"

    def probability(self, candidate: Column) -> Column:
        names = [F.concat(candidate["kind"], F.lit(f" {n}="), candidate[n].cast("string")) for n in (*LABELERS, *FEATURES)]
        names.append(F.concat(candidate["kind"], F.lit(" bias=1")))
        if not self.weights:
            return F.lit(0.0)
        table = F.create_map(*[F.lit(x) for pair in sorted(self.weights.items()) for x in pair])
        total = sum((F.coalesce(F.element_at(table, n), F.lit(0.0)) for n in names), F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def estimate(votes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """EM over the labelers' votes (rows of -1, 0, 1, each seen ``counts`` times): (reliability, prior, posterior of each row).

    Two classes; given the class, labelers vote independently. It starts from labelers that are right more often than not, so
    class 1 is the one they vote for.
    """
    n = votes.shape[1]
    chance = np.empty((2, n, 3))
    chance[0], chance[1] = (0.5, 0.35, 0.15), (0.15, 0.35, 0.5)
    prior = 0.5
    posterior = np.full(len(votes), 0.5)
    for _ in range(EM_ROUNDS):
        score = [np.log(p) + np.log(chance[c][np.arange(n), votes + 1]).sum(axis=1) for c, p in ((0, 1 - prior), (1, prior))]
        posterior = 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))
        for c, weight in ((0, counts * (1 - posterior)), (1, counts * posterior)):
            for v in (-1, 0, 1):
                chance[c, :, v + 1] = (weight[:, None] * (votes == v)).sum(axis=0) + 1
            chance[c] /= chance[c].sum(axis=1, keepdims=True)
        prior = float(np.clip((counts * posterior).sum() / counts.sum(), 1e-3, 1 - 1e-3))
    return chance, prior, posterior


def _fit(design: np.ndarray, targets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Logistic regression with soft targets by gradient descent with momentum; rows weigh as their counts."""
    weights, speed, share = np.zeros(design.shape[1]), np.zeros(design.shape[1]), counts / counts.sum()
    for _ in range(FIT_ROUNDS):
        chance = 1 / (1 + np.exp(-np.clip((design * weights).sum(axis=1), -30, 30)))
        speed = 0.9 * speed - ((share * (chance - targets))[:, None] * design).sum(axis=0) - 1e-5 * weights
        weights = weights + speed
    return weights


def train(docs: DataFrame) -> Model:
    """Votes of all candidates of all texts, counted by vote and feature pattern: only these counts, a bounded table, reach the driver."""
    found = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).select(F.explode(candidates(F.col("text"))).alias("c"))
    names = ["kind", *LABELERS, *FEATURES]
    rows = found.select(*[F.col(f"c.{n}").alias(n) for n in names]).groupBy(*names).count().collect()
    rows = sorted(rows, key=lambda r: tuple(map(str, r)))
    model = Model({}, {}, {})
    for kind in EXTRA_KINDS:
        own = [r for r in rows if r["kind"] == kind]
        if not own:
            continue
        counts = np.array([r["count"] for r in own], float)
        votes = np.array([[r[n] for n in LABELERS] for r in own], np.int64)
        model.reliability[kind], model.prior[kind], posterior = estimate(votes, counts)
        terms = sorted({f"{kind} {n}={r[n]}" for r in own for n in (*LABELERS, *FEATURES)} | {f"{kind} bias=1"})
        place = {t: i for i, t in enumerate(terms)}
        design = np.zeros((len(own), len(terms)))
        for i, r in enumerate(own):
            design[i, [place[f"{kind} {n}={r[n]}"] for n in (*LABELERS, *FEATURES)]] = 1
            design[i, place[f"{kind} bias=1"]] = 1
        fitted = _fit(design, posterior, counts)
        model.weights |= {t: float(w) for t, w in zip(terms, fitted) if math.isfinite(w)}
    return model


def find(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, base, spans): the base spans and all spans of each whole text, arrays of (start, rank, kind, end) in order.

    A candidate that the classifier accepts is added if no base span overlaps it. Starts and ends are code points, the end is
    exclusive. Null and empty texts have no spans; repeated rows and rows without id are rows like any other; an empty table gives
    no rows. Extra columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = rows.select("doc_id", *[c.alias(k) for k, c in base_spans(F.col("text")).items()], candidates(F.col("text")).alias("candidates"))

    def shaped(kind: str, rank: int) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    base = F.array_sort(F.concat(*[shaped(k, i) for i, k in enumerate(KINDS)]))
    marked = found.select("doc_id", base.alias("base"), "candidates")
    accepted = F.filter("candidates", lambda c: (model.probability(c) > THRESHOLD) & ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    extra = F.transform(
        accepted,
        lambda c: F.struct(c["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), F.concat(F.lit("likely_"), c["kind"]).alias("kind"), c["end"].alias("end")),
    )
    return marked.select("doc_id", "base", F.array_sort(F.concat("base", extra)).alias("spans"))


def joined(spans: str) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
