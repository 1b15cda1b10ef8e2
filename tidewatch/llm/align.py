"""Cross-tokenizer alignment: which tokens of one vocabulary cover the same text as which of another, by diagonal run skipping."""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import staged
from tidewatch.llm.tokens import encoder, vocabulary

#: Vocabulary A as a tokenizer file and as ranks, vocabulary B as a sentence-piece model.
FIRST = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
SECOND = "piece_bpe_32k.model"
#: Code points taken together in one array step; bounds the memory of a task, not the result.
CHUNK = 1_000_000
#: From this many links on, a group's equal ids are counted first, so that a long group makes no more links than it has different pairs.
LONG_GROUP = 64
#: Up to this many different pairs (about 100 MB as a hash table) the counts are broadcast; more are joined by shuffle.
BROADCAST_PAIRS = 2_000_000

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def _byte_alphabet() -> dict[str, int]:
    """The visible character that stands for each byte in a byte-level vocabulary: itself if printable, else the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Side:
    """Bytes of each id of a vocabulary, their number, and the id as text after each separator."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.lengths = np.array([len(p) for p in pieces], np.int64)

    def bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.tolist()))


class Pair:
    """Both tokenizers of a worker."""

    def __init__(self, json_path: str, ranks_path: str, model_path: str):
        import sentencepiece

        with open(json_path, encoding="utf-8") as file:
            vocab = json.load(file)["model"]["vocab"]
        alphabet = _byte_alphabet()
        first = [b""] * (max(vocab.values()) + 1)
        for piece, number in vocab.items():
            first[number] = bytes(alphabet[c] for c in piece) if all(c in alphabet for c in piece) else piece.encode()
        self.encoder = encoder(json_path, ranks_path)
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        second = []
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            second.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(number) else piece.replace("▁", " ").encode())
        self.a, self.b = Side(first), Side(second)
        numbers = [str(i) for i in range(max(len(first), len(second)))]
        self.shown = [separator + n for separator in (",", ";", "|") for n in numbers]
        self.ids = len(numbers)

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides; none where a text is empty or its bytes do not come back from both."""
        none = np.zeros(0, np.int64)
        seconds = self.model.encode([t or "" for t in texts], num_threads=1)
        out = []
        for text, second in zip(texts, seconds):
            a = b = none
            if text:
                a, b = np.frombuffer(self.encoder.ids(f" {text}"), "<u4").astype(np.int64), np.array(second, np.int64)
                whole = f" {text}".encode("utf-8", "surrogatepass")
                if self.a.bytes(a) != whole or self.b.bytes(b) != whole:
                    a = b = none
            out.append((a, b))
        return out


@cache
def _pair(json_path: str, ranks_path: str, model_path: str) -> Pair:
    return Pair(json_path, ranks_path, model_path)


def common_cuts(ends_a: list[int], ends_b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places (in A, in B) of the tokens with which each group closes: both end arrays hold the same number there.

    At a shift of j - i between the arrays, windows of doubling length are compared; the first unequal one is halved down to the
    place where the stretch of one-to-one groups stops. There the group is resolved token by token, which gives the next shift.
    """
    size, i, j = len(ends_a), 0, 0
    runs_a, runs_b, lengths = [], [], []
    while i < size:
        if ends_a[i] == ends_b[j]:
            good, width = 1, 2
            while i + good + width <= size and ends_a[i + good : i + good + width] == ends_b[j + good : j + good + width]:
                good += width
                width *= 2
            while width > 1:
                width //= 2
                if i + good + width <= size and ends_a[i + good : i + good + width] == ends_b[j + good : j + good + width]:
                    good += width
        else:
            good = 1
            a, b = ends_a[i], ends_b[j]
            while a != b:
                if a < b:
                    i += 1
                    a = ends_a[i]
                else:
                    j += 1
                    b = ends_b[j]
        runs_a.append(i)
        runs_b.append(j)
        lengths.append(good)
        i += good
        j += good
    lengths = np.array(lengths, np.int64)
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return tuple(np.repeat(np.array(runs, np.int64), lengths) + inside for runs in (runs_a, runs_b))


def _links(a: np.ndarray, b: np.ndarray, doc: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, times) of all links of the groups, each different pair of a document once; ``doc`` and the sizes are by group."""
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    long = np.flatnonzero(n_a * n_b >= LONG_GROUP)
    short = n_a * n_b < LONG_GROUP
    of_a = np.repeat(np.arange(len(n_a)), n_a)
    times = np.where(short, n_b, 0)[of_a]
    left = np.repeat(np.arange(len(a)), times)
    right = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times) + first_b[of_a[left]]
    docs, pairs, weights = [doc[of_a[left]]], [a[left] * wide + b[right]], [np.ones(len(left), np.int64)]
    for g in long.tolist():
        x, x_times = np.unique(a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
        y, y_times = np.unique(b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
        pairs.append((x[:, None] * wide + y[None, :]).ravel())
        weights.append((x_times[:, None] * y_times[None, :]).ravel())
        docs.append(np.full(len(pairs[-1]), doc[g]))
    docs, pairs, weights = (np.concatenate(x) for x in (docs, pairs, weights))
    order = np.lexsort((pairs, docs))
    docs, pairs, weights = docs[order], pairs[order], weights[order]
    if not len(docs):
        return docs, pairs, weights
    new = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (pairs[1:] != pairs[:-1])]))
    return docs[new], pairs[new], np.add.reduceat(weights, new)


def align(texts: list[str | None], tools: Pair) -> dict[str, list]:
    """Per text: numbers of tokens, groups and links, the hash of the groups, and the different linked pairs with their times."""
    ids = tools.encode(texts)
    a, b = (np.concatenate([pair[side] for pair in ids]) for side in (0, 1))
    counts = np.array([(len(x), len(y)) for x, y in ids], np.int64).reshape(-1, 2)
    # All texts in one stretch of bytes: a text ends where both sides end, so no group crosses it.
    cut_a, cut_b = common_cuts(*(np.cumsum(side.lengths[x]).tolist() for side, x in ((tools.a, a), (tools.b, b))))
    n_a, n_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
    last = np.cumsum(counts[:, 0])
    doc = np.searchsorted(last, cut_a, side="right")
    groups = np.bincount(doc, minlength=len(texts))
    links = np.zeros(len(texts), np.int64)
    np.add.at(links, doc, n_a * n_b)
    # The ids as text: A's of a group, then B's, a separator before each; the first of a text is cut off again.
    group = np.arange(len(cut_a))
    first_a, first_b = (np.concatenate([[True] * bool(len(n)), np.diff(np.repeat(group, n)) > 0]) if len(n) else np.zeros(0, bool) for n in (n_a, n_b))
    shown = np.concatenate([a + np.where(first_a, tools.ids, 0), b + np.where(first_b, 2 * tools.ids, 0)])
    order = np.argsort(np.concatenate([np.repeat(2 * group, n_a), np.repeat(2 * group + 1, n_b)]), kind="stable")
    ends = np.cumsum(counts.sum(axis=1)).tolist()
    shown, hashes, start = shown[order].tolist(), [], 0
    for end in ends:
        text = "".join(map(tools.shown.__getitem__, shown[start:end]))
        hashes.append(hashlib.sha256(text[1:].encode()).hexdigest() if text else "")
        start = end
    docs, pairs, times = _links(a, b, doc, n_a, n_b, len(tools.b.pieces))
    bounds = np.searchsorted(docs, np.arange(len(texts) + 1))
    offsets = pa.array(bounds, pa.int32())
    return {
        "n_a": counts[:, 0], "n_b": counts[:, 1], "n_groups": groups, "n_links": links, "groups_sha256": hashes,
        "pairs": pa.ListArray.from_arrays(offsets, pa.array(pairs, pa.int64())), "times": pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
    }


def aligned(docs: DataFrame, first: tuple[str, str] = FIRST, second: str = SECOND) -> DataFrame:
    """Each document's alignment with its linked id pairs: ``pairs`` holds a * (size of B) + b, ``times`` how often each is linked."""
    paths = (*map(vocabulary, first), vocabulary(second))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _pair(*paths)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            weights = np.cumsum([len(t or "") + 1 for t in texts])
            start = 0
            while start < len(texts):
                stop = max(start + 1, int(np.searchsorted(weights, (weights[start - 1] if start else 0) + CHUNK, side="right")))
                found = align(texts[start:stop], tools)
                arrays = [ids.slice(start, stop - start), *(v if isinstance(v, pa.Array) else pa.array(v) for v in found.values())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *found])
                start = stop

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ALIGNED)


def pair_counts(links: DataFrame, wide: int) -> DataFrame:
    """(pair, n_docs, is_best): in how many documents each pair is linked, and whether that is the most its A id has with any B id."""
    counts = links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n_docs"))
    counts = staged(counts, "align-counts")
    best = counts.groupBy(F.expr(f"pair div {wide}").alias("a")).agg(F.max("n_docs").alias("most"))
    rated = counts.withColumn("a", F.expr(f"pair div {wide}")).join(best, "a")
    return rated.select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("is_best"))


def alignment(docs: DataFrame, first: tuple[str, str] = FIRST, second: str = SECOND) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Texts are read once; what stays is a table of each document's different pairs. Their counts over all documents are
    summed up in the tasks first, then by pair, and joined back by pair, or broadcast if there are at most ``BROADCAST_PAIRS``.
    Null and empty texts, and texts that a vocabulary does not give back byte for byte, have no tokens: zeros and an empty hash.
    Repeated rows and rows without id are documents of their own. An empty table gives an empty result.
    """
    import sentencepiece

    wide = sentencepiece.SentencePieceProcessor(model_file=vocabulary(second)).get_piece_size()
    links = staged(aligned(docs, first, second).withColumn("row", F.monotonically_increasing_id()), "align-links")
    rated = staged(pair_counts(links, wide), "align-rated")
    small = rated.count() <= BROADCAST_PAIRS
    each = links.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    met = each.join(F.broadcast(rated) if small else rated, "pair")
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n_docs")).alias("count_sum")
    )
    out = links.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "row", "left")
    zero = [F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("n_best", "count_sum")]
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")
