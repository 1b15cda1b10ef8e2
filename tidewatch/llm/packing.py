"""Packing documents into fixed-length sequences by cutting-stock column generation."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import shuffle_partitions, staged
from tidewatch.llm.tokens import encoder, vocabulary

SEQUENCE = 1024
#: The linear program stops when its padding is proved within this share of the optimum.
GAP = 5e-4
#: Columns priced at most; it bounds driver time and can only cost padding, as the first patterns are close already.
MAX_COLUMNS = 300
VOCABULARY = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, text_key long"


def first_patterns(lengths: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A basis and its inverse: each column fills a sequence greedily, longest first, from the lengths not used up yet.

    Every column, taken as often as it can be, uses up one more length and has its place; so the matrix is triangular
    up to order, and its solution is not negative. The inverse grows by one pivot a column.
    """
    left = counts.astype(float)
    basis = np.zeros((len(lengths), len(lengths)))
    inverse = np.eye(len(lengths))
    alive = list(np.argsort(-lengths))
    while alive:
        room = size
        column = np.zeros(len(lengths))
        for i in alive:
            if lengths[i] <= room:
                column[i] = room // lengths[i]
                room -= int(column[i]) * lengths[i]
            if room == 0:
                break
        used = np.flatnonzero(column)
        times = left[used] / column[used]
        out = used[np.argmin(times)]
        left[used] = np.maximum(0, left[used] - times.min() * column[used])
        alive.remove(out)
        basis[:, out] = column
        # What the columns before used up is not in this one, so its direction is the column itself.
        _pivot(inverse, column, out)
    return basis, inverse


def _pivot(inverse: np.ndarray, direction: np.ndarray, out: int) -> None:
    row = inverse[out] / direction[out]
    changed = np.flatnonzero(direction)
    inverse[changed] -= direction[changed, None] * row
    inverse[out] = row


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    # Not the BLAS product: its thread pool can block in a process that also drives a JVM.
    return np.einsum("ij,j->i", matrix, vector)


def priced_pattern(lengths: np.ndarray, prices: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern, by dynamic programming over the capacity (unbounded knapsack)."""
    keep = np.flatnonzero(prices > 0)
    best, choice = np.zeros(size + 1), np.full(size + 1, -1)
    order = keep[np.argsort(lengths[keep])]
    long, price = lengths[order], prices[order]
    fits = np.searchsorted(long, np.arange(size + 1), side="right")
    for room in range(1, size + 1):
        best[room] = best[room - 1]
        if fits[room]:
            values = best[room - long[: fits[room]]] + price[: fits[room]]
            at = int(np.argmax(values))
            if values[at] > best[room]:
                best[room], choice[room] = values[at], order[at]
    pattern, room = np.zeros(len(lengths)), size
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= lengths[choice[room]]
    return float(best[size]), pattern


def solve(lengths: np.ndarray, counts: np.ndarray, size: int = SEQUENCE, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (a column each) and how often each is used, not rounded: the linear program of the cutting-stock problem.

    The revised simplex method keeps the inverse of the basis; the duals price a new column by knapsack. It ends at the
    optimum, or as soon as the objective is within ``gap`` of a lower bound: all tokens over the size, or the duals scaled by the best column's value.
    """
    basis, inverse = first_patterns(lengths, counts, size)
    times = _times(inverse, counts)
    floor = float((lengths * counts).sum()) / size
    for _ in range(MAX_COLUMNS):
        if times.sum() <= floor * (1 + gap):
            break
        prices = inverse.sum(axis=0)
        value, column = priced_pattern(lengths, prices, size)
        if value > 0:
            floor = max(floor, float((prices * counts).sum()) / value)
        if value <= 1 + 1e-9:
            break
        direction = _times(inverse, column)
        up = np.flatnonzero(direction > 1e-9)
        ratios = np.maximum(times[up], 0) / direction[up]
        out = up[np.argmin(ratios)]
        basis[:, out] = column
        _pivot(inverse, direction, out)
        step = ratios.min()
        times = times - step * direction
        times[out] = step
    return basis, np.maximum(times, 0)


@dataclass
class Plan:
    """Where the piece of a given length and rank goes. Bounded by the number of lengths, whatever the number of pieces.

    runs: by length, arrays (first rank, first sequence, pieces per sequence, first offset) of patterns used in bulk;
    cuts: by (length, rank), the parts (start in the piece, length, sequence, offset) of pieces in the last sequences.
    """

    runs: dict[int, np.ndarray]
    cuts: dict[tuple[int, int], list[tuple[int, int, int, int]]]
    sequences: int


def plan(histogram: dict[int, int], size: int = SEQUENCE) -> Plan:
    """Round the linear program down; what is left over (less than a sequence a pattern) fills the last sequences, cut where one is full."""
    lengths = np.array(sorted(histogram), np.int64)
    if not len(lengths):
        return Plan({}, {}, 0)
    counts = np.array([histogram[n] for n in lengths], np.int64)
    patterns, times = solve(lengths, counts, size)
    whole = np.rint(patterns).astype(np.int64)
    bulk = np.floor(times + 1e-7).astype(np.int64)
    for i in np.flatnonzero(whole @ bulk > counts):
        for k in np.flatnonzero(whole[i]):
            over = int(whole[i] @ bulk - counts[i])
            if over > 0:
                bulk[k] -= min(bulk[k], -(-over // whole[i, k]))
    runs: dict[int, list] = {int(n): [] for n in lengths}
    ranks, sequence = np.zeros(len(lengths), np.int64), 0
    for k in np.flatnonzero(bulk):
        offset = 0
        for i in np.flatnonzero(whole[:, k])[::-1]:
            runs[int(lengths[i])].append((int(ranks[i]), sequence, int(whole[i, k]), offset))
            ranks[i] += whole[i, k] * bulk[k]
            offset += int(whole[i, k] * lengths[i])
        sequence += int(bulk[k])
    cuts: dict[tuple[int, int], list] = {}
    offset = 0
    for i in range(len(lengths) - 1, -1, -1):
        for rank in range(int(ranks[i]), int(counts[i])):
            parts, done, length = [], 0, int(lengths[i])
            while done < length:
                take = min(length - done, size - offset)
                parts.append((done, take, sequence, offset))
                done, offset = done + take, offset + take
                if offset == size:
                    sequence, offset = sequence + 1, 0
            cuts[length, rank] = parts
    return Plan({n: np.array(r, np.int64).reshape(-1, 4) for n, r in runs.items()}, cuts, sequence + (offset > 0))


def pieces(docs: DataFrame, size: int = SEQUENCE, names: tuple[str, str] = VOCABULARY) -> DataFrame:
    """Each document's ids and a closing 0, cut into whole sequences and a rest: a row per piece, ids only as their checksum."""
    paths = tuple(map(vocabulary, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*paths)
        for batch in batches:
            rows = []
            for doc_id, text, key in zip(*(c.to_pylist() for c in batch.columns)):
                ids = encode.ids(text) + bytes(4)
                n = len(ids) // 4
                rows += [(doc_id, at, min(size, n - at), zlib.crc32(ids[4 * at : 4 * (at + size)]), n, key) for at in range(0, n, size)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], PIECE.replace(" long", "").split(", "))

    return _texts(docs).mapInArrow(run, PIECE)


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def ranked(rows: DataFrame) -> DataFrame:
    """Add ``rank``, from 0 within each length: a count per (length, salt), summed up, plus the place within the salt."""
    salts = 4 * shuffle_partitions(rows.sparkSession)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "text_key"), F.lit(salts)))
    before = salted.groupBy("length", "salt").count().selectExpr(
        "length", "salt", "coalesce(sum(count) over (partition by length order by salt rows between unbounded preceding and 1 preceding), 0) as before"
    )
    placed = salted.selectExpr("*", "row_number() over (partition by length, salt order by doc_id, start, text_key) - 1 as place")
    return placed.join(before, ["length", "salt"]).withColumn("rank", F.col("place") + F.col("before")).drop("salt", "place", "before")


def pack(docs: DataFrame, size: int = SEQUENCE, names: tuple[str, str] = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The driver sees the histogram of piece lengths alone (``size`` numbers). Whole sequences stand by themselves, rests are placed by the
    patterns. Null and empty texts are one piece, the closing id; repeated rows and rows without id are packed like
    any other; an empty table packs to nothing.
    """
    rows = staged(pieces(docs, size, names), "pack-pieces")
    histogram = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    todo = plan(histogram, size)
    paths = tuple(map(vocabulary, names))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for length, group in frame.groupby("length", sort=False):
                runs, rank = todo.runs[length], group["rank"].to_numpy()
                bulk = np.array([(length, r) not in todo.cuts for r in rank.tolist()], bool)
                some = group[bulk].drop(columns="rank")
                if len(some):
                    at = np.searchsorted(runs[:, 0], rank[bulk], side="right") - 1
                    nth = rank[bulk] - runs[at, 0]
                    some["sequence_id"] = runs[at, 1] + nth // runs[at, 2]
                    some["offset"] = runs[at, 3] + nth % runs[at, 2] * length
                    some["cut"] = False
                    out.append(some)
                for row in group[~bulk].itertuples(index=False):
                    parts = todo.cuts[length, row.rank]
                    out.append(pd.DataFrame([
                        (row.doc_id, row.start + a, n, row.ids_crc32, row.doc_tokens, row.text_key, s, o, len(parts) > 1) for a, n, s, o in parts
                    ], columns=[*columns, "sequence_id", "offset", "cut"]))
            if out:
                yield pd.concat(out, ignore_index=True)[[*columns, "sequence_id", "offset", "cut"]].astype({"doc_id": "Int64"})

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "text_key"]
    placed = staged(ranked(rows).select(*columns, "rank").mapInPandas(place, f"{PIECE}, sequence_id long, offset long, cut boolean"), "pack-placed")

    def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*paths)
        for batch in batches:
            ids = [encode.ids(t) + bytes(4) for t in batch.column("text").to_pylist()]
            spans = zip(batch.column("start").to_pylist(), batch.column("length").to_pylist())
            crc = [zlib.crc32(i[4 * a : 4 * (a + n)]) for i, (a, n) in zip(ids, spans)]
            yield batch.drop_columns(["text", "ids_crc32"]).append_column("ids_crc32", pa.array(crc, pa.int64()))

    # Less than a sequence a pattern is left over, and each last sequence cuts at most one piece: at most 2 x size rows.
    cut = placed.filter("cut").drop("cut")
    recut = cut.join(
        _texts(docs).join(F.broadcast(cut.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).distinct()),
                          F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left_semi")
        .dropDuplicates(["doc_id", "text_key"]).select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "text"),
        F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")),
    ).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "text")
    fields = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32"]
    summed = recut.mapInArrow(checksums, ", ".join(f"{c} long" for c in fields))
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return placed.filter("not cut").select(*out).unionByName(summed.select(*out))
