"""SimHash near-duplicates: covering locality-sensitive hashing, no pair within the radius is missed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import components, staged

SHINGLE_WORDS = 3
RADIUS = 2
BITS = 64
#: A run of fingerprints with one table key up to this length is compared pair by pair, a longer one by
#: looking up all neighbours of each member; both find every link.
PAIRWISE_RUN = 256
#: Keys held by more fingerprints than this are split by the bits that the table's mask leaves out.
HOT_KEY = 20_000


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 bit masks; any ``radius`` bit positions are all outside at least one of them.

    Bit i carries the vector m(i) = 1 + i mod (2^(radius+1) - 1); mask v holds the bits whose product with v over
    GF(2) is odd. ``radius`` vectors span too little of the (radius+1)-dimensional space to leave no v orthogonal
    to all of them, so two fingerprints that differ only there agree under mask v.
    """
    full = 1 << (radius + 1)
    vectors = [1 + i % (full - 1) for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, full)]


def text_fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Majority of the XXH64 (seed 42) bits of the word shingles; 0 for a text without words."""
    import xxhash

    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(tokens) - words + 1)
    last = (ends - 1)[min(words, len(tokens)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[a:b], 42) for a, b in zip(starts[:n].tolist(), last.tolist())), np.uint64, n
    )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of each whole text as a signed 64-bit number. Null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((text_fingerprint(t) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _pairs(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of sorted distinct ``fps`` within ``radius`` bits."""
    if len(fps) <= PAIRWISE_RUN:
        left, right = np.triu_indices(len(fps), 1)
        near = np.bitwise_count(fps[left] ^ fps[right]) <= radius
        return fps[left[near]], fps[right[near]]
    out_a, out_b = [], []
    flips = [np.uint64(0)]
    for _ in range(radius):
        flips = sorted({int(f) ^ (1 << i) for f in flips for i in range(BITS)} | {int(f) for f in flips})
    for flip in flips:
        other = fps ^ np.uint64(flip)
        at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
        hit = (fps[at] == other) & (fps < other)
        out_a.append(fps[hit])
        out_b.append(other[hit])
    return np.concatenate(out_a), np.concatenate(out_b)


def near_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): every pair of the distinct fingerprints ``distinct(fp)`` that differ in at most ``radius`` bits.

    Each fingerprint goes to one key per covering mask. A key that more than ``HOT_KEY`` fingerprints hold
    is split exactly: the bits outside its mask are cut into radius + 1 blocks, and two members within the
    radius agree on one of them. What one key then holds is bounded by the free bits, and only links are emitted.
    """
    masks = covering_masks(radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = distinct.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("mask", "key")
    )
    counted = keyed.groupBy("mask", "key").count().filter("count > 1")
    hot = counted.select("mask", "key", (F.col("count") > HOT_KEY).alias("hot"))
    blocks = []
    for m in masks:
        free = [i for i in range(BITS) if not m >> i & 1]
        cut = [sum(1 << i for i in free[k :: radius + 1]) for k in range(radius + 1)]
        blocks.append(F.array(*[F.lit(c - (1 << 64) if c >> 63 else c).cast("long") for c in cut]))
    block = F.when(F.col("hot"), F.element_at(F.array(*blocks), F.col("mask") + 1)).otherwise(F.array(F.lit(0).cast("long")))
    dealt = (
        keyed.join(hot, ["mask", "key"])
        .select("fp", "mask", "key", F.posexplode(block).alias("block", "bits"))
        .select("fp", "mask", "key", "block", F.col("fp").bitwiseAND(F.col("bits")).alias("part"))
    )
    parts = ["mask", "key", "block", "part"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            starts = np.flatnonzero((frame[parts] != frame[parts].shift()).any(axis=1).to_numpy())
            rest = frame.iloc[starts[-1] :]
            yield links(frame.iloc[: starts[-1]], starts[:-1])
        if rest is not None:
            yield links(rest, np.array([0]))

    def links(frame: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        fps = frame["fp"].to_numpy(np.int64).view(np.uint64)
        found = [_pairs(np.sort(fps[a:b]), radius) for a, b in zip(starts, [*starts[1:], len(fps)]) if b - a > 1]
        a, b = (np.concatenate([f[i] for f in found]) if found else np.array([], np.uint64) for i in (0, 1))
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.repartition(*parts).sortWithinPartitions(*parts).mapInPandas(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fp (signed), component_id, the smallest doc_id reachable over links.

    Documents link when their fingerprints differ in at most ``radius`` bits. Equal fingerprints are folded
    first, so copies never form pairs. Null and empty texts have fingerprint 0 and link like any other;
    repeated rows stay rows; a document without id takes the smallest id of its component, null if there is none.
    An empty table gives an empty result.
    """
    marked = staged(fingerprints(docs, id_col, text_col), "simhash-marked")
    folded = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "simhash-folded")
    roots = staged(components(near_links(folded.select("fp"), radius), "simhash"), "simhash-components")
    rooted = folded.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_doc", F.coalesce("root", "fp").alias("root"))
    smallest = staged(rooted.groupBy("root").agg(F.min("first_doc").alias("component_id")), "simhash-smallest")
    named = staged(rooted.join(smallest, "root").select("fp", "component_id"), "simhash-named")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all columns kept, that stand for their group of near-duplicates: the smallest doc_id.

    Rows that share an id count as one document, of which one row stays; rows without id cannot be told apart and stay.
    """
    keepers = staged(near_duplicates(docs, radius=radius).select("component_id").distinct(), "simhash-keepers")
    known = docs.filter(F.col("doc_id").isNotNull()).join(keepers, F.col("doc_id") == F.col("component_id"), "left_semi")
    return known.dropDuplicates(["doc_id"]).unionByName(docs.filter(F.col("doc_id").isNull()))
