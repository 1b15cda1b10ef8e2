"""Document fingerprints: a homomorphic multiset hash over paragraphs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import shuffle_partitions

#: Equality lanes: 8 numbers modulo 2^64 taken from a 512-bit hash of the paragraph.
EQUAL_LANES = 8
#: Likeness lanes: 128 numbers modulo 2^16, each +1 or -1 for every sampled gram of the paragraph.
LIKE_LANES = 128
GRAM = 8
_MULTIPLIERS = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


def _mixed(h: np.ndarray, m: np.uint64) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * m
    return h ^ (h >> np.uint64(29))


def _signs(hashes: np.ndarray) -> np.ndarray:
    """Sum of the +1/-1 vectors of 64-bit hashes, modulo 2^16."""
    lanes = np.zeros(LIKE_LANES, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        both = np.stack([part, _mixed(part, _MULTIPLIERS[3])], axis=1)
        lanes += 2 * np.unpackbits(both.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64) - len(part)
    return lanes.astype(np.uint16)


def _grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``GRAM`` code points and the places of line breaks."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    h, step = points + np.uint64(1), 1
    for m in _MULTIPLIERS[:3]:
        if len(h) <= step:
            return np.array([], np.uint64), points == 10
        h = _mixed(h[:-step] * m + h[step:], m) if step == 4 else h[:-step] * m + h[step:]
        step *= 2
    return h, points == 10


def vector(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The text's multiset hash: (equality lanes, likeness lanes), the sum over its paragraphs.

    A paragraph is a line; an empty text has the single empty paragraph. Its vector has a 512-bit hash of the
    whole paragraph as equality lanes, and as likeness lanes the signs of its grams (every fourth by hash; the paragraph itself if
    shorter than a gram). Sums run modulo 2^64 and 2^16, so vectors can be added for an insertion and subtracted for a deletion.
    """
    paragraphs = (text or "").split("\n")
    digests = b"".join(hashlib.blake2b(p.encode("utf-8", "surrogatepass")).digest() for p in paragraphs)
    wide = np.frombuffer(digests, "<u8").reshape(-1, EQUAL_LANES)
    short = [i for i, p in enumerate(paragraphs) if len(p) < GRAM]
    hashes, breaks = _grams(text or "")
    if len(hashes):
        seen = np.concatenate(([0], np.cumsum(breaks)))
        whole = seen[GRAM:] == seen[:-GRAM]
        hashes = hashes[whole & (hashes >> np.uint64(62) == 0)]
    like = _signs(np.concatenate([_mixed(hashes, _MULTIPLIERS[0]), wide[short, 0]]))
    return wide.sum(axis=0, dtype=np.uint64), like


def encode(equal: np.ndarray, like: np.ndarray) -> str:
    return (equal.astype("<u8").tobytes() + like.astype("<u2").tobytes()).hex()


def decode(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = bytes.fromhex(fingerprint)
    return np.frombuffer(raw[: 8 * EQUAL_LANES], "<u8"), np.frombuffer(raw[8 * EQUAL_LANES :], "<u2")


def inserted(fingerprint: str, paragraph: str) -> str:
    """The fingerprint after ``paragraph`` (without line breaks) joined the document."""
    return encode(*(a + b for a, b in zip(decode(fingerprint), vector(paragraph))))


def deleted(fingerprint: str, paragraph: str) -> str:
    """The fingerprint after one copy of ``paragraph`` left the document."""
    return encode(*(a - b for a, b in zip(decode(fingerprint), vector(paragraph))))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """1 for equal fingerprints, else the estimated share of grams in common, from the likeness lanes alone.

    The difference of two vectors is the vector of what only one of the texts has; with random signs its squared
    length estimates how much that is.
    """
    if (a[0] == b[0]).all():
        return 1.0
    apart, size = (a[1] - b[1]).view(np.int16).astype(float), [x[1].view(np.int16).astype(float) for x in (a, b)]
    total = sum(float(x @ x) for x in size)
    return float(min(1.0, max(0.0, 1 - float(apart @ apart) / total))) if total else 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every whole text; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([encode(*vector(t)) for t in texts], pa.string())],
                ["doc_id", "n_chars", "fingerprint"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def with_successors(docs: DataFrame, buckets_per_partition: int = 4) -> DataFrame:
    """(bucket, doc_id, text, is_copy), sorted for a pass in descending doc_id that sees each row's successor.

    Rows are dealt into id ranges, cut at quantiles of the ids (one number per range reaches the driver); the first row of each range
    is also sent, marked as a copy, to the end of the range before it, and the first of all to the last range. Null ids come last,
    rows with one id are ordered by text. One shuffle, no window over the table.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = shuffle_partitions(spark) * buckets_per_partition
    shares = [i / n for i in range(1, n)]
    cuts = rows.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), F.lit(max(10_000, 10 * n))).alias("q")).head()["q"] if shares else []
    cuts = sorted(set(cuts or []), reverse=True)
    # Bucket k holds the ids from cut k (exclusive) down to cut k + 1 (inclusive); nulls are in the last one.
    below = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    bucket = F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(F.size(F.filter(below, lambda c: F.col("doc_id") <= c)))
    ranked = rows.withColumn("bucket", bucket)
    # The head of a bucket has its largest id; of rows with that id, the least text.
    heads = ranked.groupBy("bucket").agg(F.max("doc_id").alias("head")).collect()
    if not heads:
        return ranked.select("bucket", "doc_id", "text", F.lit(False).alias("is_copy"))
    order = sorted(h["bucket"] for h in heads)
    before = {b: order[i - 1] for i, b in enumerate(order)}
    spots = spark.createDataFrame([(h["bucket"], h["head"], before[h["bucket"]]) for h in heads], "bucket int, head long, target int")
    head_rows = (
        rows.join(F.broadcast(spots), F.col("doc_id").eqNullSafe(F.col("head")))
        .groupBy("target", "doc_id").agg(F.min("text").alias("text"))
        .select(F.col("target").alias("bucket"), "doc_id", "text", F.lit(True).alias("is_copy"))
    )
    dealt = ranked.select("bucket", "doc_id", "text", F.lit(False).alias("is_copy")).unionByName(head_rows)
    return dealt.repartition(shuffle_partitions(spark), "bucket").sortWithinPartitions("bucket", "is_copy", F.col("doc_id").desc_nulls_last(), "text")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each whole text and of its edited text, with likenesses; see ``op2`` of the queries.

    The edited text keeps the first n_chars - n_chars // 2 code points and goes on with as many of the next document's,
    in descending doc_id, as were cut (all of it if it is shorter). Null text is empty; rows with one id follow each other by text; null ids come last.
    A table of one row is its own successor, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            for bucket, doc_id, text, copy in zip(*(c.to_pylist() for c in batch.columns)):
                now = (bucket, doc_id, text, None if copy else vector(text))
                if held is not None and held[0] == bucket:
                    out.append(row(held, now))
                held = None if copy else now
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    def row(this: tuple, following: tuple) -> dict:
        _, doc_id, text, own = this
        cut = len(text) // 2
        edited = text[: len(text) - cut] + following[2][:cut]
        changed = vector(edited)
        return {
            "doc_id": doc_id,
            "n_chars": len(text),
            "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": encode(*own),
            "edited_fingerprint": encode(*changed),
            "near_edited": likeness(own, changed),
            "near_next": likeness(own, following[3] or vector(following[2])),
        }

    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *((n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    return with_successors(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
