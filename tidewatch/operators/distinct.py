"""Distinct counts that add up: sets as bitmaps over a dictionary of ids (exact), and as sketches (approximate)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of precision of the sketches: the relative standard error is 1.04 / sqrt(2 ** 12), 1.6 %.
PRECISION = 12
STANDARD_ERROR = 1.04 / (1 << PRECISION) ** 0.5
#: Ids of a dictionary are numbered from 0 within each block of this size; a word of a bitmap covers 64 of them.
BLOCK = 1 << 33


def extended_dictionary(values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(value, id): an id for each non-null value of the only column of ``values``; those of ``known`` keep theirs.

    Ids are dense within a block per task, so few bitmaps cover many values. They are given anew whenever the result is computed: write
    it to a table before using it, and pass that table as ``known`` later.
    """
    (name,) = values.columns
    fresh = values.select(F.col(name).alias("value")).filter("value IS NOT NULL").distinct()
    if known is None:
        return fresh.withColumn("id", F.monotonically_increasing_id())
    fresh = fresh.join(known, "value", "left_anti").withColumn("id", F.monotonically_increasing_id())
    top = known.agg(F.coalesce(F.floor(F.max("id") / BLOCK) + 1, F.lit(0)).cast("long").alias("blocks"))
    return known.select("value", "id").unionByName(fresh.join(F.broadcast(top)).select("value", (F.col("id") + F.col("blocks") * BLOCK).alias("id")))


def distinct_sets(rows: DataFrame, keys: Sequence[str | Column], value: str, dictionary: DataFrame) -> DataFrame:
    """The set of values of each key as words of a bitmap: keys, bucket, members. Null values are in no set; a row per key and 64 ids.

    Words without members are left out, so a set of few values takes few rows and all sets together no more rows than their input. Each task
    reduces its rows to one word (8 bytes) per key and bucket, so a dominant key or value costs as little as any other.
    """
    named = rows.select(*keys, F.col(value).alias("value")).filter("value IS NOT NULL").join(dictionary, "value")
    names = [c for c in named.columns if c not in ("value", "id")]
    grouped = named.groupBy(*names, F.shiftright("id", 6).alias("bucket"))
    return grouped.agg(F.bit_or(F.expr("shiftleft(1L, CAST(id & 63 AS INT))")).alias("members"))


def merged_sets(sets: DataFrame, *keys: str | Column) -> DataFrame:
    """The unions of the sets over coarser keys, in the same form."""
    return sets.groupBy(*keys, "bucket").agg(F.bit_or("members").alias("members"))


def set_sizes(sets: DataFrame, *keys: str, name: str) -> DataFrame:
    """Number of members per key, exact."""
    return sets.groupBy(*keys).agg(F.sum(F.bit_count("members")).alias(name))


def sketch(value: str) -> Column:
    """Aggregate: a mergeable sketch of the distinct non-null values."""
    return F.hll_sketch_agg(value, F.lit(PRECISION))


def merged_sketch(value: str) -> Column:
    """Aggregate: the union of sketches."""
    return F.hll_union_agg(value)


def sketched_count(value: str | Column) -> Column:
    """The number a sketch stands for. Up to a few hundred values it is exact."""
    return F.hll_sketch_estimate(value)
