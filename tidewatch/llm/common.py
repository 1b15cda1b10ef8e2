"""Helpers the text operators share: intermediate tables, whole-text columns, connected components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import scratch_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    """Within this block Spark removes a job's shuffle files as soon as its result is written."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back.

    It cuts the lineage like a checkpoint, survives the loss of executors, keeps rows compressed and
    gives joins on it a plain scan, whose hot keys adaptive execution can split.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    with shuffle_cleanup(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for df in tables:
        jvm = df.sparkSession._jvm
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Return the memory that this Python worker has freed to the system: an idle worker keeps it else, beside what the JVM takes for a later stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def training_row(doc_id: str = "doc_id") -> Column:
    """Rows a model may learn from: crc32 of the id as text, modulo 4, is not 2. A null id counts as text ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 != 2


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """Distributed union-find: (node, root) for every node of ``edges(a, b)``; root is the smallest node reachable.

    Rounds of hooking (each root hooks to its smallest smaller neighbour) and path compression by pointer
    doubling; the edges are contracted to roots after each round, until none is left. Nothing but one
    "is anything left" row reaches the driver, and each step is an aggregate with a partial step or a join of
    two scans. Null ends and loops are ignored.
    """
    live = staged(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .filter("hi <> lo").distinct(),
        f"{purpose}-edges",
    )
    nodes = live.select(F.explode(F.array("hi", "lo")).alias("node")).distinct()
    roots = None
    while True:
        parents = staged(live.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")), f"{purpose}-hook")
        if parents.isEmpty():
            break
        parents = _compressed(parents, purpose)
        hi, lo = (parents.select(F.col("node").alias(n), F.col("root").alias(f"{n}_root")) for n in ("hi", "lo"))
        live = staged(
            live.join(hi, "hi", "left").join(lo, "lo", "left")
            .select(F.coalesce("hi_root", "hi").alias("p"), F.coalesce("lo_root", "lo").alias("q"))
            .filter("p <> q").select(F.greatest("p", "q").alias("hi"), F.least("p", "q").alias("lo")).distinct(),
            f"{purpose}-edges",
        )
        roots = parents if roots is None else staged(_followed(roots, parents).unionByName(parents), f"{purpose}-roots")
    if roots is None:
        return nodes.select("node", F.col("node").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _followed(below: DataFrame, above: DataFrame) -> DataFrame:
    step = above.select(F.col("node").alias("root"), F.col("root").alias("next"))
    return below.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))


def _compressed(parents: DataFrame, purpose: str) -> DataFrame:
    while True:
        step = parents.select(F.col("node").alias("root"), F.col("root").alias("next"))
        doubled = staged(
            parents.join(step, "root", "left")
            .select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            f"{purpose}-jump",
        )
        parents = doubled.select("node", "root")
        if doubled.filter("moved").isEmpty():
            return parents
