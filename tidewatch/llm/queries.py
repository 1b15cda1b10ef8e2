"""The dealt operators as queries over the whole tables: (spark, folder of Parquet tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import align, decontam, fingerprint, langid, lines, packing, pii, quality_rules, repeats, simhash, toxicity, tries, warc
from tidewatch.llm.common import table
from tidewatch.llm.sql import ORACLE_SQL  # noqa: F401 - the registered queries' twins

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query
def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many of them go, and the hash of what is left."""
    cut = lines.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"), "removed",
        F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"),
    )


@query
def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id", (F.octet_length("kept") + gone).alias("n_bytes"), gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))
    return found.select(
        "doc_id", *[pii.count_of(k).alias(f"n_{k}") for k in pii.KINDS], F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans")
    )


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, counted = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_terms(counted, model)


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the conversations, each with up to five first turns taken from the conversation its hundred starts with."""
    c = F.col("conv_id")
    heads = F.crc32(c.cast("string").cast("binary")) % 6
    return tries.prefix_trie(tries.grafted(tries.turn_lists(table(spark, sf_dir, "conversations")), c - c % 100, heads, 5))


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(table(spark, sf_dir, "documents"))


@query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))

