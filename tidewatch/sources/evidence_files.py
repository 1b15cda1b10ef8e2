"""Readers for loose evidence files: CSV, JSON document, JSON lines."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewatch.session import scratch_dir
from tidewatch.sources.splits import FILE, START, csv_records, json_records


PLACE = ["_file", "_start", "_place"]


def read_csv_evidence(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Header row, every column text; a byte-order mark before the first name is dropped.

    Fields may be quoted; a quote inside is doubled, a backslash is itself. Empty fields read as empty text, not null. Quoted
    line breaks are allowed, and large files are split all the same (``splits.csv_records``); with ``multi_line`` off a
    record is a line, which saves one reading of the file.
    """
    reader = spark.read.option("header", True).option("encoding", "UTF-8").option("escape", '"').option("multiLine", multi_line)
    rows = reader.csv(path)
    if not multi_line:
        return rows.toDF(*(name.lstrip("\ufeff") for name in rows.columns)).na.fill("")
    return _placed_csv(spark, path, rows.columns).drop(*PLACE)


def _placed_csv(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """The records with their place: file, split and number in the split. The first record of each file is its header."""
    if names is None:
        names = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).columns
    fields = StructType([StructField(name.lstrip("\ufeff"), StringType()) for name in names])
    records = csv_records(spark, path).filter(f"{START} > 0 or place > 0")
    parsed = records.select(F.col(FILE).alias("_file"), F.col(START).alias("_start"), F.col("place").alias("_place"), F.from_csv("text", _ddl(fields), {"escape": '"'}).alias("_record"))
    return parsed.select(*PLACE, *(F.coalesce(F.col("_record").getField(f.name), F.lit("")).alias(f.name) for f in fields))


def _ddl(fields: StructType) -> str:
    return ", ".join("`{}` string".format(f.name.replace("`", "``")) for f in fields)


def read_json_evidence(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A document that is an array of records, or an object with the records under ``events``; any other object is one record.

    A large document is split: its records are cut out and written as JSON lines, in their order, to the scratch folder, and read
    from there. A malformed document is an error.
    """
    records = json_records(spark, path)
    if records is None:
        reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
        return (reader.schema(schema) if schema else reader).json(path)
    lines = scratch_dir(spark, "json-lines")
    one_line = F.regexp_replace("text", r"[\r\n]+", " ").alias("value")
    records.orderBy(FILE, START, "place").select(one_line).write.text(lines)
    return read_jsonl_evidence(spark, lines, schema)


def read_jsonl_evidence(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """One record per line; blank lines are skipped, a malformed line is an error."""
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


READERS = {"csv": read_csv_evidence, "json": read_json_evidence, "jsonl": read_jsonl_evidence}


def format_of(path: str) -> str:
    suffix = path.rstrip("/").rsplit("/", 1)[-1].rpartition(".")[2].lower()
    return suffix if suffix in ("csv", "json") else "jsonl"


def load_evidence(spark: SparkSession, path: str, fmt: str | None = None, limit: int | None = None) -> DataFrame:
    """Records of an evidence file, reader chosen by suffix unless ``fmt`` is given.

    ``limit`` keeps the first records in file order.
    """
    kind = fmt or format_of(path)
    if limit is None:
        return READERS[kind](spark, path)
    if kind == "csv":
        return _placed_csv(spark, path).orderBy(*PLACE).limit(limit).drop(*PLACE)
    return first_records(READERS[kind](spark, path), limit)


def first_records(records: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` records by file name and place in the file (a plain ``limit`` may take them from any split).

    The input is read whole, and each task passes on ``limit`` records at most.
    """
    place = [F.col(f"_metadata.{name}").alias(f"_{name}") for name in ("file_path", "file_block_start")]
    try:
        located = records.select("*", *place)
    except AnalysisException:  # records made from a document, which one task reads
        located = records.select("*", F.lit("").alias("_file_path"), F.lit(0).alias("_file_block_start"))
    ordered = located.withColumn("_position", F.monotonically_increasing_id())
    order = ["_file_path", "_file_block_start", "_position"]
    return ordered.orderBy(*order).limit(limit).drop(*order)
