"""Curated tables: fact, quarantine, one-minute metrics and insights."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType, StringType, StructField, StructType, TimestampType

from tidewatch.schemas import AGGREGATE_SCHEMA, FACT_SCHEMA, INSIGHT_SCHEMA, SKETCHES, conform
from tidewatch.sources.commits import CommitLog, Part, overlapping

FACT = "fact_security_events"
QUARANTINE = "error_security_events"
METRICS = "agg_security_metrics_1m"
INSIGHTS = "ai_threat_insights"

TABLE_SCHEMAS: dict[str, StructType] = {
    FACT: FACT_SCHEMA,
    QUARANTINE: FACT_SCHEMA,
    METRICS: AGGREGATE_SCHEMA,
    INSIGHTS: INSIGHT_SCHEMA,
}
# The time that gives a row its date partition; insights are looked up by id and stay unpartitioned.
DATE_SOURCE = {FACT: "event_timestamp", QUARANTINE: "event_timestamp", METRICS: "window_start"}
EVENT_DATE, BATCH_KEY = "event_date", "batch_key"
WRITTEN_AT = "written_at"
# While several tables are written together, the table of a row.
TABLE = "_table"
# Event time and storage time, whose bounds the manifests keep.
TIMES = {
    FACT: ("event_timestamp", "ingestion_timestamp"),
    QUARANTINE: ("event_timestamp", "ingestion_timestamp"),
    METRICS: ("window_start", WRITTEN_AT),
    INSIGHTS: ("event_timestamp", "generated_at"),
}
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def partition_columns(table: str) -> tuple[str, ...]:
    """The batch comes first: what an attempt wrote is one folder."""
    return (BATCH_KEY, EVENT_DATE) if table in DATE_SOURCE else (BATCH_KEY,)

# Layers: raw stays empty until a job lands undecoded messages there.
LAYERS = ("raw", "curated", "marts")


def _beside(table: str) -> list[StructField]:
    """Columns stored with a table beside its own: when a metric row was written, and its mergeable sketches."""
    return [*(StructField(name, BinaryType()) for name in SKETCHES), StructField(WRITTEN_AT, TimestampType())] if table == METRICS else []


def stored_schema(table: str) -> StructType:
    """Table columns plus the partition columns it is stored by."""
    fields = list(TABLE_SCHEMAS[table].fields)
    fields += [*_beside(table), StructField(BATCH_KEY, StringType())]
    if table in DATE_SOURCE:
        fields.append(StructField(EVENT_DATE, DateType()))
    return StructType(fields)


def create_layers(spark: SparkSession, prefix: str = "") -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}")


def create_curated_tables(spark: SparkSession, database: str, location: str) -> None:
    """Declare the four tables over the Parquet folders below ``location``; existing ones are kept."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in TABLE_SCHEMAS:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored_schema(table).fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) "
            f"USING parquet PARTITIONED BY ({', '.join(partition_columns(table))}) LOCATION '{location}/{table}'"
        )


def recover_partitions(store: CuratedStore, database: str) -> None:
    """Make what the store holds by now visible to SQL on the declared tables, and to views on them: parts come and go with the commits."""
    spark = store.spark

    def spec(batch_key: str, day: date | None, table: str) -> str:
        dated = f", {EVENT_DATE} = {'NULL' if day is None else f"DATE '{day}'"}" if table in DATE_SOURCE else ""
        return f"PARTITION ({BATCH_KEY} = '{batch_key}'{dated})"

    for table in TABLE_SCHEMAS:
        known = spark.sql(f"SHOW PARTITIONS {database}.{table}").collect()
        shown = {}
        for (text,) in known:
            values = dict(item.split("=", 1) for item in text.split("/"))
            day = values.get(EVENT_DATE)
            key = (values[BATCH_KEY], None if day in (None, "null", NO_DATE) else date.fromisoformat(day))
            shown[key] = spark.sql(f"DESCRIBE EXTENDED {database}.{table} {spec(*key, table)}").filter("col_name = 'Location'").first()[1]
        held = {(p.batch_key, p.event_date): p.folder for p in store.log.parts(table).collect()}
        for key, location in shown.items():
            if not location.endswith(held.get(key, "?")):
                spark.sql(f"ALTER TABLE {database}.{table} DROP IF EXISTS {spec(*key, table)}")
        for key, folder in held.items():
            spark.sql(f"ALTER TABLE {database}.{table} ADD IF NOT EXISTS {spec(*key, table)} LOCATION '{store.path(table)}/{folder}'")


@dataclass(frozen=True)
class CuratedStore:
    """The curated tables below one shared folder.

    A commit (see ``commits``) makes the rows of one or several tables visible at once; repeating a batch replaces exactly what
    its first attempt committed. Event tables are partitioned by batch and event date. Reading asks the manifests, not the
    folders, and skips parts by date and by the bounds of event and storage time.
    """

    spark: SparkSession
    location: str

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.location}/commits")

    def path(self, table: str) -> str:
        return f"{self.location}/{table}"

    def read(
        self,
        table: str,
        dates: Iterable[date] | None = None,
        events: tuple[datetime | None, datetime | None] | None = None,
        stored: tuple[datetime | None, datetime | None] | None = None,
        version: int | None = None,
        without_batch: str | None = None,
    ) -> DataFrame:
        """The table with its partition columns, as of now or of a ``version``; empty before the first commit.

        ``dates``, ``events`` and ``stored`` (first and last time, either may be open) leave out parts that hold nothing of the kind;
        the rows of the other parts are all returned.
        """
        schema, parts = stored_schema(table), self.log.parts(table, version)
        if dates is not None:
            parts = parts.filter(F.col("event_date").isin(list(dates)))
        if events is not None:
            parts = parts.filter(overlapping("first_event", "last_event", *events))
        if stored is not None:
            parts = parts.filter(overlapping("first_stored", "last_stored", *stored))
        if without_batch is not None:
            parts = parts.filter(F.col("batch_key") != without_batch)
        folders = [f"{self.path(table)}/{p.folder}" for p in parts.select("folder").distinct().collect()]
        if not folders:
            return self.spark.createDataFrame([], schema)
        # The attempt's folder shows up as one more partition column.
        return self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*folders).select(*schema.names)

    def write(self, table: str, rows: DataFrame, batch_key: str, batch_id: int | None = None) -> list[Part]:
        """Write rows to a folder of their own; they belong to the table once their parts are committed."""
        rows = rows if batch_id is None else rows.withColumn("batch_id", F.lit(batch_id))
        own = TABLE_SCHEMAS[table].fields
        shaped = conform(rows, StructType([*own, *(f for f in _beside(table) if f.name != WRITTEN_AT)]))
        folder = f"{BATCH_KEY}={batch_key}/run={uuid.uuid4().hex}"
        dated = table in DATE_SOURCE
        if dated:
            shaped = shaped.withColumn(EVENT_DATE, F.to_date(DATE_SOURCE[table]))
            if table == METRICS:
                shaped = shaped.withColumn(WRITTEN_AT, F.current_timestamp())
            # Rows of a date come together, and adaptive execution splits a large date.
            shaped.hint("rebalance", EVENT_DATE).write.partitionBy(EVENT_DATE).parquet(f"{self.path(table)}/{folder}")
        else:
            shaped.write.parquet(f"{self.path(table)}/{folder}")
        return self._written(table, folder, batch_key)

    def write_split(self, rows: DataFrame, table: Column, tables: Sequence[str], batch_key: str, batch_id: int | None = None) -> list[Part]:
        """``write`` to several dated tables of one schema in one pass over the rows, which ``table`` deals out; rows of no table are left out.

        All of them go to one folder first; each table's part of it is then moved below that table.
        """
        rows = rows if batch_id is None else rows.withColumn("batch_id", F.lit(batch_id))
        shaped = conform(rows.withColumn(TABLE, table), StructType([*TABLE_SCHEMAS[tables[0]].fields, StructField(TABLE, StringType())]))
        shaped = shaped.filter(F.col(TABLE).isin(list(tables))).withColumn(EVENT_DATE, F.to_date(DATE_SOURCE[tables[0]]))
        run = uuid.uuid4().hex
        folder, together = f"{BATCH_KEY}={batch_key}/run={run}", f"{self.location}/_together/run={run}"
        shaped.hint("rebalance", TABLE, EVENT_DATE).write.partitionBy(TABLE, EVENT_DATE).parquet(together)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(together).getFileSystem(self.spark._jsc.hadoopConfiguration())
        parts = []
        for name in tables:
            own, target = path(f"{together}/{TABLE}={name}"), path(f"{self.path(name)}/{folder}")
            if files.exists(own):
                files.mkdirs(target.getParent())
                if not files.rename(own, target):
                    raise OSError(f"{own} could not be moved to {target}")
                parts += self._written(name, folder, batch_key)
        files.delete(path(together), True)
        return parts

    def _written(self, table: str, folder: str, batch_key: str) -> list[Part]:
        event, stored = TIMES[table]
        rows = self.spark.read.schema(stored_schema(table)).parquet(f"{self.path(table)}/{folder}")
        day = F.col(EVENT_DATE) if table in DATE_SOURCE else F.lit(None).cast("date").alias(EVENT_DATE)
        bounds = [f(c).cast("string") for c in (event, stored) for f in (F.min, F.max)]
        parts = []
        for day, n, *times in rows.groupBy(day).agg(F.count("*"), *bounds).collect():
            below = f"/{EVENT_DATE}={day or NO_DATE}" if table in DATE_SOURCE else ""
            parts.append(Part(table, folder + below, batch_key, day, n, *times))
        return parts

    def commit(self, tables: Mapping[str, DataFrame], batch_id: int | None = None, batch_key: str | None = None, after: int | None = None) -> int:
        """Write one batch of several tables and make it visible as a whole. The same ``batch_key`` again replaces the earlier attempt."""
        key = batch_key or (f"batch-{batch_id}" if batch_id is not None else f"run-{uuid.uuid4().hex}")
        parts = [part for table, rows in tables.items() for part in self.write(table, rows, key, batch_id)]
        return self.log.commit(key, parts, after=after)

    def append(self, table: str, rows: DataFrame, batch_id: int | None = None, batch_key: str | None = None, after: int | None = None) -> int:
        """``commit`` of one table."""
        return self.commit({table: rows}, batch_id, batch_key, after)

    def compact(self, table: str, batch_key: str) -> None:
        """Gather all batches of a table into the one named ``batch_key``; a commit to it in between is an error and leaves all as it was.

        Do not repeat a batch from before afterwards: it would be there twice. Files stay for those who read an earlier version.
        """
        version = self.log.version()
        parts = self.write(table, self.read(table, version=version).drop(BATCH_KEY), batch_key)
        self.log.commit(batch_key, parts, clears=[table], after=version)
