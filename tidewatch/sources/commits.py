"""What a curated store holds: one small manifest per commit, naming the folders of all tables that the commit wrote.

Data is written to folders of its own first and becomes visible with its manifest, all tables at once. Manifests are numbered, and a number can be
taken only once, so two writers that must not overlook each other's rows find out.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass
from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_PART = (
    "table string, folder string, batch_key string, event_date date, n_rows long, "
    "first_event timestamp, last_event timestamp, first_stored timestamp, last_stored timestamp"
)
_MANIFEST = f"key string, clears array<string>, parts array<struct<{_PART.replace(' ', ': ').replace(',: ', ', ')}>>"


class CommitConflict(Exception):
    """Somebody else committed to the table since it was read."""


@dataclass(frozen=True)
class Part:
    """One folder of rows, with the first and last event time and storage time in it (as text, in the session's zone)."""

    table: str
    folder: str
    batch_key: str
    event_date: date | None
    n_rows: int
    first_event: str | None
    last_event: str | None
    first_stored: str | None
    last_stored: str | None


@dataclass(frozen=True)
class CommitLog:
    """The manifests below one folder of the store."""

    spark: SparkSession
    folder: str

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def version(self) -> int:
        """Number of the newest commit, -1 before the first: one listing."""
        path = self._path("*.json")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return max((int(s.getPath().getName().split(".")[0]) for s in found or []), default=-1)

    def parts(self, table: str | None = None, until: int | None = None) -> DataFrame:
        """The parts that count, of one table or all: those of each key's newest commit, and none from before a commit that clears the table."""
        if self.version() < 0:
            return self.spark.createDataFrame([], f"version long, key string, {_PART}")
        raw = self.spark.read.schema(_MANIFEST).option("mode", "FAILFAST").json(f"{self.folder}/*.json")
        numbered = raw.select("*", F.split("_metadata.file_name", "[.]")[0].cast("long").alias("version"))
        if until is not None:
            numbered = numbered.filter(F.col("version") <= until)
        newest = numbered.withColumn("_newest", F.max("version").over(Window.partitionBy("key"))).filter("version = _newest")
        rows = newest.select("version", "key", F.explode("parts").alias("p")).select("version", "key", "p.*")
        cleared = numbered.select(F.col("version").alias("_cleared"), F.explode("clears").alias("table")).groupBy("table").agg(F.max("_cleared").alias("_cleared"))
        live = rows.join(cleared, "table", "left").filter("_cleared IS NULL OR version >= _cleared").select("version", "key", *rows.columns[2:])
        return live if table is None else live.filter(F.col("table") == table)

    def commit(self, key: str, parts: Sequence[Part], clears: Iterable[str] = (), after: int | None = None) -> int:
        """Make the parts visible, in place of those of an earlier commit with the same key.

        With ``after``, the version that was read, it fails if a commit since then touched one of the same tables.
        """
        fields = [asdict(part) | {"event_date": part.event_date and part.event_date.isoformat()} for part in parts]
        text = json.dumps({"key": key, "clears": list(clears), "parts": fields})
        hidden = self._path(f"_{uuid.uuid4().hex}")
        conf = self.spark._jsc.hadoopConfiguration()
        out = hidden.getFileSystem(conf).create(hidden, False)
        out.write(bytearray(text.encode()))
        out.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(hidden.toUri(), conf)
        none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        number, touched = (self.version() if after is None else after) + 1, {p.table for p in parts} | set(clears)
        while True:
            try:
                # Fails if the number is taken.
                context.rename(hidden, self._path(f"{number:020}.json"), none)
                return number
            except Py4JJavaError as error:
                if "FileAlreadyExists" not in str(error.java_exception):
                    raise
            if after is not None and self._touched(number) & touched:
                hidden.getFileSystem(conf).delete(hidden, False)
                raise CommitConflict(f"commit {number} wrote to {sorted(touched)} too")
            number += 1

    def _touched(self, number: int) -> set[str]:
        row = self.spark.read.schema(_MANIFEST).json(f"{self.folder}/{number:020}.json").select("clears", "parts.table").first()
        return set(row["clears"] or []) | set(row["table"] or [])


def overlapping(first: str, last: str, since: datetime | None, until: datetime | None) -> Column:
    """Parts with times from ``since`` to ``until``; a part without any time has none."""
    inside = F.col(first).isNotNull()
    if since is not None:
        inside = inside & (F.col(last) >= F.lit(since))
    return inside if until is None else inside & (F.col(first) <= F.lit(until))
