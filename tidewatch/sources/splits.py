"""Records of CSV files and JSON documents that Spark reads in splits although a record may span lines.

A reader that starts in the middle of a file does not know whether it is inside quotes. So each split works out what it does to
either state, those small maps are composed over the splits of a file (a parallel prefix), and then each split, knowing
its true first state, cuts its records; the pieces of a record that crosses splits are put together.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.session import scratch_dir

#: Up to this many splits that start inside quotes (or a JSON record) their states are broadcast, about 100 bytes each.
BROADCAST_SPLITS = 200_000
FILE, START = "file_path", "file_block_start"


def chunks(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(value, file_path, file_block_start): the text between separators, in the order of the file within each split."""
    rows = spark.read.option("lineSep", separator).text(path)
    return rows.select("value", F.col(f"_metadata.{FILE}").alias(FILE), F.col(f"_metadata.{START}").alias(START))


def by_split(rows: DataFrame, summarise: Callable[[Iterator[str]], tuple], result: str) -> DataFrame:
    """One row per split: file_path, file_block_start and ``summarise`` of its chunks, which are streamed."""
    fields = [FILE, START, *(f.split()[0] for f in result.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start), values in _splits(batches):
            yield pa.RecordBatch.from_pydict({name: [value] for name, value in zip(fields, (file, start, *summarise(values)))})

    return rows.mapInArrow(run, f"{FILE} string, {START} long, {result}")


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator]]:
    """((file, start, ...), chunks) of each split in turn; the chunks have to be read before the next split is asked for."""
    rows = (
        (tuple(key), value)
        for batch in batches
        for value, *key in zip(*(column.to_pylist() for column in batch.columns))
    )
    held = next(rows, None)
    while held is not None:
        key, ahead = held[0], [held]

        def values():
            while ahead[0] is not None and ahead[0][0] == key:
                yield ahead[0][1]
                ahead[0] = next(rows, None)

        yield key, values()
        held = ahead[0]


def start_states(maps: DataFrame) -> DataFrame:
    """(file_path, file_block_start, inside): the state each split starts in, from (from_out, from_in), the states it ends in.

    A map that gives one state for both forgets what was before; one that exchanges them flips it. So the state is what the
    last forgetting split left, flipped once per exchanging split since.
    """
    order = Window.partitionBy(FILE).orderBy(START)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    constant = F.when(F.col("from_out") == F.col("from_in"), F.col("from_out"))
    flips = F.sum((F.col("from_out") & ~F.col("from_in")).cast("int")).over(order)
    counted = maps.withColumns({"_constant": constant, "_flips": flips})
    left = counted.withColumns(
        {
            "_state": F.coalesce(F.last("_constant", ignorenulls=True).over(before), F.lit(False)),
            "_at": F.coalesce(F.last(F.when(F.col("_constant").isNotNull(), F.col("_flips")), ignorenulls=True).over(before), F.lit(0)),
            "_last": F.coalesce(F.last("_flips").over(before), F.lit(0)),
        }
    )
    flipped = (F.col("_last") - F.col("_at")) % 2 == 1
    return left.withColumn("inside", F.col("_state") != flipped).drop("_constant", "_flips", "_state", "_at", "_last")


def with_state(rows: DataFrame, states: DataFrame, default: dict[str, object]) -> DataFrame:
    """The chunks with the columns of ``default`` from ``states``, or the default where a split is not among them; chunks keep their order."""
    spark = rows.sparkSession
    path = scratch_dir(spark, "split-states")
    states.write.parquet(path)
    known = spark.read.schema(states.schema).parquet(path)
    if known.count() <= BROADCAST_SPLITS:
        met = rows.join(F.broadcast(known), [FILE, START], "left")
    else:
        placed = rows.withColumn("_place", F.monotonically_increasing_id()).join(known, [FILE, START], "left")
        met = placed.repartition(FILE, START).sortWithinPartitions(FILE, START, "_place")
    return met.select("value", FILE, START, *(F.coalesce(F.col(name), F.lit(value)).alias(name) for name, value in default.items()))


PIECE = f"{FILE} string, {START} long, place long, part string, text string"


def put_together(pieces: DataFrame, separator: str, *more: str) -> DataFrame:
    """(file_path, file_block_start, place, text, ``more``): whole records, and those of the parts 'open', 'within' and 'close' joined.

    The record belongs where it opens. Per split there is one part of each kind at most, so the window sees few rows.
    """
    parts = pieces.filter("part <> 'whole'")
    order = F.expr("CASE part WHEN 'close' THEN 0 WHEN 'within' THEN 1 ELSE 2 END")
    numbered = parts.withColumn("_o", order).withColumn(
        "_record", F.sum((F.col("part") == "open").cast("int")).over(Window.partitionBy(FILE).orderBy(START, "_o"))
    )
    rows = F.sort_array(F.collect_list(F.struct(START, "_o", "place", "text", *more)))
    text = F.array_join(F.transform("r", lambda p: p["text"]), separator).alias("text")
    joined = numbered.groupBy(FILE, "_record").agg(rows.alias("r")).select(FILE, *(F.col("r")[0][c].alias(c) for c in (START, "place", *more)), text)
    return pieces.filter("part = 'whole'").select(*joined.columns).unionByName(joined)


# --- CSV ---

_QUOTED = re.compile(r'(?:[^"]|"")*+')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that starts inside quotes or not ends inside quotes.

    A field is quoted if it starts with a quote; a quote within is doubled. What follows a closing quote up to the comma is
    plain, and so is a field with a quote in its middle.
    """
    if '"' not in line:
        return inside
    at, size = 0, len(line)
    while True:
        if not inside:
            if at < size and line[at] == '"':
                inside = True
                at += 1
            else:
                at = line.find(",", at) + 1
                if at == 0:
                    return False
                continue
        at = _QUOTED.match(line, at).end()
        if at >= size:
            return True
        inside = False
        at = line.find(",", at) + 1
        if at == 0:
            return False


def _csv_map(lines: Iterator[str]) -> tuple[bool, bool]:
    out, within = False, True
    for line in lines:
        if '"' in line:
            same = out == within
            out = ends_inside(line, out)
            within = out if same else ends_inside(line, within)
    return out, within


def _csv_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [FILE, START, "place", "part", "text"]

    def batch(file, start, first, parts, texts) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([file] * n, pa.string()), pa.array([start] * n, pa.int64()), pa.array(range(first, first + n), pa.int64()), pa.array(parts, pa.string()), pa.array(texts, pa.string())], names
        )

    for (file, start, inside), lines in _splits(batches):
        place, parts, texts = 0, [], []
        held, closing = [], inside
        for line in lines:
            open_before = inside
            inside = ends_inside(line, inside)
            if open_before or inside:
                held.append(line)
            if inside or (line in ("", "\r") and not open_before):
                continue
            if open_before:
                texts.append("\n".join(held))
                parts.append("close" if closing else "whole")
                held, closing = [], False
            else:
                texts.append(line)
                parts.append("whole")
            if len(texts) >= 4096:
                yield batch(file, start, place, parts, texts)
                place, parts, texts = place + len(texts), [], []
        if held:
            texts.append("\n".join(held))
            parts.append("within" if closing else "open")
        if texts:
            yield batch(file, start, place, parts, texts)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, file_block_start, place, text): the records of CSV files, headers included, each as its text.

    Lines end with a line feed, with or without a carriage return before it. The file is read twice, in splits: for what each split does to
    the quote state, and for its records.
    """
    lines = chunks(spark, path, "\n")
    maps = by_split(lines, _csv_map, "from_out boolean, from_in boolean")
    inside = start_states(maps).filter("inside").select(FILE, START, "inside")
    pieces = with_state(lines, inside, {"inside": False}).select("value", FILE, START, "inside").mapInArrow(_csv_pieces, PIECE)
    records = put_together(pieces, "\n")
    return records.withColumn("text", F.regexp_replace("text", r"\r$", ""))


# --- JSON documents ---

#: Text without a bracket, strings as a whole; and the rest of a string.
_PLAIN = re.compile(r'(?:[^"{}\[\]]|"(?:[^"\\]|\\.)*+")*+', re.DOTALL)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*+', re.DOTALL)
#: A chunk ends before a closing brace, which is put back; JSON records end with one.
BRACE = "}"


def _brackets(text: str, inside: bool) -> Iterator[tuple[str, int]]:
    """(bracket, place) of each bracket outside strings, at last ('in' or 'out', size): whether the text ends inside a string."""
    at, size = 0, len(text)
    while True:
        if inside:
            at = _STRING_END.match(text, at).end()
            if at == size:
                yield "in", size
                return
            inside = False
            at += 1
        at = _PLAIN.match(text, at).end()
        if at == size:
            yield "out", size
            return
        if text[at] == '"':
            inside = True
        else:
            yield text[at], at
        at += 1


def _json_map(texts: Iterator[str]) -> tuple[bool, bool, int, int, str | None]:
    """States in which a split ends and its changes of depth, from outside and from inside a string; its first character."""
    states, depths, first = [False, True], [0, 0], None
    for chunk in texts:
        first = first or chunk.lstrip("\ufeff \t\r\n")[:1] or None
        for k in (0, 1):
            for what, _ in _brackets(chunk + BRACE, states[k]):
                if what in "{[":
                    depths[k] += 1
                elif what in "}]":
                    depths[k] -= 1
                else:
                    states[k] = what == "in"
    return (*states, *depths, first)


JSON_PIECE = f"{PIECE}, run long"


def _json_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The values that start at depth ``level``, and each split's frame: all else, with a mark for every run of values that only commas separate."""
    for (file, start, inside, depth, level), texts in _splits(batches):
        place, run, rows, held, frame = 0, -1, [], [], []
        closing = recording = depth > level

        def row(part: str, text: str) -> dict:
            return {FILE: file, START: start, "place": place, "part": part, "text": text, "run": run}

        def mark() -> None:
            """A new run, unless only a comma lies between this value and the one before."""
            nonlocal run
            if run < 0 or "".join(frame[-1:]).strip(" \t\r\n") != ",":
                run = place
                frame.append(json.dumps(f"{start}:{run}"))
            else:
                frame.pop()

        for chunk in texts:
            text, since = chunk + BRACE, 0
            for what, at in _brackets(text, inside):
                if what in ("in", "out"):
                    inside = what == "in"
                elif what in "{[":
                    if depth == level:
                        frame.append("".join([frame.pop()] if frame and not frame[-1].startswith('"') else []) + text[since:at])
                        since, recording = at, True
                        mark()
                    depth += 1
                else:
                    depth -= 1
                    if recording and depth == level:
                        held.append(text[since : at + 1])
                        rows.append(row("close" if closing else "whole", "".join(held)))
                        place, since, held, closing, recording = place + 1, at + 1, [], False, False
            if recording:
                held.append(text[since:])
            elif frame and not frame[-1].startswith('"'):
                frame.append(frame.pop() + text[since:])
            else:
                frame.append(text[since:])
            if len(rows) >= 4096:
                yield pa.RecordBatch.from_pylist(rows)
                rows = []
        if held:
            rows.append(row("within" if closing else "open", "".join(held)))
        rows.append(row("frame", "".join(frame)))
        yield pa.RecordBatch.from_pylist(rows)


def _kept_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, split, run) of the values that are records, read from each file's frame; an error if the frame is no proper document."""
    for batch in batches:
        for file, frame, depth in zip(*(c.to_pylist() for c in batch.columns)):
            # A file that does not end with a brace got one too many.
            whole = frame[:-1] if depth == -1 else frame
            if depth not in (0, -1):
                raise ValueError(f"{file}: brackets are not balanced")
            try:
                top = json.loads(whole.lstrip("\ufeff"))
            except ValueError as error:
                raise ValueError(f"{file} is not a JSON document: {error}") from None
            records = top.get("events") if isinstance(top, dict) else top
            if not isinstance(records, list):
                marks, kind = [(0, 0)], "document"
            elif not all(isinstance(r, str) and re.fullmatch(r"\d+:\d+", r) for r in records):
                raise ValueError(f"{file}: not all records are objects")
            else:
                marks, kind = [tuple(map(int, r.split(":"))) for r in records], "records"
            n = len(marks)
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * n, pa.string()), *(pa.array([m[k] for m in marks], pa.int64()) for k in (0, 1)), pa.array([kind] * n, pa.string())],
                [FILE, START, "run", "kind"],
            )


def json_records(spark: SparkSession, path: str) -> DataFrame | None:
    """(file_path, file_block_start, place, text) of the records of JSON documents, or None if a document is no list of records.

    A document is an array of objects, or an object with such an array under ``events``. It is read in splits that end with closing braces, twice: for
    what each split does to strings and depth, and for its records. A file that is no proper document is an error.
    """
    texts = chunks(spark, path, BRACE)
    summary = "from_out boolean, from_in boolean, depth_out long, depth_in long, first string"
    maps = start_states(by_split(texts, _json_map, summary))
    change = F.when(F.col("inside"), F.col("depth_in")).otherwise(F.col("depth_out"))
    order = Window.partitionBy(FILE).orderBy(START)
    whole = Window.partitionBy(FILE)
    level = F.when(F.first("first", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) == "{", 2).otherwise(1)
    states = maps.select(
        FILE, START, "inside", F.coalesce(F.sum(change).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("depth"),
        level.cast("long").alias("level"), F.sum(change).over(whole).alias("last_depth"),
    )
    path_of = scratch_dir(spark, "json-states")
    states.write.parquet(path_of)
    states = spark.read.parquet(path_of)
    default = {"inside": False, "depth": 0, "level": 1}
    known = with_state(texts, states.drop("last_depth"), default).select("value", FILE, START, "inside", F.col("depth").cast("long"), F.col("level").cast("long"))
    path_of = scratch_dir(spark, "json-pieces")
    known.mapInArrow(_json_pieces, JSON_PIECE).write.parquet(path_of)
    pieces = spark.read.parquet(path_of)
    frames = pieces.filter("part = 'frame'").groupBy(FILE).agg(F.sort_array(F.collect_list(F.struct(START, "text"))).alias("f"))
    ends = states.groupBy(FILE).agg(F.max("last_depth").alias("last_depth"))
    framed = frames.join(ends, FILE).select(FILE, F.array_join(F.transform("f", lambda p: p["text"]), "").alias("frame"), "last_depth")
    path_of = scratch_dir(spark, "json-runs")
    framed.mapInArrow(_kept_runs, f"{FILE} string, {START} long, run long, kind string").write.parquet(path_of)
    runs = spark.read.parquet(path_of)
    if not runs.filter("kind = 'document'").isEmpty():
        return None
    records = put_together(pieces.filter("part <> 'frame'"), "", "run")
    return records.join(runs.drop("kind"), [FILE, START, "run"], "left_semi").drop("run")
