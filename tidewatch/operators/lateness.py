"""Mark events that arrive later than the watermark allows, over a stored feed."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _earlier_maximum(points: DataFrame, position: str, value: str, out: str, chunk: int, levels: int) -> DataFrame:
    """Add ``out``: the largest ``value`` at any smaller ``position``.

    Positions are unique whole numbers, so a chunk of consecutive ones holds at most ``chunk`` rows and no
    window sees more. The chunk maxima are a feed ``chunk`` times smaller that is solved the same way.
    """
    if levels == 0:
        everything = Window.orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
        return points.withColumn(out, F.max(value).over(everything))
    number, inside, carried = f"_chunk{levels}", f"_inside{levels}", f"_carried{levels}"
    chunked = points.withColumn(number, F.expr(f"{position} div {chunk}"))
    maxima = chunked.groupBy(number).agg(F.max(value).alias("_chunk_max"))
    before = _earlier_maximum(maxima, number, "_chunk_max", carried, chunk, levels - 1).select(number, carried)
    in_chunk = Window.partitionBy(number).orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    joined = chunked.withColumn(inside, F.max(value).over(in_chunk)).join(before, number)
    return joined.withColumn(out, F.greatest(inside, carried)).drop(number, inside, carried)


def mark_late(
    events: DataFrame,
    position: str,
    event_time: str = "event_timestamp",
    delay: str = "10 minutes",
    chunk: int = 1_000_000,
    levels: int | None = None,
) -> DataFrame:
    """Add ``watermark`` and ``is_late``.

    ``position`` is the unique arrival number of the event. The watermark of an event is the largest event
    time that arrived before it minus ``delay``; an earlier event time is late. An event without a time
    neither moves the watermark nor is late; one without a position has no watermark and is not late. The number of levels
    follows from the largest position, so that no task sees more than ``chunk`` rows.
    """
    placed = events.filter(F.col(position).isNotNull())
    if levels is None:
        largest = placed.agg(F.max(position)).head()[0] or 0
        levels = max(1, math.ceil(math.log(max(2, largest), chunk)))
    seen = _earlier_maximum(placed, position, event_time, "_max_seen", chunk, levels)
    seen = seen.unionByName(events.filter(F.col(position).isNull()), allowMissingColumns=True)
    watermark = F.col("_max_seen") - F.expr(f"INTERVAL {delay}")
    late = F.coalesce(F.col(event_time) < watermark, F.lit(False))
    return seen.withColumn("watermark", watermark).withColumn("is_late", late).drop("_max_seen")
