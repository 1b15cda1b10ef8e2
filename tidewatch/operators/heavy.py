"""Most frequent values from mergeable states: kept per minute, also by a stream, and combined over any longer time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values that a state tracks. With no more different values than that, all counts are exact.
TRACKED = 10_000
STATE, ROWS = "hitters", "n_rows"


def count_error(total: float, tracked: int = TRACKED) -> float:
    """By how much an estimated count may be off at most, and the count from which on a value is never missing: 3.5 / map size of all rows."""
    size = 1 << max(3, (int(tracked / 0.75) - 1).bit_length())
    return 3.5 / size * total


def hitter_states(rows: DataFrame, keys: Sequence[str | Column], value: str, tracked: int = TRACKED) -> DataFrame:
    """One state per key over the non-null values, and their number: a row of bounded size, however many rows or values there are.

    Partial states are built in each task before the shuffle, so a dominant key or value costs no more than another.
    """
    state = F.call_function("approx_top_k_accumulate", F.col(value), F.lit(tracked)).alias(STATE)
    return rows.filter(F.col(value).isNotNull()).groupBy(*keys).agg(state, F.count("*").alias(ROWS))


def combined_states(states: DataFrame, *keys: str | Column, tracked: int = TRACKED) -> DataFrame:
    """The states of coarser keys; without keys one state of all, none if there are no states."""
    combined = (F.call_function("approx_top_k_combine", F.col(STATE), F.lit(tracked)).alias(STATE), F.sum(ROWS).alias(ROWS))
    return states.groupBy(*keys).agg(*combined) if keys else states.groupBy(F.lit(True).alias("_all")).agg(*combined).drop("_all")


def top_values(states: DataFrame, k: int, *keys: str) -> DataFrame:
    """(keys, value, count): of each state the ``k`` values with the largest estimated counts."""
    found = F.inline(F.call_function("approx_top_k_estimate", F.col(STATE), F.lit(k))).alias("value", "count")
    return states.select(*keys, found)
