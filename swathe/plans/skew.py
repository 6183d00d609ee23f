"""Sizing and slicing of groups that may hold a large share of all rows.

Equi-joins are left to adaptive execution, which splits a skewed partition.
Nothing does that for a window or for an aggregate whose state grows with the
group, so those operators cut the group themselves.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GroupSizes(NamedTuple):
    groups: int
    largest: int


def group_sizes(df: DataFrame, by: Sequence[str]) -> GroupSizes:
    """Number of groups and rows of the biggest one. Runs a job that reads
    only the keys and combines counts before its shuffle."""
    row = df.groupBy(*by).count().agg(F.count("*"), F.max("count")).first()
    return GroupSizes(row[0], row[1] or 0)


def seconds(interval: str) -> int:
    """Length of ``"<n> <unit>"`` in seconds, for fixed-length units."""
    # Seconds per unit.
    unit_seconds = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    number, unit = interval.split()
    unit = unit.rstrip("s")
    if unit not in unit_seconds or int(number) <= 0:
        raise ValueError(f"need a positive fixed-length interval, got {interval!r}")
    return int(number) * unit_seconds[unit]


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, the resolution at which Spark stores time."""
    return F.unix_micros(ts.cast("timestamp"))


def floor_div(number: Column, width: int) -> Column:
    """Whole-number division rounding down, exact for 64-bit numbers."""
    w = F.lit(width).cast("long")
    return F.call_function("div", number - F.pmod(number, w), w)


def time_slice(ts: Column, width: str) -> Column:
    """Number of the fixed-width slice a timestamp lies in."""
    return floor_div(micros(ts), seconds(width) * 1_000_000)


def narrowest_needed(
    instants: DataFrame, keys: Sequence[str], at: Column, widths: Sequence[int], limit: int
) -> int:
    """First of ``widths`` (microseconds, falling) at which no slice of a key
    holds more than ``limit`` rows; the last one if none is narrow enough.

    Counts combine before their shuffle. Usually the first width will do, and
    one job is all.
    """
    for width in widths[:-1]:
        sliced = instants.withColumn("_slice", floor_div(at, width))
        if group_sizes(sliced, [*keys, "_slice"]).largest <= limit:
            return width
    return widths[-1]
