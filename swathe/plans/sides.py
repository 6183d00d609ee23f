"""Broadcast a join side only after its size has been checked.

Spark estimates a plan's size from its files. It does not know how many rows
an ``explode`` makes, so a side that was exploded could be broadcast though it
is huge. Such sides are checked here, and merged by shuffle beyond the limit,
where adaptive execution can still split a skewed key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether there are so few rows.

    Each task stops at one more than that and sends them without columns; what
    lies before the last shuffle of ``df`` is computed whole.
    """
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df.hint("merge")


def join_null_safe(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join where null keys match, as they do in ``groupBy``."""
    if not on:
        raise ValueError("at least one grouping column is needed")
    names = {c: f"_r_{c}" for c in on}
    same = F.expr(" AND ".join(f"`{c}` <=> `{r}`" for c, r in names.items()))
    return left.join(right.withColumnsRenamed(names), same, how).drop(*names.values())
