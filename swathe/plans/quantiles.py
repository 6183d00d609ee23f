"""Exact quantiles per group when a group may not fit in one task.

The built-in ``percentile`` keeps every distinct value of a group in one task's
memory. That is the right plan while the largest group is small, so its size is
measured first. Groups beyond the limit are cut into value ranges:

1. collapse rows to (group, value, weight), combined before the shuffle;
2. sketch splitters over the distinct values of each group;
3. add up weights per (group, range); only these few rows are ordered per group;
4. order values inside the ranges that hold a wanted rank, and pick.

The sketch only balances the ranges. Any splitters give the same exact answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swathe.plans.sides import broadcast_if, join_null_safe
from swathe.plans.skew import GroupSizes, group_sizes

# Types with at most 65,536 values: the built-in aggregate's state is bounded.
SMALL_TYPES = ("tinyint", "smallint", "boolean")

# A range is found among this many splitters at a time.
FAN = 64
# Up to this many large groups are kept apart from the others.
MOST_LARGE = 50_000


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float],
    weight: str | None = None, group_limit: int = 1_000_000, ranges: int | None = None,
    sizes: GroupSizes | None = None,
) -> DataFrame:
    """Interpolated quantiles per group; ``probs`` maps output column to p.

    Same definition as SQL ``percentile_cont``. Null values are ignored.
    ``weight`` is an integer count of how often a row's value occurs.
    ``group_limit`` is the most rows a group may have for the built-in
    aggregate to be used. ``sizes`` spares measuring the groups again.
    ``ranges`` is how many ranges a larger group is cut into, 64 or 4096;
    chosen by its size if left out.
    """
    by = list(by)
    known = df.where(F.col(value).isNotNull())
    small = df.schema[value].dataType.simpleString() in SMALL_TYPES
    if not small and sizes is None:
        sizes = group_sizes(known, by)
    if small or sizes.largest <= group_limit:
        return known.groupBy(*by).agg(*builtin_quantiles(value, probs, weight))
    if ranges is None:
        ranges = FAN if sizes.largest <= FAN * 1_000_000 else FAN * FAN
    large = known.groupBy(*by).count().where(F.col("count") > group_limit).select(*by)
    count = large.limit(MOST_LARGE + 1).count()
    if count > MOST_LARGE:
        return _by_ranges(known, by, value, probs, weight, ranges, sizes.groups)
    # Few groups are large: broadcast which, and leave the rest to the built-in.
    split = _by_ranges(_with_keys(known, large, by, "left_semi"), by, value, probs, weight, ranges, count)
    rest = _with_keys(known, large, by, "left_anti")
    return split.unionByName(rest.groupBy(*by).agg(*builtin_quantiles(value, probs, weight)))


def builtin_quantiles(
    value: str, probs: dict[str, float], weight: str | None = None
) -> list[Column]:
    """Quantiles as plain aggregates, for groups known to be small."""
    often = F.lit(1) if weight is None else F.col(weight)
    return [F.percentile(F.col(value), p, often).alias(c) for c, p in probs.items()]


def _by_ranges(
    known: DataFrame, by: list[str], value: str, probs: dict[str, float],
    weight: str | None, ranges: int, groups: int,
) -> DataFrame:
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = known.groupBy(*by, F.col(value).cast("double").alias("_v")).agg(n.alias("_n"))
    cuts = [(i + 1) / ranges for i in range(ranges - 1)]
    group = counts.groupBy(*by).agg(
        F.sum("_n").alias("_total"),
        F.approx_percentile("_v", cuts, 10_000).alias("_cuts"),
    )
    # Tables of one or a few rows per group are broadcast while the groups are
    # few; with many groups adaptive execution splits the hot ones.
    few = groups * max(ranges, 2 * len(probs)) <= 2_000_000
    ranged = join_null_safe(counts, broadcast_if(group, few), by)
    ranged = ranged.withColumn("_range", F.expr(_range_of(ranges))).drop("_cuts")

    rank = {
        c: (F.lit(float(p)) * (F.col("_total") - 1)) for c, p in probs.items()
    }
    per_range = ranged.groupBy(*by, "_range", "_total").agg(F.sum("_n").alias("_in"))
    so_far = Window.partitionBy(*by).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    per_range = per_range.withColumn("_before", F.sum("_in").over(so_far) - F.col("_in"))

    def holds(position: Column) -> Column:
        return (position >= F.col("_before")) & (position < F.col("_before") + F.col("_in"))

    wanted = None
    for pos in rank.values():
        for p in (F.floor(pos), F.ceil(pos)):
            wanted = holds(p) if wanted is None else wanted | holds(p)
    targets = per_range.where(wanted).select(*by, "_range", "_before")

    inside = Window.partitionBy(*by, "_range").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    picked = join_null_safe(ranged, broadcast_if(targets, few), [*by, "_range"]).withColumn(
        "_upto", F.col("_before") + F.sum("_n").over(inside)
    )
    aggs, outs = [], []
    for i, (c, pos) in enumerate(rank.items()):
        at = lambda p: F.min(F.when(F.col("_upto") > p, F.col("_v")))
        aggs += [
            at(F.floor(pos)).alias(f"_lo{i}"),
            at(F.ceil(pos)).alias(f"_hi{i}"),
            F.first(pos - F.floor(pos)).alias(f"_f{i}"),
            F.first(F.ceil(pos) - pos).alias(f"_g{i}"),
        ]
        lo, hi, f, g = (F.col(f"_{name}{i}") for name in ("lo", "hi", "f", "g"))
        # As the built-in does it, so that both give the same to the last bit, infinities included.
        outs.append(F.when((f == 0) | (lo == hi), lo).otherwise(g * lo + f * hi).alias(c))
    return picked.groupBy(*by).agg(*aggs).select(*by, *outs)


def _range_of(ranges: int) -> str:
    """SQL for how many splitters lie below the value: straight, or by first
    finding the right block of splitters."""
    below = lambda cuts: f"size(filter({cuts}, c -> c < _v))"
    if ranges == FAN:
        return below("_cuts")
    if ranges != FAN * FAN:
        raise ValueError(f"ranges must be {FAN} or {FAN * FAN}")
    block = below(f"transform(sequence(1, {FAN - 1}), i -> _cuts[i * {FAN} - 1])")
    return f"{block} * {FAN} + {below(f'slice(_cuts, {block} * {FAN} + 1, {FAN - 1})')}"


def _with_keys(rows: DataFrame, keys: DataFrame, by: list[str], how: str) -> DataFrame:
    return join_null_safe(rows, F.broadcast(keys), by, how)
