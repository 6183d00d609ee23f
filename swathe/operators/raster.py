"""Grid operators on long cell tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathe.functions.grid import cell_xy
from swathe.operators.composite import STATS
from swathe.plans.quantiles import builtin_quantiles, exact_quantiles
from swathe.plans.sides import join_null_safe
from swathe.plans.skew import group_sizes


def regrid(
    df: DataFrame, res_deg: float, stat: str = "mean", by: Sequence[str] = ("band",),
    value: str = "value", lon: str = "lon", lat: str = "lat", group_limit: int = 1_000_000,
) -> DataFrame:
    """Aggregate cells to a coarser grid: one row per target cell and ``by``."""
    cx, cy = cell_xy(lon, lat, res_deg)
    placed = df.withColumn("cx", cx).withColumn("cy", cy)
    keys = ["cx", "cy", *by]
    if stat == "median":
        return exact_quantiles(placed, keys, value, {value: 0.5}, group_limit=group_limit)
    return placed.groupBy(*keys).agg(STATS[stat](value).alias(value))


def refine_grid(
    df: DataFrame, factor: int, ix: str = "ix", iy: str = "iy"
) -> DataFrame:
    """Repeat each cell as ``factor`` x ``factor`` finer cells. Narrow."""
    steps = F.sequence(F.lit(0), F.lit(factor - 1))
    return (
        df.withColumn("_dx", F.explode(steps))
        .withColumn("_dy", F.explode(steps))
        .withColumn(ix, F.col(ix) * factor + F.col("_dx"))
        .withColumn(iy, F.col(iy) * factor + F.col("_dy"))
        .drop("_dx", "_dy")
    )


def band_stats(
    df: DataFrame, by: Sequence[str] = ("band",), value: str = "value",
    probs: dict[str, float] | None = None, approx: bool = False, group_limit: int = 1_000_000,
) -> DataFrame:
    """Count, min, max, mean, stddev and percentiles per band or scene.

    A band is a large share of the rows. Everything but exact percentiles has
    a fixed-size state; ``approx`` makes the percentiles so too and gives one
    shuffle of one row per band and task.
    """
    by = list(by)
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75} if probs is None else probs
    aggs = [
        F.count(value).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("stddev"),
    ]
    if approx or not probs:
        sketched = [F.approx_percentile(value, p, 10_000).alias(c) for c, p in probs.items()]
        return df.groupBy(*by).agg(*aggs, *sketched)
    sizes = group_sizes(df, by)
    if sizes.largest <= group_limit:
        return df.groupBy(*by).agg(*aggs, *builtin_quantiles(value, probs))
    exact = exact_quantiles(df, by, value, probs, group_limit=group_limit, sizes=sizes)
    return join_null_safe(df.groupBy(*by).agg(*aggs), exact, by, "left")


def histogram(
    df: DataFrame, width: float, by: Sequence[str] = ("band",), value: str = "value"
) -> DataFrame:
    """Counts per ``width``-wide bin; ``bin`` is the bin number, ``bin_start``
    its lower edge. Empty bins give no row. Null and NaN are missing."""
    step = F.lit(float(width))
    return (
        df.where(F.col(value).isNotNull() & ~F.isnan(value))
        .groupBy(*by, F.floor(F.col(value) / step).cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_start", F.col("bin") * step)
    )


def focal(
    df: DataFrame, radius: int, stat: str = "mean", by: Sequence[str] = ("band",),
    value: str = "value", ix: str = "ix", iy: str = "iy",
) -> DataFrame:
    """Mean, sum, min, max or count over the square of cells within ``radius``.

    Only cells with data get a row, named ``focal``. Rows of a cell are
    combined first. The square is done as a row pass and a column pass, which
    multiplies cells by 2(2r+1) instead of (2r+1)^2. The grid does not wrap.
    """
    by = list(by)
    v = F.col(value)
    part = df.where(v.isNotNull()).groupBy(ix, iy, *by).agg(
        F.sum(v).alias("_s"), F.count(v).alias("_n"), F.min(v).alias("_lo"), F.max(v).alias("_hi"),
    ).withColumn("_own", F.lit(True))
    for axis in (ix, iy):
        part = (
            part.withColumn("_d", F.explode(F.sequence(F.lit(-radius), F.lit(radius))))
            .withColumn(axis, F.col(axis) + F.col("_d"))
            .groupBy(ix, iy, *by)
            .agg(
                F.sum("_s").alias("_s"), F.sum("_n").alias("_n"),
                F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"),
                F.bool_or(F.col("_own") & (F.col("_d") == 0)).alias("_own"),
            )
        )
    result: dict[str, Column] = {
        "mean": F.col("_s") / F.col("_n"), "sum": F.col("_s"), "count": F.col("_n"),
        "min": F.col("_lo"), "max": F.col("_hi"),
    }
    return part.where("_own").select(ix, iy, *by, result[stat].alias("focal"))
