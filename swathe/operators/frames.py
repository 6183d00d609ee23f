"""Frames of a timelapse, as table rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swathe.operators.composite import period_start, temporal_composite
from swathe.plans.quantiles import exact_quantiles
from swathe.plans.sides import broadcast_if, has_at_most, join_null_safe
from swathe.plans.skew import GroupSizes, group_sizes, micros, time_slice


# Time slices whose counts are added up in one task before the blocks' sums are.
SLICES_PER_BLOCK = 1024
# Frames that a row may be compared with.
FEW_FRAMES = 64


def frames_by_step(
    df: DataFrame, keys: Sequence[str], step: str, stat: str = "median",
    value: str = "value", ts: str = "obs_ts",
) -> DataFrame:
    """Composite per key and step, with ``frame_idx`` 1, 2, ... over the steps
    that have data and ``frame_ts`` the start of the step."""
    df = df.where(F.col(value).isNotNull())
    comp = temporal_composite(df, keys, step, stat, value, ts)
    comp = comp.withColumnRenamed("period_start", "frame_ts")
    # The distinct steps come from the rows, not from the composite, so the
    # composite is not computed twice. They grow with the calendar, not with
    # the rows.
    steps = df.select(period_start(df, ts, step).alias("frame_ts")).distinct()
    index = steps.select(
        "frame_ts", F.dense_rank().over(Window.orderBy("frame_ts")).alias("frame_idx")
    )
    index = broadcast_if(index, has_at_most(steps, 100_000))
    return comp.join(index, "frame_ts").select(*keys, "frame_idx", "frame_ts", value)


def frames_by_count(
    df: DataFrame, n: int, ts: str = "obs_ts", slice_width: str = "1 minute"
) -> DataFrame:
    """Rows with ``frame_idx`` 1..n, the distinct instants shared out evenly
    in time order as ``ntile(n)`` would. Rows of one instant share a frame.

    ``ntile`` itself would sort everything in one task. Here instants are
    ranked inside time slices and offset by the counts of earlier slices, in
    two levels. With up to :data:`FEW_FRAMES` frames, rows find theirs by their
    slice: the last frame of the slice that starts at or before the row. With
    more of them a slice may hold any number, and rows find their frame by their
    instant, where adaptive execution splits a hot one. Rows without a time are
    kept, without a frame.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    us = micros(F.col(ts))
    instants = (
        df.where(F.col(ts).isNotNull()).select(us.alias("_us"), time_slice(F.col(ts), slice_width).alias("_slice"))
        .distinct()
    )
    per_slice = instants.groupBy("_slice").agg(F.count(F.lit(1)).alias("_in"))
    blocked = per_slice.withColumn("_block", F.floor(F.col("_slice") / SLICES_PER_BLOCK))
    in_order = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocked.groupBy("_block").agg(F.sum("_in").alias("_sum")).select(
        "_block", F.coalesce(F.sum("_sum").over(in_order), F.lit(0)).alias("_earlier"),
        F.sum("_sum").over(everything).alias("_all"),
    )
    in_block = Window.partitionBy("_block").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_earlier") + F.coalesce(F.col("_here"), F.lit(0))
    per_slice = (
        blocked.withColumn("_here", F.sum("_in").over(in_block)).join(blocks, "_block")
        .select("_slice", before.alias("_before"), "_all")
    )
    at = F.row_number().over(Window.partitionBy("_slice").orderBy("_us")) - 1
    ranked = instants.withColumn("_at", at).join(per_slice, "_slice")
    r = F.col("_before") + F.col("_at")
    size = F.floor(F.col("_all") / F.lit(n))
    longer = F.col("_all") % F.lit(n)
    cut = longer * (size + 1)
    frame = F.when(r < cut, F.floor(r / (size + 1)) + 1).otherwise(
        longer + F.floor(F.try_divide(r - cut, size)) + 1
    )
    framed = ranked.select("_slice", "_us", frame.cast("int").alias("frame_idx"))
    placed = df.withColumn("_us", us)
    if n > FEW_FRAMES:
        return placed.join(framed.select("_us", "frame_idx"), "_us", "left").select(*df.columns, "frame_idx")
    # One row per slice: the frames that have an instant in it, each with its first one.
    starts = framed.groupBy("_slice", "frame_idx").agg(F.min("_us").alias("_us"))
    by_slice = starts.groupBy("_slice").agg(F.collect_list(F.struct("_us", "frame_idx")).alias("_starts"))
    here = F.filter("_starts", lambda s: s["_us"] <= F.col("_us"))
    placed = placed.withColumn("_slice", time_slice(F.col(ts), slice_width)).join(by_slice, "_slice", "left")
    return placed.withColumn("frame_idx", F.array_max(here)["frame_idx"]).select(*df.columns, "frame_idx")


def frame_delta(
    frames: DataFrame, keys: Sequence[str], value: str = "value", frame: str = "frame_idx"
) -> DataFrame:
    """Change from the previous frame of the same key.

    Expects one row per key and frame, as :func:`frames_by_step` gives, so a
    key holds at most one row per frame.
    """
    series = Window.partitionBy(*keys).orderBy(frame)
    return frames.withColumn("previous", F.lag(value).over(series)).withColumn(
        "delta", F.col(value) - F.col("previous")
    )


def stretch(
    df: DataFrame, by: Sequence[str], lo: float = 0.02, hi: float = 0.98,
    value: str = "value", out: str = "shade", approx: bool = False,
    sizes: GroupSizes | None = None,
) -> DataFrame:
    """Map values to 0..255 between two percentiles of their group.

    Values beyond the percentiles clamp; a flat group maps to 0. The exact
    percentiles need a shuffle of distinct values; ``approx`` uses a
    fixed-size sketch instead. The rows themselves are shuffled only when the
    groups are too many to broadcast their limits. ``sizes`` spares measuring
    the groups, when the caller knows bounds.
    """
    by = list(by)
    sizes = sizes or group_sizes(df.where(F.col(value).isNotNull()), by)
    if approx:
        limits = df.groupBy(*by).agg(
            F.approx_percentile(value, lo, 10_000).alias("_lo"),
            F.approx_percentile(value, hi, 10_000).alias("_hi"),
        )
    else:
        limits = exact_quantiles(df, by, value, {"_lo": lo, "_hi": hi}, sizes=sizes)
    limits = broadcast_if(limits, sizes.groups <= 500_000)
    share = F.try_divide(F.col(value) - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    shade = F.round(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * F.lit(255.0)).cast("int")
    shade = F.when(F.col(value).isNotNull(), F.coalesce(shade, F.lit(0)))
    return join_null_safe(df, limits, by, "left").withColumn(out, shade).drop("_lo", "_hi")
