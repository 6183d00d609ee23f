"""Row filters and per-cell value transforms. All are narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathe.functions.grid import col
from swathe.plans.sides import broadcast_if, has_at_most


# Most steps that one range of a lookup is cut into.
MOST_STEPS = 65_536


def bbox_filter(
    df: DataFrame, west: float, south: float, east: float, north: float,
    lon: str = "lon", lat: str = "lat",
) -> DataFrame:
    """Rows inside a box, all four edges included.

    ``west > east`` means the box spans the antimeridian. On stored columns
    the comparisons are pushed into the Parquet scan.
    """
    x, y = F.col(lon), F.col(lat)
    if west <= east:
        in_x = x.between(F.lit(float(west)), F.lit(float(east)))
    else:
        in_x = (x >= F.lit(float(west))) | (x <= F.lit(float(east)))
    return df.where(in_x & y.between(F.lit(float(south)), F.lit(float(north))))


def time_filter(df: DataFrame, start=None, end=None, ts: str = "obs_ts") -> DataFrame:
    """Rows with ``start <= ts < end``; either bound may be left out."""
    kind = df.schema[ts].dataType.simpleString()
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast(kind))
    if end is not None:
        df = df.where(F.col(ts) < F.lit(end).cast(kind))
    return df


def qa_bits(qa: Column | str, shift: int, width: int) -> Column:
    """Value of a bit field inside a packed quality column."""
    return F.shiftright(col(qa), shift).bitwiseAND(F.lit((1 << width) - 1))


def qa_mask(
    df: DataFrame, shift: int, width: int, allowed: Sequence[int], qa: str = "qa"
) -> DataFrame:
    """Keep rows whose bit field holds an allowed value; null flags drop."""
    return df.where(qa_bits(qa, shift, width).isin(list(allowed)))


def rescale(
    df: DataFrame, scale: float, offset: float = 0.0, nodata: float | None = None,
    value: str = "value", out: str | None = None,
) -> DataFrame:
    """Fill value to null, then ``value * scale + offset``."""
    v = F.col(value).cast("double")
    if nodata is not None:
        v = F.nullif(v, F.lit(float(nodata)))
    return df.withColumn(out or value, v * F.lit(float(scale)) + F.lit(float(offset)))


def reclassify(
    df: DataFrame, breaks: Sequence[float], value: str = "value", out: str = "class"
) -> DataFrame:
    """Class 0 below the first break, 1 from it up to the next, and so on.

    A value equal to a break belongs to the class above. Null stays null.
    """
    edges = [float(b) for b in breaks]
    if edges != sorted(set(edges)):
        raise ValueError("breaks must rise strictly")
    above = sum((F.when(F.col(value) >= F.lit(b), 1).otherwise(0) for b in edges), F.lit(0))
    return df.withColumn(out, F.when(F.col(value).isNotNull(), above))


def reclassify_by_table(
    df: DataFrame, lookup: DataFrame, width: float, value: str = "value",
    lower: str = "lower", upper: str = "upper",
) -> DataFrame:
    """Classes from a lookup table of half-open ``[lower, upper)`` ranges.

    For lookups too long for a ``CASE``: each range is cut into steps of
    ``width`` and joined on the step number, then refined, so the join is an
    equi-join rather than a nested loop. Steps outside the least and greatest
    finite value are left out, and steps are widened so that no range has more
    than ``MOST_STEPS``; ranges may therefore be open, with infinite ends. Rows
    without a class, null and NaN among them, are kept with nulls.
    """
    v = F.col(value).cast("double")
    finite = df.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    least, most = finite.agg(F.min(v), F.max(v)).first()
    least, most = (0.0, 0.0) if least is None else (least, most)
    step = F.lit(max(float(width), (most - least) / MOST_STEPS))
    slot = lambda c: F.floor(c / step)
    first, last = F.greatest(F.col(lower).cast("double"), F.lit(least)), F.least(F.col(upper).cast("double"), F.lit(most))
    ranges = lookup.withColumn("_slot", F.explode(F.when(first <= last, F.sequence(slot(first), slot(last)))))
    ranges = broadcast_if(ranges, has_at_most(ranges, 50_000))
    held = F.least(F.greatest(v, F.lit(least)), F.lit(most))  # infinite values stand with the outermost
    keyed = df.withColumn("_slot", F.when(~F.isnan(v), slot(held)))
    hit = (
        (keyed["_slot"] == ranges["_slot"])
        & (keyed[value] >= ranges[lower])
        & (keyed[value] < ranges[upper])
    )
    return keyed.join(ranges, hit, "left").drop("_slot")
