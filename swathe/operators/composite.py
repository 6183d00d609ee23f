"""One value or one observation per cell and period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swathe.plans.quantiles import exact_quantiles
from swathe.plans.skew import seconds, time_slice

# Calendar units; anything else is read as a fixed-length interval.
UNITS = ("year", "quarter", "month", "week", "day", "hour")

STATS = {
    "mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max,
    "count": F.count, "stddev": F.stddev_samp,
}


def period_start(df: DataFrame, ts: str, period: str) -> Column:
    """Start of the period a timestamp lies in, with the type of ``ts``.

    ``period`` is a calendar unit such as ``month``, or a length such as
    ``8 days`` counted from 1970-01-01.
    """
    kind = df.schema[ts].dataType
    if period in UNITS:
        return F.date_trunc(period, F.col(ts)).cast(kind)
    start = time_slice(F.col(ts), period) * F.lit(seconds(period) * 1_000_000)
    return F.timestamp_micros(start).cast(kind)


def temporal_composite(
    df: DataFrame, keys: Sequence[str], period: str, stat: str = "median",
    value: str = "value", ts: str = "obs_ts", group_limit: int = 1_000_000,
) -> DataFrame:
    """One value per key and period: ``mean sum min max count stddev median``.

    All but the median combine before the shuffle with a fixed-size state. The
    median measures the largest group first, see ``plans.quantiles``.
    """
    dated = df.withColumn("period_start", period_start(df, ts, period))
    by = [*keys, "period_start"]
    if stat == "median":
        return exact_quantiles(dated, by, value, {value: 0.5}, group_limit=group_limit)
    return dated.groupBy(*by).agg(STATS[stat](value).alias(value))


def best_pixel(
    df: DataFrame, keys: Sequence[str], score: str, tie: str = "obs_id",
) -> DataFrame:
    """The whole observation with the highest score per key.

    Null and NaN scores never win unless all are; equal scores go to the higher
    ``tie``, which must be unique.
    """
    known = F.when(~F.isnan(score), F.col(score))
    return _first_per_key(df, keys, [known.desc_nulls_last(), F.desc(tie)])


def mosaic(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("obs_ts", "obs_id"),
    value: str = "value",
) -> DataFrame:
    """Latest observation per key with a value.

    ``order`` is compared from its highest value down and must end in a unique
    column.
    """
    return _first_per_key(df.where(F.col(value).isNotNull()), keys, [F.desc(c) for c in order])


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rank filter lets each task drop all but its own first row per key
    before the shuffle, so a hot key sends one row per task."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")
