"""Tables of mergeable sketches per map tile and period.

Counts, sums and extremes merge exactly; distinct counts are HyperLogLog sketches
and quantiles KLL sketches, both of bounded size. A finished table answers for any
coarser zoom and any stretch of periods without a look at the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathe.operators.composite import period_start
from swathe.operators.tiles import with_tile

#: Logarithm of the registers of a distinct count: a standard error of 1.6 %.
LG_K = 12
#: Size of a quantile sketch: a rank error of 1.33 % with 99 % confidence.
KLL_K = 200


def tile_sketches(
    df: DataFrame, z: int, step: str = "1 day", counted: str = "station_id", value: str = "value", ts: str = "obs_ts",
    lon: str = "lon", lat: str = "lat",
) -> DataFrame:
    """One row per tile of zoom ``z`` and period with values: ``z, x, y, period_start``,
    ``n``, ``total``, ``least``, ``most``, and the sketches ``different`` (of ``counted``)
    and ``spread`` (of ``value``).

    Null and NaN values, null times and rows without a position take no part. Each
    task sketches what it reads; only sketches are shuffled, so a hot tile costs no
    more than another.
    """
    v = F.col(value).cast("double")
    known = df.where(v.isNotNull() & ~F.isnan(v) & F.col(ts).isNotNull()).withColumn("_v", v)
    tiled = with_tile(known, z, lon, lat).where("x IS NOT NULL AND y IS NOT NULL")
    return tiled.groupBy("z", "x", "y", period_start(tiled, ts, step).alias("period_start")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_v").alias("total"), F.min("_v").alias("least"), F.max("_v").alias("most"),
        F.hll_sketch_agg(counted, LG_K).alias("different"), F.kll_sketch_agg_double("_v", KLL_K).alias("spread"),
    )


def _merged(sketches: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    return sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.hll_union_agg("different").alias("different"),
        F.reduce(F.collect_list("spread"), F.lit(None).cast("binary"), lambda a, b: F.when(a.isNull(), b).otherwise(F.kll_sketch_merge_double(a, b))).alias("spread"),
    )


def merge_zooms(sketches: DataFrame, z: int) -> DataFrame:
    """Sketches of one zoom merged up to zoom ``z``, which must not be finer.

    One zoom at a time, so that a merged tile is made of four at most.
    """
    first = sketches.select("z").first()
    for _ in range(first["z"] - z if first else 0):
        up = [(F.col("z") - 1).alias("z"), F.shiftright("x", 1).alias("x"), F.shiftright("y", 1).alias("y")]
        sketches = _merged(sketches, [*up, "period_start"])
    return sketches


def merge_periods(sketches: DataFrame, start: str, end: str) -> DataFrame:
    """Sketches of all periods from ``start`` up to but not including ``end`` merged per
    tile: ``z, x, y`` and the merged columns. A tile has one row per period at most."""
    at = F.col("period_start")
    return _merged(sketches.where((at >= F.lit(start)) & (at < F.lit(end))), ["z", "x", "y"])


def read_sketches(sketches: DataFrame, probs: dict[str, float]) -> DataFrame:
    """Sketches as numbers: ``n_different`` and a column for each of ``probs``."""
    quantiles = {c: F.kll_sketch_get_quantile_double("spread", F.lit(float(p))) for c, p in probs.items()}
    return sketches.withColumns({"n_different": F.hll_sketch_estimate("different"), **quantiles}).drop("different", "spread")
