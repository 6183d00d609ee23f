"""Map-tile tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swathe.functions.grid import tile_xy


def with_tile(df: DataFrame, z: int, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Rows with the ``z, x, y`` of their tile."""
    x, y = tile_xy(lon, lat, z)
    return df.withColumns({"z": F.lit(z), "x": x, "y": y})


def tile_pyramid(
    df: DataFrame, zmin: int, zmax: int, by: Sequence[str] = (), value: str = "value",
    lon: str = "lon", lat: str = "lat",
) -> DataFrame:
    """Count, sum, mean, min and max per tile at every zoom.

    Rows are combined at the deepest zoom; only those partial sums are copied
    to the shallower zooms, where a tile's parent is its index halved. Low
    zooms hold few tiles with many children, and combine before the shuffle.
    """
    by = list(by)
    v = F.col(value)
    placed = with_tile(df.where(v.isNotNull()), zmax, lon, lat)
    deepest = placed.groupBy("x", "y", *by).agg(
        F.count(v).alias("_n"), F.sum(v).alias("_s"), F.min(v).alias("_lo"), F.max(v).alias("_hi"),
    )
    copies = deepest.withColumn("z", F.explode(F.sequence(F.lit(zmin), F.lit(zmax))))
    halved = lambda c: F.call_function("shiftright", F.col(c), F.lit(zmax) - F.col("z"))
    return (
        copies.select("z", halved("x").alias("x"), halved("y").alias("y"), *by, "_n", "_s", "_lo", "_hi")
        .groupBy("z", "x", "y", *by)
        .agg(
            F.sum("_n").alias("n"), F.sum("_s").alias("total"),
            (F.sum("_s") / F.sum("_n")).alias("mean"),
            F.min("_lo").alias("min"), F.max("_hi").alias("max"),
        )
    )


def tile_top_k(
    df: DataFrame, k: int, z: int, by: str, tie: str, lon: str = "lon", lat: str = "lat"
) -> DataFrame:
    """At most ``k`` rows per tile, highest ``by`` first, then lower ``tie``.

    Spark applies the rank limit in each task before the shuffle as well, so a
    crowded tile sends ``k`` rows per task, up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``.
    """
    order = Window.partitionBy("z", "x", "y").orderBy(F.desc_nulls_last(by), tie)
    return (
        with_tile(df, z, lon, lat)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )
