"""Footprints as cell sets, and stacking of products."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathe.functions.grid import cell_centre
from swathe.functions.polygon import inside
from swathe.operators.spatial import zone_cover

# Which sides a cell must come from. Bit 1 is a, bit 2 is b.
OVERLAYS = {
    "union": (1, 2, 3),
    "intersection": (3,),
    "difference": (1,),
    "symmetric_difference": (1, 2),
}


def cell_overlay(
    a: DataFrame, b: DataFrame, op: str, keys: Sequence[str] = ("ix", "iy")
) -> DataFrame:
    """Cells of two footprints combined: ``union``, ``intersection``,
    ``difference`` (a without b) or ``symmetric_difference``.

    One partially aggregated shuffle for any of them: repeated cells collapse
    in each task, where a join would carry them.
    """
    sides = a.select(*keys, F.lit(1).alias("_side")).unionByName(
        b.select(*keys, F.lit(2).alias("_side"))
    )
    return (
        sides.groupBy(*keys)
        .agg(F.bit_or("_side").alias("_in"))
        .where(F.col("_in").isin(*OVERLAYS[op]))
        .select(*keys)
    )


def footprint_cells(
    zones: DataFrame, res: float, zone_id: str = "zone_id", rings: str = "rings"
) -> DataFrame:
    """Cells whose centre lies in a zone: ``zone_id, ix, iy``. Narrow."""
    cover = zone_cover(zones, res, zone_id, rings)
    x, y = cell_centre("cx", "cy", res)
    cover = cover.withColumns({"_x": x, "_y": y})
    return cover.where((F.size("edges") == 0) | inside("edges", "_x", "_y")).select(
        zone_id, F.col("cx").alias("ix"), F.col("cy").alias("iy")
    )


def shared_cells(
    a: DataFrame, b: DataFrame, res: float, a_id: str = "a_id", b_id: str = "b_id", rings: str = "rings",
) -> DataFrame:
    """Areas of ``a`` and ``b`` that meet: ``a_id, b_id, cells, share``.

    ``cells`` is how many ``res``-degree cells have their centre in both, and
    ``share`` that number over the cells of the ``a`` area. Areas too small to
    hold a centre meet nothing. Both sides become cells, joined by equality, so
    no pair is tested that shares no cell.
    """
    left, right = footprint_cells(a, res, a_id, rings), footprint_cells(b, res, b_id, rings)
    size = left.groupBy(a_id).agg(F.count(F.lit(1)).alias("_size"))
    met = left.join(right, ["ix", "iy"]).groupBy(a_id, b_id).agg(F.count(F.lit(1)).alias("cells"))
    return met.join(size, a_id).select(a_id, b_id, "cells", (F.col("cells") / F.col("_size")).alias("share"))


def stack(dfs: Sequence[DataFrame]) -> DataFrame:
    """Products one after another; columns a product lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
