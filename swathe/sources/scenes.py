"""Scene catalogs: one row per acquisition with its box, time and cloud."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathe.operators.filters import time_filter


def search_scenes(
    scenes: DataFrame, bbox: tuple[float, float, float, float] | None = None,
    start: str | None = None, end: str | None = None, max_cloud: float | None = None,
    products: Sequence[str] | None = None, ts: str = "acq_ts",
) -> DataFrame:
    """Scenes whose box meets the area and whose time lies in ``[start, end)``.

    Touching boxes meet. ``west > east``, in ``bbox`` or in a scene, spans the
    antimeridian. Plain comparisons of stored columns; all but those between a
    scene's own two edges reach the scan.
    """
    if bbox is not None:
        west, south, east, north = (float(v) for v in bbox)
        scenes = scenes.where(
            (F.col("south") <= F.lit(north)) & (F.col("north") >= F.lit(south))
        )
        starts, ends = F.col("west") <= F.lit(east), F.col("east") >= F.lit(west)
        wraps = F.col("west") > F.col("east")
        if west <= east:
            scenes = scenes.where((starts & ends) | (wraps & (starts | ends)))
        else:
            scenes = scenes.where(starts | ends | wraps)
    scenes = time_filter(scenes, start, end, ts)
    if max_cloud is not None:
        scenes = scenes.where(F.col("cloud") <= F.lit(float(max_cloud)))
    if products is not None:
        scenes = scenes.where(F.col("product").isin(list(products)))
    return scenes
