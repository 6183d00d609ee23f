"""The whole way from observations to a timelapse table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from swathe.functions.grid import frame_label
from swathe.operators.composite import period_start
from swathe.operators.filters import qa_mask
from swathe.operators.frames import frames_by_step, stretch
from swathe.plans.skew import group_sizes


def timelapse(
    cells: DataFrame, keys: Sequence[str], step: str, stat: str = "median",
    qa_field: tuple[int, int] | None = None, qa_allowed: Sequence[int] = (0,),
    lo: float = 0.02, hi: float = 0.98, label: str = "yyyy-MM-dd HH:mm",
    value: str = "value", ts: str = "obs_ts",
) -> DataFrame:
    """Masked, composited, stretched and labelled frames.

    One row per key and frame: ``frame_idx, frame_ts, value, shade, label``.
    Each frame is stretched on its own. ``qa_field`` is (shift, width).
    """
    if qa_field is not None:
        cells = qa_mask(cells, *qa_field, allowed=qa_allowed)
    shots = frames_by_step(cells, keys, step, stat, value, ts)
    # A frame has a row per key seen in it. Counting those is cheaper than
    # counting the rows of the composite, which would compute it.
    seen = cells.select(*keys, period_start(cells, ts, step).alias("_frame")).distinct()
    shaded = stretch(shots, ["frame_idx"], lo, hi, value, sizes=group_sizes(seen, ["_frame"]))
    return shaded.withColumn("label", frame_label("frame_ts", label)).select(
        *keys, "frame_idx", "frame_ts", value, "shade", "label"
    )
