from swathe.functions.grid import (
    attribute,
    cell_area_km2,
    cell_centre,
    cell_xy,
    frame_label,
    haversine_km,
    tile_xy,
)
from swathe.functions.polygon import box_ring, ring_edges

__all__ = [
    "attribute",
    "box_ring",
    "cell_area_km2",
    "cell_centre",
    "cell_xy",
    "frame_label",
    "haversine_km",
    "ring_edges",
    "tile_xy",
]
