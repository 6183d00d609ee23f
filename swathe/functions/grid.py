"""Column helpers for grid cells, map tiles and distances.

Every helper takes and returns Columns, so it stays inside generated code and
can be pushed or folded by Catalyst.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres (IUGG).
EARTH_RADIUS_KM = 6371.0088
# Fixed value: latitude at which the square Web-Mercator map ends.
MERCATOR_LIMIT = 85.0511287798066


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_int(c: Column) -> Column:
    return F.floor(c).cast("int")


def cell_xy(lon: Column | str, lat: Column | str, res: float, globe: bool = True) -> tuple[Column, Column]:
    """Grid cell of a lon/lat position, counted from the south-west corner.

    Cells are half open: a point on a shared edge belongs to the cell to its
    east or north. On the ``globe``, longitude 180 is the first column, as -180
    is, and the north pole belongs to the last row; otherwise both lie beyond
    the grid. NaN has no cell.
    """
    step = F.lit(float(res))
    x, y = (F.when(~F.isnan(col(c)), col(c)) for c in (lon, lat))
    if globe:
        x = F.when(x == 180.0, F.lit(-180.0)).otherwise(x)
    ix, iy = floor_int((x + F.lit(180.0)) / step), floor_int((y + F.lit(90.0)) / step)
    if globe:
        iy = F.when(y == 90.0, F.lit(math.ceil(180 / res) - 1)).otherwise(iy)
    return ix, iy


def cell_centre(ix: Column | str, iy: Column | str, res: float) -> tuple[Column, Column]:
    """Lon/lat of the middle of a cell; the inverse of :func:`cell_xy`."""
    step = F.lit(float(res))
    return (
        (col(ix) + F.lit(0.5)) * step - F.lit(180.0),
        (col(iy) + F.lit(0.5)) * step - F.lit(90.0),
    )


def hilbert_key(ix: str, iy: str, bits: int = 20) -> Column:
    """Place of a cell along a Hilbert curve through a grid of 2 to the ``bits`` cells
    each way; cells next to each other on the curve are neighbours. Indices beyond
    the grid wrap, so that the key orders any cells. ``ix`` and ``iy`` are SQL."""
    side = 1 << bits
    start = f"named_struct('x', cast(pmod({ix}, {side}) AS bigint), 'y', cast(pmod({iy}, {side}) AS bigint), 'key', 0L)"
    east, north = "CASE WHEN a.x & s > 0 THEN 1 ELSE 0 END", "CASE WHEN a.y & s > 0 THEN 1 ELSE 0 END"
    # A quarter that the curve passes the other way round is turned, and in the last one mirrored too.
    mirrored = f"named_struct('x', {side - 1}L - a.x, 'y', {side - 1}L - a.y)"
    seen = f"CASE WHEN q.north = 0 AND q.east = 1 THEN {mirrored} ELSE named_struct('x', a.x, 'y', a.y) END"
    turned = "CASE WHEN q.north = 0 THEN v.y ELSE v.x END", "CASE WHEN q.north = 0 THEN v.x ELSE v.y END"
    step = f"named_struct('x', {turned[0]}, 'y', {turned[1]}, 'key', a.key + s * s * ((3 * q.east) ^ q.north))"
    step = f"transform(array({seen}), v -> {step})[0]"
    step = f"transform(array(named_struct('east', {east}, 'north', {north})), q -> {step})[0]"
    sides = ", ".join(f"{1 << k}L" for k in reversed(range(bits)))
    return F.expr(f"aggregate(array({sides}), {start}, (a, s) -> {step}, a -> a.key)")


def cell_area_km2(lat: Column | str, res: float) -> Column:
    """Area of a ``res``-degree cell centred at ``lat`` on the sphere."""
    half = F.lit(float(res) / 2)
    band = F.sin(F.radians(col(lat) + half)) - F.sin(F.radians(col(lat) - half))
    return F.lit(EARTH_RADIUS_KM**2 * math.radians(float(res))) * band


def tile_xy(lon: Column | str, lat: Column | str, z: int) -> tuple[Column, Column]:
    """Web-Mercator tile column and row at zoom ``z``.

    Positions beyond the projection's latitude limit fall into the first or
    last row, and longitude 180 into the last column.
    """
    n = float(2**z)
    last = F.lit(2**z - 1)
    mapped = F.least(F.greatest(col(lat), F.lit(-MERCATOR_LIMIT)), F.lit(MERCATOR_LIMIT))
    lat_r = F.radians(F.when(col(lat).isNotNull(), mapped))
    x = floor_int((col(lon) + F.lit(180.0)) / F.lit(360.0) * F.lit(n))
    merc = F.ln(F.tan(lat_r) + F.lit(1.0) / F.cos(lat_r)) / F.lit(math.pi)
    y = floor_int((F.lit(1.0) - merc) / F.lit(2.0) * F.lit(n))
    onto = lambda c: F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(0)), last))
    return onto(x), onto(y)


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance on a sphere (not ellipsoidal)."""
    dlat = F.radians(lat2 - lat1) / F.lit(2.0)
    dlon = F.radians(lon2 - lon1) / F.lit(2.0)
    h = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(
        dlon
    ) * F.sin(dlon)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def unit_xyz(lon: Column | str, lat: Column | str) -> tuple[Column, Column, Column]:
    """Position on the unit sphere. Straight-line (chord) distance between two
    such positions grows with great-circle distance, and has no seam at the
    antimeridian or the poles."""
    lo, la = F.radians(col(lon)), F.radians(col(lat))
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)


def chord(km: float) -> float:
    """Unit-sphere chord that spans ``km`` of great circle."""
    return 2 * math.sin(min(km / EARTH_RADIUS_KM, math.pi) / 2)


def attribute(props: Column | str, path: str, as_type: str = "string") -> Column:
    """Typed value from a JSON attribute string; null when absent.

    ``try_cast`` so that one malformed attribute does not fail the job.
    """
    p = path if path.startswith("$") else f"$.{path}"
    return F.get_json_object(col(props), p).try_cast(as_type)


def frame_label(ts: Column | str, fmt: str = "yyyy-MM-dd HH:mm") -> Column:
    """Timestamp text drawn on a frame."""
    return F.date_format(col(ts), fmt)
