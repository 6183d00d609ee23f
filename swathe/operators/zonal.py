"""Statistics of cells per zone, and measures of the zones themselves."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathe.functions.grid import cell_area_km2
from swathe.functions.polygon import ring_edges, sum_over
from swathe.functions.seam import on_globe, unrolled
from swathe.operators.spatial import spatial_join
from swathe.plans.quantiles import builtin_quantiles, exact_quantiles
from swathe.plans.scratch import read_once
from swathe.plans.sides import join_null_safe
from swathe.plans.skew import group_sizes

ZONAL_STATS = ("count", "sum", "mean", "min", "max", "stddev")
# Of the values as classes.
CLASS_STATS = ("majority", "minority", "variety")


def _quantile(stat: str) -> float | None:
    """Share below a quantile: ``median``, or ``p0`` to ``p100``."""
    if stat == "median":
        return 0.5
    number = stat.removeprefix("p")
    return int(number) / 100 if stat != number and number.isdigit() and int(number) <= 100 else None


def zonal_stats(
    cells: DataFrame, zones: DataFrame, stats: Sequence[str] = ("count", "mean"),
    by: Sequence[str] = (), value: str = "value", cell_deg: float = 2.0,
    zone_id: str = "zone_id", lon: str = "lon", lat: str = "lat", group_limit: int = 1_000_000, levels: int = 0,
) -> DataFrame:
    """One row per zone (and ``by``) with a column per statistic:
    :data:`ZONAL_STATS`, ``median``, percentiles as ``p90``, and
    :data:`CLASS_STATS`: the value seen most and least often, of equals the
    lower one, and the number of different values.

    Cells sit at few distinct positions, so values are combined per position
    first: the spatial join then sees each position once however often it was
    observed, and it is made once whatever the statistics. ``levels`` is that of
    :func:`spatial_join`. Nulls and NaN are
    missing values. Zones without cells give no row.
    """
    probs = {c: p for c in stats if (p := _quantile(c)) is not None}
    classes = [c for c in stats if c in CLASS_STATS]
    unknown = set(stats) - set(ZONAL_STATS) - set(classes) - set(probs)
    if unknown:
        raise ValueError(f"unknown statistics {sorted(unknown)}")
    keys, spot, v = [zone_id, *by], [lon, lat, *by], F.col(value)
    known = cells.where(v.isNotNull() & ~F.isnan(v))
    plain = [c for c in stats if c in ZONAL_STATS]

    def held(per_spot: DataFrame) -> DataFrame:
        return spatial_join(per_spot, zones, "inner", cell_deg, zone_id=zone_id, lon=lon, lat=lat, levels=levels)

    if not probs and not classes:
        per_spot = known.groupBy(*spot).agg(
            F.count(F.lit(1)).alias("_n"), F.sum(v).alias("_s"), F.avg(v).alias("_v"),
            (F.var_pop(v) * F.count(F.lit(1))).alias("_m2"), F.min(v).alias("_lo"), F.max(v).alias("_hi"),
        )
        return _plain(held(per_spot), keys, plain).select(*keys, *stats)
    # Everything comes from how often each value occurs in each zone.
    per_spot = known.groupBy(*spot, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    per_value = held(per_spot).groupBy(*keys, "_v").agg(F.sum("_n").alias("_n"))
    large = bool(probs) and known.count() > group_limit
    if large or "stddev" in plain:
        per_value = read_once(per_value, "zonal")
    once = F.count(F.lit(1))
    ranked = {
        "majority": F.max_by("_v", F.struct("_n", -F.col("_v"))), "minority": F.min_by("_v", F.struct("_n", "_v")), "variety": once,
    }
    aggs = [ranked[c].alias(c) for c in classes]
    tables = []
    sizes = group_sizes(per_value, keys) if large else None
    if sizes is not None and sizes.largest > group_limit:
        tables.append(exact_quantiles(per_value, keys, "_v", probs, "_n", group_limit, sizes=sizes))
    else:
        aggs += builtin_quantiles("_v", probs, "_n")
    if "stddev" in plain:
        same = [F.col("_v").alias(c) for c in ("_lo", "_hi")]
        rows = per_value.select("*", (F.col("_v") * F.col("_n")).alias("_s"), F.lit(0.0).alias("_m2"), *same)
        tables.append(_plain(rows, keys, plain))
    else:
        n, total = F.sum("_n"), F.sum(F.col("_v") * F.col("_n"))
        merged = {"count": n, "sum": total, "mean": total / n, "min": F.min("_v"), "max": F.max("_v")}
        aggs += [merged[c].alias(c) for c in plain]
    if aggs:
        tables.append(per_value.groupBy(*keys).agg(*aggs))
    return _side_by_side(tables, keys).select(*keys, *stats)


def _plain(rows: DataFrame, keys: list[str], stats: Sequence[str]) -> DataFrame:
    """Statistics of rows that stand for ``_n`` values each, with their sum, mean,
    squared spread, least and greatest: ``_s, _v, _m2, _lo, _hi``.

    Spread is added up without a second pass and without sums of squares, which
    cancel far from zero: rows of equal weight have the built-in variance, and
    the few weights of a group are merged around the group's mean.
    """
    n, s = F.sum("_n"), F.sum("_s")
    merged = {"count": n, "sum": s, "mean": s / n, "min": F.min("_lo"), "max": F.max("_hi")}
    if "stddev" not in stats:
        return rows.groupBy(*keys).agg(*(merged[c].alias(c) for c in stats))
    weighed = rows.groupBy(*keys, F.col("_n").alias("_w")).agg(
        n.alias("_n"), s.alias("_s"), F.avg("_v").alias("_v"), (F.sum("_m2") + F.var_pop("_v") * n).alias("_m2"),
        F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"),
    )
    parts = F.collect_list(F.struct("_n", "_v", "_m2")).alias("_parts")
    grouped = weighed.groupBy(*keys).agg(parts, *(merged[c].alias(f"_{c}") for c in merged))
    centre = "aggregate(_parts, 0D, (a, p) -> a + p._n * p._v) / _count"
    spread = f"transform(array({centre}), c -> aggregate(_parts, 0D, (a, p) -> a + p._m2 + p._n * (p._v - c) * (p._v - c)))[0]"
    out = {c: F.col(f"_{c}") for c in merged} | {"stddev": F.expr(f"CASE WHEN _count > 1 THEN sqrt({spread} / (_count - 1)) END")}
    return grouped.select(*keys, *(out[c].alias(c) for c in stats))


def _side_by_side(tables: list[DataFrame], keys: list[str]) -> DataFrame:
    return reduce(lambda a, b: join_null_safe(a, b, keys), tables)


def class_area(
    cells: DataFrame, zones: DataFrame, res: float, class_col: str = "class",
    cell_deg: float = 2.0, zone_id: str = "zone_id", lon: str = "lon", lat: str = "lat", cube: bool = False,
) -> DataFrame:
    """Cells and area per zone and class, with subtotals.

    ``level`` is 0 for (zone, class), 1 for a zone, 3 for everything, and with
    ``cube`` also 2 for a class. ``n`` and
    ``area_km2`` count each cell once per class and zone however often it was
    visited, ``visits`` every row. Area is that of ``res``-degree cells on the
    sphere.
    """
    per_spot = cells.groupBy(lon, lat, class_col).agg(F.count(F.lit(1)).alias("_n"))
    held = spatial_join(per_spot, zones, "inner", cell_deg, zone_id=zone_id, lon=lon, lat=lat)
    # The rollup copies its input once per level: give it only the totals.
    totals = held.groupBy(zone_id, class_col).agg(
        F.count(F.lit(1)).alias("_cells"), F.sum("_n").alias("_n"), F.sum(cell_area_km2(lat, res)).alias("_area")
    )
    grouped = totals.cube(zone_id, class_col) if cube else totals.rollup(zone_id, class_col)
    return grouped.agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("_cells").alias("n"),
        F.sum("_n").alias("visits"),
        F.sum("_area").alias("area_km2"),
    )


def _within(x: Column) -> Column:
    """A longitude from -180 to 180."""
    return F.when(x.between(-180.0, 180.0), x).otherwise(on_globe(x))


def zone_measures(
    zones: DataFrame, zone_id: str = "zone_id", rings: str = "rings"
) -> DataFrame:
    """Planar area, perimeter, centroid and box per zone, in degrees.

    An outline over the antimeridian is measured as one; its ``east`` is then below
    its ``west``. Narrow: each outline is measured where its row is. Rings follow the
    GeoJSON winding (outer anticlockwise, holes clockwise) so that holes
    subtract. Centroid is null for a flat outline.
    """
    turn = "(e.x1 * e.y2 - e.x2 * e.y1)"
    length = "sqrt((e.x2 - e.x1) * (e.x2 - e.x1) + (e.y2 - e.y1) * (e.y2 - e.y1))"
    twice = F.col("_twice")
    outlines = zones.select(zone_id, unrolled(rings).alias(rings))
    measured = outlines.select(F.col(zone_id), ring_edges(rings).alias("_edges")).withColumn(
        "_twice", sum_over("_edges", turn)
    )
    return measured.select(
        zone_id,
        F.abs(twice / 2).alias("area"),
        sum_over("_edges", length).alias("perimeter"),
        _within(F.try_divide(sum_over("_edges", f"(e.x1 + e.x2) * {turn}"), twice * 3)).alias("centroid_x"),
        F.try_divide(sum_over("_edges", f"(e.y1 + e.y2) * {turn}"), twice * 3).alias("centroid_y"),
        _within(F.array_min("_edges.x1")).alias("west"), F.array_min("_edges.y1").alias("south"),
        _within(F.array_max("_edges.x1")).alias("east"), F.array_max("_edges.y1").alias("north"),
    )
