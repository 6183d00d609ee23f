"""Spatial joins, zonal statistics, zone measures and map tiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from swathe.functions.grid import cell_xy
from swathe.operators import filters, overlay, sketches, spatial, tiles, zonal
from workload.cells import CLASS
from workload.fixtures import (
    OBS, PAIRS, PARCEL_EDGES, SCENES, ZONE_EDGES, cell_area_sql, haversine_sql, observations, parcels, rounded, scenes, stations, stations_sql, tile_sql, zones,
)

IN_ZONES = f"WITH {OBS}, {ZONE_EDGES}, {PAIRS}"
IN_PARCELS = f"WITH {OBS}, {PARCEL_EDGES}, {PAIRS}"


def spatial_join(how):
    def query(spark, sf):
        got = spatial.spatial_join(observations(spark, sf), zones(spark), how)
        return got.select("obs_id", "zone_id")

    return query


def spatial_join_parcels(spark, sf):
    got = spatial.spatial_join(observations(spark, sf), parcels(spark, sf), cell_deg=1.0)
    return got.select("obs_id", "zone_id")


def clip(spark, sf):
    return spatial.clip(observations(spark, sf), zones(spark)).select("obs_id", "lon", "lat")


def outside(spark, sf):
    return spatial.outside(observations(spark, sf), zones(spark)).select("obs_id", "lon", "lat")


def within_distance_join(spark, sf):
    got = spatial.within_distance_join(
        observations(spark, sf).select("obs_id", "lon", "lat"), stations(spark, sf), 60.0
    )
    return rounded(got.select("obs_id", F.col("b_station").alias("station"), "dist_km"), "dist_km")


DISTANCE = haversine_sql("o.lon", "o.lat", "s.lon", "s.lat")
WITHIN = f"""WITH {OBS}, {stations_sql()}, d AS (
  SELECT obs_id, station, {DISTANCE} AS dist_km FROM obs o, stations s)
SELECT obs_id, station, round(dist_km, 6) AS dist_km FROM d WHERE dist_km <= 60"""


def nearest_join(spark, sf):
    got = spatial.nearest_join(
        observations(spark, sf).select("obs_id", "lon", "lat"),
        stations(spark, sf, "supplier", "s_suppkey"), 3, "station",
    )
    return rounded(got.select("obs_id", F.col("b_station").alias("station"), "dist_km", "rank"), "dist_km")


NEAREST = f"""WITH {OBS}, {stations_sql('supplier', 's_suppkey')}, d AS (
  SELECT obs_id, station, {DISTANCE} AS dist_km FROM obs o, stations s),
r AS (SELECT *, row_number() OVER (PARTITION BY obs_id ORDER BY dist_km, station) AS rank FROM d)
SELECT obs_id, station, round(dist_km, 6) AS dist_km, CAST(rank AS INT) AS rank FROM r WHERE rank <= 3"""


def sample_at_points(spark, sf):
    ix, iy = cell_xy("lon", "lat", 1.0)
    cells = observations(spark, sf).groupBy(ix.alias("ix"), iy.alias("iy")).agg(
        F.round(F.avg("value"), 6).alias("mean_value")
    )
    return spatial.sample_at_points(stations(spark, sf), cells, 1.0, ["mean_value"]).select(
        "station", "mean_value"
    )


SAMPLE = f"""WITH {OBS}, {stations_sql()}, c AS (
  SELECT CAST(floor((lon + 180.0::DOUBLE) / 1.0::DOUBLE) AS INT) AS ix,
    CAST(floor((lat + 90.0::DOUBLE) / 1.0::DOUBLE) AS INT) AS iy, round(avg(value), 6) AS mean_value
  FROM obs GROUP BY 1, 2)
SELECT station, mean_value FROM stations LEFT JOIN c
  ON ix = CAST(floor((lon + 180.0::DOUBLE) / 1.0::DOUBLE) AS INT)
  AND iy = CAST(floor((lat + 90.0::DOUBLE) / 1.0::DOUBLE) AS INT)"""


def zonal_stats(spark, sf):
    got = zonal.zonal_stats(
        observations(spark, sf), zones(spark), ("count", "sum", "mean", "min", "max", "stddev")
    )
    return rounded(got, "sum", "mean", "stddev")


ZONAL = IN_ZONES + """ SELECT zone_id, count(*) AS count, round(sum(value), 6) AS sum,
  round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max,
  round(stddev_samp(value), 6) AS stddev FROM pairs JOIN obs USING (obs_id) GROUP BY zone_id"""


def zonal_stats_band(spark, sf):
    got = zonal.zonal_stats(
        observations(spark, sf), zones(spark), ("count", "mean", "stddev", "median"), by=("band",)
    )
    return rounded(got, "mean", "stddev", "median")


ZONAL_BAND = IN_ZONES + """ SELECT zone_id, band, count(*) AS count, round(avg(value), 6) AS mean,
  round(stddev_samp(value), 6) AS stddev, round(median(value), 6) AS median
  FROM pairs JOIN obs USING (obs_id) GROUP BY zone_id, band"""


def zonal_stats_classes(spark, sf):
    whole = observations(spark, sf).withColumn("value", F.floor("value").cast("double"))
    stats = ("count", "p90", "majority", "minority", "variety")
    return rounded(zonal.zonal_stats(whole, zones(spark), stats), "p90")


ZONAL_CLASSES = IN_ZONES + """, v AS (SELECT zone_id, floor(value) AS value FROM pairs JOIN obs USING (obs_id)),
  c AS (SELECT zone_id, value, count(*) AS n FROM v GROUP BY 1, 2),
  r AS (SELECT DISTINCT zone_id, first_value(value) OVER (PARTITION BY zone_id ORDER BY n DESC, value) AS majority,
    first_value(value) OVER (PARTITION BY zone_id ORDER BY n, value) AS minority FROM c)
SELECT zone_id, count(*) AS count, round(quantile_cont(value, 0.9), 6) AS p90, any_value(majority) AS majority,
  any_value(minority) AS minority, count(DISTINCT value) AS variety FROM v JOIN r USING (zone_id) GROUP BY zone_id"""


def zonal_stats_offset(spark, sf):
    """Values far from zero, where sums of squares lose the spread."""
    far = observations(spark, sf).withColumn("value", F.col("value") + 1e9)
    return rounded(zonal.zonal_stats(far, zones(spark), ("count", "stddev")), "stddev", places=3)


ZONAL_OFFSET = IN_ZONES + """ SELECT zone_id, count(*) AS count, round(stddev_samp(value), 3) AS stddev
  FROM pairs JOIN obs USING (obs_id) GROUP BY zone_id"""


def zonal_median_split(spark, sf):
    """Every zone cut into value ranges, as a huge zone is."""
    got = zonal.zonal_stats(observations(spark, sf), zones(spark), ("median",), group_limit=10)
    return rounded(got, "median")


ZONAL_MEDIAN = IN_ZONES + """ SELECT zone_id, round(median(value), 6) AS median
  FROM pairs JOIN obs USING (obs_id) GROUP BY zone_id"""


def class_area(spark, sf):
    classed = filters.reclassify(observations(spark, sf), [10, 50, 100, 200])
    return rounded(zonal.class_area(classed, zones(spark), 0.1), "area_km2", places=4)


CLASS_AREA = IN_ZONES + f""" SELECT zone_id, CAST({CLASS} AS INT) AS class,
  CAST(grouping_id(zone_id, CAST({CLASS} AS INT)) AS INT) AS level, count(*) AS n, CAST(sum(seen) AS BIGINT) AS visits,
  round(sum({cell_area_sql('lat', 0.1)}), 4) AS area_km2
  FROM (SELECT zone_id, lon, lat, any_value(value) AS value, count(*) AS seen
    FROM pairs JOIN obs USING (obs_id) GROUP BY zone_id, lon, lat, CAST({CLASS} AS INT))
  GROUP BY ROLLUP (zone_id, CAST({CLASS} AS INT))"""


def class_area_cube(spark, sf):
    classed = filters.reclassify(observations(spark, sf), [10, 50, 100, 200])
    return rounded(zonal.class_area(classed, zones(spark), 0.1, cube=True), "area_km2", places=4)


def spatial_join_attributes(spark, sf):
    held = spatial.spatial_join(observations(spark, sf), parcels(spark, sf), attributes=("c_mktsegment",))
    return held.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("obs_id").alias("points"))


def zone_measures(spark, sf):
    got = zonal.zone_measures(parcels(spark, sf))
    return rounded(got, *[c for c in got.columns if c != "zone_id"])


ZONE_MEASURES = f"""WITH {PARCEL_EDGES}, m AS (
  SELECT zone_id, sum(x1 * y2 - x2 * y1) AS twice,
    sum(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))) AS perimeter,
    sum((x1 + x2) * (x1 * y2 - x2 * y1)) AS mx, sum((y1 + y2) * (x1 * y2 - x2 * y1)) AS my,
    min(x1) AS west, min(y1) AS south, max(x1) AS east, max(y1) AS north
  FROM edges GROUP BY zone_id)
SELECT zone_id, round(abs(twice / 2), 6) AS area, round(perimeter, 6) AS perimeter,
  round(mx / (twice * 3), 6) AS centroid_x, round(my / (twice * 3), 6) AS centroid_y,
  round(west, 6) AS west, round(south, 6) AS south, round(east, 6) AS east, round(north, 6) AS north
FROM m"""


def footprint_cells(spark, sf):
    return overlay.footprint_cells(parcels(spark, sf), 1.0)


FOOTPRINT = f"""WITH {PARCEL_EDGES}, e AS (SELECT *, min(x1) OVER w AS lo_x, max(x1) OVER w AS hi_x,
    min(y1) OVER w AS lo_y, max(y1) OVER w AS hi_y FROM edges WINDOW w AS (PARTITION BY zone_id)),
c AS (SELECT zone_id, cx, cy, sum(CASE WHEN (y1 > cy - 89.5) <> (y2 > cy - 89.5)
    AND cx - 179.5 < (x2 - x1) * (cy - 89.5 - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) AS crossed
  FROM e, range(360) a(cx), range(180) b(cy)
  WHERE cx - 179.5 BETWEEN lo_x AND hi_x AND cy - 89.5 BETWEEN lo_y AND hi_y GROUP BY 1, 2, 3)
SELECT zone_id, CAST(cx AS INT) AS ix, CAST(cy AS INT) AS iy FROM c WHERE crossed % 2 = 1"""


def footprint_overlap(spark, sf):
    """Cells covered by parcels of one segment and of any other at once."""
    cells = overlay.footprint_cells(parcels(spark, sf), 1.0).join(
        parcels(spark, sf).select("zone_id", "c_mktsegment"), "zone_id"
    )
    building = F.col("c_mktsegment") == "BUILDING"
    return overlay.cell_overlay(cells.where(building), cells.where(~building), "intersection")


FOOTPRINT_OVERLAP = f"""WITH f AS ({FOOTPRINT}), s AS (SELECT ix, iy, c_mktsegment AS seg
  FROM f JOIN customer ON c_custkey = zone_id)
SELECT ix, iy FROM s WHERE seg = 'BUILDING' INTERSECT SELECT ix, iy FROM s WHERE seg <> 'BUILDING'"""


def scenes_by_zone(spark, sf):
    """Which scenes cover which zone, and with what share of their cells."""
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(corner("west", "south"), corner("east", "south"), corner("east", "north"), corner("west", "north"), corner("west", "south"))
    boxes = scenes(spark, sf).select("scene_id", F.array(ring).alias("rings"))
    return rounded(overlay.shared_cells(boxes, zones(spark), 1.0, "scene_id", "zone_id"), "share")


SCENES_BY_ZONE = f"""WITH {SCENES}, {ZONE_EDGES}, c AS (SELECT zone_id, cx, cy FROM edges, range(360) a(cx), range(180) b(cy)
  GROUP BY zone_id, cx, cy HAVING sum(CASE WHEN (y1 > cy - 89.5) <> (y2 > cy - 89.5)
    AND cx - 179.5 < (x2 - x1) * (cy - 89.5 - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1),
s AS (SELECT scene_id, CAST(west + 180 AS BIGINT) + dx AS cx, CAST(south + 90 AS BIGINT) + dy AS cy
  FROM scenes, range(2) d(dx), range(2) e(dy))
SELECT scene_id, zone_id, count(*) AS cells, round(count(*) / 4::DOUBLE, 6) AS share FROM s JOIN c USING (cx, cy) GROUP BY 1, 2"""


def tile_xy(spark, sf):
    return tiles.with_tile(observations(spark, sf), 7).select("obs_id", "z", "x", "y")


_X7, _Y7 = tile_sql("lon", "lat", 7)
TILE_XY = f"WITH {OBS} SELECT obs_id, 7 AS z, CAST({_X7} AS INT) AS x, CAST({_Y7} AS INT) AS y FROM obs"


def tile_pyramid(spark, sf):
    return rounded(tiles.tile_pyramid(observations(spark, sf), 0, 8), "total", "mean")


_X8, _Y8 = tile_sql("lon", "lat", 8)
TILE_PYRAMID = f"""WITH {OBS}, t AS (SELECT {_X8} AS x, {_Y8} AS y, value FROM obs)
SELECT CAST(z AS INT) AS z, CAST(x >> (8 - z)::INT AS INT) AS x, CAST(y >> (8 - z)::INT AS INT) AS y,
  count(*) AS n, round(sum(value), 6) AS total, round(avg(value), 6) AS mean,
  min(value) AS min, max(value) AS max FROM t, range(9) l(z) GROUP BY 1, 2, 3"""


def tile_top_k(spark, sf):
    got = tiles.tile_top_k(observations(spark, sf), 4, 3, "value", "obs_id")
    return got.select("z", "x", "y", "rank", "obs_id", "value")


_X3, _Y3 = tile_sql("lon", "lat", 3)
TILE_TOP_K = f"""WITH {OBS}, t AS (SELECT {_X3} AS x, {_Y3} AS y, obs_id, value FROM obs),
r AS (SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY value DESC, obs_id) AS rank FROM t)
SELECT 3 AS z, CAST(x AS INT) AS x, CAST(y AS INT) AS y, CAST(rank AS INT) AS rank, obs_id, value
FROM r WHERE rank <= 4"""

def tile_sketches(spark, sf):
    """Daily sketches of zoom 6 merged to zoom 2 and two weeks, beside exact values: are
    the estimates within their error?"""
    obs = observations(spark, sf)
    daily = sketches.tile_sketches(obs, 6)
    merged = sketches.merge_periods(sketches.merge_zooms(daily, 2), "2024-01-05", "2024-01-19")
    told = sketches.read_sketches(merged, {"median": 0.5})
    rows = tiles.with_tile(obs.where("obs_ts >= '2024-01-05' AND obs_ts < '2024-01-19'"), 2).where("value IS NOT NULL")
    ranked = rows.join(F.broadcast(told.select("x", "y", "median")), ["x", "y"]).groupBy("x", "y").agg(
        F.count_distinct("station_id").alias("_different"), F.count_if(F.col("value") < F.col("median")).alias("_below"),
        F.count_if(F.col("value") <= F.col("median")).alias("_upto"),
    )
    both = told.join(ranked, ["x", "y"])
    return rounded(both.select(
        "x", "y", "n", "total", "least", "most", (F.abs(F.col("n_different") - F.col("_different")) <= 0.05 * F.col("_different") + 1).alias("count_near"),
        ((F.col("_below") <= 0.52 * F.col("n") + 1) & (F.col("_upto") >= 0.48 * F.col("n") - 1)).alias("median_near"),
    ), "total")


TILE_SKETCHES = f"""WITH {OBS}, t AS (SELECT {tile_sql("lon", "lat", 2)[0]} AS x, {tile_sql("lon", "lat", 2)[1]} AS y, value FROM obs
  WHERE obs_ts >= TIMESTAMP '2024-01-05' AND obs_ts < TIMESTAMP '2024-01-19' AND value IS NOT NULL)
SELECT CAST(x AS INT) AS x, CAST(y AS INT) AS y, count(*) AS n, round(sum(value), 6) AS total, min(value) AS least, max(value) AS most,
  true AS count_near, true AS median_near FROM t GROUP BY 1, 2"""

QUERIES = {
    "tile_sketches": (tile_sketches, TILE_SKETCHES),
    "zonal_stats": (zonal_stats, ZONAL),
    "zonal_stats_band": (zonal_stats_band, ZONAL_BAND),
    "zonal_stats_classes": (zonal_stats_classes, ZONAL_CLASSES),
    "zonal_stats_offset": (zonal_stats_offset, ZONAL_OFFSET),
    "zonal_median_split": (zonal_median_split, ZONAL_MEDIAN),
    "spatial_join_inner": (spatial_join("inner"), IN_ZONES + " SELECT obs_id, zone_id FROM pairs"),
    "spatial_join_left": (
        spatial_join("left"),
        IN_ZONES + " SELECT obs_id, zone_id FROM obs LEFT JOIN pairs USING (obs_id)",
    ),
    "spatial_join_parcels": (
        spatial_join_parcels, IN_PARCELS + " SELECT obs_id, zone_id FROM pairs"
    ),
    "clip": (clip, IN_ZONES + " SELECT obs_id, lon, lat FROM obs SEMI JOIN pairs USING (obs_id)"),
    "outside": (outside, IN_ZONES + " SELECT obs_id, lon, lat FROM obs ANTI JOIN pairs USING (obs_id)"),
    "within_distance_join": (within_distance_join, WITHIN),
    "nearest_join": (nearest_join, NEAREST),
    "sample_at_points": (sample_at_points, SAMPLE),
    "class_area": (class_area, CLASS_AREA),
    "class_area_cube": (class_area_cube, CLASS_AREA.replace("ROLLUP", "CUBE")),
    "spatial_join_attributes": (
        spatial_join_attributes,
        IN_PARCELS + """ SELECT c_mktsegment, count(*) AS n, count(DISTINCT obs_id) AS points
  FROM pairs JOIN customer ON c_custkey = zone_id GROUP BY 1""",
    ),
    "zone_measures": (zone_measures, ZONE_MEASURES),
    "footprint_cells": (footprint_cells, FOOTPRINT),
    "footprint_overlap": (footprint_overlap, FOOTPRINT_OVERLAP),
    "scenes_by_zone": (scenes_by_zone, SCENES_BY_ZONE),
    "tile_xy": (tile_xy, TILE_XY),
    "tile_pyramid": (tile_pyramid, TILE_PYRAMID),
    "tile_top_k": (tile_top_k, TILE_TOP_K),
}
