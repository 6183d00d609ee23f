"""Zones over the antimeridian, connected regions, and distances between cells and zones."""

from __future__ import annotations

from pyspark.sql import functions as F

from swathe.functions.polygon import RINGS_TYPE
from swathe.operators import distance, overlay, regions, spatial, zonal
from workload.fixtures import OBS, PAIRS, ZONE_EDGES, observations, rounded, zones


def seam_zones(spark):
    """18 hexagons of radius 14 degrees around longitudes 170, 180 and -170, two of three over the seam."""
    x, y = "170D + (id % 3) * 10 + 14D * cos(2 * pi() * i / 6)", "-75D + floor(id / 3) * 30 + 14D * sin(2 * pi() * i / 6)"
    corner = f"transform(array({x}), x -> named_struct('x', CASE WHEN x > 180 THEN x - 360 ELSE x END, 'y', {y}))[0]"
    rings = F.expr(f"array(transform(sequence(0, 5), i -> {corner}))").cast(RINGS_TYPE)
    return spark.range(18).select(F.col("id").alias("zone_id"), rings.alias("rings"))


def _at(f: str, j: str) -> str:
    return f"14::DOUBLE * {f}(2 * pi() * {j} / 6)"


_X, _Y = "170::DOUBLE + (zid % 3) * 10", "-75::DOUBLE + (zid // 3) * 30"
# On a globe cut at longitude 0 instead, none of these zones is cut.
SEAM_PAIRS = f"""edges AS (SELECT zid AS zone_id, {_X} + {_at('cos', 'i')} AS x1, {_Y} + {_at('sin', 'i')} AS y1,
    {_X} + {_at('cos', '((i + 1) % 6)')} AS x2, {_Y} + {_at('sin', '((i + 1) % 6)')} AS y2 FROM range(18) z(zid), range(6) e(i)),
pairs AS (
  SELECT obs_id, zone_id FROM (SELECT obs_id, lat, CASE WHEN lon < 0 THEN lon + 360 ELSE lon END AS lon FROM obs), edges
  GROUP BY obs_id, zone_id HAVING sum(CASE WHEN (y1 > lat) <> (y2 > lat)
    AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1)"""


def spatial_join_seam(spark, sf):
    return spatial.spatial_join(observations(spark, sf), seam_zones(spark)).select("obs_id", "zone_id")


def zonal_stats_seam(spark, sf):
    got = zonal.zonal_stats(observations(spark, sf), seam_zones(spark), ("count", "mean", "stddev", "median"))
    return rounded(got, "mean", "stddev", "median")


ZONAL_SEAM = f"""WITH {OBS}, {SEAM_PAIRS} SELECT zone_id, count(*) AS count, round(avg(value), 6) AS mean,
  round(stddev_samp(value), 6) AS stddev, round(median(value), 6) AS median FROM pairs JOIN obs USING (obs_id) GROUP BY zone_id"""


def footprint_seam(spark, sf):
    """Observations on the footprint cells of each zone, on a grid of one degree."""
    cells = overlay.footprint_cells(seam_zones(spark), 1.0)
    seen = observations(spark, sf).select(F.expr("ix div 10").alias("ix"), F.expr("iy div 10").alias("iy"))
    return cells.join(seen, ["ix", "iy"]).groupBy("zone_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("ix", "iy").alias("cells")
    )


FOOTPRINT_SEAM = f"""WITH {OBS.replace("obs AS", "all_obs AS")}, obs AS (
  SELECT DISTINCT (iy // 10) * 360 + ix // 10 AS obs_id, ix // 10 - 179.5::DOUBLE AS lon, iy // 10 - 89.5::DOUBLE AS lat FROM all_obs),
{SEAM_PAIRS}
SELECT zone_id, count(*) AS n, count(DISTINCT p.obs_id) AS cells
FROM pairs p JOIN all_obs o ON p.obs_id = (iy // 10) * 360 + ix // 10 GROUP BY zone_id"""


def zonal_stats_nan(spark, sf):
    """NaN is missing."""
    rows = observations(spark, sf).withColumn("value", F.expr("CASE WHEN obs_id % 11 = 0 THEN double('NaN') WHEN obs_id % 13 = 0 THEN NULL ELSE value END"))
    got = zonal.zonal_stats(rows, seam_zones(spark), ("count", "mean", "min", "max", "stddev", "median"))
    return rounded(got, "mean", "stddev", "median")


ZONAL_NAN = f"""WITH {OBS}, {SEAM_PAIRS} SELECT zone_id, count(*) AS count, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max,
  round(stddev_samp(value), 6) AS stddev, round(median(value), 6) AS median
FROM pairs JOIN obs USING (obs_id) WHERE obs_id % 11 <> 0 AND obs_id % 13 <> 0 GROUP BY zone_id"""


def classed_cells(spark, sf, classes):
    """Cells of five degrees, classed by how often they were seen."""
    cells = observations(spark, sf).groupBy(F.expr("ix div 50").alias("ix"), F.expr("iy div 50").alias("iy"))
    return cells.agg((F.count(F.lit(1)) % classes).alias("class"))


def classed_sql(classes: int) -> str:
    return f"c AS (SELECT ix // 50 AS x, iy // 50 AS y, count(*) % {classes} AS class FROM obs GROUP BY 1, 2)"


def cell_regions(spark, sf):
    return regions.cell_regions(classed_cells(spark, sf, 2), columns=72)


CELL_REGIONS = f"""WITH RECURSIVE {OBS}, {classed_sql(2)}, touch AS (
  SELECT a.y * 72 + a.x AS a, b.y * 72 + b.x AS b FROM c a JOIN c b ON a.class = b.class AND (
    (a.y = b.y AND ((a.x + 1) % 72 = b.x OR (b.x + 1) % 72 = a.x)) OR (a.x = b.x AND abs(a.y - b.y) = 1))),
reach AS (SELECT y * 72 + x AS a, y * 72 + x AS b FROM c UNION SELECT r.a, t.b FROM reach r JOIN touch t ON r.b = t.a),
root AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
SELECT (root % 72)::BIGINT AS region_ix, (root // 72)::BIGINT AS region_iy, any_value(class) AS class, count(*) AS cells,
  min(x)::BIGINT AS west, min(y)::BIGINT AS south, max(x)::BIGINT AS east, max(y)::BIGINT AS north
FROM c JOIN root ON a = y * 72 + x GROUP BY root"""


def region_cells(spark, sf):
    return regions.region_cells(classed_cells(spark, sf, 2), connectivity=8)


REGION_CELLS = f"""WITH RECURSIVE {OBS}, {classed_sql(2)}, touch AS (
  SELECT a.y * 72 + a.x AS a, b.y * 72 + b.x AS b FROM c a JOIN c b ON a.class = b.class AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1),
reach AS (SELECT y * 72 + x AS a, y * 72 + x AS b FROM c UNION SELECT r.a, t.b FROM reach r JOIN touch t ON r.b = t.a),
root AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
SELECT x::BIGINT AS ix, y::BIGINT AS iy, class, (root % 72)::BIGINT AS region_ix, (root // 72)::BIGINT AS region_iy,
  count(*) OVER (PARTITION BY root) AS cells FROM c JOIN root ON a = y * 72 + x"""


def class_distance(spark, sf):
    return rounded(distance.class_distance(classed_cells(spark, sf, 7), 0, columns=72), "dist")


CLASS_DISTANCE = f"""WITH {OBS}, {classed_sql(7)}, d AS (
  SELECT a.x, a.y, min(pow(least(abs(a.x - b.x), 72 - abs(a.x - b.x)), 2) + pow(a.y - b.y, 2)) AS d
  FROM c a, c b WHERE b.class = 0 GROUP BY 1, 2)
SELECT c.x::BIGINT AS ix, c.y::BIGINT AS iy, d::BIGINT AS dist2, round(sqrt(d), 6) AS dist FROM c LEFT JOIN d USING (x, y)"""

def spatial_join_levels(spark, sf):
    """Cells of half a degree on the outlines, and up to 16 degrees inside."""
    return spatial.spatial_join(observations(spark, sf), zones(spark), cell_deg=0.5, levels=5).select("obs_id", "zone_id")


QUERIES = {
    "spatial_join_levels": (spatial_join_levels, f"WITH {OBS}, {ZONE_EDGES}, {PAIRS} SELECT obs_id, zone_id FROM pairs"),
    "spatial_join_seam": (spatial_join_seam, f"WITH {OBS}, {SEAM_PAIRS} SELECT obs_id, zone_id FROM pairs"),
    "zonal_stats_seam": (zonal_stats_seam, ZONAL_SEAM),
    "zonal_stats_nan": (zonal_stats_nan, ZONAL_NAN),
    "footprint_seam": (footprint_seam, FOOTPRINT_SEAM),
    "cell_regions": (cell_regions, CELL_REGIONS),
    "region_cells": (region_cells, REGION_CELLS),
    "class_distance": (class_distance, CLASS_DISTANCE),
}
