"""Sources, filters, projections and grid aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from swathe.functions.grid import attribute, cell_xy, frame_label
from swathe.operators import bands, composite, filters, overlay, raster
from swathe.plans.quantiles import exact_quantiles
from swathe.session import scratch_path
from swathe.sources import cells as cell_io
from swathe.sources import features, scenes, tables
from workload.fixtures import (
    OBS, SCENES, observations, parcels, rounded, table,
)
from workload.fixtures import scenes as scene_table

KEYS = ["ix", "iy"]


def scan_cells(spark, sf):
    path = scratch_path(spark, "cells")
    cell_io.write_cells(observations(spark, sf), path)
    got = cell_io.scan_cells(
        spark, path, ["click", "view"], "2024-01-05", "2024-01-20", (-100, -40, 100, 40)
    )
    return got.select("obs_id", "obs_ts", "band", "value", "ix", "iy")


SCAN_CELLS = f"""WITH {OBS} SELECT obs_id, obs_ts, band, value, ix, iy FROM obs
WHERE band IN ('click', 'view') AND obs_ts >= TIMESTAMP '2024-01-05'
  AND obs_ts < TIMESTAMP '2024-01-20' AND lon BETWEEN -100 AND 100 AND lat BETWEEN -40 AND 40"""


def search_scenes(spark, sf):
    return scenes.search_scenes(
        scene_table(spark, sf), (-30, -20, 60, 50), "1996-01-01", "2000-01-01", 40.0, ["F", "O"]
    )


SEARCH_SCENES = f"""WITH {SCENES} SELECT scene_id, product, acq_ts, west, south, cloud, east, north
FROM scenes WHERE west <= 60 AND east >= -30 AND south <= 50 AND north >= -20
  AND acq_ts >= TIMESTAMP '1996-01-01' AND acq_ts < TIMESTAMP '2000-01-01'
  AND cloud <= 40 AND product IN ('F', 'O')"""


def search_scenes_antimeridian(spark, sf):
    return scenes.search_scenes(scene_table(spark, sf), (170, -20, -160, 20)).select("scene_id", "west")


SEARCH_SCENES_ANTIMERIDIAN = f"""WITH {SCENES} SELECT scene_id, west FROM scenes
WHERE (west <= -160 OR east >= 170) AND south <= 20 AND north >= -20"""


def search_scenes_wrapped(spark, sf):
    """Scenes six degrees wide, some of them over the antimeridian."""
    east = F.when(F.col("west") + 6 > 180, F.col("west") - 354).otherwise(F.col("west") + 6)
    wide = scene_table(spark, sf).withColumn("east", east)
    return scenes.search_scenes(wide, (177.5, -60, 179.5, 60)).select("scene_id", "west", "east")


SEARCH_SCENES_WRAPPED = f"""WITH {SCENES} SELECT scene_id, west,
  CASE WHEN west + 6 > 180 THEN west - 354 ELSE west + 6 END AS east FROM scenes
WHERE west <= 179.5 AND west + 6 >= 177.5 AND south <= 60 AND north >= -60"""


def scan_features(spark, sf):
    path = scratch_path(spark, "features")
    features.write_features(parcels(spark, sf), path, props=("c_mktsegment",))
    got = features.scan_features(spark, path)
    return got.select(
        F.col("id").cast("bigint").alias("zone_id"), "kind",
        F.size(F.get("rings", 0)).alias("vertices"),
        F.round(F.get(F.get("rings", 0), 1)["x"], 6).alias("second_x"),
        attribute("props", "c_mktsegment").alias("segment"),
    )


SCAN_FEATURES = """SELECT c_custkey AS zone_id, 'Polygon' AS kind, 7 AS vertices,
  round(-170::DOUBLE + ((c_custkey * 7919) % 3400) * 0.1::DOUBLE
    + (1::DOUBLE + (c_custkey % 7) * 0.5::DOUBLE) * cos(2 * pi() * 1 / 6), 6) AS second_x,
  c_mktsegment AS segment FROM customer"""

def scan_features_kinds(spark, sf):
    """One feature per customer, of a kind that goes by its key; a collection is a point and a line."""
    path = scratch_path(spark, "kinds")
    pair = "concat('[', c_custkey % 360 - 180, ',', c_nationkey, ']')"
    line = f"concat('[', {pair}, ',[0,1]]')"
    kinds = {
        "Point": pair, "MultiPoint": line, "LineString": line, "MultiLineString": f"concat('[', {line}, ',', {line}, ']')",
    }
    single = {k: f"concat('{{\"type\":\"{k}\",\"coordinates\":', {v}, '}}')" for k, v in kinds.items()}
    both = f"concat('{{\"type\":\"GeometryCollection\",\"geometries\":[', {single['Point']}, ',', {single['LineString']}, ']}}')"
    cases = " ".join(f"WHEN {i} THEN {g}" for i, g in enumerate([*single.values(), both]))
    feature = f"concat('{{\"type\":\"Feature\",\"id\":\"', c_custkey, '\",\"geometry\":', CASE c_custkey % 5 {cases} END, ',\"properties\":{{}}}}')"
    table(spark, sf, "customer").select(F.expr(feature).alias("value")).write.text(path)
    got = features.scan_features(spark, path)
    return got.select(
        F.col("id").cast("bigint").alias("id"), "kind", "lon",
        F.get("points", 0)["x"].alias("point_x"), F.size(F.coalesce("lines", F.array())).alias("n_lines"),
        F.get(F.get("lines", 0), 1)["y"].alias("line_y"),
    )


SCAN_FEATURES_KINDS = """WITH k AS (SELECT c_custkey AS id, (c_custkey % 360 - 180)::DOUBLE AS x,
    unnest(CASE c_custkey % 5 WHEN 0 THEN ['Point'] WHEN 1 THEN ['MultiPoint'] WHEN 2 THEN ['LineString']
      WHEN 3 THEN ['MultiLineString'] ELSE ['Point', 'LineString'] END) AS kind FROM customer)
SELECT id, kind, CASE WHEN kind = 'Point' THEN x END AS lon, CASE WHEN kind = 'MultiPoint' THEN x END AS point_x,
  CASE kind WHEN 'LineString' THEN 1 WHEN 'MultiLineString' THEN 2 ELSE 0 END AS n_lines,
  CASE WHEN kind LIKE '%LineString' THEN 1.0::DOUBLE END AS line_y FROM k"""


CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


def _round_trip(fmt):
    def query(spark, sf):
        path = scratch_path(spark, fmt)
        tables.write_table(table(spark, sf, "customer"), path, fmt)
        return tables.scan_table(spark, path, fmt, CUSTOMER)

    return query


ROUND_TRIP = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def bbox_filter(spark, sf):
    return filters.bbox_filter(observations(spark, sf), -60, -30, 45, 60).select("obs_id", "lon", "lat")


BBOX = f"""WITH {OBS} SELECT obs_id, lon, lat FROM obs
WHERE lon BETWEEN -60 AND 45 AND lat BETWEEN -30 AND 60"""


def time_filter(spark, sf):
    got = filters.time_filter(observations(spark, sf), "2024-01-10", "2024-01-12 06:00:00")
    return got.select("obs_id", "obs_ts")


TIME = f"""WITH {OBS} SELECT obs_id, obs_ts FROM obs
WHERE obs_ts >= TIMESTAMP '2024-01-10' AND obs_ts < TIMESTAMP '2024-01-12 06:00:00'"""


def qa_mask(spark, sf):
    got = filters.qa_mask(observations(spark, sf), 3, 2, [0, 2])
    return got.select("obs_id", "qa", filters.qa_bits("qa", 3, 2).alias("flag"))


QA = f"""WITH {OBS} SELECT obs_id, qa, CAST((qa >> 3) & 3 AS INT) AS flag FROM obs
WHERE ((qa >> 3) & 3) IN (0, 2)"""


def rescale(spark, sf):
    raw = observations(spark, sf).withColumn("dn", F.expr("cast(floor(value) as int) % 50"))
    return filters.rescale(raw, 0.0001, -0.2, nodata=0, value="dn", out="reflectance").select(
        "obs_id", F.round("reflectance", 9).alias("reflectance")
    )


RESCALE = f"""WITH {OBS} SELECT obs_id, round(CAST(nullif(CAST(floor(value) AS INT) % 50, 0) AS DOUBLE)
  * 0.0001::DOUBLE + -0.2::DOUBLE, 9) AS reflectance FROM obs"""


def _by_day(spark, sf):
    return observations(spark, sf).withColumn("day", F.to_date("obs_ts"))


def bands_to_columns(spark, sf):
    wide = bands.bands_to_columns(_by_day(spark, sf), ["click", "view", "error"], ["station_id", "day"])
    return rounded(wide, "click", "view", "error")


WIDE = f"""WITH {OBS}, wide AS (SELECT station_id, CAST(obs_ts AS DATE) AS day,
  avg(value) FILTER (band = 'click') AS click, avg(value) FILTER (band = 'view') AS view,
  avg(value) FILTER (band = 'error') AS error
  FROM obs WHERE band IN ('click', 'view', 'error') GROUP BY 1, 2)"""
BANDS_TO_COLUMNS = WIDE + """ SELECT station_id, day, round(click, 6) AS click, round(view, 6) AS view,
  round(error, 6) AS error FROM wide"""


def columns_to_bands(spark, sf):
    wide = bands.bands_to_columns(_by_day(spark, sf), ["click", "view", "error"], ["station_id", "day"])
    return rounded(
        bands.columns_to_bands(wide, ["click", "view", "error"], ["station_id", "day"]), "value"
    )


COLUMNS_TO_BANDS = f"""WITH {OBS} SELECT station_id, CAST(obs_ts AS DATE) AS day, band,
  round(avg(value), 6) AS value FROM obs WHERE band IN ('click', 'view', 'error') GROUP BY 1, 2, 3"""


def normalized_difference(spark, sf):
    wide = bands.bands_to_columns(_by_day(spark, sf), ["click", "view"], ["station_id", "day"])
    nd = bands.normalized_difference(wide, "click", "view")
    return rounded(nd.select("station_id", "day", "nd"), "nd")


NORMALIZED_DIFFERENCE = f"""WITH {OBS}, wide AS (SELECT station_id, CAST(obs_ts AS DATE) AS day,
  avg(value) FILTER (band = 'click') AS a, avg(value) FILTER (band = 'view') AS b
  FROM obs WHERE band IN ('click', 'view') GROUP BY 1, 2)
SELECT station_id, day, round((a - b) / nullif(a + b, 0), 6) AS nd FROM wide"""


def band_math(spark, sf):
    wide = bands.bands_to_columns(
        _by_day(spark, sf), ["click", "view", "error"], ["station_id", "day"]
    )
    got = bands.band_math(wide, "2.5D * (click - view) / (click + 6D * view + 7.5D * error + 1D)")
    return rounded(got.select("station_id", "day", "result"), "result")


BAND_MATH = WIDE + """ SELECT station_id, day,
  round(2.5 * (click - view) / (click + 6 * view + 7.5 * error + 1), 6) AS result FROM wide"""


def reclassify(spark, sf):
    return filters.reclassify(observations(spark, sf), [10, 50, 100, 200]).select("obs_id", "class")


CLASS = """CASE WHEN value >= 200 THEN 4 WHEN value >= 100 THEN 3 WHEN value >= 50 THEN 2
  WHEN value >= 10 THEN 1 ELSE 0 END"""
RECLASSIFY = f"WITH {OBS} SELECT obs_id, CAST({CLASS} AS INT) AS class FROM obs"


def reclassify_open_ended(spark, sf):
    """The outer classes have no end."""
    ends = [float("-inf"), 10.0, 50.0, 200.0, float("inf")]
    lookup = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(zip(ends, ends[1:]))], "class int, lower double, upper double")
    return filters.reclassify_by_table(observations(spark, sf), lookup, 0.001).select("obs_id", "value", "class")


RECLASSIFY_OPEN_ENDED = f"""WITH {OBS} SELECT obs_id, value,
  CASE WHEN value < 10 THEN 0 WHEN value < 50 THEN 1 WHEN value < 200 THEN 2 ELSE 3 END AS class FROM obs"""


def reclassify_by_table(spark, sf):
    # Price bands of the parts are the ranges: [0.1 k, 0.1 k + 0.05) in value.
    lookup = table(spark, sf, "part").selectExpr(
        "p_partkey AS class_id", "p_partkey * 0.1D AS lower", "p_partkey * 0.1D + 0.05D AS upper"
    )
    return filters.reclassify_by_table(observations(spark, sf), lookup, 5.0).select("obs_id", "class_id")


RECLASSIFY_BY_TABLE = f"""WITH {OBS}, lookup AS (SELECT p_partkey AS class_id,
  p_partkey * 0.1::DOUBLE AS lower, p_partkey * 0.1::DOUBLE + 0.05::DOUBLE AS upper FROM part)
SELECT obs_id, class_id FROM obs LEFT JOIN lookup ON value >= lower AND value < upper"""


def regrid(spark, sf):
    return rounded(raster.regrid(observations(spark, sf), 5.0), "value")


REGRID_CELL = """CAST(floor((lon + 180.0::DOUBLE) / 5.0::DOUBLE) AS INT) AS cx,
  CAST(floor((lat + 90.0::DOUBLE) / 5.0::DOUBLE) AS INT) AS cy"""
REGRID = f"""WITH {OBS} SELECT {REGRID_CELL}, band, round(avg(value), 6) AS value
FROM obs GROUP BY 1, 2, 3"""


def regrid_median(spark, sf):
    return rounded(raster.regrid(observations(spark, sf), 5.0, "median"), "value")


REGRID_MEDIAN = f"""WITH {OBS} SELECT {REGRID_CELL}, band, round(median(value), 6) AS value
FROM obs GROUP BY 1, 2, 3"""


def refine_grid(spark, sf):
    return raster.refine_grid(observations(spark, sf).select("obs_id", "ix", "iy"), 2)


REFINE = f"""WITH {OBS} SELECT obs_id, CAST(ix * 2 + dx AS INT) AS ix, CAST(iy * 2 + dy AS INT) AS iy
FROM obs, range(2) a(dx), range(2) b(dy)"""


def temporal_composite(stat, period):
    def query(spark, sf):
        got = composite.temporal_composite(observations(spark, sf), ["band", "iy"], period, stat)
        return rounded(got, "value")

    return query


def _composite_sql(agg, start):
    return f"""WITH {OBS} SELECT band, iy, CAST({start} AS TIMESTAMP) AS period_start,
  round({agg}, 6) AS value FROM obs GROUP BY 1, 2, 3"""


EIGHT_DAYS = "make_timestamp((epoch_us(obs_ts) // (8 * 86400000000)) * (8 * 86400000000))"


def best_pixel(spark, sf):
    got = composite.best_pixel(observations(spark, sf), ["ix", "iy"], "value")
    return got.select("ix", "iy", "obs_id", "obs_ts", "band", "value")


BEST_PIXEL = f"""WITH {OBS} SELECT ix, iy, obs_id, obs_ts, band, value FROM obs
QUALIFY row_number() OVER (PARTITION BY ix, iy ORDER BY value DESC, obs_id DESC) = 1"""


def mosaic(spark, sf):
    obs = filters.qa_mask(observations(spark, sf), 0, 1, [0])
    return composite.mosaic(obs, ["ix", "iy"]).select("ix", "iy", "obs_id", "obs_ts", "value")


MOSAIC = f"""WITH {OBS} SELECT ix, iy, obs_id, obs_ts, value FROM obs WHERE (qa & 1) = 0
QUALIFY row_number() OVER (PARTITION BY ix, iy ORDER BY obs_ts DESC, obs_id DESC) = 1"""


def band_stats(spark, sf):
    got = raster.band_stats(observations(spark, sf))
    return rounded(got, "mean", "stddev", "p25", "p50", "p75")


BAND_STATS = f"""WITH {OBS} SELECT band, count(value) AS n, min(value) AS min, max(value) AS max,
  round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stddev,
  round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
  round(quantile_cont(value, 0.75), 6) AS p75 FROM obs GROUP BY band"""


def band_stats_split(spark, sf):
    """The same with every band cut into value ranges, as a huge band is."""
    got = raster.band_stats(observations(spark, sf), group_limit=100)
    return rounded(got, "mean", "stddev", "p25", "p50", "p75")


def band_stats_approx(spark, sf):
    """Sketched percentiles lie between the exact ones 0.01 to either side."""
    obs = observations(spark, sf)
    got = raster.band_stats(obs, probs={"p50": 0.5}, approx=True)
    near = exact_quantiles(obs, ["band"], "value", {"lo": 0.49, "hi": 0.51})
    return got.join(near, "band").select("band", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), F.col("p50").between(F.col("lo"), F.col("hi")).alias("near"))


BAND_STATS_APPROX = f"""WITH {OBS} SELECT band, round(quantile_cont(value, 0.49), 6) AS lo,
  round(quantile_cont(value, 0.51), 6) AS hi, true AS near FROM obs GROUP BY band"""


def nan_is_missing(spark, sf):
    """Values of low quality are NaN, which no bin counts."""
    value = F.when(F.col("qa") % 4 == 0, float("nan")).otherwise(F.col("value"))
    return raster.histogram(observations(spark, sf).withColumn("value", value), 12.5)


NAN_IS_MISSING = f"""WITH {OBS} SELECT band, CAST(floor(value / 12.5::DOUBLE) AS BIGINT) AS bin, count(*) AS n,
  CAST(floor(value / 12.5::DOUBLE) AS BIGINT) * 12.5::DOUBLE AS bin_start FROM obs WHERE qa % 4 <> 0 GROUP BY 1, 2, 4"""


def histogram(spark, sf):
    return raster.histogram(observations(spark, sf), 12.5)


HISTOGRAM = f"""WITH {OBS} SELECT band, CAST(floor(value / 12.5::DOUBLE) AS BIGINT) AS bin, count(*) AS n,
  CAST(floor(value / 12.5::DOUBLE) AS BIGINT) * 12.5::DOUBLE AS bin_start FROM obs GROUP BY 1, 2, 4"""


def focal(stat):
    def query(spark, sf):
        coarse = observations(spark, sf).withColumns(dict(zip(KEYS, cell_xy("lon", "lat", 2.0))))
        return rounded(raster.focal(coarse, 2, stat), "focal", places=9)

    return query


def _focal_sql(agg):
    return f"""WITH {OBS}, c AS (SELECT band, CAST(floor((lon + 180.0::DOUBLE) / 2.0::DOUBLE) AS INT) AS ix,
    CAST(floor((lat + 90.0::DOUBLE) / 2.0::DOUBLE) AS INT) AS iy,
    sum(value) AS s, count(*) AS n, max(value) AS hi FROM obs GROUP BY 1, 2, 3)
SELECT a.ix, a.iy, a.band, round({agg}, 9) AS focal FROM c a JOIN c b
  ON a.band = b.band AND b.ix BETWEEN a.ix - 2 AND a.ix + 2 AND b.iy BETWEEN a.iy - 2 AND a.iy + 2
GROUP BY 1, 2, 3"""


def cell_overlay(op):
    def query(spark, sf):
        obs = observations(spark, sf)
        click = F.col("band") == "click"
        side = lambda rows: obs.where(rows).select(
            *[c.alias(k) for k, c in zip(KEYS, cell_xy("lon", "lat", 4.0))]
        )
        return overlay.cell_overlay(side(click), side(~click), op)

    return query


def _overlay_sql(query):
    return f"""WITH {OBS}, c AS (SELECT DISTINCT band,
    CAST(floor((lon + 180.0::DOUBLE) / 4.0::DOUBLE) AS INT) AS ix,
    CAST(floor((lat + 90.0::DOUBLE) / 4.0::DOUBLE) AS INT) AS iy FROM obs),
  a AS (SELECT ix, iy FROM c WHERE band = 'click'), b AS (SELECT DISTINCT ix, iy FROM c WHERE band <> 'click')
{query}"""


def stack(spark, sf):
    obs = observations(spark, sf)
    a = obs.where("band = 'click'").select("obs_id", "value")
    b = obs.where("band <> 'click'").select("obs_id", "qa")
    return overlay.stack([a, b])


STACK = f"""WITH {OBS} SELECT obs_id, value, CAST(NULL AS INT) AS qa FROM obs WHERE band = 'click'
UNION ALL SELECT obs_id, CAST(NULL AS DOUBLE), qa FROM obs WHERE band <> 'click'"""


def column_helpers(spark, sf):
    ix, iy = cell_xy("lon", "lat", 0.5)
    return observations(spark, sf).select(
        "obs_id", ix.alias("cx"), iy.alias("cy"),
        frame_label("obs_ts").alias("label"), attribute("props", "k", "int").alias("k"),
    )


COLUMN_HELPERS = f"""WITH {OBS} SELECT obs_id,
  CAST(floor((lon + 180.0::DOUBLE) / 0.5::DOUBLE) AS INT) AS cx,
  CAST(floor((lat + 90.0::DOUBLE) / 0.5::DOUBLE) AS INT) AS cy,
  strftime(obs_ts, '%Y-%m-%d %H:%M') AS label,
  CAST(json_extract_string(props, '$.k') AS INT) AS k FROM obs"""

QUERIES = {
    "scan_cells": (scan_cells, SCAN_CELLS),
    "search_scenes": (search_scenes, SEARCH_SCENES),
    "search_scenes_antimeridian": (search_scenes_antimeridian, SEARCH_SCENES_ANTIMERIDIAN),
    "search_scenes_wrapped": (search_scenes_wrapped, SEARCH_SCENES_WRAPPED),
    "scan_features": (scan_features, SCAN_FEATURES),
    "scan_features_kinds": (scan_features_kinds, SCAN_FEATURES_KINDS),
    "scan_table_csv": (_round_trip("csv"), ROUND_TRIP),
    "scan_table_json": (_round_trip("json"), ROUND_TRIP),
    "scan_table_parquet": (_round_trip("parquet"), ROUND_TRIP),
    "scan_table_orc": (_round_trip("orc"), ROUND_TRIP),
    "bbox_filter": (bbox_filter, BBOX),
    "time_filter": (time_filter, TIME),
    "qa_mask": (qa_mask, QA),
    "rescale": (rescale, RESCALE),
    "bands_to_columns": (bands_to_columns, BANDS_TO_COLUMNS),
    "columns_to_bands": (columns_to_bands, COLUMNS_TO_BANDS),
    "normalized_difference": (normalized_difference, NORMALIZED_DIFFERENCE),
    "band_math": (band_math, BAND_MATH),
    "reclassify": (reclassify, RECLASSIFY),
    "reclassify_open_ended": (reclassify_open_ended, RECLASSIFY_OPEN_ENDED),
    "reclassify_by_table": (reclassify_by_table, RECLASSIFY_BY_TABLE),
    "regrid": (regrid, REGRID),
    "regrid_median": (regrid_median, REGRID_MEDIAN),
    "refine_grid": (refine_grid, REFINE),
    "composite_median_day": (
        temporal_composite("median", "day"), _composite_sql("median(value)", "date_trunc('day', obs_ts)")
    ),
    "composite_mean_month": (
        temporal_composite("mean", "month"), _composite_sql("avg(value)", "date_trunc('month', obs_ts)")
    ),
    "composite_max_8_days": (
        temporal_composite("max", "8 days"), _composite_sql("max(value)", EIGHT_DAYS)
    ),
    "best_pixel": (best_pixel, BEST_PIXEL),
    "mosaic": (mosaic, MOSAIC),
    "band_stats": (band_stats, BAND_STATS),
    "band_stats_split": (band_stats_split, BAND_STATS),
    "band_stats_approx": (band_stats_approx, BAND_STATS_APPROX),
    "nan_is_missing": (nan_is_missing, NAN_IS_MISSING),
    "histogram": (histogram, HISTOGRAM),
    "focal_mean": (focal("mean"), _focal_sql("sum(b.s) / sum(b.n)")),
    "focal_max": (focal("max"), _focal_sql("max(b.hi)")),
    "cell_overlay_union": (
        cell_overlay("union"), _overlay_sql("SELECT * FROM a UNION SELECT * FROM b")
    ),
    "cell_overlay_intersection": (
        cell_overlay("intersection"), _overlay_sql("SELECT * FROM a INTERSECT SELECT * FROM b")
    ),
    "cell_overlay_difference": (
        cell_overlay("difference"), _overlay_sql("SELECT * FROM a EXCEPT SELECT * FROM b")
    ),
    "cell_overlay_symmetric_difference": (
        cell_overlay("symmetric_difference"),
        _overlay_sql(
            "(SELECT * FROM a EXCEPT SELECT * FROM b) UNION (SELECT * FROM b EXCEPT SELECT * FROM a)"
        ),
    ),
    "stack": (stack, STACK),
    "column_helpers": (column_helpers, COLUMN_HELPERS),
}
