"""Earth-observation tables derived from the given ones, by arithmetic only,
written once for Spark and once as SQL."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swathe.functions.polygon import RINGS_TYPE


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """One row per event, at the centre of a 0.1-degree cell."""
    return table(spark, sf, "events").selectExpr(
        "event_id AS obs_id", "ts AS obs_ts", "user_id AS station_id", "event_type AS band",
        "value",
        "cast((event_id * 7919) % 3600 AS int) AS ix",
        "cast((event_id * 104729) % 1800 AS int) AS iy",
        "-179.95D + ((event_id * 7919) % 3600) * 0.1D AS lon",
        "-89.95D + ((event_id * 104729) % 1800) * 0.1D AS lat",
        "cast(event_id % 1024 AS int) AS qa", "props",
    )


OBS = """obs AS (
  SELECT event_id AS obs_id, ts AS obs_ts, user_id AS station_id, event_type AS band, value,
    CAST((event_id * 7919) % 3600 AS INT) AS ix,
    CAST((event_id * 104729) % 1800 AS INT) AS iy,
    -179.95::DOUBLE + ((event_id * 7919) % 3600) * 0.1::DOUBLE AS lon,
    -89.95::DOUBLE + ((event_id * 104729) % 1800) * 0.1::DOUBLE AS lat,
    CAST(event_id % 1024 AS INT) AS qa, props
  FROM events)"""


def _hexagon(x: str, y: str, radius: str) -> Column:
    corner = (
        f"named_struct('x', {x} + ({radius}) * cos(2 * pi() * i / 6),"
        f" 'y', {y} + ({radius}) * sin(2 * pi() * i / 6))"
    )
    return F.expr(f"array(transform(sequence(0, 5), i -> {corner}))").cast(RINGS_TYPE)


def _hexagon_edges(key: str, x: str, y: str, radius: str, source: str) -> str:
    at = lambda f, j: f"({radius}) * {f}(2 * pi() * {j} / 6)"
    return (
        f"SELECT {key} AS zone_id, i, {x} + {at('cos', 'i')} AS x1, {y} + {at('sin', 'i')} AS y1,"
        f" {x} + {at('cos', '((i + 1) % 6)')} AS x2, {y} + {at('sin', '((i + 1) % 6)')} AS y2"
        f" FROM {source}, range(6) e(i)"
    )


def zones(spark: SparkSession) -> DataFrame:
    """72 hexagons of radius 14 degrees, one per 30-degree block."""
    return spark.range(72).select(
        F.col("id").alias("zone_id"),
        _hexagon("-165D + (id % 12) * 30", "-75D + floor(id / 12) * 30", "14D").alias("rings"),
    )


ZONE_EDGES = "edges AS (" + _hexagon_edges(
    "zid", "-165::DOUBLE + (zid % 12) * 30", "-75::DOUBLE + (zid // 12) * 30", "14::DOUBLE",
    "range(72) z(zid)",
) + ")"


def parcels(spark: SparkSession, sf: str) -> DataFrame:
    """One hexagon per customer, 1 to 4 degrees in radius, overlapping."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("zone_id"),
        _hexagon(
            "-170D + ((c_custkey * 7919) % 3400) * 0.1D",
            "-80D + ((c_custkey * 104729) % 1600) * 0.1D",
            "1D + (c_custkey % 7) * 0.5D",
        ).alias("rings"),
        "c_mktsegment",
    )


PARCEL_EDGES = "edges AS (" + _hexagon_edges(
    "c_custkey", "-170::DOUBLE + ((c_custkey * 7919) % 3400) * 0.1::DOUBLE",
    "-80::DOUBLE + ((c_custkey * 104729) % 1600) * 0.1::DOUBLE",
    "1::DOUBLE + (c_custkey % 7) * 0.5::DOUBLE", "customer",
) + ")"

# Even-odd rule over all edges of every zone.
PAIRS = """pairs AS (
  SELECT obs_id, zone_id FROM obs, edges GROUP BY obs_id, zone_id
  HAVING sum(CASE WHEN (y1 > lat) <> (y2 > lat)
    AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1)"""


def scenes(spark: SparkSession, sf: str) -> DataFrame:
    """One two-degree scene per order."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS scene_id", "o_orderstatus AS product", "o_orderdate AS acq_ts",
        "-180D + ((o_orderkey * 7919) % 358) * 1.0D AS west",
        "-90D + ((o_orderkey * 104729) % 178) * 1.0D AS south",
        "cast((o_orderkey * 31) % 101 AS double) AS cloud",
    ).withColumns({"east": F.expr("west + 2.0D"), "north": F.expr("south + 2.0D")})


SCENES = """scenes AS (
  SELECT *, west + 2.0::DOUBLE AS east, south + 2.0::DOUBLE AS north FROM (
    SELECT o_orderkey AS scene_id, o_orderstatus AS product, o_orderdate AS acq_ts,
      -180::DOUBLE + ((o_orderkey * 7919) % 358) * 1.0::DOUBLE AS west,
      -90::DOUBLE + ((o_orderkey * 104729) % 178) * 1.0::DOUBLE AS south,
      CAST((o_orderkey * 31) % 101 AS DOUBLE) AS cloud
    FROM orders))"""


def stations(spark: SparkSession, sf: str, name: str = "customer", key: str = "c_custkey") -> DataFrame:
    """One position per row of a table, off the cell centres."""
    return table(spark, sf, name).selectExpr(
        f"{key} AS station",
        f"-179.97D + (({key} * 7907) % 3599) * 0.1D AS lon",
        f"-89.92D + (({key} * 104723) % 1798) * 0.1D AS lat",
    )


def stations_sql(name: str = "customer", key: str = "c_custkey") -> str:
    return (
        f"stations AS (SELECT {key} AS station,"
        f" -179.97::DOUBLE + (({key} * 7907) % 3599) * 0.1::DOUBLE AS lon,"
        f" -89.92::DOUBLE + (({key} * 104723) % 1798) * 0.1::DOUBLE AS lat FROM {name})"
    )


def haversine_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    dlat = f"radians({lat2} - {lat1}) / 2"
    dlon = f"radians({lon2} - {lon1}) / 2"
    return (
        f"2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin({dlat}), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin({dlon}), 2))))"
    )


def cell_area_sql(lat: str, res: float) -> str:
    width = 6371.0088**2 * math.radians(res)
    return f"{width!r}::DOUBLE * (sin(radians({lat} + {res / 2})) - sin(radians({lat} - {res / 2})))"


def tile_sql(lon: str, lat: str, z: int) -> tuple[str, str]:
    n = 2**z
    x = f"CAST(floor(({lon} + 180.0::DOUBLE) / 360.0::DOUBLE * {n}) AS INT)"
    merc = f"ln(tan(radians({lat})) + 1.0 / cos(radians({lat}))) / pi()"
    y = f"CAST(floor((1.0::DOUBLE - {merc}) / 2.0::DOUBLE * {n}) AS INT)"
    clamp = lambda c: f"least(greatest({c}, 0), {n - 1})"
    return clamp(x), clamp(y)


def rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    """Sums and trigonometry may differ in the last bits between engines."""
    return df.withColumns({c: F.round(c, places) for c in cols})
