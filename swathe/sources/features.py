"""GeoJSON features as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MEMBER = "type: STRING, coordinates: STRING"
_FEATURE = f"id STRING, geometry STRUCT<{_MEMBER}, geometries: ARRAY<STRUCT<{_MEMBER}>>>, properties STRING"


def scan_features(
    spark: SparkSession, path: str, schema: str = _FEATURE, lines: bool = True
) -> DataFrame:
    """One row per feature: ``id, kind, lon, lat, rings, points, lines, props``.

    ``lines`` reads one feature per line, which splits inside a file and is
    the form for large data. Without it a file is one FeatureCollection and is
    read by one task. Points fill ``lon, lat``; polygons and multipolygons
    fill ``rings``, multipoints ``points``, lines and multilines ``lines``. A
    geometry collection gives a row for each member, one of nulls if it has
    none; collections inside it stay empty. ``props`` is the attributes as JSON text for ``attribute``.
    """
    if lines:
        rows = spark.read.schema(schema).json(path)
    else:
        collection = f"features ARRAY<STRUCT<{schema}>>"
        rows = (
            spark.read.schema(collection).json(path, multiLine=True)
            .select(F.inline("features"))
        )
    if "geometries" in rows.schema["geometry"].dataType.fieldNames():
        own = F.struct(F.col("geometry.type").alias("type"), F.col("geometry.coordinates").alias("coordinates"))
        members = F.when(F.col("geometry.type") == "GeometryCollection", F.col("geometry.geometries")).otherwise(F.array(own))
        rows = rows.withColumn("geometry", F.explode_outer(members))
    text = F.col("geometry.coordinates")
    kind = F.col("geometry.type")
    point = F.when(kind == "Point", F.from_json(text, "array<double>"))
    polygon = F.when(kind == "Polygon", F.from_json(text, "array<array<array<double>>>"))
    parts = F.when(
        kind == "MultiPolygon", F.from_json(text, "array<array<array<array<double>>>>")
    )
    rings = F.coalesce(polygon, F.flatten(parts))
    line = F.when(kind == "LineString", F.array(F.from_json(text, "array<array<double>>")))
    lines = F.coalesce(line, F.when(kind == "MultiLineString", F.from_json(text, "array<array<array<double>>>")))
    points = F.when(kind == "MultiPoint", F.from_json(text, "array<array<double>>"))

    def as_xy(path):
        return F.transform(path, lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y")))
    return rows.select(
        "id", kind.alias("kind"),
        F.get(point, 0).alias("lon"), F.get(point, 1).alias("lat"),
        F.transform(rings, as_xy).alias("rings"), as_xy(points).alias("points"),
        F.transform(lines, as_xy).alias("lines"), F.col("properties").alias("props"),
    )


def write_features(
    df: DataFrame, path: str, id_col: str = "zone_id", rings: str = "rings",
    props: tuple[str, ...] = (), mode: str = "errorifexists",
) -> None:
    """Polygons as GeoJSON, one feature per line. Rings are closed if open."""
    pair = lambda p: F.array(p.x, p.y)
    closed = lambda r: F.when(
        F.element_at(r, 1) == F.element_at(r, -1), r
    ).otherwise(F.concat(r, F.slice(r, 1, 1)))
    coordinates = F.transform(F.col(rings), lambda r: F.transform(closed(r), pair))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.col(id_col).cast("string").alias("id"),
        F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")).alias("geometry"),
        F.struct(*[F.col(c) for c in props] or [F.lit(None).alias("none")]).alias("properties"),
    )
    df.select(F.to_json(feature).alias("value")).write.mode(mode).text(path)
