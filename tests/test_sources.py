import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from swathe.functions.grid import hilbert_key
from swathe.sources import cells, features, scenes, tables
from swathe.session import scratch_path
from workload.fixtures import observations, parcels


def test_cells_prune_and_push(spark, sf, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    path = str(tmp_path / "cells")
    cells.write_cells(observations(spark, sf), path, files=4)
    df = cells.scan_cells(
        spark, path, ["click"], "2024-01-05", "2024-01-06 12:00:00", (-100, -40, 100, 40)
    ).select("obs_id", "value")
    plan = df._jdf.queryExecution().executedPlan().toString()
    parts = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "band" in parts and "obs_date" in parts
    pushed = plan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(obs_ts" in pushed and "LessThanOrEqual(lon" in pushed
    assert "props" not in plan.split("ReadSchema: ")[1].split("\n")[0]
    want = observations(spark, sf).where(
        "band = 'click' AND obs_ts >= timestamp_ntz'2024-01-05' AND obs_ts < timestamp_ntz'2024-01-06 12:00:00'"
        " AND lon BETWEEN -100 AND 100 AND lat BETWEEN -40 AND 40"
    )
    assert df.count() == want.count()
    assert spark.read.parquet(path).count() == observations(spark, sf).count()


def test_hilbert_key(spark):
    """A curve through all cells of a square, from neighbour to neighbour."""
    for bits in (1, 3, 5):
        side = 1 << bits
        cells_ = spark.range(side * side).selectExpr(f"id % {side} AS ix", f"id div {side} AS iy")
        rows = cells_.select("ix", "iy", hilbert_key("ix", "iy", bits).alias("k")).orderBy("k").collect()
        assert [r["k"] for r in rows] == list(range(side * side))
        assert all(abs(a["ix"] - b["ix"]) + abs(a["iy"] - b["iy"]) == 1 for a, b in zip(rows, rows[1:]))
    assert spark.range(1).select(hilbert_key("-5", "1 << 21").alias("k")).first()["k"] >= 0


def test_a_box_meets_few_row_groups_of_a_curve(spark):
    """Groups of 1024 cells of a grid of 1024 by 1024: a row each, or squares of 32 by 32."""
    grid = spark.range(1 << 20).selectExpr("id % 1024 AS ix", "id div 1024 AS iy").withColumn("k", hilbert_key("ix", "iy"))

    def met(place):
        boxes = grid.groupBy(F.expr(f"{place} div 1024")).agg(*(f(c).alias(f"{n}_{c}") for c in ("ix", "iy") for n, f in (("low", F.min), ("high", F.max))))
        return boxes.where("low_ix <= 163 AND high_ix >= 100 AND low_iy <= 163 AND high_iy >= 100").count()

    assert met("k") <= 9 and met("k") * 5 <= met("(iy * 1024 + ix)") == 64


def test_curve_files_read_back(spark, tmp_path):
    df = spark.range(30_000).selectExpr(
        "'b' AS band", "timestamp_ntz'2024-01-01' AS obs_ts", "cast(id % 173 AS int) AS ix", "cast(id div 173 AS int) AS iy", "repeat('x', cast(id % 9 AS int)) AS s",
    )
    for curve in (True, False):
        path = str(tmp_path / f"c{curve}")
        cells.write_cells(df, path, bytes_per_file=200_000, curve=curve)
        assert len(list((tmp_path / f"c{curve}").rglob("*.parquet"))) >= 4
        back = cells.scan_cells(spark, path)
        assert back.drop("obs_date").select(*df.columns).exceptAll(df).count() == 0 and back.count() == 30_000
    cells.write_cells(df.limit(0), str(tmp_path / "none"))


def test_a_hot_band_day_spreads_over_files(spark, tmp_path):
    df = spark.range(20_000).selectExpr(
        "'b' AS band", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id % 60) AS obs_ts",
        "cast(id % 100 AS int) AS ix", "cast(id % 90 AS int) AS iy",
    )
    cells.write_cells(df, str(tmp_path / "hot"), files=6)
    assert len(list((tmp_path / "hot").rglob("*.parquet"))) == 6


def test_antimeridian_search(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, 175D, 179D), (2, -179D, -170D), (3, 0D, 5D) AS t(id, west, east)""")
    df = df.selectExpr("*", "0D AS south", "1D AS north", "timestamp_ntz'2024-01-01' AS acq_ts", "1D AS cloud")
    got = scenes.search_scenes(df, (176, 0, -175, 1))
    assert sorted(r["id"] for r in got.collect()) == [1, 2]
    assert scenes.search_scenes(df, (5, 1, 6, 2)).count() == 1


FEATURES = [
    {"type": "Feature", "id": "p", "geometry": {"type": "Point", "coordinates": [1.5, -2]}, "properties": {"n": 3}},
    {"type": "Feature", "id": "q", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}, "properties": None},
    {"type": "Feature", "id": "m", "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}, "properties": {"a": {"b": "x"}}},
]


@pytest.mark.parametrize("lines", [True, False])
def test_geojson(spark, tmp_path, lines):
    path = tmp_path / "f.json"
    if lines:
        path.write_text("\n".join(json.dumps(f) for f in FEATURES))
    else:
        path.write_text(json.dumps({"type": "FeatureCollection", "features": FEATURES}, indent=1))
    got = {r["id"]: r for r in features.scan_features(spark, str(path), lines=lines).collect()}
    assert (got["p"]["lon"], got["p"]["lat"], got["p"]["rings"]) == (1.5, -2.0, None)
    assert len(got["q"]["rings"]) == 1 and got["q"]["rings"][0][1]["x"] == 1.0
    assert len(got["m"]["rings"]) == 2 and json.loads(got["m"]["props"]) == {"a": {"b": "x"}}
    assert got["q"]["props"] is None and got["q"]["lon"] is None


def test_features_round_trip(spark, sf, tmp_path):
    path = str(tmp_path / "out")
    features.write_features(parcels(spark, sf), path, props=("c_mktsegment",))
    back = features.scan_features(spark, path)
    want = parcels(spark, sf).select("zone_id", F.get("rings", 0).alias("ring"))
    pair = back.join(want, F.expr("cast(id AS bigint) = zone_id"))
    assert pair.where("slice(rings[0], 1, 6) = ring").count() == want.count()
    assert back.where(F.size(F.get("rings", 0)) != 7).count() == 0


def test_text_tables_need_a_schema(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "cast(id AS string) AS name")
    for fmt in tables.FORMATS:
        path = str(tmp_path / fmt)
        tables.write_table(df, path, fmt)
        schema = "id long, name string"
        assert tables.scan_table(spark, path, fmt, schema).orderBy("id").collect() == df.collect()
    with pytest.raises(ValueError):
        tables.scan_table(spark, str(tmp_path / "csv"), "csv")
    with pytest.raises(ValueError):
        tables.scan_table(spark, "x", "xml")


def test_jdbc_options():
    """Only how a read is described; no database is contacted."""
    got = tables.jdbc_read_options("jdbc:x", "t", "id", 0, 100, 8, properties={"user": "u"})
    assert got["partitionColumn"] == "id" and got["numPartitions"] == "8" and got["user"] == "u"
    with pytest.raises(ValueError):
        tables.jdbc_read_options("jdbc:x", "t", "id", 0, 100, 0)


def test_scratch_paths_are_fresh(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_stream_totals_equal_batch(spark, sf, tmp_path):
    from swathe.operators.series import accumulate
    from swathe.streaming.cells import accumulate_stream, stream_cells, write_totals

    landing = str(tmp_path / "landing")
    cells_df = observations(spark, sf).select("band", "obs_ts", "value")
    cells_df.repartition(3).write.parquet(landing)
    # A row far ahead closes every earlier period.
    ahead = spark.createDataFrame([("end", datetime(2025, 1, 1), 0.0)], cells_df.schema)
    ahead.write.mode("append").parquet(landing)
    stream = stream_cells(spark, landing, cells_df.schema, files_per_batch=10)
    totals = accumulate_stream(stream, ["band"], "1 day", "2 hours")
    query = write_totals(totals, str(tmp_path / "totals"), str(tmp_path / "state"))
    assert query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "totals")).where("band <> 'end'")
    want = accumulate(cells_df, ["band"], "1 day")
    key = lambda r: (r["band"], r["period_start"], round(r["total"], 6), r["n"])
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
