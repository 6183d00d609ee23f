"""Infinite, missing, repeated and far-off values; long gaps; names that look like numbers."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from swathe.functions.grid import cell_xy
from swathe.operators import composite, filters, frames, raster, series, spatial, zonal
from swathe.plans.quantiles import exact_quantiles
from swathe.sources import cells, scenes
from workload import fixtures


def square(spark, west, south, east, north):
    ring = [(west, south), (east, south), (east, north), (west, north), (west, south)]
    return spark.createDataFrame([(1, [ring])], "zone_id int, rings array<array<struct<x:double,y:double>>>")


def test_quantiles_agree_both_ways(spark):
    inf = math.inf
    groups = {
        "up": [1.0, 2.0, inf, inf], "down": [-inf, -inf, 3.0, 4.0], "nan": [1.0, math.nan, 2.0], "zero": [-0.0, 0.0, 0.0],
        "both": [-inf, inf], "one": [7.5], "tenths": [0.1 * i for i in range(11)],
    }
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    probs = {"a": 0.1, "b": 0.5, "c": 0.9, "d": 1.0}
    plain = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", probs).collect()}
    split = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", probs, group_limit=0).collect()}
    assert plain.keys() == split.keys() == groups.keys()
    for k in groups:
        assert [repr(plain[k][c] + 0.0) for c in probs] == [repr(split[k][c] + 0.0) for c in probs], k


def test_stddev_far_from_zero(spark):
    rows = [(0.01 * (i % 30) + 0.5, 0.01 * (i // 30) + 0.5, 1e9 + i % 7) for i in range(600)]
    df = spark.createDataFrame(rows, "lon double, lat double, value double")
    got = zonal.zonal_stats(df, square(spark, 0.0, 0.0, 20.0, 20.0), ("count", "stddev", "median")).first()
    assert got["count"] == 600 and got["stddev"] == pytest.approx(1.99957, abs=1e-4) and got["median"] == 1e9 + 3


def test_no_join_at_build_time_without_need(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0)], "lon double, lat double, value double")
    plan = zonal.zonal_stats(df, square(spark, 0.0, 0.0, 2.0, 2.0), ("mean", "median"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_bands_come_back_as_written(spark, tmp_path):
    day = datetime.datetime(2024, 1, 2, 5)
    rows = [(b, day, i, i, float(i)) for i, b in enumerate(["04", "8A", "10", None])]
    schema = "band string, obs_ts timestamp_ntz, ix int, iy int, value double"
    cells.write_cells(spark.createDataFrame(rows, schema), str(tmp_path / "c"))
    back = cells.scan_cells(spark, str(tmp_path / "c"))
    assert back.schema["band"].dataType.simpleString() == "string" and back.schema["obs_date"].dataType.simpleString() == "date"
    assert {(r["band"], r["value"]) for r in back.collect()} == {("04", 0.0), ("8A", 1.0), ("10", 2.0), (None, 3.0)}
    assert cells.scan_cells(spark, str(tmp_path / "c"), bands=["04"]).count() == 1
    assert cells.scan_cells(spark, str(tmp_path / "c"), end="2024-01-02").count() == 0
    assert cells.scan_cells(spark, str(tmp_path / "c"), end="2024-01-02 06:00:00").count() == 4
    with pytest.raises(Exception, match="empty band"):
        cells.write_cells(spark.createDataFrame([("", day, 1, 1, 1.0)], schema), str(tmp_path / "d"))


@pytest.mark.parametrize("bbox, found", [((170, -1, 179, 1), True), ((-179, -1, -170, 1), True), ((0, -1, 10, 1), False), ((178, -1, -178, 1), True)])
def test_scenes_over_the_antimeridian(spark, bbox, found):
    df = spark.createDataFrame([(1, 175.0, -1.0, -175.0, 1.0)], "scene_id int, west double, south double, east double, north double")
    df = df.withColumn("acq_ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    assert (scenes.search_scenes(df, bbox).count() == 1) == found


def test_area_of_a_cell_counts_once(spark):
    rows = [(1.5, 1.5, 1)] * 3 + [(2.5, 1.5, 1)]
    df = spark.createDataFrame(rows, "lon double, lat double, class int")
    got = zonal.class_area(df, square(spark, 0.0, 0.0, 10.0, 10.0), 1.0).where("level = 0").first()
    once = zonal.class_area(df.distinct(), square(spark, 0.0, 0.0, 10.0, 10.0), 1.0).where("level = 0").first()
    assert (got["n"], got["visits"], got["area_km2"]) == (2, 4, once["area_km2"])


def test_nan_is_missing(spark):
    df = spark.createDataFrame([("a", 1, math.nan, 5.0), ("a", 2, 1.0, 6.0)], "band string, obs_id int, value double, other double")
    assert [(r["bin"], r["n"]) for r in raster.histogram(df, 10.0).collect()] == [(0, 1)]
    assert composite.best_pixel(df, ["band"], "value").first()["obs_id"] == 2


def test_open_ended_and_wide_classes(spark):
    inf = math.inf
    lookup = spark.createDataFrame([("low", -inf, 0.0), ("mid", 0.0, 1e12), ("high", 1e12, inf)], "name string, lower double, upper double")
    values = [(-5.0,), (0.0,), (5e11,), (1e12,), (None,), (math.nan,), (inf,), (-inf,)]
    got = filters.reclassify_by_table(spark.createDataFrame(values, "value double"), lookup, 0.5).collect()
    assert {str(r["value"]): r["name"] for r in got} == {
        "-5.0": "low", "0.0": "mid", "500000000000.0": "mid", "1000000000000.0": "high", "None": None, "nan": None, "inf": None, "-inf": "low",
    }


def test_long_gap_is_written_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(series, "STRETCH", 100)
    start = datetime.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, start, 0.0), (1, start + datetime.timedelta(seconds=1234), 1234.0)], "k int, obs_ts timestamp_ntz, value double")
    got = series.gap_fill(df, ["k"], "1 second", "linear").orderBy("obs_ts").collect()
    assert [r["value"] for r in got] == pytest.approx(range(1235)) and sum(r["filled"] for r in got) == 1233


def test_long_calendars_are_filled_in_pieces(spark, monkeypatch):
    start = datetime.datetime(2024, 1, 1)
    rows = [(k, start + datetime.timedelta(minutes=m), float(m)) for k in (1, 2, None) for m in (0, 3, 4, 19, 40, 41)]
    df = spark.createDataFrame(rows, "k int, obs_ts timestamp_ntz, value double")
    for method in ("carry", "linear", "null"):
        plain = sorted(map(str, series.gap_fill(df, ["k"], "1 minute", method).collect()))
        monkeypatch.setattr(series, "PLAIN_SLOTS", 1)
        monkeypatch.setattr(series, "PIECE_SLOTS", 7)
        assert sorted(map(str, series.gap_fill(df, ["k"], "1 minute", method).collect())) == plain and len(plain) == 126
        monkeypatch.undo()


def test_any_number_of_frames(spark):
    start = datetime.datetime(2024, 1, 1)
    df = spark.createDataFrame([(start + datetime.timedelta(seconds=37 * i),) for i in range(50)] + [(None,)], "obs_ts timestamp_ntz")
    for n in (1, 7, 50, 80):
        got = frames.frames_by_count(df, n).orderBy("obs_ts").collect()
        assert got[0]["frame_idx"] is None
        size, longer = divmod(50, n)
        want = [k + 1 for k in range(min(n, 50)) for _ in range(size + (k < longer))]
        assert [r["frame_idx"] for r in got[1:]] == want


def test_the_seam_and_the_pole_are_on_the_grid(spark):
    df = spark.createDataFrame([(180.0, 90.0), (-180.0, 89.5), (179.9, -90.0), (math.nan, 1.0)], "lon double, lat double")
    got = df.select(*(c.alias(k) for k, c in zip("xy", cell_xy("lon", "lat", 1.0)))).collect()
    assert [(r["x"], r["y"]) for r in got] == [(0, 179), (0, 179), (359, 0), (None, 91)]
    edge = spark.createDataFrame([(1, 180.0, 5.0)], "obs_id int, lon double, lat double")
    assert spatial.clip(edge.withColumn("lon", F.lit(179.5)), square(spark, 170.0, 0.0, 180.0, 10.0)).count() == 1
    assert spatial.clip(edge.withColumn("lon", F.lit(-179.5)), square(spark, 170.0, 0.0, 180.0, 10.0)).count() == 0


def test_radius_beyond_half_the_globe(spark):
    df = spark.createDataFrame([(0.0, 0.0), (179.0, 10.0), (-90.0, -80.0)], "lon double, lat double")
    assert spatial.within_distance_join(df, df, 20_100).count() == 9
    assert spatial.within_distance_join(df, df, 12_000).count() == 7


def test_fixtures_read_whole_tables(spark, sf):
    assert fixtures.observations(spark, sf).count() == fixtures.table(spark, sf, "events").count()
