import math

import pytest
from pyspark.sql import functions as F

from swathe.functions import grid
from swathe.operators import bands, filters, raster, tiles


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_known_tile(spark):
    # Brandenburg Gate, zoom 12, as in any slippy-map calculator.
    x, y = grid.tile_xy(F.lit(13.37771), F.lit(52.51628), 12)
    assert tuple(one(spark, x, y)) == (2200, 1343)


@pytest.mark.parametrize("lon,lat,want", [(180.0, 90.0, (7, 0)), (-180.0, -90.0, (0, 7)), (0.0, 0.0, (4, 4))])
def test_tile_clamps(spark, lon, lat, want):
    x, y = grid.tile_xy(F.lit(lon), F.lit(lat), 3)
    assert tuple(one(spark, x, y)) == want


def test_cell_edges_belong_to_the_east_and_north(spark):
    ix, iy = grid.cell_xy(F.lit(10.0), F.lit(-90.0), 2.0)
    assert tuple(one(spark, ix, iy)) == (95, 0)
    x, y = grid.cell_centre(F.lit(95), F.lit(0), 2.0)
    assert tuple(one(spark, x, y)) == (11.0, -89.0)


def test_cells_cover_the_sphere(spark):
    area = spark.range(180).select(
        F.sum(grid.cell_area_km2(F.col("id") - 89.5, 1.0)) * 360
    ).first()[0]
    assert area == pytest.approx(4 * math.pi * grid.EARTH_RADIUS_KM**2)


def test_quarter_of_the_way_round(spark):
    d = grid.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))
    assert one(spark, d)[0] == pytest.approx(math.pi / 2 * grid.EARTH_RADIUS_KM)


def test_attribute(spark):
    df = spark.createDataFrame([('{"a": {"b": "7"}, "c": "x"}',), (None,)], "props string")
    got = df.select(
        grid.attribute("props", "a.b", "int"), grid.attribute("props", "c", "int"),
        grid.attribute("props", "missing"),
    ).collect()
    assert [tuple(r) for r in got] == [(7, None, None), (None, None, None)]


def test_one_bit_pattern(spark):
    df = spark.createDataFrame([(0b1011000,), (0b0001000,), (None,)], "qa int")
    got = df.select(filters.qa_bits("qa", 3, 2)).collect()
    assert [r[0] for r in got] == [3, 1, None]
    assert filters.qa_mask(df, 3, 2, [1]).collect() == [(0b0001000,)]


def test_rescale_and_reclassify_keep_nulls(spark):
    df = spark.createDataFrame([(10.0,), (-1.0,), (None,), (20.0,)], "value double")
    got = [r[0] for r in filters.rescale(df, 2.0, 1.0, nodata=-1).collect()]
    assert got == [21.0, None, None, 41.0]
    got = [r[1] for r in filters.reclassify(df, [0, 20]).collect()]
    assert got == [1, 0, None, 2]
    with pytest.raises(ValueError):
        filters.reclassify(df, [2, 1])


def test_time_filter_is_half_open_and_box_is_closed(spark):
    df = spark.sql("""SELECT * FROM VALUES (timestamp_ntz'2024-01-01', 0D, 1D),
      (timestamp_ntz'2024-01-02', 170D, 1D), (timestamp_ntz'2024-01-03', -175D, 2D) AS t(obs_ts, lon, lat)""")
    assert filters.time_filter(df, "2024-01-01", "2024-01-03").count() == 2
    assert filters.bbox_filter(df, 0, 1, 170, 1).count() == 2
    assert filters.bbox_filter(df, 170, 0, -170, 2).count() == 2


def test_band_round_trip(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", 3.0), (2, "a", 5.0)], "k int, band string, value double"
    )
    wide = bands.bands_to_columns(df, ["a", "b"], ["k"])
    back = bands.columns_to_bands(wide, ["a", "b"], ["k"])
    assert sorted(back.collect()) == sorted(df.collect())
    nd = bands.normalized_difference(wide, "b", "a").orderBy("k").collect()
    assert [r["nd"] for r in nd] == [0.5, None]


def test_regrid_keeps_sums(spark, sf):
    from workload.fixtures import observations

    obs = observations(spark, sf)
    total = obs.agg(F.sum("value")).first()[0]
    for res in (1.0, 7.0, 30.0):
        got = raster.regrid(obs, res, "sum").agg(F.sum("value")).first()[0]
        assert got == pytest.approx(total)


def test_each_zoom_sums_to_the_next(spark, sf):
    from workload.fixtures import observations

    got = tiles.tile_pyramid(observations(spark, sf), 0, 6)
    up = got.where("z > 0").groupBy(
        (F.col("z") - 1).alias("z"), F.shiftright("x", 1).alias("x"), F.shiftright("y", 1).alias("y")
    ).agg(F.sum("n").alias("n"))
    level = got.where("z < 6").select("z", "x", "y", "n")
    assert level.exceptAll(up).count() == 0 and up.exceptAll(level).count() == 0


def test_focal_equals_brute_force(spark):
    df = spark.range(60).selectExpr(
        "cast(id * 7 % 10 as int) ix", "cast(id * 3 % 11 as int) iy", "'a' band", "cast(id as double) value"
    )
    b = df.selectExpr("ix bx", "iy by", "value bv")
    want = (
        df.select("ix", "iy").distinct()
        .join(b, F.expr("abs(ix - bx) <= 2 AND abs(iy - by) <= 2"))
        .groupBy("ix", "iy").agg(F.avg("bv").alias("w"))
    )
    got = raster.focal(df, 2).join(want, ["ix", "iy"])
    assert got.count() == want.count()
    assert got.where("abs(focal - w) > 1e-9").count() == 0
