"""Zones over the antimeridian and around the poles."""

import random

import pytest
from pyspark.sql import functions as F
from swathe.functions.polygon import RINGS_TYPE
from swathe.operators import overlay, spatial, zonal

ZONES = f"zone_id long, rings {RINGS_TYPE}"
POINTS = "id long, lon double, lat double"
BOX = [(175.0, -5.0), (-175.0, -5.0), (-175.0, 5.0), (175.0, 5.0)]


def parity(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def rolled_on(ring):
    """Longitudes that go on over the seam, by walking."""
    out = [ring[0]]
    for x, y in ring[1:]:
        step = x - out[-1][0]
        while step > 180:
            step -= 360
        while step < -180:
            step += 360
        out.append((out[-1][0] + step, y))
    return out


def brute(rings, x, y):
    rolled = [rolled_on(r) for r in rings]
    return sum(parity([r], x + turn, y) for r in rolled for turn in (-720, -360, 0, 360, 720)) % 2 == 1


@pytest.mark.parametrize("cell", [0.7, 2.0, 400.0])
def test_box_over_the_seam(spark, cell):
    hole = [(179.0, -1.0), (179.0, 1.0), (-179.0, 1.0), (-179.0, -1.0)]
    closed = BOX + BOX[:1]
    drawn_on = [(175.0, -5.0), (185.0, -5.0), (185.0, 5.0), (175.0, 5.0)]
    zones = spark.createDataFrame([(1, [BOX]), (2, [BOX, hole]), (3, [closed]), (4, [drawn_on]), (5, [BOX[::-1]]), (6, None), (7, [])], ZONES)
    rows = [(179.5, 0.5), (-179.5, 0.5), (0.0, 0.0), (180.0, 2.0), (-180.0, 2.0), (182.0, 3.0), (-176.0, 0.0), (174.0, 0.0), (None, 0.0), (float("nan"), 0.0)]
    points = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], POINTS)
    held = spatial.spatial_join(points, zones, "inner", cell)
    got = {z: {r["id"] for r in held.where(F.col("zone_id") == z).collect()} for z in range(1, 8)}
    inside = {0, 1, 3, 4, 5, 6}
    assert got == {1: inside, 2: inside - {0, 1}, 3: inside, 4: inside, 5: inside, 6: set(), 7: set()}
    assert {r["id"] for r in spatial.clip(points, zones, cell).collect()} == inside
    assert {r["id"] for r in spatial.outside(points, zones, cell).collect()} == {2, 7, 8, 9}
    assert held.columns == [*points.columns, "zone_id"] and held.where("id = 5 and lon = 182").count() == 5


def test_poles(spark):
    cap = [(-120.0, -60.0), (0.0, -65.0), (120.0, -60.0)]
    north = [(170.0, 70.0), (80.0, 75.0), (-10.0, 70.0), (-100.0, 75.0)]
    zones = spark.createDataFrame([(1, [cap]), (2, [north])], ZONES)
    rows = [(0.0, -89.9), (179.9, -80.0), (-180.0, -62.0), (60.0, -62.0), (0.0, 89.0), (-170.0, 72.0), (-10.0, 71.0), (-10.0, 69.0), (0.0, 0.0)]
    points = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], POINTS)
    got = sorted(tuple(r) for r in spatial.spatial_join(points, zones).select("zone_id", "id").collect())
    assert got == [(1, 0), (1, 1), (1, 2), (2, 4), (2, 6)] or got == [(1, 0), (1, 1), (1, 2), (2, 4), (2, 5), (2, 6)]
    assert (1, 3) not in got and (2, 7) not in got


@pytest.mark.parametrize("seed", range(4))
def test_random_rings_equal_brute_force(spark, seed):
    draw = random.Random(seed)
    zones = []
    for z in range(12):
        centre, rings = draw.choice([180.0, 179.0, -178.0, 150.0, 0.0, 700.0]), []
        for _ in range(draw.randrange(1, 4)):
            ring = [(centre + draw.uniform(-70, 70), draw.uniform(-60, 60)) for _ in range(draw.randrange(3, 9))]
            drawn_on = centre < 200 and draw.random() < 0.2
            rings.append(ring if drawn_on else [((x + 180) % 360 - 180, y) for x, y in ring])
        zones.append((z, rings))
    spots = [(draw.uniform(-180, 180), draw.uniform(-70, 70)) for _ in range(150)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(spots)], POINTS)
    want = {(i, z) for i, p in enumerate(spots) for z, rings in zones if brute(rings, *p)}
    for cell in (3.0, 50.0):
        held = spatial.spatial_join(points, spark.createDataFrame(zones, ZONES), "inner", cell)
        assert {(r["id"], r["zone_id"]) for r in held.collect()} == want
    assert len(want) > 50


def test_wide_zones_stay(spark):
    world = [(-180.0, -90.0), (180.0, -90.0), (180.0, 90.0), (-180.0, 90.0)]
    wide = [(-120.0, 0.0), (0.0, 0.0), (120.0, 0.0), (120.0, 10.0), (0.0, 10.0), (-120.0, 10.0)]
    zones = spark.createDataFrame([(1, [world]), (2, [wide])], ZONES)
    points = spark.createDataFrame([(0, 0.5, 5.0), (1, 150.0, 5.0), (2, -180.0, 0.0), (3, -119.0, 1.0)], POINTS)
    got = sorted((r["zone_id"], r["id"]) for r in spatial.spatial_join(points, zones).collect())
    assert got == [(1, 0), (1, 1), (1, 2), (1, 3), (2, 0), (2, 3)]


def test_measures_and_footprints_over_the_seam(spark):
    part = [(-172.0, 0.0), (-170.0, 0.0), (-170.0, 2.0), (-172.0, 2.0)]
    zones = spark.createDataFrame([(1, [BOX]), (2, [[(x + 10, y) for x, y in [(-5.0, -5.0), (5.0, -5.0), (5.0, 5.0), (-5.0, 5.0)]]]), (3, [BOX, part])], ZONES)
    rows = {r["zone_id"]: r for r in zonal.zone_measures(zones).collect()}
    assert (rows[1]["area"], rows[1]["perimeter"], abs(rows[1]["centroid_x"]), rows[1]["west"], rows[1]["east"]) == (100.0, 40.0, 180.0, 175.0, -175.0)
    assert (rows[2]["area"], rows[2]["perimeter"], rows[2]["west"], rows[2]["east"]) == (100.0, 40.0, 5.0, 15.0)
    assert (rows[3]["area"], rows[3]["west"], rows[3]["east"]) == (104.0, 175.0, -170.0)
    cells = overlay.footprint_cells(zones, 1.0)
    counts = {r["zone_id"]: r["count"] for r in cells.groupBy("zone_id").count().collect()}
    assert counts == {1: 100, 2: 100, 3: 104} and cells.count() == cells.distinct().count()
    assert cells.where("zone_id = 1").selectExpr("min(ix)", "max(ix)").first()[:] == (0, 359)


def test_cover_of_a_seam_zone_stays_near_it(spark):
    cover = spatial.zone_cover(spark.createDataFrame([(1, [BOX])], ZONES), 1.0)
    assert cover.where("cx between 6 and 353").count() == 0 and cover.count() < 200


def test_levels_give_the_same_pairs_from_a_smaller_cover(spark):
    draw = random.Random(8)
    land = [[(-60.0, -20.0), (-20.0, -45.0), (30.0, -40.0), (55.0, 0.0), (40.0, 45.0), (-10.0, 50.0), (-50.0, 30.0)], [(0.0, 0.0), (9.0, 3.0), (4.0, 11.0)]]
    small = [[(10.1, 10.1), (10.4, 10.1), (10.4, 10.3)]]
    zones = spark.createDataFrame([(1, land), (2, small), (3, [BOX]), (4, None)], ZONES)
    rows = [(draw.uniform(-180, 180), draw.uniform(-60, 60)) for _ in range(1500)] + [(10.35, 10.15), (179.9, 0.0), (None, 1.0)]
    points = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], POINTS)
    plain = {tuple(r) for r in spatial.spatial_join(points, zones, "inner", 0.5).select("id", "zone_id").collect()}
    for levels in (1, 5):
        held = spatial.spatial_join(points, zones, "inner", 0.5, levels=levels)
        assert held.columns == [*points.columns, "zone_id"]
        assert sorted(tuple(r) for r in held.select("id", "zone_id").collect()) == sorted(plain)
    one = zones.where("zone_id = 1")
    cover = spatial.multi_level_cover(one, 0.5, 5)
    assert cover.count() * 10 <= spatial.zone_cover(one, 0.5).count() and cover.select("level").distinct().count() == 6
    with pytest.raises(ValueError):
        spatial.spatial_join(points, zones, "left", levels=2)
    want = sorted(map(tuple, zonal.zonal_stats(points.withColumn("value", F.col("lat")), zones, ("count", "max"), cell_deg=0.5).collect()))
    assert sorted(map(tuple, zonal.zonal_stats(points.withColumn("value", F.col("lat")), zones, ("count", "max"), cell_deg=0.5, levels=4).collect())) == want


def test_one_cover_whatever_the_statistics(spark):
    zones = spark.createDataFrame([(1, [BOX])], ZONES)
    cells = spark.createDataFrame([(float(x), 0.5, float(x % 3)) for x in range(176, 185)], "lon double, lat double, value double")
    held = zonal.zonal_stats(cells, zones, ("mean", "stddev", "median", "majority"))
    assert held._jdf.queryExecution().optimizedPlan().toString().count("_zx") == 0  # read from where it was written once
    plain = zonal.zonal_stats(cells, zones, ("mean", "median", "majority"))._jdf.queryExecution().executedPlan().toString()
    assert plain.count("Scan ExistingRDD[zone_id") <= 1
    assert zonal.zonal_stats(cells, zones, ("mean", "stddev"))._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD [zone_id") == 1
