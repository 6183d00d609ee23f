import collections
import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from swathe.functions.grid import haversine_km
from swathe.functions.polygon import RINGS_TYPE, box_ring, inside, ring_edges
from swathe.operators import overlay, spatial, zonal

ZONES = f"zone_id long, rings {RINGS_TYPE}"
SQUARE = [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]]
# A U open to the north.
CONCAVE = [[(20.0, 0.0), (30.0, 0.0), (30.0, 10.0), (27.0, 10.0), (27.0, 3.0), (23.0, 3.0), (23.0, 10.0), (20.0, 10.0), (20.0, 0.0)]]
HOLED = [
    [(40.0, 0.0), (60.0, 0.0), (60.0, 20.0), (40.0, 20.0)],
    [(45.0, 5.0), (45.0, 15.0), (55.0, 15.0), (55.0, 5.0)],
]
PARTS = [[(70.0, 0.0), (72.0, 0.0), (72.0, 2.0)], [(80.0, 0.0), (82.0, 0.0), (82.0, 2.0)]]


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame([(1, SQUARE), (2, CONCAVE), (3, HOLED), (4, PARTS)], ZONES)


@pytest.fixture
def merged(monkeypatch):
    """Sides never count as small, so that the shuffled joins run."""
    monkeypatch.setattr(spatial, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(spatial, "FEW_ROWS", -1)


def points(spark, rows):
    return spark.createDataFrame(
        [(i, x, y) for i, (x, y) in enumerate(rows)], "id long, lon double, lat double"
    )


KNOWN = [
    ((5.0, 5.0), 1), ((-1.0, 5.0), None), ((21.0, 9.0), 2), ((25.0, 9.0), None), ((25.0, 1.0), 2),
    ((42.0, 3.0), 3), ((50.0, 10.0), None), ((71.5, 0.5), 4), ((75.0, 0.5), None), ((81.5, 0.5), 4),
    ((None, 5.0), None),
]


@pytest.mark.parametrize("cell", [0.7, 2.0, 25.0, 400.0])
def test_known_polygons(spark, zones, cell):
    df = points(spark, [p for p, _ in KNOWN])
    got = spatial.spatial_join(df, zones, "left", cell).orderBy("id").collect()
    assert [r["zone_id"] for r in got] == [z for _, z in KNOWN]


def test_known_polygons_without_broadcast(spark, zones, merged):
    df = points(spark, [p for p, _ in KNOWN])
    got = spatial.spatial_join(df, zones, "left")
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert [r["zone_id"] for r in got.orderBy("id").collect()] == [z for _, z in KNOWN]
    assert spatial.clip(df, zones).count() == 6
    assert spatial.outside(df, zones).count() == 5


def test_clip_and_outside_partition_the_input(spark, zones):
    df = points(spark, [p for p, _ in KNOWN])
    a, b = spatial.clip(df, zones), spatial.outside(df, zones)
    assert a.unionByName(b).exceptAll(df).count() == 0 and a.count() + b.count() == df.count()


coordinate = st.floats(-60, 60, allow_nan=False).map(lambda v: round(v, 3))
ring = st.lists(st.tuples(coordinate, coordinate), min_size=3, max_size=9)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rings=st.lists(st.lists(ring, min_size=1, max_size=3), min_size=1, max_size=4),
    pts=st.lists(st.tuples(coordinate, coordinate), min_size=20, max_size=60),
    cell=st.sampled_from([3.0, 11.0, 40.0]),
)
def test_cover_equals_brute_force(spark, rings, pts, cell):
    # Any closed chains will do for parity, even ones that cross themselves.
    zones = spark.createDataFrame(list(enumerate(rings)), ZONES)
    df = points(spark, [(x + 1e-4, y + 1e-4) for x, y in pts])
    got = {tuple(r) for r in spatial.spatial_join(df, zones, cell_deg=cell).select("id", "zone_id").collect()}
    every = df.join(zones.select("zone_id", ring_edges("rings").alias("e")))
    want = {tuple(r) for r in every.where(inside("e", "lon", "lat")).select("id", "zone_id").collect()}
    assert got == want


def circle(x, y, radius, corners):
    at = [2 * math.pi * i / corners + 0.1 for i in range(corners)]
    return [[(x + radius * math.cos(a), y + radius * math.sin(a)) for a in at]]


@pytest.mark.parametrize("corners", [6, 40])
@pytest.mark.parametrize("shuffled", [False, True])
def test_joins_are_compiled_and_equal_brute_force(spark, monkeypatch, corners, shuffled):
    if shuffled:
        monkeypatch.setattr(spatial, "BROADCAST_BYTES", -1)
    rows = [(i, circle(i * 3.1, i % 4, 1.0 + i % 3, corners if i % 2 else 4)) for i in range(8)]
    zones = spark.createDataFrame([*rows, (8, None), (1, circle(4.0, 1.0, 2.0, corners))], ZONES)
    df = points(spark, [(x * 0.37 - 4.0, y * 0.41 - 3.0) for x in range(80) for y in range(24)] + [(None, 1.0), (1.0, None)])
    every = df.join(zones.select("zone_id", ring_edges("rings").alias("e")))
    want = collections.Counter(tuple(r) for r in every.where(inside("e", "lon", "lat")).select("id", "zone_id").collect())
    held = {i for i, _ in want}
    free = [i for i in range(df.count()) if i not in held]
    joined = spatial.spatial_join(df, zones, cell_deg=0.9).select("id", "zone_id")
    assert collections.Counter(map(tuple, joined.collect())) == want
    # A plan node that is compiled has a star before its name.
    kind = "SortMergeJoin" if shuffled else "BroadcastHashJoin"
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"\*\(\d+\) {kind}", plan.split("Initial Plan")[0])
    left = spatial.spatial_join(df, zones, "left", 0.9).select("id", "zone_id").collect()
    assert collections.Counter(map(tuple, left)) == want + collections.Counter((i, None) for i in free)
    assert sorted(r["id"] for r in spatial.clip(df, zones, 0.9).collect()) == sorted(held)
    assert sorted(r["id"] for r in spatial.outside(df, zones, 0.9).collect()) == free


def test_cover_skips_and_clears_cells(spark, zones):
    cover = spatial.zone_cover(zones.where("zone_id = 1"), 1.0)
    # 8 x 8 cells lie wholly inside; the outline runs through the rest.
    assert cover.where("size(edges) = 0").count() == 64
    assert cover.count() <= 12 * 12
    assert cover.agg(F.max(F.size("edges"))).first()[0] <= 4
    size = spatial.cover_bytes(zones.where("zone_id = 1"), 1.0)
    assert size >= cover.count() * spatial.ROW_BYTES


def test_measures(spark, zones):
    got = {r["zone_id"]: r for r in zonal.zone_measures(zones).collect()}
    assert (got[1]["area"], got[1]["perimeter"], got[1]["centroid_x"]) == (100.0, 40.0, 5.0)
    assert got[2]["area"] == 100.0 - 28.0
    assert got[3]["area"] == 400.0 - 100.0
    assert (got[3]["centroid_x"], got[3]["centroid_y"]) == (50.0, 10.0)
    assert (got[4]["west"], got[4]["east"]) == (70.0, 82.0)


def test_zonal_stats_of_a_hot_position(spark, zones):
    # Nine in ten observations sit on one position.
    df = spark.range(10_000).selectExpr(
        "CASE WHEN id % 10 < 9 THEN 5.5D ELSE (id % 97) * 1.0D END AS lon", "5.5D AS lat",
        "cast(id % 101 AS double) AS value",
    )
    stats = ("count", "sum", "mean", "min", "max", "stddev", "median")
    got = zonal.zonal_stats(df, zones, stats).orderBy("zone_id").collect()
    want = (
        spatial.spatial_join(df, zones).groupBy("zone_id")
        .agg(
            F.count("*"), F.sum("value"), F.avg("value"), F.min("value"), F.max("value"),
            F.stddev_samp("value"), F.median("value"),
        ).orderBy("zone_id").collect()
    )
    for g, w in zip(got, want, strict=True):
        assert tuple(g) == pytest.approx(tuple(w))
    split = zonal.zonal_stats(df, zones, stats, group_limit=5).orderBy("zone_id").collect()
    for g, w in zip(split, want, strict=True):
        assert tuple(g) == pytest.approx(tuple(w))


SPREAD = [
    (lon, lat)
    for lon in (-180.0, -179.9, -90.0, 0.0, 0.05, 89.0, 179.95)
    for lat in (-90.0, -89.99, -45.0, 0.0, 0.03, 60.0, 89.98)
]


def brute_distances(spark, a, b):
    b = b.select(F.col("id").alias("bid"), F.col("lon").alias("blon"), F.col("lat").alias("blat"))
    d = haversine_km(F.col("lon"), F.col("lat"), F.col("blon"), F.col("blat"))
    return a.crossJoin(b).withColumn("d", d)


@pytest.mark.parametrize("km", [0.5, 20.0, 400.0, 4000.0])
@pytest.mark.parametrize("broadcast", [True, False])
def test_within_distance_at_poles_and_antimeridian(spark, monkeypatch, km, broadcast):
    if not broadcast:
        monkeypatch.setattr(spatial, "FEW_ROWS", -1)
    a, b = points(spark, SPREAD), points(spark, [(x + 0.01, y * 0.9999) for x, y in SPREAD])
    got = spatial.within_distance_join(a, b, km).select("id", "b_id")
    want = brute_distances(spark, a, b).where(F.col("d") <= km).select("id", "bid")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(got) == rows(want) and got.count() > 0


def test_crowded_cubes_are_dealt_in_blocks(spark, monkeypatch):
    """All pairs once, and no task with more than a share of a cube that holds nearly all rows."""
    monkeypatch.setattr(spatial, "FEW_ROWS", -1)
    monkeypatch.setattr(spatial, "BLOCK_ROWS", 16)
    a = points(spark, SPREAD + [(10.0, 10.0)] * 300)
    b = points(spark, [(10.01, 10.0)] * 200 + SPREAD + [(10.0, 10.0 + k * 1e-3) for k in range(40)])
    got = spatial.within_distance_join(a.withColumn("tags", F.create_map(F.lit("k"), "id")), b, 20.0)
    want = brute_distances(spark, a, b).where("d <= 20").select("id", "bid")
    rows = [tuple(r) for r in got.select("id", "b_id", F.spark_partition_id()).collect()]
    assert sorted(r[:2] for r in rows) == sorted(map(tuple, want.collect()))
    held = collections.Counter(r[2] for r in rows)
    assert len(rows) > 60_000 and max(held.values()) < len(rows) / 3


def test_attributes_come_along_with_the_cover(spark):
    """As by a join on the id afterwards, also where ids repeat or are null; pairs are not shuffled by zone."""
    zones = spark.createDataFrame([(i, SQUARE, n) for i, n in ((1, "a"), (1, "b"), (2, "c"), (None, "d"))], ZONES + ", name string")
    dots = points(spark, [(5.0, 5.0), (50.0, 50.0)])
    for how in ("inner", "left"):
        got = spatial.spatial_join(dots, zones, how, attributes=("name",))
        want = spatial.spatial_join(dots, zones, how).join(zones.select("zone_id", "name"), "zone_id", how)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        # The last join is that with the cover.
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "_zx" in next(line for line in plan.split("\n") if "Join" in line)


@pytest.mark.parametrize("k,leaf", [(1, 1), (3, 4), (7, 32), (200, 8)])
def test_nearest_equals_brute_force(spark, k, leaf):
    # A dense cluster beside scattered positions, and repeated positions.
    cluster = [(30.0 + i * 1e-4, 40.0 + (i % 7) * 1e-4) for i in range(60)]
    a = points(spark, SPREAD + [(29.0, 41.0), (30.003, 40.0003), (30.003, 40.0003)])
    b = points(spark, cluster + SPREAD[::3] + [(30.0, 40.0)] * 5)
    got = spatial.nearest_join(a, b, k, "id", leaf=leaf)
    brute = brute_distances(spark, a, b).selectExpr(
        "id", "bid", "d", "row_number() OVER (PARTITION BY id ORDER BY d, bid) AS r"
    ).where(f"r <= {k}")
    pairs = lambda df, *c: sorted(map(tuple, df.select(*c).collect()))
    assert pairs(got, "id", "rank", "b_id") == pairs(brute, "id", "r", "bid")


def test_nearest_without_broadcast(spark, merged):
    a = points(spark, SPREAD + SPREAD[:9] + [(None, 1.0)])
    b = points(spark, [(x + 0.01, y * 0.9999) for x, y in SPREAD])
    got = spatial.nearest_join(a, b, 2, "id", leaf=4)
    assert got.count() == 2 * (len(SPREAD) + 9)
    shuffled = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in shuffled


def test_nearest_inside_a_millimetre_cluster(spark):
    b = points(spark, [(30.0 + i * 1e-9, 40.0) for i in range(300)])
    a = points(spark, [(30.0 + 150.4e-9, 40.0), (-150.0, -40.0)])
    got = spatial.nearest_join(a, b, 2, "id", leaf=4).where("id = 0").orderBy("rank").collect()
    assert [r["b_id"] for r in got] == [150, 151]


def test_a_hot_cell_is_split(spark, zones, merged):
    low = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    df = spark.range(0, 40_000, 1, 8).selectExpr(
        "id", "CASE WHEN id % 3 > 0 THEN 5.5D ELSE (id % 80) * 1D + 0.5D END AS lon",
        "CASE WHEN id % 3 > 0 THEN 5.5D ELSE (id % 70) * 1D + 0.5D END AS lat",
    )
    before = {k: spark.conf.get(k) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        got = spatial.spatial_join(df, zones, "left")
        held = got.where("zone_id = 1").collect()
        got.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(held) == df.where("lon < 10 AND lat < 10").count()


def test_sample_at_points(spark):
    cells = spark.createDataFrame([(190, 95, 1.5)], "ix int, iy int, v double")
    df = points(spark, [(10.5, 5.5), (11.5, 5.5)])
    got = spatial.sample_at_points(df, cells, 1.0, ["v"]).orderBy("id").collect()
    assert [r["v"] for r in got] == [1.5, None]


def test_footprints(spark, zones):
    cells = overlay.footprint_cells(zones, 1.0).groupBy("zone_id").count()
    assert dict(map(tuple, cells.where("zone_id <= 3").collect())) == {1: 100, 2: 72, 3: 300}


def test_box_ring(spark):
    box = spark.sql("SELECT 1L AS zone_id, 1D AS w, 2D AS s, 4D AS e, 6D AS n")
    box = box.withColumn("rings", box_ring("w", "s", "e", "n"))
    assert zonal.zone_measures(box).first()["area"] == 12.0
    assert math.isclose(zonal.zone_measures(box).first()["centroid_y"], 4.0)
