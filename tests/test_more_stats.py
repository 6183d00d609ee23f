"""Zone statistics of classes, seasons and shared cells on small tables."""

import datetime

import pytest

from swathe.operators import overlay, series, zonal
from test_edges import square


def test_class_statistics(spark):
    rows = [(1.0, 1.0, 5.0), (1.0, 1.0, 5.0), (2.0, 2.0, 7.0), (2.0, 2.0, 7.0), (3.0, 3.0, 9.0), (4.0, 4.0, None), (50.0, 50.0, 1.0)]
    df = spark.createDataFrame(rows, "lon double, lat double, value double")
    stats = ("majority", "minority", "variety", "p0", "p50", "p100", "mean")
    zone = square(spark, 0.0, 0.0, 10.0, 10.0)
    for limit in (1_000_000, 1):
        got = zonal.zonal_stats(df, zone, stats, group_limit=limit).collect()
        assert [tuple(got[0][c] for c in stats)] == [(5.0, 9.0, 3, 5.0, 7.0, 9.0, 6.6)] and len(got) == 1
    assert zonal.zonal_stats(df, zone, ("variety",)).columns == ["zone_id", "variety"]
    with pytest.raises(ValueError, match="unknown"):
        zonal.zonal_stats(df, zone, ("p101",))


def test_seasons(spark):
    days = [(datetime.datetime(2024, m, 1), float(m)) for m in range(1, 13)]
    df = spark.createDataFrame([(1, *d) for d in days], "k int, obs_ts timestamp_ntz, value double")
    got = {r["season"]: r["clim_mean"] for r in series.climatology(df, ["k"], "season").collect()}
    assert got == {1: 5.0, 2: 4.0, 3: 7.0, 4: 10.0}


def test_shared_cells(spark):
    a = square(spark, 0.0, 0.0, 4.0, 4.0).withColumnRenamed("zone_id", "a_id")
    b = square(spark, 2.0, 0.0, 9.0, 2.0).withColumnRenamed("zone_id", "b_id")
    assert [tuple(r) for r in overlay.shared_cells(a, b, 1.0).collect()] == [(1, 1, 4, 0.25)]
    far = square(spark, 20.0, 20.0, 30.0, 30.0).withColumnRenamed("zone_id", "b_id")
    assert overlay.shared_cells(a, far, 1.0).count() == 0
