"""Sketch tables against exact values."""

import datetime
import random

from pyspark.sql import functions as F
from swathe.operators import sketches

SCHEMA = "station_id bigint, obs_ts timestamp_ntz, lon double, lat double, value double"


def test_merged_sketches_are_near(spark):
    draw = random.Random(1)
    start = datetime.datetime(2024, 1, 1)
    rows = [
        (draw.randrange(3000), start + datetime.timedelta(hours=draw.randrange(24 * 20)), 10.0 if k % 3 == 0 else draw.uniform(-179, 179), draw.uniform(-60, 60), draw.gauss(0, 9))
        for k in range(6000)
    ]
    rows += [(1, start, 10.0, 10.0, None), (1, start, None, 10.0, 1.0), (1, None, 10.0, 10.0, 1.0), (1, start, 10.0, 10.0, float("nan")), (None, start, 10.0, 10.0, 5.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    daily = sketches.tile_sketches(df, 3)
    assert daily.count() == daily.select("x", "y", "period_start").distinct().count()
    merged = sketches.merge_periods(sketches.merge_zooms(daily, 0), "2024-01-03", "2024-01-15")
    told = sketches.read_sketches(merged, {"low": 0.1, "median": 0.5}).collect()
    kept = [r for r in rows if None not in r[1:] and r[4] == r[4] and datetime.datetime(2024, 1, 3) <= r[1] < datetime.datetime(2024, 1, 15)]
    assert len(told) == 1 and told[0]["n"] == len(kept) and abs(told[0]["total"] - sum(r[4] for r in kept)) < 1e-6
    assert (told[0]["least"], told[0]["most"]) == (min(r[4] for r in kept), max(r[4] for r in kept))
    different = len({r[0] for r in kept})
    assert abs(told[0]["n_different"] - different) <= 0.05 * different
    for name, p in (("low", 0.1), ("median", 0.5)):
        assert abs(sum(r[4] <= told[0][name] for r in kept) / len(kept) - p) < 0.02
    assert {r["z"] for r in sketches.merge_zooms(daily, 3).select("z").collect()} == {3}
    assert sketches.read_sketches(sketches.merge_periods(daily, "2030-01-01", "2031-01-01"), {}).count() == 0
    assert sketches.merge_zooms(sketches.tile_sketches(df.limit(0), 3), 1).count() == 0
    assert daily.where("period_start = '2024-01-01' and x = 4 and y = 3").agg(F.max("most")).first()[0] >= 5.0
