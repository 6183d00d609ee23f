from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from swathe.operators import asof, composite, frames, series
from swathe.plans import quantiles
from swathe.plans.quantiles import exact_quantiles
from swathe.plans.skew import group_sizes, seconds

T0 = datetime(2024, 3, 1)


def rows(df, *cols):
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds two thirds of the rows; instants repeat; some are before 1970."""
    return spark.range(3000).selectExpr(
        "id AS obs_id", "CASE WHEN id % 3 < 2 THEN 'hot' ELSE concat('k', id % 11) END AS key",
        "timestamp_ntz'1969-12-30' + make_dt_interval(0, 0, 0, (id * 7919) % 400000) AS obs_ts",
        "cast((id * 31) % 97 AS double) AS value",
    )


def test_gap_fill_of_a_null_run(spark):
    df = spark.createDataFrame(
        [("a", T0, 1.0), ("a", T0 + timedelta(hours=4), 5.0), ("a", T0 + timedelta(hours=1), None),
         ("b", T0, 7.0)],
        "key string, obs_ts timestamp_ntz, value double",
    )
    got = {
        m: rows(series.gap_fill(df, ["key"], "1 hour", m).orderBy("key", "obs_ts"), "value", "filled")
        for m in ("carry", "linear", "null")
    }
    assert [v for v, _ in got["carry"]] == [1.0, 1.0, 1.0, 1.0, 5.0, 7.0]
    assert [v for v, _ in got["linear"]] == [1.0, 2.0, 3.0, 4.0, 5.0, 7.0]
    assert [v for v, _ in got["null"]] == [1.0, None, None, None, 5.0, 7.0]
    assert [f for _, f in got["carry"]] == [False, True, True, True, False, False]
    with pytest.raises(ValueError):
        series.gap_fill(df, ["key"], "1 hour", "spline")


@pytest.mark.parametrize("span,slices", [("1 hour", 1), ("1 hour", 4), ("2 days", 32), ("9 days", 8), ("2 days", None)])
def test_rolling_equals_plain_window(spark, hot, span, slices):
    got = series.rolling(hot, ["key"], span, slices=slices)
    w = f"PARTITION BY key ORDER BY obs_ts RANGE BETWEEN INTERVAL {span} PRECEDING AND CURRENT ROW"
    want = hot.selectExpr(
        "key", "obs_ts", f"count(value) OVER ({w})", f"sum(value) OVER ({w})",
        f"avg(value) OVER ({w})", f"min(value) OVER ({w})", f"max(value) OVER ({w})",
    ).distinct()
    a, b = sorted(rows(got)), sorted(rows(want))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:4] == y[:4] and x[5:] == y[5:] and x[4] == pytest.approx(y[4])


@pytest.mark.parametrize("limit,width", [(10**6, 1), (300, 32), (20, 500), (0, 4000)])
def test_rolling_narrows_crowded_slices(spark, hot, limit, width, monkeypatch):
    chosen = []
    real = series.narrowest_needed
    monkeypatch.setattr(series, "narrowest_needed", lambda *a: chosen.append(real(*a)) or chosen[0])
    got = series.rolling(hot, ["key"], "8 days", plain_limit=0, slice_limit=limit)
    assert seconds("8 days") * 1_000_000 // chosen[0] == width
    assert sorted(rows(got)) == sorted(rows(series.rolling(hot, ["key"], "8 days", slices=8)))


@pytest.mark.parametrize("plain", [0, 5000])
def test_rolling_with_nulls(spark, plain):
    df = spark.createDataFrame(
        [(None, T0, None), (None, T0 + timedelta(hours=1), 2.0), (None, T0 + timedelta(hours=9), None)],
        "key string, obs_ts timestamp_ntz, value double",
    )
    got = series.rolling(df, ["key"], "4 hours", plain_limit=plain).orderBy("obs_ts")
    assert rows(got, "roll_count", "roll_sum", "roll_mean", "roll_max") == [
        (0, None, None, None), (1, 2.0, 2.0, 2.0), (0, None, None, None),
    ]
    with pytest.raises(ValueError):
        series.rolling(df, ["key"], "1 second", slices=7)


@pytest.mark.parametrize("limit", [10**6, 1000, 10])
@pytest.mark.parametrize("tolerance", [None, "10 minutes"])
def test_asof_of_a_hot_key(spark, hot, limit, tolerance):
    left, right = hot.where("obs_id % 2 = 0"), hot.where("obs_id % 2 = 1 AND value > 30")
    got = asof.asof_join(left, right, ["key"], right_id="obs_id", tolerance=tolerance, key_limit=limit)
    r = right.select(F.col("key").alias("k"), F.col("obs_ts").alias("t"), F.col("obs_id").alias("rid"))
    best = F.max(F.when(F.col("t") <= F.col("obs_ts"), F.struct("t", "rid")))
    want = left.join(r, left.key == r.k, "left").groupBy("obs_id", "obs_ts").agg(best.alias("b"))
    oldest = seconds(tolerance) if tolerance else 10**9
    age = "timestampdiff(SECOND, b.t, obs_ts)"
    want = want.selectExpr("obs_id", f"CASE WHEN {age} <= {oldest} THEN b.rid END AS rid")
    assert sorted(rows(got, "obs_id", "asof_obs_id"), key=repr) == sorted(rows(want), key=repr)
    assert got.count() == left.count()


@pytest.mark.parametrize("limit", [100, 0])
def test_asof_keeps_left_rows_without_key_or_time(spark, limit):
    left = spark.createDataFrame(
        [(1, None, T0), (2, "a", None), (3, "a", T0)], "id int, key string, obs_ts timestamp_ntz"
    )
    right = spark.createDataFrame([("a", T0, 5.0), (None, T0, 6.0)], "key string, obs_ts timestamp_ntz, v double")
    got = asof.asof_join(left, right, ["key"], key_limit=limit).orderBy("id")
    assert rows(got, "id", "asof_v") == [(1, None), (2, None), (3, 5.0)]


@pytest.mark.parametrize("limit,ranges", [(10, 64), (10, 4096), (500, None), (10**9, None)])
def test_quantiles_of_a_hot_group(spark, hot, limit, ranges):
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    df = hot.withColumn("value", F.when(F.col("obs_id") % 5 > 0, F.col("value") * 1.37))
    df = df.withColumn("key", F.nullif(F.col("key"), F.lit("k3")))
    got = exact_quantiles(df, ["key"], "value", probs, group_limit=limit, ranges=ranges)
    want = df.groupBy("key").agg(*[F.percentile("value", p).alias(c) for c, p in probs.items()])
    a, b = sorted(rows(got), key=repr), sorted(rows(want, *got.columns), key=repr)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[0] == y[0] and x[1:] == pytest.approx(y[1:])


def test_quantiles_when_most_groups_are_large(spark, hot, monkeypatch):
    monkeypatch.setattr(quantiles, "MOST_LARGE", 3)
    got = exact_quantiles(hot, ["key"], "value", {"m": 0.5}, group_limit=10)
    want = hot.groupBy("key").agg(F.median("value").alias("m"))
    assert sorted(rows(got)) == sorted(rows(want))


def test_weighted_quantiles(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 2.0, 1), ("a", 9.0, 4)], "k string, v double, n int")
    for limit in (0, 100):
        got = exact_quantiles(df, ["k"], "v", {"m": 0.5}, "n", limit)
        assert rows(got) == [("a", 5.5)]


def test_small_integers_need_no_measuring(spark):
    df = spark.sql("SELECT 'a' AS k, cast(id % 7 AS smallint) AS v FROM range(100)")
    got = exact_quantiles(df, ["k"], "v", {"m": 0.5}, group_limit=0)
    assert rows(got) == [("a", 3.0)]


def test_group_sizes(spark, hot):
    assert group_sizes(hot, ["key"]) == (12, 2000)


def test_ties_go_to_the_higher_id(spark):
    df = spark.createDataFrame(
        [(1, 1, T0, 5.0), (1, 2, T0, 5.0), (1, 3, T0, None), (2, 4, T0, None)],
        "cell int, obs_id int, obs_ts timestamp_ntz, value double",
    )
    best = composite.best_pixel(df, ["cell"], "value").orderBy("cell")
    assert rows(best, "cell", "obs_id") == [(1, 2), (2, 4)]
    assert rows(composite.mosaic(df, ["cell"]), "cell", "obs_id") == [(1, 2)]


def test_periods_keep_the_time_type(spark):
    df = spark.sql("SELECT timestamp_ntz'1969-12-31 23:00:00' AS obs_ts, 1 AS k, 2D AS value")
    got = composite.temporal_composite(df, ["k"], "2 days", "mean")
    assert dict(got.dtypes)["period_start"] == "timestamp_ntz"
    assert got.first()["period_start"] == datetime(1969, 12, 30)
    assert composite.temporal_composite(df, ["k"], "month", "median").first()["period_start"] == datetime(1969, 12, 1)


@pytest.mark.parametrize("n", [1, 2, 7, 60, 5000])
def test_frames_by_count_equals_ntile(spark, n):
    df = spark.range(150).selectExpr(
        "id", "timestamp_ntz'1969-12-20' + make_dt_interval(cast(id % 50 AS int), 0, 0, 0) AS obs_ts"
    )
    got = frames.frames_by_count(df, n, slice_width="3 days").select("obs_ts", "frame_idx").distinct()
    want = df.select("obs_ts").distinct().withColumn(
        "frame_idx", F.ntile(n).over(Window.orderBy("obs_ts"))
    )
    assert sorted(rows(got)) == sorted(rows(want))


def test_frames_skip_empty_steps_and_delta(spark):
    df = spark.createDataFrame(
        [("a", T0, 1.0), ("a", T0 + timedelta(days=5), 4.0), ("b", T0, None)],
        "cell string, obs_ts timestamp_ntz, value double",
    )
    fr = frames.frames_by_step(df, ["cell"], "1 days", "mean")
    assert sorted(rows(fr, "cell", "frame_idx", "value")) == [("a", 1, 1.0), ("a", 2, 4.0)]
    assert [r["delta"] for r in frames.frame_delta(fr, ["cell"]).orderBy("frame_idx").collect()] == [None, 3.0]


@pytest.mark.parametrize("approx", [False, True])
def test_stretch_clamps_and_survives_flat_groups(spark, approx):
    df = spark.createDataFrame(
        [("a", float(v)) for v in range(101)] + [("flat", 3.0), ("flat", None)], "band string, value double"
    )
    got = frames.stretch(df, ["band"], 0.1, 0.9, approx=approx)
    shades = {r["value"]: r["shade"] for r in got.where("band = 'a'").collect()}
    assert (shades[0.0], shades[10.0], shades[90.0], shades[100.0]) == (0, 0, 255, 255)
    assert shades[50.0] in (127, 128)
    unnamed = df.withColumn("band", F.nullif(F.col("band"), F.lit("a")))
    again = frames.stretch(unnamed, ["band"], 0.1, 0.9, approx=approx).where("band IS NULL")
    assert {r["value"]: r["shade"] for r in again.collect()} == shades
    assert sorted(rows(got.where("band = 'flat'"), "value", "shade"), key=repr) == [(3.0, 0), (None, None)]


def test_anomaly_keeps_every_row(spark, hot):
    got = series.anomaly(hot.withColumn("key", F.nullif(F.col("key"), F.lit("k3"))), ["key"], "hour")
    assert got.count() == hot.count() and got.where("anomaly IS NULL").count() == 0


def test_accumulate(spark):
    df = spark.createDataFrame(
        [(1, T0 + timedelta(minutes=30 * i), 2.0) for i in range(48)] + [(1, T0, None)],
        "cell int, obs_ts timestamp_ntz, value double",
    )
    got = series.accumulate(df, ["cell"], "1 day", hours=0.5)
    assert rows(got) == [(1, T0, 48.0, 48)]
