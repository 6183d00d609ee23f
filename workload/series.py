"""Per-key time series, as-of join and timelapse frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from swathe.operators import asof, frames, harmonic, series
from swathe.plans.timelapse import timelapse
from workload.fixtures import OBS, observations, rounded

KEYS = ["station_id", "band"]


def accumulate(spark, sf):
    got = series.accumulate(observations(spark, sf), ["iy"], "1 day", hours=0.5)
    return rounded(got, "total")


ACCUMULATE = f"""WITH {OBS} SELECT iy, date_trunc('day', obs_ts)::TIMESTAMP AS period_start,
  round(sum(value * 0.5), 6) AS total, count(value) AS n FROM obs GROUP BY 1, 2"""


def climatology(part):
    def query(spark, sf):
        return rounded(
            series.climatology(observations(spark, sf), KEYS, part), "clim_mean", "clim_std"
        )

    return query


def _climatology_sql(part, expr):
    return f"""WITH {OBS} SELECT station_id, band, CAST({expr} AS INT) AS {part},
  round(avg(value), 6) AS clim_mean, round(stddev_samp(value), 6) AS clim_std,
  count(value) AS clim_n FROM obs GROUP BY 1, 2, 3"""


def anomaly(spark, sf):
    got = series.anomaly(observations(spark, sf), KEYS, "dayofweek")
    return rounded(got.select("obs_id", "dayofweek", "anomaly", "zscore"), "anomaly", "zscore")


ANOMALY = f"""WITH {OBS}, c AS (SELECT *, CAST(dayofweek(obs_ts) + 1 AS INT) AS dow FROM obs),
w AS (SELECT obs_id, dow, value - avg(value) OVER p AS d, stddev_samp(value) OVER p AS s FROM c
  WINDOW p AS (PARTITION BY station_id, band, dow))
SELECT obs_id, dow AS dayofweek, round(d, 6) AS anomaly, round(d / nullif(s, 0), 6) AS zscore FROM w"""


def trend(spark, sf):
    got = series.trend(observations(spark, sf), KEYS, origin="2024-01-01")
    return rounded(got, "slope_per_day", "correlation")


TREND = f"""WITH {OBS}, d AS (SELECT *, epoch_us(obs_ts) / 86400e6 - 19723 AS day FROM obs)
SELECT station_id, band, CASE WHEN count(*) > 1 THEN round(regr_slope(value, day), 6) END AS slope_per_day,
  CASE WHEN count(*) > 1 THEN round(corr(value, day), 6) END AS correlation, count(value) AS n FROM d GROUP BY 1, 2"""


def rolling(spark, sf):
    got = series.rolling(observations(spark, sf), KEYS, "7 days")
    return rounded(got, "roll_sum", "roll_mean")


def rolling_sliced(spark, sf):
    """The same through time slices, as keys too large for one task are."""
    got = series.rolling(observations(spark, sf), KEYS, "7 days", slices=32)
    return rounded(got, "roll_sum", "roll_mean")


def rolling_hot(spark, sf):
    """One key for all rows: a day's window over the whole table."""
    one = observations(spark, sf).withColumn("all_bands", F.lit("all"))
    # Nine places: a mean of 128 two-decimal values can end in 5 at the seventh.
    means = rounded(series.rolling(one, ["all_bands"], "1 day"), "roll_mean", places=9)
    return rounded(means, "roll_sum")


def _rolling_sql(keys, span, places=6):
    over = f"(PARTITION BY {keys} ORDER BY obs_ts RANGE BETWEEN INTERVAL {span} PRECEDING AND CURRENT ROW)"
    return f"""SELECT DISTINCT {keys}, obs_ts, count(value) OVER w AS roll_count,
  round(sum(value) OVER w, 6) AS roll_sum, round(avg(value) OVER w, {places}) AS roll_mean,
  min(value) OVER w AS roll_min, max(value) OVER w AS roll_max FROM obs WINDOW w AS {over}"""


def gap_fill(method):
    def query(spark, sf):
        return rounded(series.gap_fill(observations(spark, sf), KEYS, "6 hours", method), "value", places=9)

    return query


SLOT = 6 * 3600 * 1_000_000


def _gap_sql(fill):
    return f"""WITH {OBS}, s AS (SELECT station_id, band, epoch_us(obs_ts) // {SLOT} AS slot, avg(value) AS v
    FROM obs GROUP BY 1, 2, 3),
  cal AS (SELECT station_id, band, unnest(generate_series(min(slot), max(slot))) AS slot FROM s GROUP BY 1, 2),
  j AS (SELECT station_id, band, slot, v,
      last_value(v IGNORE NULLS) OVER a AS v0, last_value(CASE WHEN v IS NOT NULL THEN slot END IGNORE NULLS) OVER a AS s0,
      first_value(v IGNORE NULLS) OVER b AS v1, first_value(CASE WHEN v IS NOT NULL THEN slot END IGNORE NULLS) OVER b AS s1
    FROM cal LEFT JOIN s USING (station_id, band, slot)
    WINDOW a AS (PARTITION BY station_id, band ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      b AS (PARTITION BY station_id, band ORDER BY slot ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT station_id, band, make_timestamp(slot * {SLOT}) AS obs_ts,
  round(CASE WHEN v IS NOT NULL THEN v ELSE {fill} END, 9) AS value, v IS NULL AS filled FROM j"""


def asof_join(tolerance, key_limit=5_000_000):
    def query(spark, sf):
        obs = observations(spark, sf)
        left = obs.where("band = 'click'").select("obs_id", "obs_ts", "station_id", "value")
        right = obs.where("band <> 'click'").select("obs_id", "obs_ts", "station_id", "value")
        got = asof.asof_join(left, right, ["station_id"], right_id="obs_id", tolerance=tolerance, key_limit=key_limit)
        return got.select("obs_id", "obs_ts", "station_id", "asof_obs_id", "asof_obs_ts", "asof_value")

    return query


def _asof_sql(keep):
    fresh = lambda c: f"CASE WHEN {keep} THEN r.{c} END AS asof_{c}"
    return f"""WITH {OBS}, l AS (SELECT * FROM obs WHERE band = 'click'),
  r AS (SELECT * FROM obs WHERE band <> 'click')
SELECT l.obs_id, l.obs_ts, l.station_id, {fresh('obs_id')}, {fresh('obs_ts')}, {fresh('value')}
FROM l ASOF LEFT JOIN r ON l.station_id = r.station_id AND l.obs_ts >= r.obs_ts"""


def frames_by_step(spark, sf):
    return rounded(
        frames.frames_by_step(observations(spark, sf), ["band", "iy"], "7 days"), "value"
    )


WEEK = "make_timestamp((epoch_us(obs_ts) // 604800000000) * 604800000000)"
FRAMES = f"""f AS (SELECT band, iy, {WEEK} AS frame_ts, median(value) AS value FROM obs GROUP BY 1, 2, 3),
  g AS (SELECT *, CAST(dense_rank() OVER (ORDER BY frame_ts) AS INT) AS frame_idx FROM f)"""
FRAMES_BY_STEP = f"""WITH {OBS}, {FRAMES}
SELECT band, iy, frame_idx, frame_ts, round(value, 6) AS value FROM g"""


def frames_by_count(spark, sf):
    got = frames.frames_by_count(observations(spark, sf), 12)
    return got.select("obs_id", "obs_ts", "frame_idx")


FRAMES_BY_COUNT = f"""WITH {OBS}, t AS (SELECT obs_ts, CAST(ntile(12) OVER (ORDER BY obs_ts) AS INT) AS frame_idx
  FROM (SELECT DISTINCT obs_ts FROM obs))
SELECT obs_id, obs_ts, frame_idx FROM obs JOIN t USING (obs_ts)"""


def frames_by_count_many(spark, sf):
    """More frames than most tables have instants."""
    got = frames.frames_by_count(observations(spark, sf), 20_000)
    return got.select("obs_id", "obs_ts", "frame_idx")


def frames_by_count_crowded(spark, sf):
    """Every instant in one minute, and a frame for every second one of 10,000."""
    crowded = observations(spark, sf).withColumn("obs_ts", F.expr(f"TIMESTAMP_NTZ '2024-05-01 00:00:00' + {CROWDED}"))
    return frames.frames_by_count(crowded, 5_000).select("obs_id", "frame_idx")


CROWDED = "make_dt_interval(0, 0, 0, (obs_id * 7919 % 50000000) / 1000000)"
FRAMES_CROWDED = f"""WITH {OBS}, t AS (SELECT k, CAST(ntile(5000) OVER (ORDER BY k) AS INT) AS frame_idx
  FROM (SELECT DISTINCT obs_id * 7919 % 50000000 AS k FROM obs))
SELECT obs_id, frame_idx FROM obs JOIN t ON k = obs_id * 7919 % 50000000"""


def frame_delta(spark, sf):
    fr = frames.frames_by_step(observations(spark, sf), ["band", "iy"], "7 days", "mean")
    return rounded(frames.frame_delta(fr, ["band", "iy"]), "value", "previous", "delta")


FRAME_DELTA = f"""WITH {OBS}, {FRAMES.replace('median(', 'avg(')}, d AS (
  SELECT *, lag(value) OVER (PARTITION BY band, iy ORDER BY frame_idx) AS previous FROM g)
SELECT band, iy, frame_idx, frame_ts, round(value, 6) AS value, round(previous, 6) AS previous,
  round(value - previous, 6) AS delta FROM d"""


def stretch(spark, sf):
    return frames.stretch(observations(spark, sf), ["band"]).select("obs_id", "shade")


SHADE = "CAST(round(least(greatest((value - lo) / nullif(hi - lo, 0), 0), 1) * 255) AS INT)"
STRETCH = f"""WITH {OBS}, q AS (SELECT band, quantile_cont(value, 0.02) AS lo,
  quantile_cont(value, 0.98) AS hi FROM obs GROUP BY band)
SELECT obs_id, {SHADE} AS shade FROM obs JOIN q USING (band)"""


def timelapse_table(spark, sf):
    got = timelapse(
        observations(spark, sf), ["band", "iy"], "7 days", qa_field=(0, 1), qa_allowed=[0], label="yyyy-MM-dd"
    )
    return rounded(got, "value")


TIMELAPSE = f"""WITH {OBS.replace('obs AS', 'raw AS')}, obs AS (SELECT * FROM raw WHERE (qa & 1) = 0), {FRAMES},
  q AS (SELECT frame_idx, quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.98) AS hi FROM g GROUP BY 1)
SELECT band, iy, frame_idx, frame_ts, round(value, 6) AS value, coalesce({SHADE}, 0) AS shade,
  strftime(frame_ts, '%Y-%m-%d') AS label FROM g JOIN q USING (frame_idx)"""

WEEKLY = {"harmonics": 1, "period_days": 7.0, "with_trend": False, "origin": "2024-01-01"}


def harmonic_fit(spark, sf):
    obs = observations(spark, sf).withColumn("station_id", F.col("station_id") % 12)
    got = harmonic.harmonic_fit(obs, KEYS, **WEEKLY)
    return rounded(got, "mean", "cos1", "sin1", "rmse")


# Cramer's rule for mean, cosine and sine; keys with fewer than three values have no fit.
HARMONIC = f"""x AS (
  SELECT station_id % 12 AS station_id, band, obs_ts, value AS y, cos(2 * pi() * turn) AS c, sin(2 * pi() * turn) AS s
  FROM (SELECT *, (epoch_us(obs_ts) - epoch_us(TIMESTAMP '2024-01-01')) / 604800000000::DOUBLE AS turn FROM obs) WHERE y IS NOT NULL),
m AS (SELECT station_id, band, count(*) AS n, sum(c) AS c, sum(s) AS s, sum(c * c) AS cc, sum(c * s) AS cs, sum(s * s) AS ss,
    sum(y) AS y, sum(y * c) AS yc, sum(y * s) AS ys FROM x GROUP BY station_id, band),
d AS (SELECT *, n * (cc * ss - cs * cs) - c * (c * ss - cs * s) + s * (c * cs - cc * s) AS det FROM m),
w AS (SELECT station_id, band, n, CASE WHEN n >= 3 THEN (y * (cc * ss - cs * cs) - c * (yc * ss - cs * ys) + s * (yc * cs - cc * ys)) / det END AS mean,
    CASE WHEN n >= 3 THEN (n * (yc * ss - cs * ys) - y * (c * ss - cs * s) + s * (c * ys - yc * s)) / det END AS cos1,
    CASE WHEN n >= 3 THEN (n * (cc * ys - yc * cs) - c * (c * ys - yc * s) + y * (c * cs - cc * s)) / det END AS sin1 FROM d),
e AS (SELECT x.*, n, y - mean - cos1 * x.c - sin1 * x.s AS e FROM x JOIN w USING (station_id, band)),
r AS (SELECT station_id, band, sqrt(sum(e * e) / count(*)) AS rmse FROM e GROUP BY station_id, band)"""


def first_break(spark, sf):
    got = harmonic.first_break(observations(spark, sf), ["band"], critical=1.0, **WEEKLY)
    return rounded(got, "excursion")


FIRST_BREAK = f"""WITH {OBS}, {HARMONIC.replace("station_id % 12 AS station_id, ", "").replace("station_id, ", "")},
i AS (SELECT band, obs_ts, any_value(n) AS n, sum(e) AS e FROM e GROUP BY band, obs_ts),
l AS (SELECT *, abs(sum(e) OVER (PARTITION BY band ORDER BY obs_ts)) / (rmse * sqrt(n)) AS level FROM i JOIN r USING (band))
SELECT band, any_value(n) AS n, round(max(level), 6) AS excursion, min(obs_ts) FILTER (level > 1.0) AS break_ts FROM l GROUP BY band"""

QUERIES = {
    "harmonic_fit": (
        harmonic_fit,
        f"""WITH {OBS}, {HARMONIC} SELECT station_id, band, n, round(mean, 6) AS mean, round(cos1, 6) AS cos1, round(sin1, 6) AS sin1,
  round(rmse, 6) AS rmse FROM w LEFT JOIN r USING (station_id, band)""",
    ),
    "first_break": (first_break, FIRST_BREAK),
    "accumulate": (accumulate, ACCUMULATE),
    "climatology_dayofweek": (
        climatology("dayofweek"), _climatology_sql("dayofweek", "dayofweek(obs_ts) + 1")
    ),
    "climatology_month": (climatology("month"), _climatology_sql("month", "month(obs_ts)")),
    "climatology_season": (
        climatology("season"), _climatology_sql("season", "month(obs_ts) % 12 // 3 + 1")
    ),
    "anomaly": (anomaly, ANOMALY),
    "trend": (trend, TREND),
    "rolling": (rolling, f"WITH {OBS} " + _rolling_sql("station_id, band", "7 DAY")),
    "rolling_sliced": (rolling_sliced, f"WITH {OBS} " + _rolling_sql("station_id, band", "7 DAY")),
    "rolling_hot": (
        rolling_hot,
        f"WITH {OBS.replace('obs AS', 'raw AS')}, obs AS (SELECT 'all' AS all_bands, * FROM raw) "
        + _rolling_sql("all_bands", "1 DAY", 9),
    ),
    "gap_fill_carry": (gap_fill("carry"), _gap_sql("v0")),
    "gap_fill_linear": (
        gap_fill("linear"), _gap_sql("v0 + (v1 - v0) * (slot - s0)::DOUBLE / (s1 - s0)")
    ),
    "asof_join": (asof_join(None), _asof_sql("true")),
    "asof_join_tolerance": (
        asof_join("36 hours"), _asof_sql("l.obs_ts - r.obs_ts <= INTERVAL 36 HOUR")
    ),
    # As keys too large for one task are joined.
    "asof_join_sliced": (asof_join(None, key_limit=10), _asof_sql("true")),
    "frames_by_step": (frames_by_step, FRAMES_BY_STEP),
    "frames_by_count": (frames_by_count, FRAMES_BY_COUNT),
    "frames_by_count_crowded": (frames_by_count_crowded, FRAMES_CROWDED),
    "frames_by_count_many": (frames_by_count_many, FRAMES_BY_COUNT.replace("ntile(12)", "ntile(20000)")),
    "frame_delta": (frame_delta, FRAME_DELTA),
    "stretch": (stretch, STRETCH),
    "timelapse": (timelapse_table, TIMELAPSE),
}
