"""Seasonal curves fitted per key, and the first break from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swathe.plans.sides import join_null_safe
from swathe.plans.skew import floor_div, micros

_DAY = 86_400_000_000
# Fixed value: 5 % point of the greatest excursion of a Brownian bridge.
BRIDGE_5_PERCENT = 1.3581015157406195


def _features(at: Column, harmonics: int, period_days: float, with_trend: bool) -> dict[str, Column]:
    """Columns of the regression by name; ``at`` is a time in periods."""
    out = {"mean": F.lit(1.0)}
    if with_trend:
        out["trend"] = at
    for k in range(1, harmonics + 1):
        turn = at * F.lit(2 * k) * F.pi()
        out |= {f"cos{k}": F.cos(turn), f"sin{k}": F.sin(turn)}
    return out


def _periods(ts: Column, period_days: float, origin: str) -> Column:
    since = micros(ts) - micros(F.lit(origin).cast("timestamp_ntz"))
    return since / F.lit(period_days * _DAY)


def harmonic_fit(
    df: DataFrame, keys: Sequence[str], harmonics: int = 2, period_days: float = 365.25, with_trend: bool = True,
    value: str = "value", ts: str = "obs_ts", origin: str = "2000-01-01",
) -> DataFrame:
    """One row per key: ``n``, the least-squares coefficients ``mean``, ``trend`` (per
    period) and ``cos1, sin1, ...`` of a curve with so many ``harmonics`` of the
    period, and ``rmse``.

    The sums of products of all columns are one fixed-size aggregate, combined
    before its shuffle, so a key may hold any share of the rows. They are solved in
    column expressions by Cholesky's method. Coefficients are null for a key with
    fewer values than coefficients, or whose times do not tell them apart. Null and
    NaN values and null times take no part. ``origin`` is where the time of the
    trend starts; choose it near the data.
    """
    if harmonics < 0 or not period_days > 0:
        raise ValueError("harmonics must not be below 0, and period_days above 0")
    keys, v = list(keys), F.col(value).cast("double")
    known = df.where(v.isNotNull() & ~F.isnan(v) & F.col(ts).isNotNull())
    names = list(_features(F.lit(0.0), harmonics, period_days, with_trend))
    x = _features(F.col("_at"), harmonics, period_days, with_trend)
    rows = known.select(*keys, v.alias("_y"), _periods(F.col(ts), period_days, origin).alias("_at"))
    rows = rows.select(*keys, "_y", *(c.alias(f"_x{i}") for i, c in enumerate(x.values())))
    p = len(names)
    products = [F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_a{i}_{j}") for i in range(p) for j in range(i + 1)]
    sides = [F.sum(F.col(f"_x{i}") * F.col("_y")).alias(f"_b{i}") for i in range(p)]
    sums = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_y") * F.col("_y")).alias("_yy"), *products, *sides)
    solved = _solved(sums, p)
    # The squared rest is what the sum of squares keeps after the explained part.
    explained = sum((F.col(f"_w{i}") * F.col(f"_b{i}") for i in range(p)), F.lit(0.0))
    rest = F.when(explained.isNotNull(), F.greatest(F.col("_yy") - explained, F.lit(0.0)))
    return solved.select(*keys, "n", *(F.col(f"_w{i}").alias(c) for i, c in enumerate(names)), F.sqrt(rest / F.col("n")).alias("rmse"))


def _solved(sums: DataFrame, p: int) -> DataFrame:
    """``sums`` with the solution ``_w0, _w1, ...`` of its normal equations, null where there is none."""
    out = sums
    for j in range(p):
        inner = sum((F.col(f"_l{j}_{k}") * F.col(f"_l{j}_{k}") for k in range(j)), F.lit(0.0))
        left = F.col(f"_a{j}_{j}") - inner
        # A pivot that rounding may have made is no pivot.
        out = _with(out, {f"_l{j}_{j}": F.when((F.col("n") >= p) & (left > F.col(f"_a{j}_{j}") * 1e-12), F.sqrt(left))})
        below = {
            f"_l{i}_{j}": (F.col(f"_a{i}_{j}") - sum((F.col(f"_l{i}_{k}") * F.col(f"_l{j}_{k}") for k in range(j)), F.lit(0.0))) / F.col(f"_l{j}_{j}")
            for i in range(j + 1, p)
        }
        out = _with(out, below) if below else out
    for i in range(p):
        inner = sum((F.col(f"_l{i}_{k}") * F.col(f"_z{k}") for k in range(i)), F.lit(0.0))
        out = _with(out, {f"_z{i}": (F.col(f"_b{i}") - inner) / F.col(f"_l{i}_{i}")})
    for i in reversed(range(p)):
        inner = sum((F.col(f"_l{k}_{i}") * F.col(f"_w{k}") for k in range(i + 1, p)), F.lit(0.0))
        out = _with(out, {f"_w{i}": (F.col(f"_z{i}") - inner) / F.col(f"_l{i}_{i}")})
    return out


def _with(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with columns that the optimizer does not put into each other: the steps
    of a solution name earlier ones so often that one expression of them all would
    be too large to plan."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))


def harmonic_residuals(
    df: DataFrame, fit: DataFrame, keys: Sequence[str], period_days: float = 365.25,
    value: str = "value", ts: str = "obs_ts", origin: str = "2000-01-01",
) -> DataFrame:
    """Rows with ``fitted`` and ``residual`` from coefficients of :func:`harmonic_fit`; null where there are none."""
    harmonics = sum(c.startswith("cos") and c[3:].isdigit() for c in fit.columns)
    x = _features(_periods(F.col(ts), period_days, origin), harmonics, period_days, "trend" in fit.columns)
    curve = sum((F.col(f"_fit_{c}") * e for c, e in x.items()), F.lit(0.0))
    named = fit.select(*keys, *(F.col(c).alias(f"_fit_{c}") for c in x))
    joined = join_null_safe(df, named, list(keys), "left")
    return joined.withColumn("fitted", curve).withColumn("residual", F.col(value) - F.col("fitted")).select(*df.columns, "fitted", "residual")


def first_break(
    df: DataFrame, keys: Sequence[str], harmonics: int = 2, period_days: float = 365.25, with_trend: bool = True,
    value: str = "value", ts: str = "obs_ts", origin: str = "2000-01-01", critical: float = BRIDGE_5_PERCENT,
) -> DataFrame:
    """One row per key with a fit: ``n``, ``excursion`` and ``break_ts``.

    The residuals of the fitted curve are added up in time order and divided by
    their root mean square times the root of their number. ``excursion`` is the
    greatest absolute value of that sum, and ``break_ts`` the first time at which it
    is above ``critical``, null if it never is. Values of one instant count
    together. Sums run inside days and over the sums of earlier days, so no task
    holds a whole key.
    """
    keys = list(keys)
    fit = harmonic_fit(df, keys, harmonics, period_days, with_trend, value, ts, origin)
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & F.col(ts).isNotNull())
    rests = harmonic_residuals(known, fit.where("rmse IS NOT NULL"), keys, period_days, value, ts, origin).where("residual IS NOT NULL")
    instants = rests.groupBy(*keys, F.col(ts).alias("_ts")).agg(F.sum("residual").alias("_e"))
    instants = instants.withColumn("_day", floor_div(micros(F.col("_ts")), _DAY))
    days = instants.groupBy(*keys, "_day").agg(F.sum("_e").alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    before = days.select(*keys, "_day", F.coalesce(F.sum("_sum").over(earlier), F.lit(0.0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_day").orderBy("_ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = instants.withColumn("_run", F.sum("_e").over(inside))
    summed = join_null_safe(summed, before, [*keys, "_day"])
    scaled = join_null_safe(summed, fit.select(*keys, "n", "rmse"), keys)
    level = F.abs(F.try_divide(F.col("_before") + F.col("_run"), F.col("rmse") * F.sqrt("n")))
    return scaled.withColumn("_level", level).groupBy(*keys).agg(
        F.first("n").alias("n"), F.max("_level").alias("excursion"), F.min(F.when(F.col("_level") > critical, F.col("_ts"))).alias("break_ts"),
    )
