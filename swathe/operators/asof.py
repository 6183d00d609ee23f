"""As-of join: the latest earlier right row for each left row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swathe.plans.skew import floor_div, group_sizes, micros, narrowest_needed, seconds


def asof_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], ts: str = "obs_ts",
    right_ts: str | None = None, right_id: str | None = None,
    tolerance: str | None = None, key_limit: int = 5_000_000, prefix: str = "asof_",
) -> DataFrame:
    """Left rows with the columns of the latest right row at or before their
    time and with equal ``by`` columns; nulls where there is none.

    Among right rows of the same key and instant the highest ``right_id``
    wins. ``tolerance`` drops matches older than that. Right columns get
    ``prefix``. Null keys and times match nothing.

    Both sides are sorted together per key and the last right row is carried
    along: one shuffle. If some key has more than ``key_limit`` rows, keys are
    cut into time slices instead, see :func:`_sliced`.
    """
    by = list(by)
    right_ts = right_ts or ts
    payload = [c for c in right.columns if c not in by]
    known = right.where(" AND ".join(f"{c} IS NOT NULL" for c in [*by, right_ts]))
    moments = left.select(*by, F.col(ts).alias("_t")).unionByName(
        known.select(*by, F.col(right_ts).alias("_t"))
    )
    tie = F.struct(F.col(right_id)) if right_id else F.struct(*payload)
    rows = known.select(
        *by, F.col(right_ts).alias("_t"), F.struct(*payload).alias("_row"), tie.alias("_tie")
    )
    if group_sizes(moments, by).largest <= key_limit:
        found = _by_key(left, rows, by, ts)
    else:
        found = _sliced(left, rows, by, ts, moments, key_limit)
    if tolerance is not None:
        age = micros(F.col(ts)) - micros(F.col("_row")[right_ts])
        fresh = age <= F.lit(seconds(tolerance) * 1_000_000)
        found = found.withColumn("_row", F.when(fresh, F.col("_row")))
    return found.select(
        *left.columns, *[F.col("_row")[c].alias(f"{prefix}{c}") for c in payload]
    )


def _by_key(left: DataFrame, rows: DataFrame, by: list[str], ts: str) -> DataFrame:
    """Left rows with ``_row``, resolved by one window per key."""
    none = lambda c: F.lit(None).cast(rows.schema[c].dataType).alias(c)
    asked = left.select(
        *by, F.col(ts).alias("_t"), none("_row"), none("_tie"),
        F.struct(*left.columns).alias("_left"), F.lit(1).alias("_ask"),
    )
    both = asked.unionByName(rows.withColumn("_ask", F.lit(0)), allowMissingColumns=True)
    # At equal instants right rows sort first, so that they are seen.
    so_far = (
        Window.partitionBy(*by).orderBy("_t", "_ask", "_tie")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        both.withColumn("_row", F.last("_row", ignorenulls=True).over(so_far))
        .where("_ask = 1")
        .select("_left.*", "_row")
    )


def _sliced(
    left: DataFrame, rows: DataFrame, by: list[str], ts: str, moments: DataFrame, limit: int
) -> DataFrame:
    """Left rows with ``_row``, without any task receiving a whole key.

    Left rows are reduced to their distinct instants and right rows to one per
    instant, both are cut into time slices, each slice is resolved on its own,
    and the last right row of earlier slices is carried in from a table of one
    row per key and slice. The answers are joined back on key and instant,
    where adaptive execution splits a hot one. A slice is a day, or less if a
    day of one key would hold more than ``limit`` rows.
    """
    widths = [seconds(w) * 1_000_000 for w in ("1 day", "1 hour", "1 minute")]
    timed = moments.where("_t IS NOT NULL")
    width = narrowest_needed(timed, by, micros(F.col("_t")), widths, limit)

    best = rows.groupBy(*by, "_t").agg(F.max_by("_row", "_tie").alias("_row"))
    asked = left.select(*by, F.col(ts).alias("_t")).distinct()
    none = F.lit(None).cast(rows.schema["_row"].dataType).alias("_row")
    both = (
        best.withColumn("_ask", F.lit(0))
        .unionByName(asked.select(*by, "_t", none, F.lit(1).alias("_ask")))
        .withColumn("_slice", floor_div(micros(F.col("_t")), width))
        # Said here once, so that the two uses below stay the same plan and
        # share their shuffles.
        .where(" AND ".join(f"{c} IS NOT NULL" for c in [*by, "_slice"]))
    )
    within = (
        Window.partitionBy(*by, "_slice").orderBy("_t", "_ask")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    answers = both.withColumn("_seen", F.last("_row", ignorenulls=True).over(within)).where("_ask = 1")
    earlier = (
        Window.partitionBy(*by).orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = (
        both.groupBy(*by, "_slice")
        .agg(F.max_by("_row", F.when(F.col("_ask") == 0, F.col("_t"))).alias("_end"))
        .select(
            *by, "_slice",
            F.last("_end", ignorenulls=True).over(earlier).alias("_carried"),
        )
    )
    answers = answers.join(carry, [*by, "_slice"]).select(
        *by, F.col("_t").alias(ts), F.coalesce("_seen", "_carried").alias("_row")
    )
    return left.join(answers, [*by, ts], "left")
