"""Time series per key (usually a grid cell and band)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swathe.plans.sides import join_null_safe
from swathe.plans.skew import floor_div, group_sizes, micros, narrowest_needed, seconds, time_slice

SECONDS_PER_DAY = 86400.0
# Slots of a gap that are written out from one row.
STRETCH = 65_536
# Slots of a calendar up to which a key is one window, and of a piece of a longer one.
PLAIN_SLOTS, PIECE_SLOTS = 5_000_000, 1_000_000


def accumulate(
    df: DataFrame, keys: Sequence[str], period: str, rate: str = "value",
    hours: float = 1.0, ts: str = "obs_ts", out: str = "total",
) -> DataFrame:
    """Total per key and fixed-length period of a rate per hour that holds for
    ``hours`` each row. Use ``hours=1`` when the column is already an amount.

    Works on a stream too, after a watermark on ``ts``.
    """
    span = F.window(ts, period)
    return (
        df.groupBy(*keys, span)
        .agg(F.sum(F.col(rate) * F.lit(float(hours))).alias(out), F.count(rate).alias("n"))
        .select(*keys, F.col("window.start").alias("period_start"), out, "n")
    )


def calendar_part(ts: Column | str, part: str) -> Column:
    """``month``, ``season`` (1 = December to February), ``dayofweek`` (1 = Sunday), ``dayofyear`` or ``hour``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    parts = {"month": F.month, "dayofweek": F.dayofweek, "dayofyear": F.dayofyear, "hour": F.hour}
    if part == "season":
        return F.floor(F.month(c) % 12 / 3).cast("int") + 1
    return parts[part](c)


def climatology(
    df: DataFrame, keys: Sequence[str], part: str, value: str = "value", ts: str = "obs_ts"
) -> DataFrame:
    """Long-term mean, sample standard deviation and count per key and
    calendar part."""
    return df.groupBy(*keys, calendar_part(ts, part).alias(part)).agg(
        F.avg(value).alias("clim_mean"),
        F.stddev_samp(value).alias("clim_std"),
        F.count(value).alias("clim_n"),
    )


def anomaly(
    df: DataFrame, keys: Sequence[str], part: str, value: str = "value", ts: str = "obs_ts"
) -> DataFrame:
    """Difference from the climatology of the same rows, and z-score.

    An aggregate joined back instead of a window: the aggregate combines
    before its shuffle and adaptive execution can split a hot key in the join,
    where a window would hold the whole key in one task.
    """
    clim = climatology(df, keys, part, value, ts).drop("clim_n")
    rows = df.withColumn(part, calendar_part(ts, part))
    diff = F.col(value) - F.col("clim_mean")
    return (
        join_null_safe(rows, clim, [*keys, part], "left")
        .withColumn("anomaly", diff)
        .withColumn("zscore", F.try_divide(diff, F.col("clim_std")))
    )


def trend(
    df: DataFrame, keys: Sequence[str], value: str = "value", ts: str = "obs_ts",
    origin: str = "2000-01-01",
) -> DataFrame:
    """Least-squares slope per day, correlation with time, and count per key.

    Time is counted from ``origin`` so that the sums stay small.
    """
    day = (
        F.col(ts).cast("timestamp").cast("double")
        - F.lit(origin).cast("timestamp").cast("double")
    ) / F.lit(SECONDS_PER_DAY)
    return (
        df.withColumn("_day", day)
        .groupBy(*keys)
        .agg(
            F.regr_slope(F.col(value), F.col("_day")).alias("slope_per_day"),
            F.corr(value, "_day").alias("correlation"),
            F.count(value).alias("n"),
        )
    )


def rolling(
    df: DataFrame, keys: Sequence[str], span: str, value: str = "value", ts: str = "obs_ts",
    slices: int | None = None, plain_limit: int = 5_000, slice_limit: int = 5_000_000,
) -> DataFrame:
    """Trailing count, sum, mean, min and max over ``[t - span, t]``.

    One row per key and instant: rows of the same key and instant share one
    window and are combined first.

    While no key has more than ``plain_limit`` rows this is a window over the
    key. Such a window visits a whole span of rows for each row, and puts a hot
    key into one task, so larger keys are cut into time slices one span long:
    the window of an instant is then the tail of the slice before its own and
    the head of its own, two running aggregates. If a slice of some key would
    hold more than ``slice_limit`` rows the span is cut into more ``slices``,
    and the whole slices between tail and head are added from a table of one
    row per key and slice.
    """
    keys = list(keys)
    length = seconds(span) * 1_000_000
    us = micros(F.col(ts))
    timed = df.where(F.col(ts).isNotNull())
    partial = [
        F.count(value).alias("_n"), F.sum(value).alias("_s"),
        F.min(value).alias("_lo"), F.max(value).alias("_hi"),
    ]
    if slices is None:
        if group_sizes(timed, keys).largest <= plain_limit:
            span_back = Window.partitionBy(*keys).orderBy("_us").rangeBetween(-length, 0)
            instants = timed.groupBy(*keys, ts).agg(*partial).withColumn("_us", us)
            n, s = F.sum("_n").over(span_back), F.sum("_s").over(span_back)
            return instants.select(
                *keys, ts, n.alias("roll_count"), s.alias("roll_sum"),
                F.try_divide(s, n).alias("roll_mean"),
                F.min("_lo").over(span_back).alias("roll_min"),
                F.max("_hi").over(span_back).alias("roll_max"),
            )
        # Numbers of slices that divide a second's microseconds.
        widths = [length // n for n in (1, 32, 500, 4000)]
        slices = length // narrowest_needed(timed, keys, us, widths, slice_limit)
    width = length // slices
    if width * slices != length:
        raise ValueError("slices must divide the span")
    parts = [("_n", F.sum), ("_s", F.sum), ("_lo", F.min), ("_hi", F.max)]
    names = [c for c, _ in parts]

    sliced = timed.withColumn("_slice", floor_div(us, width))
    instants = sliced.groupBy(*keys, "_slice", ts).agg(*partial)

    # Every instant is written twice: as data, and as a question to the slice
    # one span earlier, about what lies at or after its own offset there.
    data = F.col("_ask") == 0
    rows = (
        instants.withColumn("_off", F.pmod(us, F.lit(width)))
        .withColumn("_ask", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("_slice", F.col("_slice") - F.col("_ask") * slices)
        .withColumns({c: F.when(data, F.col(c)) for c in names})
    )
    in_slice = Window.partitionBy(*keys, "_slice")
    to_here = in_slice.orderBy("_off").rowsBetween(Window.unboundedPreceding, 0)
    # At equal offsets data sorts before questions.
    from_here = in_slice.orderBy(F.desc("_off"), "_ask").rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.select(
        *keys, ts, "_slice", "_ask",
        *[F.when(data, f(c).over(to_here)).otherwise(f(c).over(from_here)).alias(c) for c, f in parts],
    )

    if slices > 1:
        # Whole slices between, one row per key and slice.
        whole = sliced.groupBy(*keys, "_slice").agg(*partial)
        between = Window.partitionBy(*keys).orderBy("_slice").rangeBetween(-(slices - 1), -1)
        whole = whole.select(
            *keys, "_slice", *[f(c).over(between).alias(f"_mid{c}") for c, f in parts]
        )
        ends = join_null_safe(ends, whole, [*keys, "_slice"], "left")
    else:
        ends = ends.withColumns({f"_mid{c}": F.lit(None).cast(ends.schema[c].dataType) for c in names})
    merged = ends.groupBy(*keys, ts).agg(
        *[f(c).alias(f"_end{c}") for c, f in parts],
        *[f(F.when(data, F.col(f"_mid{c}"))).alias(f"_mid{c}") for c, f in parts],
    )
    nothing = F.lit(0)
    count = F.coalesce(F.col("_end_n"), nothing) + F.coalesce(F.col("_mid_n"), nothing)
    total = F.when(
        count > 0, F.coalesce(F.col("_end_s"), nothing) + F.coalesce(F.col("_mid_s"), nothing)
    )
    return merged.select(
        *keys, ts, count.alias("roll_count"), total.alias("roll_sum"),
        F.try_divide(total, count).alias("roll_mean"),
        F.least("_end_lo", "_mid_lo").alias("roll_min"),
        F.greatest("_end_hi", "_mid_hi").alias("roll_max"),
    )


def gap_fill(
    df: DataFrame, keys: Sequence[str], step: str, method: str = "carry",
    value: str = "value", ts: str = "obs_ts",
) -> DataFrame:
    """Regular series per key: the mean per ``step`` slot, and every empty
    slot between a key's first and last one filled.

    ``carry`` repeats the last value, ``linear`` interpolates, ``null`` leaves
    the new slots empty. Column ``filled`` marks new slots. After the mean a
    key holds at most one row per slot. While the calendar has at most
    ``PLAIN_SLOTS`` slots a key is one window; a longer one is cut into pieces,
    and the last slot of a piece looks up the first of the key's next piece.
    Each slot writes out the gap behind it, so no calendar table is built.
    """
    if method not in ("carry", "linear", "null"):
        raise ValueError(f"unknown method {method!r}")
    keys = list(keys)
    width = F.lit(seconds(step) * 1_000_000)
    slot = time_slice(F.col(ts), step)
    slots = (
        df.where(F.col(value).isNotNull() & F.col(ts).isNotNull())
        .groupBy(*keys, slot.alias("_slot"))
        .agg(F.avg(value).alias("_v"))
    )
    first, last = df.where(F.col(value).isNotNull()).agg(F.min(slot), F.max(slot)).first()
    ahead = _with_next(slots, keys, first is not None and last - first > PLAIN_SLOTS)
    nxt, gap = F.col("_next"), F.col("_gap")
    # A gap may be longer than one row's array should be: first its stretches, then the slots of each.
    longest = F.coalesce(nxt - F.col("_slot") - 1, F.lit(0))
    stretch = F.col("_stretch") * STRETCH
    ahead = (
        ahead.withColumn("_stretch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(longest / STRETCH))))
        .withColumn("_gap", F.explode(F.sequence(stretch, F.least(stretch + (STRETCH - 1), longest))))
    )
    share = gap / (nxt - F.col("_slot"))
    fill = {
        "carry": F.col("_v"),
        "linear": F.col("_v") + (F.col("_next_v") - F.col("_v")) * share,
        "null": F.lit(None).cast("double"),
    }[method]
    when = F.timestamp_micros((F.col("_slot") + gap) * width).cast(df.schema[ts].dataType)
    return ahead.select(
        *keys, when.alias(ts),
        F.when(gap == 0, F.col("_v")).otherwise(fill).alias(value),
        (gap > 0).alias("filled"),
    )


def _with_next(slots: DataFrame, keys: list[str], pieces: bool) -> DataFrame:
    """``_next`` and ``_next_v``: slot and value of the key's next slot."""
    if not pieces:
        series = Window.partitionBy(*keys).orderBy("_slot")
        return slots.withColumn("_next", F.lead("_slot").over(series)).withColumn("_next_v", F.lead("_v").over(series))
    cut = slots.withColumn("_piece", floor_div(F.col("_slot"), PIECE_SLOTS))
    inside = Window.partitionBy(*keys, "_piece").orderBy("_slot")
    after = F.lead("_first").over(Window.partitionBy(*keys).orderBy("_piece"))
    firsts = cut.groupBy(*keys, "_piece").agg(F.min(F.struct("_slot", "_v")).alias("_first"))
    later = firsts.select(*keys, "_piece", after.alias("_later"))
    led = cut.withColumn("_follow", F.lead(F.struct("_slot", "_v")).over(inside))
    joined = join_null_safe(led, later, [*keys, "_piece"]).withColumn("_follow", F.coalesce("_follow", "_later"))
    return joined.select(*keys, "_slot", "_v", F.col("_follow._slot").alias("_next"), F.col("_follow._v").alias("_next_v"))
