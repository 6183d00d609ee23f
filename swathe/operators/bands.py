"""Band arithmetic: long to wide, indices, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bands_to_columns(
    df: DataFrame, bands: Sequence[str], keys: Sequence[str],
    band: str = "band", value: str = "value",
) -> DataFrame:
    """One row per key with a column per band (the mean where a band repeats).

    The band list is explicit, so no job runs to discover it and one partially
    aggregated shuffle does the work.
    """
    wanted = list(bands)
    return (
        df.where(F.col(band).isin(wanted))
        .groupBy(*keys)
        .agg(*[F.avg(F.when(F.col(band) == b, F.col(value))).alias(b) for b in wanted])
    )


def columns_to_bands(
    df: DataFrame, bands: Sequence[str], keys: Sequence[str],
    band: str = "band", value: str = "value",
) -> DataFrame:
    """Inverse of :func:`bands_to_columns`; absent bands give no row."""
    long = df.unpivot(list(keys), list(bands), band, value)
    return long.where(F.col(value).isNotNull())


def normalized_difference(df: DataFrame, a: str, b: str, out: str = "nd") -> DataFrame:
    """``(a - b) / (a + b)``; null where the sum is zero or a band is null."""
    return df.withColumn(out, F.try_divide(F.col(a) - F.col(b), F.col(a) + F.col(b)))


def band_math(df: DataFrame, expression: str, out: str = "result") -> DataFrame:
    """Any SQL expression over the band columns."""
    return df.withColumn(out, F.expr(expression))
