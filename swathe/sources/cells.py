"""Long cell tables: one row per observation of a grid cell in a band."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swathe.functions.grid import hilbert_key
from swathe.operators.filters import bbox_filter, time_filter


def scan_cells(
    spark: SparkSession, path: str, bands: Sequence[str] | None = None,
    start: str | None = None, end: str | None = None,
    bbox: tuple[float, float, float, float] | None = None, ts: str = "obs_ts",
) -> DataFrame:
    """Cells written by :func:`write_cells`.

    Bands and dates prune directories, the exact period and the box are pushed
    into the Parquet scan, and row groups are clustered so that the box skips
    most of them. The period is half open.
    """
    # Directory names would be read as numbers where they look like it: band 04 as 4.
    found = spark.read.parquet(path).schema
    kinds = {"band": T.StringType(), "obs_date": T.DateType()}
    schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in found])
    df = spark.read.schema(schema).parquet(path)
    if bands is not None:
        df = df.where(F.col("band").isin(list(bands)))
    if start is not None:
        df = df.where(F.col("obs_date") >= F.lit(start).cast("date"))
    if end is not None:
        last = F.lit(end).cast("timestamp_ntz") - F.expr("INTERVAL '0.000001' SECOND")
        df = df.where(F.col("obs_date") <= last.cast("date"))
    df = time_filter(df, start, end, ts)
    return df if bbox is None else bbox_filter(df, *bbox)


def write_cells(
    df: DataFrame, path: str, files: int | None = None, bytes_per_file: int = 512 << 20,
    mode: str = "errorifexists", ts: str = "obs_ts", curve: bool = True,
) -> None:
    """Write cells partitioned by band and date, clustered by place inside.

    A null band comes back as null; the empty band is an error. Range partitioning
    on (band, date, place, time) lets a large band-day spread over many tasks and
    files, and a small one stay in one. Places are ordered along a Hilbert curve,
    or with ``curve=False`` row by row: the files and row groups of a curve are
    compact, so that a box meets few of them. Files are cut by ``bytes_per_file``,
    the size of their values before Parquet encodes and compresses them; rows are
    measured for that in one pass, which also tells the number of tasks unless
    ``files`` is given.
    """
    size, rows = _measured(df)
    per_file = max(1, int(bytes_per_file // size)) if rows else 1
    if files is None:
        # Few rows still use the cores there are: cuts fall between band-days
        # first, so more tasks hardly make more files.
        tasks = min(df.sparkSession.sparkContext.defaultParallelism, rows // 10_000 + 1)
        files = max(-(-rows // per_file), tasks)
    named = F.when(F.col("band") == "", F.raise_error(F.lit("an empty band has no directory"))).otherwise(F.col("band"))
    dated = df.withColumn("obs_date", F.to_date(ts)).withColumn("band", named)
    place = ["iy", "ix"]
    if curve:
        dated, place = dated.withColumn("_place", hilbert_key("ix", "iy")), ["_place"]
    order = ["band", "obs_date", *place, ts]
    (
        dated.repartitionByRange(files, *order)
        .sortWithinPartitions(*order)
        .drop("_place")
        .write.mode(mode)
        .option("maxRecordsPerFile", per_file)
        .partitionBy("band", "obs_date")
        .parquet(path)
    )


def _measured(df: DataFrame) -> tuple[float, int]:
    """Bytes of a row on average, counting eight for a value of fixed size, and rows."""
    long_ = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    fixed = 8.0 * max(1, len(df.columns) - len(long_))
    lengths = [F.coalesce(F.sum(F.octet_length(f"`{c}`")), F.lit(0)) for c in long_]
    row = df.agg(F.count(F.lit(1)), *lengths).first()
    return fixed + sum(row[1:]) / max(1, row[0]), row[0]
