"""The same operators over cells that keep landing as files.

Filters, masks and joins against static zones take a streaming DataFrame as
they are. An aggregate over time needs a watermark, so that its state can be
dropped once a period is over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from swathe.operators.series import accumulate


def stream_cells(
    spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int = 1000
) -> DataFrame:
    """Cells from Parquet files as they arrive in a folder."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def accumulate_stream(
    cells: DataFrame, keys: Sequence[str], period: str, late: str, value: str = "value",
    hours: float = 1.0, ts: str = "obs_ts",
) -> DataFrame:
    """:func:`accumulate` over a stream: a period's total is emitted once
    ``late`` has passed after its end, and later rows for it are dropped.

    A watermark needs an instant, so a time without zone is read in the
    session zone. State is one row per key and open period, kept in RocksDB by
    :func:`write_totals`.
    """
    timed = cells.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return accumulate(timed, keys, period, value, hours, ts)


def write_totals(totals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished totals to Parquet, taking up all that has arrived and
    then stopping; run it again for later files. ``checkpoint`` must be on
    shared storage: it makes each total appear exactly once."""
    totals.sparkSession.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return (
        totals.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
