"""Plain table files and database tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FORMATS = ("parquet", "orc", "json", "csv")


def scan_table(
    spark: SparkSession, path: str | list[str], fmt: str = "parquet",
    schema: StructType | str | None = None, **options: str,
) -> DataFrame:
    """Shards of a published table. Text formats need a schema: inferring one
    would read every byte twice."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}")
    if schema is None and fmt in ("csv", "json"):
        raise ValueError(f"{fmt} needs a schema")
    if fmt == "csv":
        options = {"header": "true", **options}
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
    partition_by: tuple[str, ...] = (), **options: str,
) -> None:
    """Write shards; one file per task, and per partition value it holds."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}")
    if fmt == "csv":
        options = {"header": "true", **options}
    writer = df.write.format(fmt).mode(mode).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def jdbc_read_options(
    url: str, table: str, column: str, lower: int | str, upper: int | str, partitions: int,
    fetch_size: int = 10_000, properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a read in ``partitions`` ranges of ``column``.

    The bounds only place the cuts: rows beyond them fall into the first or
    last range and are not lost. Choose them, and a column, that spread rows
    evenly.
    """
    if partitions < 1:
        raise ValueError("partitions must be positive")
    return {
        "url": url, "dbtable": table, "partitionColumn": column,
        "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions),
        "fetchsize": str(fetch_size), **(properties or {}),
    }


def read_table_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower: int | str, upper: int | str,
    partitions: int, fetch_size: int = 10_000, properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Partitioned read of a database table; filters and columns are pushed
    down to the database. Geometry is best read as text by naming a query
    such as ``(select id, ST_AsGeoJSON(geom) g from t) q`` as the table."""
    opts = jdbc_read_options(url, table, column, lower, upper, partitions, fetch_size, properties)
    return spark.read.format("jdbc").options(**opts).load()


def write_table_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", connections: int = 16,
    batch_size: int = 10_000, properties: Mapping[str, str] | None = None,
) -> None:
    """Bulk write with at most ``connections`` open at once.

    Each task commits on its own, so a lost executor can repeat a task's rows
    in ``append`` mode: write to a staging table and move rows by key.
    """
    (
        df.write.format("jdbc").mode(mode)
        .options(
            url=url, dbtable=table, numPartitions=str(connections),
            batchsize=str(batch_size), **(properties or {}),
        )
        .save()
    )
