"""Tables written to the shared scratch folder between steps of an iteration."""

from __future__ import annotations

from pyspark.sql import DataFrame

from swathe.session import NoSharedFolder, scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` read back from files, which cuts its lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` for several uses: written once, or, on a cluster that names no shared
    folder, as it is and so computed for each use."""
    try:
        return written(df, name)
    except NoSharedFolder:
        return df
