"""Reading tables, adding columns from Arrow batches, and shared scratch tables."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swathe.session import scratch_path

_SHIPPED: set[str] = set()

#: What a worker process keeps from task to task, by module.
_HELD: dict[str, dict] = {}


def held(module: str, key, make: Callable[[], object]):
    """The object that ``make`` gives, made once per worker process."""
    own = _HELD.setdefault(module, {})
    if key not in own:
        own[key] = make()
    return own[key]


def _starting(make: Callable) -> None:
    """A worker that goes on to another operator lets go of what earlier ones kept."""
    for module in [m for m in _HELD if m != make.__module__]:
        del _HELD[module]


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per application, for the Python workers."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parent.parent
        path = Path(tempfile.mkdtemp(prefix="swathe-")) / "swathe.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for file in sorted(root.rglob("*.py")):
                z.write(file, file.relative_to(root.parent))
        context.addPyFile(str(path))
        _SHIPPED.add(context.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_columns(
    df: DataFrame, make: Callable[[pa.RecordBatch], list], fields: str, drop: tuple[str, ...] = ()
) -> DataFrame:
    """All columns of ``df`` but ``drop``, and those that ``make`` returns for each batch.

    ``fields`` is a DDL string. A column of ``df`` whose name is among the new
    ones, in whatever case, is replaced.
    """
    added = T._parse_datatype_string(fields)
    gone = {f.name.lower() for f in added} | {d.lower() for d in drop}
    kept = [f for f in df.schema if f.name.lower() not in gone]
    names = [f.name for f in kept]
    kinds = _arrow_types(added)

    def run(batches):
        _starting(make)
        for batch in _slices(batches):
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            new = [pa.array(x, t) for x, t in zip(make(batch), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns + new, names + [f.name for f in added])

    return df.mapInArrow(run, T.StructType(kept + list(added)))


def rows_from(
    df: DataFrame, make: Callable[[pa.RecordBatch], list], fields: str
) -> DataFrame:
    """The rows that ``make`` returns, as lists of columns, for each batch of ``df``."""
    schema = T._parse_datatype_string(fields)
    kinds = _arrow_types(schema)

    def run(batches):
        _starting(make)
        for batch in _slices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(make(batch), kinds, strict=True)], [f.name for f in schema]
            )

    return df.mapInArrow(run, schema)


def _slices(batches):
    """So few rows at a time that their Python copies stay small."""
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            yield batch.slice(i, 512)


def _arrow_types(schema: T.StructType) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in schema]


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """A string column of a batch; null is the empty string."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Later stages read the files, so a lost executor costs no recomputation, and
    what uses the rows twice computes them once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A key on so large a share of all rows is heavy: there are no more of them than the inverse.
HEAVY = 1 / 256


def named_rows(rows: DataFrame, names: DataFrame, key: str, count: str = "n_rows") -> DataFrame:
    """``rows`` with what ``names`` says of their ``key``, which is one row for each key.

    ``count`` is the number of rows of a key. The few heavy keys, at most 256 of
    them, are broadcast, so that no task gets all rows of one; the others are
    joined by shuffle. Rows of a null key, or of a key without a name, go.
    """
    total = names.agg(F.sum(count)).first()[0] or 0
    least = max(1, total * HEAVY)
    heavy = F.broadcast(names.where(F.col(count) >= least))
    rest = rows.join(heavy.select(key), key, "left_anti").join(names.where(F.col(count) < least), key)
    return rows.join(heavy, key).unionByName(rest)
