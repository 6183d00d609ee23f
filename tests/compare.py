"""Run registered queries against their SQL in DuckDB.

``python tests/compare.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import importlib.util
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parent.parent
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS FROM '{sf}/{t}.parquet'")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    rows = []
    for row in pdf.itertuples(index=False, name=None):
        rows.append(tuple(None if pd.isna(v) else str(v) for v in row))
    return sorted(rows, key=repr)


def kinds(pdf: pd.DataFrame) -> dict[str, str]:
    return {c: str(pdf[c].dtype) for c in sorted(pdf.columns)}


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = canonical(got), canonical(want)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0]}" if wrong else None


def collect(df) -> pd.DataFrame:
    rows = [tuple(r) for r in df.collect()]
    return pd.DataFrame(rows, columns=df.columns, dtype=object)


def run(spark, con, entry, name: str, sf: str) -> str | None:
    got = entry.queries()[name](spark, sf)
    rel = con.sql(entry.oracle_sql()[name])
    want = pd.DataFrame(rel.fetchall(), columns=rel.columns, dtype=object)
    trouble = difference(collect(got), want)
    simple = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
    }
    spark_types = {c: simple.get(t, t) for c, t in got.dtypes}
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    odd = {c: (spark_types.get(c), duck_types[c]) for c in duck_types if spark_types.get(c) != duck_types[c]}
    if odd:
        trouble = f"{trouble or ''} types {odd}"
    return trouble


def main() -> int:
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    entry = load_entry()
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    failed = 0
    for name in names:
        t = time.time()
        try:
            trouble = run(spark, con, entry, name, sf)
        except Exception as e:  # noqa: BLE001
            trouble = f"{type(e).__name__}: {str(e)[:600]}"
        failed += trouble is not None
        print(f"{'ok  ' if trouble is None else 'FAIL'} {name} {time.time() - t:.2f}s {trouble or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.path.insert(0, str(ROOT))
    raise SystemExit(main())
