"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order in which it meets the pivots, nearest first.
It is posted in the inverted files of its ``POSTED`` nearest pivots; a query
probes those of its ``PROBED`` nearest. In a file, candidates are ranked by
Spearman's footrule between their order and the query's, in which pivots beyond
half of them count as equally far, and the best ``RERANKED`` share is compared
by cosine. A candidate met in several files counts in the one of the query's
nearest pivot. Files are cut into blocks, so that a task holds a bounded number
of vectors and queries however many share a pivot.

Equal vectors are one candidate with the six smallest of their ids, one more than
a query can need, so groups of copies cost nothing and lose nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swathe.llm.common import stored, with_columns

#: Pivots (the first vectors by hash), files a vector is in, files a query probes.
PIVOTS, POSTED, PROBED = 256, 4, 56
#: Share of a file's candidates that are reranked, and the least number.
RERANKED, LEAST = 0.25, 16
#: Vectors of a file, and queries, in one block on average.
BLOCK = 4096

_FOUND = "query bigint, vec_id bigint, score double"


def nearest(df: DataFrame, is_query: str, k: int = 5) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score``: up to ``k`` neighbours of each query.

    ``df`` has ``vec_id`` and ``embedding``; ``is_query`` is a condition on it.
    Candidates are all rows but those of the query's own id. The score is the
    cosine in double precision; equal scores go to the smaller id. Vectors that
    are null, zero, of another length than that of the smallest id, or hold null
    or non-finite components, and rows without id, take no part. Repeated rows
    count once; an id with several vectors is searched once for each of them. A
    query has all candidates if there are fewer than ``k``. Other columns are
    not read.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = df.where("vec_id is not null and embedding is not null").where(~bad & F.exists("embedding", lambda x: x != 0))
    valid = valid.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", F.expr(is_query).alias("asks"))
    size = valid.agg(F.min_by(F.size("embedding"), "vec_id")).first()[0] or 0
    valid = valid.where(F.size("embedding") == size)
    place = F.dense_rank().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = valid.select("vec_id", "embedding", place.alias("n")).where(F.col("n") <= k + 1)
    classes = stored(few.groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")), "vectors")
    asking = valid.where("asks").select("vec_id", "embedding").distinct()
    queries = stored(
        asking.join(classes, "embedding").select(F.col("vec_id").alias("query_id"), F.col("ids")[0].alias("query"), "embedding"), "queries"
    )
    probes = queries.select("query", "embedding").distinct()
    n, n_queries = classes.count(), probes.count()
    pivots = _unit(_matrix(classes.orderBy(F.xxhash64("embedding"), F.col("ids")[0]).limit(PIVOTS).select("embedding").toArrow().column(0)))
    found = stored(_search(probes, classes, pivots, n, n_queries, k), "found")
    short = probes.join(found.groupBy("query").count().where(F.col("count") > k).select("query"), "query", "left_anti")
    if n_queries and not short.isEmpty():
        found = found.unionByName(_search(short, classes, None, n, short.count(), k)).distinct()
    ranked = queries.select("query_id", "query").join(found, "query").where("query_id <> vec_id")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return ranked.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def _search(probes: DataFrame, classes: DataFrame, pivots: np.ndarray | None, n: int, n_queries: int, k: int) -> DataFrame:
    """The ``k + 1`` best ids of each query, its own among them; without pivots, of all vectors."""
    files = 1 if pivots is None else max(1, len(pivots))
    posted, probed = (1, 1) if pivots is None else (min(POSTED, files), min(PROBED, files))
    blocks = max(1, -(-n * posted // (files * BLOCK)))
    query_blocks = max(1, -(-n_queries * probed // (files * BLOCK)))
    own = F.pmod(F.xxhash64("query"), F.lit(query_blocks)).cast("int")
    spread = F.sequence(F.lit(0), F.lit(blocks - 1))
    left = _filed(probes.select("query", "embedding"), "query", pivots, probed).select(
        "file", F.explode(spread).alias("block"), own.alias("query_block"), "query", "embedding"
    )
    first = F.col("ids")[0]
    vectors = _filed(classes.select(first.alias("first"), "ids", "embedding"), "first", pivots, posted)
    right = vectors.select(
        "file", F.pmod(F.xxhash64("first"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"), "ids", "embedding",
    )

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return pa.table({"query": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return _cell(a, b, pivots, posted, k)

    keys = ("file", "block", "query_block")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, _FOUND)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.select("*", F.row_number().over(order).alias("n")).where(F.col("n") <= k + 1).drop("n")


def _filed(df: DataFrame, name: str, pivots: np.ndarray | None, files: int) -> DataFrame:
    """``df`` once for each of its ``files`` nearest pivots, as ``file``."""
    if pivots is None:
        return df.select("*", F.lit(0).alias("file"))
    def make(batch):
        vectors = _unit(_matrix(batch.column(batch.schema.get_field_index("embedding"))))
        return [_orders(vectors, pivots)[:, :files].tolist()]

    return with_columns(df, make, "files array<int>").select(*df.columns, F.explode("files").alias("file"))


def _cell(a: pa.Table, b: pa.Table, pivots: np.ndarray | None, posted: int, k: int) -> pa.Table:
    """The best of one block of one file for each query in it."""
    queries, vectors = _matrix(a.column("embedding")), _matrix(b.column("embedding"))
    lengths = np.sqrt((vectors * vectors).sum(1))
    ids = b.column("ids").to_pylist()
    if pivots is not None:
        file, half = a.column("file")[0].as_py(), max(1, len(pivots) // 2)
        order = _orders(_unit(vectors), pivots)
        places, asked = _places(order), _places(_orders(_unit(queries), pivots))
        cut = np.minimum(places, half).astype(np.int16)
        posts = order[:, :posted]
    out: list[tuple] = []
    for i, query in enumerate(a.column("query").to_pylist()):
        if pivots is None:
            chosen = np.arange(len(vectors))
        else:
            chosen = np.flatnonzero(asked[i][posts].min(1) == asked[i][file])
            footrule = np.abs(cut[chosen] - np.minimum(asked[i], half).astype(np.int16)).sum(1, dtype=np.int64)
            few = max(LEAST, int(np.ceil(RERANKED * len(chosen))))
            if few < len(chosen):
                chosen = chosen[np.argpartition(footrule, few)[:few]]
        q = queries[i]
        score = (vectors[chosen] * q).sum(1) / (lengths[chosen] * np.sqrt((q * q).sum()))
        if len(chosen) > k + 1:  # all that tie with the last one stay
            least = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
            chosen, score = chosen[score >= least], score[score >= least]
        best = sorted((-s, v) for s, c in zip(score.tolist(), chosen.tolist()) for v in ids[c])[: k + 1]
        out += [(query, v, -s) for s, v in best]
    columns = list(zip(*out)) or [(), (), ()]
    return pa.table({"query": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True)) if vectors.size else vectors


def _orders(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Numbers of the pivots, nearest first; ties to the smaller number."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable").astype(np.int32)


def _places(orders: np.ndarray) -> np.ndarray:
    places = np.empty_like(orders)
    np.put_along_axis(places, orders, np.broadcast_to(np.arange(orders.shape[1], dtype=orders.dtype), orders.shape), axis=1)
    return places
