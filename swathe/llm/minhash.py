"""Near duplicates by MinHash: banding, signature verification, exact confirmation, components.

A document's set holds its distinct shingles. ``ROWS * BANDS`` universal hash
functions give its signature of minima; equal rows of a band put two sets into
one bucket. Of pairs at the similarity wanted a share of
``1 - (1 - 0.8 ** 4) ** 32``, all but 5 in 100 million, meet in a bucket.

Equal sets are one class before anything is compared. In each bucket all members
are compared with its smallest one first, which is one pair for each member, and
the components of what that links are found. Only buckets that then still hold
several components are compared member by member, in pairs of blocks inside
tasks that write out no pairs: once on signatures, to find who needs comparing
at all, and then on the full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathe.llm.common import named_rows, rows_from, stored, text_or_empty, with_columns
from swathe.llm.components import components
from swathe.llm.words import coded_words, large_strings

#: Rows of a band, and bands.
ROWS, BANDS = 4, 32
#: Signatures may agree on this share less than the similarity wanted: over five deviations at 128 minima.
SLACK = 0.2
#: Members of a bucket, and bytes of their sets, in one block on average.
BLOCK, BLOCK_BYTES = 1024, 32 << 20

_DRAW = np.random.default_rng(29)
_TIMES, _PLUS = (_DRAW.integers(0, 1 << 64, ROWS * BANDS, np.uint64) for _ in range(2))
_TIMES |= np.uint64(1)
_ODD = _DRAW.integers(0, 1 << 64, 8, np.uint64) | np.uint64(1)


def near_dedup(df: DataFrame, size: int = 2, similarity: int = 80) -> DataFrame:
    """One row per row of ``df`` (``doc_id``, ``text``): ``doc_id``, ``n_shingles``,
    ``component_id`` and ``kept``.

    Two documents are linked if 100 times what their sets share is at least
    ``similarity`` times their union. ``component_id`` is the smallest id
    reachable over links, the row's own included, and ``kept`` whether it is the
    row's own. Words are runs of anything but ASCII white space, ASCII letters
    count in lower case, a text of fewer than ``size`` words is one shingle, and
    one without words, or null, has the empty set and is linked with nothing.
    Repeated rows stay, and all of the smallest id are kept. A row with a null id
    has a null ``component_id`` and is kept where every id of its component is
    null or its set is empty. Other columns are not read.
    """
    docs = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    rows = stored(
        with_columns(docs.withColumn("text_key", F.sha2("text", 256)), lambda batch: _described(batch, size),
                     "n_shingles bigint, set_key binary, signature binary", drop=("text",)),
        "signatures",
    )
    full = rows.where("n_shingles > 0")
    classes = full.groupBy("set_key").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("n_rows"), F.first("n_shingles").alias("n_shingles"),
        F.min("text_key").alias("text_key"), F.first("signature").alias("signature"),
    )
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    roots = stored(components(links(classes, docs, size, similarity)), "roots")
    rooted = classes.select("node", "first_id").join(roots, "node")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = rooted.join(least, "root").select("node", "component_id")
    names = classes.join(linked, "node", "left").select(
        "set_key", F.coalesce("component_id", "first_id").alias("component_id"), "n_rows"
    )
    found = named_rows(full.select("doc_id", "n_shingles", "set_key"), stored(names, "names"), "set_key")
    empty = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    both = found.select("doc_id", "n_shingles", "component_id").unionAll(empty)
    return both.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def links(classes: DataFrame, docs: DataFrame, size: int, similarity: int) -> DataFrame:
    """Links ``a``, ``b`` of nodes that span the components of all links between classes."""
    keys = rows_from(classes.select("node", "n_shingles", "signature"), _banded, "node bigint, n_shingles bigint, keys array<bigint>")
    buckets = keys.select(F.posexplode("keys").alias("band", "key"), "node", "n_shingles")
    sizes = buckets.groupBy("band", "key").agg(
        F.count("*").alias("n"), F.min("node").alias("centre"), F.sum("n_shingles").alias("shingles")
    )
    members = stored(buckets.join(sizes.where("n > 1"), ["band", "key"]), "members")
    stars = members.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    near = stored(_agreeing(stars, classes, similarity), "pairs")
    sets = _sets(near.select(F.col("a").alias("node")).unionAll(near.select("b")).distinct(), classes, docs, size)
    first = _confirmed(near, stored(sets, "sets"), similarity)
    roots = stored(components(first), "roots")

    met = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = met.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("shingles") * 8 / BLOCK_BYTES)).cast("int")
    still = stored(met.join(open_.select("band", "key"), ["band", "key"]).select("band", "key", "node", "root", blocks.alias("blocks")), "open")
    dealt = still.withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    cell = [*_CELL, "own", "node", "root"]
    dealt = dealt.select("band", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "root")
    signed = _grouped(dealt.join(classes.select("node", "signature"), "node").select(*cell, "signature"))
    kinds = "band int, key bigint, low int, high int, own int, node bigint, root bigint"
    flagged = stored(signed.mapInArrow(lambda b: _in_groups(b, lambda g: _worth_comparing(g, similarity), kinds), kinds), "flagged")
    sets = stored(_sets(flagged.select("node").distinct(), classes, docs, size), "sets")
    held = _grouped(flagged.join(sets, "node").select(*cell, "shingles"))
    second = held.mapInArrow(lambda b: _in_groups(b, lambda g: _linked(g, similarity), "a bigint, b bigint"), "a bigint, b bigint")
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(second)


_CELL = ("band", "key", "low", "high")


def _grouped(df: DataFrame) -> DataFrame:
    return df.repartition(*_CELL).sortWithinPartitions(*_CELL)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[0]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text."""
    of_text, codes, words = coded_words(large_strings(texts))
    hashes = np.fromiter((xxhash.xxh64_intdigest(w.encode().lower()) for w in words.to_pylist()), np.uint64, len(words))[codes]
    ends = np.searchsorted(of_text, np.arange(len(texts)), "right")
    out = []
    for i, j in zip([0, *ends[:-1].tolist()], ends.tolist()):
        own, n = hashes[i:j], min(size, j - i)
        if not n:
            out.append(own)
            continue
        joined = np.full(len(own) - n + 1, n, np.uint64)
        for k in range(n):
            joined = _mixed(joined * _ODD[2] + own[k : len(own) - n + 1 + k])
        out.append(np.unique(joined))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of ``ROWS * BANDS`` universal hash functions over each set, none of them empty."""
    out = np.empty((ROWS * BANDS, len(sets)), np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    shingles = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    for k in range(ROWS * BANDS if sets else 0):
        out[k] = np.minimum.reduceat(((shingles * _TIMES[k] + _PLUS[k]) >> np.uint64(32)).astype(np.uint32), starts)
    return np.ascontiguousarray(out.T)


def _described(batch: pa.RecordBatch, size: int) -> list:
    sets = shingle_sets(batch.column(batch.schema.get_field_index("text")), size)
    full = [i for i, s in enumerate(sets) if len(s)]
    signed: list = [None] * len(sets)
    for i, row in zip(full, signatures([sets[i] for i in full])):
        signed[i] = row.tobytes()
    return [[len(s) for s in sets], [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], signed]


def _banded(batch: pa.RecordBatch) -> list:
    rows = _stacked(batch.column(2)).view(np.uint64).reshape(len(batch), BANDS, ROWS // 2)
    keys = np.zeros((len(batch), BANDS), np.uint64)
    for k in range(ROWS // 2):
        keys = _mixed(keys * _ODD[3] + rows[:, :, k])
    return [batch.column(0), batch.column(1), list(keys.view(np.int64))]


def _stacked(column: pa.Array) -> np.ndarray:
    """Signatures of a binary column, one a row."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), ROWS * BANDS)


def _least(similarity: int) -> float:
    return ROWS * BANDS * (similarity / 100 - SLACK)


def _agreeing(pairs: DataFrame, classes: DataFrame, similarity: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose signatures and set sizes allow the similarity."""
    own = classes.select("node", "n_shingles", "signature")
    a, b = (own.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("signature").alias(f"signature_{x}")) for x in "ab")
    both = pairs.join(a, "a").join(b, "b").where(
        f"100 * least(n_a, n_b) >= {similarity} * greatest(n_a, n_b)"
    ).select("a", "b", "signature_a", "signature_b")

    def make(batch: pa.RecordBatch) -> list:
        stays = np.flatnonzero((_stacked(batch.column(2)) == _stacked(batch.column(3))).sum(1) >= _least(similarity))
        return [batch.column(i).take(pa.array(stays)) for i in (0, 1)]

    return rows_from(both, make, "a bigint, b bigint")


def _sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """``node`` and its ``shingles`` as sorted bytes, from one text of each class."""
    wanted = classes.join(nodes, "node", "left_semi").select("node", "text_key")
    texts = docs.withColumn("text_key", F.sha2("text", 256)).select("text_key", "text")
    once = texts.join(wanted.select("text_key"), "text_key", "left_semi").dropDuplicates(["text_key"])

    def make(batch: pa.RecordBatch) -> list:
        return [[s.tobytes() for s in shingle_sets(batch.column(batch.schema.get_field_index("text")), size)]]

    return with_columns(once, make, "shingles binary", drop=("text",)).join(wanted, "text_key").select("node", "shingles")


def _near(a: np.ndarray, b: np.ndarray, similarity: int) -> bool:
    if 100 * min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= similarity * (len(a) + len(b) - both)


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs whose full sets are near enough."""
    a, b = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"shingles_{x}")) for x in "ab")

    def make(batch: pa.RecordBatch) -> list:
        sides = [[np.frombuffer(s, np.uint64) for s in batch.column(i).to_pylist()] for i in (2, 3)]
        near = pa.array([_near(x, y, similarity) for x, y in zip(*sides)], pa.bool_())
        return [batch.column(i).filter(near) for i in (0, 1)]

    both = pairs.join(a, "a").join(b, "b").select("a", "b", "shingles_a", "shingles_b")
    return rows_from(both, make, "a bigint, b bigint")


def _in_groups(batches, make, fields: str):
    """What ``make`` gives for the rows of each group of consecutive equal cells, across batches."""
    names = [f.split()[0] for f in fields.split(", ")]
    kinds = [pa.int64() if f.endswith("bigint") else pa.int32() for f in fields.split(", ")]
    key, parts = None, []

    def out(rows: list):
        columns = [np.concatenate(c) for c in zip(*rows)] if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    for batch in batches:
        cells = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], 1)
        new = (np.flatnonzero((cells[1:] != cells[:-1]).any(1)) + 1).tolist()
        rows = []
        for i, j in zip([0, *new], [*new, len(cells)]):
            if i == j:
                continue
            own = tuple(cells[i].tolist())
            if own != key:
                if parts:
                    rows.append(make(pa.Table.from_batches(parts)))
                key, parts = own, []
            parts.append(batch.slice(i, j - i))
        yield out([r for r in rows if len(r[0])])
    if parts:
        last = make(pa.Table.from_batches(parts))
        yield out([last] if len(last[0]) else [])


def _worth_comparing(group: pa.Table, similarity: int) -> list[np.ndarray]:
    """Rows that agree enough with one of another root in the group.

    Of two blocks only pairs across count, and a pair counts in the first band on
    which it agrees alone.
    """
    band, low, high = (group.column(i)[0].as_py() for i in (0, 2, 3))
    own, root = (group.column(i).to_numpy() for i in (4, 6))
    signed = _stacked(group.column(7).combine_chunks())
    flagged = np.zeros(len(group), bool)
    for i in range(1, len(group)):
        other = root[:i] != root[i]
        if low != high:
            other &= own[:i] != own[i]
        met = np.flatnonzero(other)
        if not len(met):
            continue
        same = signed[met] == signed[i]
        met, same = (x[same.sum(1) >= _least(similarity)] for x in (met, same))
        if len(met):
            first = same.reshape(len(met), BANDS, ROWS).all(2).argmax(1)
            met = met[first == band]
            flagged[met] = True
            flagged[i] |= len(met) > 0
    at = np.flatnonzero(flagged)
    return [group.column(k).to_numpy()[at] for k in range(7)]


def _linked(group: pa.Table, similarity: int) -> list[np.ndarray]:
    """Spanning links of the group's rows, which start out joined by root."""
    own, node, label = (group.column(i).to_numpy().copy() for i in (4, 5, 6))
    across = group.column(2)[0].as_py() != group.column(3)[0].as_py()
    sets = [np.frombuffer(s, np.uint64) for s in group.column(7).to_pylist()]
    found = []
    for i in range(1, len(group)):
        other = label[:i] != label[i]
        if across:
            other &= own[:i] != own[i]
        for j in np.flatnonzero(other):
            if label[j] != label[i] and _near(sets[i], sets[j], similarity):
                found.append((node[i], node[j]))
                label[label == label[j]] = label[i]
    return list(np.array(found, np.int64).reshape(-1, 2).T)
