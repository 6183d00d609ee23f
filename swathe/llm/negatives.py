"""Hard negatives by slot-decomposed selection.

An anchor's positives are its best rows of the same label. The score of each
positive sets a window of scores for its negatives, and the windows of one
anchor overlap. Their upper limits cut the scores into disjoint slots. Each task
keeps the best ``k`` rows of each anchor and slot that it meets, what tasks kept
is combined to the best ``k`` of each slot, and the answer of a window is the
best ``k`` of its own slot and all lower ones, found by one merge in descending
order, as far as they reach its lower limit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swathe.llm.common import stored

#: Anchors that a task holds, and rows of a block that passes by them, on average and at least.
HELD, BLOCK = 16_384, 4096
#: Rows compared at once.
CHUNK = 1024
#: Below every score.
NEVER = np.int64(-(1 << 63))


def hard_negatives(
    df: DataFrame, is_anchor: str, n_positives: int = 5, k: int = 3, low: int = 50, high: int = 95, scale: int = 256
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``df`` has ``vec_id``, ``embedding`` and ``label``; ``is_anchor`` is a condition
    on it. A component counts as the floor of ``scale`` times it, a score is the
    integer inner product with the anchor, higher scores come first and ties go
    to the smaller id. Positives are an anchor's first ``n_positives`` rows of its
    label; the negatives of a positive are the first ``k`` rows of another label
    with ``low * positive_score <= 100 * negative_score <= high * positive_score``.

    Rows with a null id, label or vector, with null or non-finite components, or
    of another length than that of the smallest id take no part, nor do rows of
    the anchor's own id in its search. Repeated rows count once; an id with
    several vectors or labels is searched once for each. Scores are exact while
    their terms sum to less than 2 ** 62 in magnitude; beyond that components are
    cut to where that holds. Other columns are not read.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = df.where("vec_id is not null and label is not null and embedding is not null").where(~bad)
    valid = valid.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"), F.expr(is_anchor).alias("asks"),
    )
    size = valid.agg(F.min_by(F.size("embedding"), "vec_id")).first()[0] or 0
    whole = F.transform("embedding", lambda x: F.floor(x * float(scale)).cast("double"))
    rows = valid.where(F.size("embedding") == size).withColumn("embedding", whole)
    rows = stored(rows.distinct(), "vectors")
    anchors = stored(rows.where("asks").select(F.monotonically_increasing_id().alias("anchor"), "vec_id", "label", "embedding"), "anchors")
    n, asked = rows.count(), anchors.count()

    def best(found: DataFrame, keys: list[str], most: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    found = _met(anchors.withColumn("limits", F.array().cast("array<bigint>")), rows, n, asked, n_positives)
    positives = stored(best(found, ["anchor"], n_positives).select("anchor", "vec_id", "score"), "positives")
    limits = positives.where("score >= 0").groupBy("anchor").agg(
        F.sort_array(F.collect_set(F.expr(f"floor({high} * cast(score as decimal(20, 0)) / 100)").cast("bigint")), asc=False).alias("limits")
    )
    slots = stored(best(_met(anchors.join(limits, "anchor"), rows, n, asked, k), ["anchor", "slot"], k), "slots")
    upper = positives.where("score >= 0").join(limits, "anchor").select(
        "anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        (F.array_position("limits", F.expr(f"floor({high} * cast(score as decimal(20, 0)) / 100)").cast("bigint")) - 1).cast("int").alias("own"),
    )
    kept = slots.groupBy("anchor").agg(F.collect_list(F.struct("slot", F.negative("score").alias("down"), "vec_id")).alias("kept"))
    # At most k rows of each of n_positives slots.
    merged = upper.join(kept, "anchor").withColumn(
        "first", F.slice(F.sort_array(F.transform(F.filter("kept", lambda s: s["slot"] >= F.col("own")), lambda s: F.struct(s["down"], s["vec_id"]))), 1, k)
    )
    pairs = merged.select("anchor", "positive_id", "positive_score", F.posexplode("first").alias("place", "one")).where(
        f"cast(-one.down as decimal(30, 0)) * 100 >= cast(positive_score as decimal(30, 0)) * {low}"
    )
    named = pairs.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return named.select(
        "anchor_id", "positive_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("one.vec_id").alias("negative_id"),
        "positive_score", F.negative("one.down").alias("negative_score"),
    )


def _met(anchors: DataFrame, rows: DataFrame, n: int, asked: int, k: int) -> DataFrame:
    """``anchor``, ``slot``, ``vec_id``, ``score``: what each task kept.

    Without limits the best ``k`` rows of the anchor's label, as slot -1; else the
    best ``k`` rows of another label in each slot. A task holds the anchors of its
    cell and lets the cell's rows pass by.
    """
    groups = max(1, -(-asked // HELD))
    # So many blocks that anchors are not copied more often than rows are.
    blocks = max(1, min(-(-n // BLOCK), groups * n // max(1, asked)))
    near = F.pmod(F.xxhash64("anchor"), F.lit(groups)).cast("int")
    held = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), near.alias("held"), F.lit(0).alias("side"),
        "anchor", "vec_id", "label", "embedding", "limits",
    )
    passing = rows.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("held"), F.lit(1).alias("side"),
        F.lit(None).cast("bigint").alias("anchor"), "vec_id", "label", "embedding", F.lit(None).cast("array<bigint>").alias("limits"),
    )
    dealt = held.unionAll(passing).repartition("block", "held").sortWithinPartitions("block", "held", "side")
    return dealt.mapInArrow(lambda batches: _cells(batches, k), "anchor bigint, slot int, vec_id bigint, score bigint")


def _cells(batches, k: int):
    key, kept = None, None
    for batch in batches:
        cell = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], 1)
        new = (np.flatnonzero((cell[1:] != cell[:-1]).any(1)) + 1).tolist()
        for i, j in zip([0, *new], [*new, len(cell)]):
            if i == j:
                continue
            part = batch.slice(i, j - i)
            if (own := tuple(cell[i, :2].tolist())) != key:
                if kept is not None:
                    yield from kept.out()
                key, kept = own, _Kept(k)
            (kept.hold if cell[i, 2] == 0 else kept.pass_by)(part)
    if kept is not None:
        yield from kept.out()


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(6)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 0))


class _Kept:
    """The anchors of a cell and the best rows met so far of each slot."""

    def __init__(self, k: int):
        self.k, self.parts, self.found = k, [], None

    def hold(self, batch: pa.RecordBatch) -> None:
        self.parts.append(batch)

    def _start(self) -> None:
        held = pa.Table.from_batches(self.parts)
        self.anchor, self.id, self.label = (held.column(i).to_numpy() for i in (3, 4, 5))
        self.vectors = np.concatenate([_vectors(p) for p in self.parts])
        limits = held.column(7).to_pylist()
        self.slots = max(map(len, limits))
        # Slot j holds scores from above limit j + 1 up to limit j; without limits one slot holds all.
        self.edges = np.full((len(limits), self.slots + 1), NEVER)
        for i, own in enumerate(limits):
            self.edges[i, : len(own)] = own
        self.found = [np.empty(0, np.int64) for _ in range(4)]  # place of the anchor, slot, id, score
        self.least = np.full((len(limits), max(1, self.slots)), NEVER)

    def pass_by(self, batch: pa.RecordBatch) -> None:
        if not self.parts:
            return
        if self.found is None:
            self._start()
        vectors, ids, labels = _vectors(batch), batch.column(4).to_numpy(), batch.column(5).to_numpy()
        for a in range(0, len(self.anchor), CHUNK):
            for r in range(0, len(ids), CHUNK):
                self._compare(slice(a, a + CHUNK), vectors[r : r + CHUNK], ids[r : r + CHUNK], labels[r : r + CHUNK])
            self._trim()

    def _compare(self, at: slice, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        score = _products(self.vectors[at], vectors)
        alike = self.label[at][:, None] == labels
        able = (alike if not self.slots else ~alike) & (self.id[at][:, None] != ids)
        for slot in range(max(1, self.slots)):
            stays = able & (score >= self.least[at, slot, None])
            if self.slots:
                stays &= (score <= self.edges[at, slot, None]) & (score > self.edges[at, slot + 1, None])
            if len(ids) > self.k:  # below the k-th best of the chunk nothing counts; all that tie with it stay
                best = np.partition(np.where(stays, score, NEVER), len(ids) - self.k, 1)[:, len(ids) - self.k]
                stays &= score >= best[:, None]
            i, j = np.nonzero(stays)
            new = (i + at.start, np.full(len(i), slot), ids[j], score[i, j])
            self.found = [np.concatenate([f, x.astype(np.int64)]) for f, x in zip(self.found, new)]

    def _trim(self) -> None:
        place, slot, ids, score = self.found
        order = np.lexsort((ids, -score, slot, place))
        place, slot, ids, score = (x[order] for x in self.found)
        group = place * max(1, self.slots) + slot
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.empty(0, np.int64)
        rank = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
        self.found = [x[rank < self.k] for x in (place, slot, ids, score)]
        last = rank == self.k - 1
        self.least[place[last], slot[last]] = score[last]

    def out(self):
        if self.found is not None and len(self.found[0]):
            place, slot, ids, score = self.found
            columns = (self.anchor[place], (slot if self.slots else slot - 1).astype(np.int32), ids, score)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "slot", "vec_id", "score"])


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of ``a`` and ``b``, which hold whole numbers."""
    most = [float(np.abs(x).max(initial=0.0)) for x in (a, b)]
    if most[0] * most[1] * a.shape[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)
    bound = np.sqrt(2.0**62 / max(1, a.shape[1]))
    return np.clip(a, -bound, bound).astype(np.int64) @ np.clip(b, -bound, bound).astype(np.int64).T
