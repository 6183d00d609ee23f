"""SimHash fingerprints and near duplicates by a self-join of binary tries.

Fingerprints within ``BUDGET`` bits of each other are linked. Cut into
``BUDGET + 1`` runs of bits, two such fingerprints agree on a whole run. So there
is one trie for each run, with the bits rotated to bring the run first. Its
first levels have no budget left for errors, which is an equality that Spark
joins on; from there on a task walks pairs of nodes of its subtrie together.

Equal texts are one fingerprint before anything is joined. Inside a subtrie
only a spanning forest of the links is kept, so a group of thousands of near
copies yields as many rows as it has fingerprints.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathe.llm.common import stored, strings, with_columns
from swathe.llm.components import components

BUDGET = 2
#: Rotation and length of the runs; fixed by 64 bits and the budget.
RUNS = ((0, 22), (22, 21), (43, 21))
#: Larger subtries are split by pairs of prefixes of so many further bits.
LARGE, SPLIT_BITS = 1 << 15, 8
#: Node pairs of at most so many fingerprints each are compared as arrays.
LEAF = 128


def fingerprint(text: str, size: int = 3, seed: int = 42) -> int:
    """64 bits as a signed integer; bit i is set if it is set in over half of the
    XXH64 values of the text's shingles, repeats included.

    ASCII letters count in lower case, words are runs of anything but ASCII
    white space, a text of fewer words than ``size`` is one shingle, and one
    without words is 0.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, seed) for s in shingles], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``simhash``; a null text is empty."""
    return with_columns(df, lambda batch: [[fingerprint(t) for t in strings(batch, text)]], "simhash bigint")


def as_hex(simhash: str = "simhash") -> Column:
    return F.lower(F.lpad(F.hex(simhash), 16, "0"))


def near_links(prints: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between distinct values of ``prints.simhash`` whose
    components are those of all pairs within the budget."""
    runs = F.array(*(
        F.struct(F.lit(k).alias("run"), _rotated(F.col("simhash"), turn).alias("bits"), F.lit(64 - length).alias("rest"))
        for k, (turn, length) in enumerate(RUNS)
    ))
    rotated = prints.select("simhash").distinct().select(F.inline(runs))
    keyed = rotated.select("run", F.expr("shiftrightunsigned(bits, rest)").alias("head"), "bits", "rest")
    shared = keyed.groupBy("run", "head").count().where("count > 1")
    members = keyed.join(shared, ["run", "head"])
    whole = members.where(F.col("count") <= LARGE).select("run", "head", F.lit(-1).alias("pair"), F.lit(0).alias("side"), "bits")
    prefix = F.expr(f"cast(shiftrightunsigned(bits, rest - {SPLIT_BITS}) & {(1 << SPLIT_BITS) - 1} as int)")
    flips = [m for m in range(1 << SPLIT_BITS) if m.bit_count() <= BUDGET]
    large = members.where(F.col("count") > LARGE).select(
        "run", "head", "bits", prefix.alias("own"), F.explode(F.array(*map(F.lit, flips))).alias("flip")
    )
    other = F.expr("own ^ flip")
    split = large.select(
        "run", "head", (F.least("own", other) * (1 << SPLIT_BITS) + F.greatest("own", other)).alias("pair"),
        (F.col("own") > other).cast("int").alias("side"), "bits",
    )
    grouped = whole.unionAll(split).repartition("run", "head", "pair")
    ordered = grouped.sortWithinPartitions("run", "head", "pair", "side")
    return ordered.mapInArrow(_walk_groups, "a bigint, b bigint")


def near_dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``simhash`` and ``component_id``, the
    smallest id reachable over links, itself included.

    A null text is empty; texts without words share the fingerprint 0 and are
    linked like any other. Repeated rows stay. Where ids repeat, each row has
    its own fingerprint. A null id keeps its row and names no component unless
    all ids of the component are null. Other columns are not read.
    """
    prints = stored(fingerprints(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text").drop("text"), "simhash")
    classes = prints.groupBy("simhash").agg(F.min("doc_id").alias("first_id"))
    roots = stored(components(near_links(classes)), "roots").withColumnRenamed("node", "simhash")
    rooted = classes.join(roots, "simhash").select("simhash", "root", "first_id")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = rooted.join(least, "root").select("simhash", "component_id")
    named = classes.join(linked, "simhash", "left").select(
        "simhash", F.coalesce("component_id", "first_id").alias("component_id")
    )
    # Both sides come from files, so that adaptive execution can split a fingerprint with many copies.
    return prints.join(stored(named, "named"), "simhash").select("doc_id", "simhash", "component_id")


def _rotated(bits: Column, turn: int) -> Column:
    if not turn:
        return bits
    return F.shiftleft(bits, turn).bitwiseOR(F.shiftrightunsigned(bits, 64 - turn))


def _walk_groups(batches):
    """Spanning links of each group of consecutive rows, across batches."""
    key, sides = None, ([], [])

    def links():
        if key is None:
            return [], []
        a, b = (np.concatenate(s) if s else np.empty(0, np.uint64) for s in sides)
        a, b = spanning_links(a, b) if key[2] >= 0 and key[2] >> SPLIT_BITS != key[2] % (1 << SPLIT_BITS) else spanning_links(a, None)
        turn = RUNS[key[0]][0]
        return [((x >> np.uint64(turn)) | (x << np.uint64((64 - turn) % 64)) if turn else x).view(np.int64) for x in (a, b)]

    for batch in batches:
        run, head, pair, side = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        bits = batch.column(4).to_numpy(zero_copy_only=False).view(np.uint64)
        new = np.flatnonzero((np.diff(run) != 0) | (np.diff(head) != 0) | (np.diff(pair) != 0)) + 1
        found = []
        for i, j in zip([0, *new.tolist()], [*new.tolist(), len(run)]):
            if i == j:
                continue
            own = (int(run[i]), int(head[i]), int(pair[i]))
            if own != key:
                found.append(links())
                key, sides = own, ([], [])
            for k in (0, 1):
                if len(part := bits[i:j][side[i:j] == k]):
                    sides[k].append(part)
        yield _links_batch(found)
    yield _links_batch([links()])


def _links_batch(found: list) -> pa.RecordBatch:
    a, b = (np.concatenate([f[k] for f in found if len(f[k])] or [np.empty(0, np.int64)]) for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def spanning_links(left: np.ndarray, right: np.ndarray | None, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the pairs within ``budget`` bits, of ``left`` with itself or with ``right``.

    The values are unsigned 64-bit and distinct. A trie node is a range of the
    sorted values that agree above some bit.
    """
    own = right is None
    values = np.sort(left) if own else np.concatenate([np.sort(left), np.sort(right)])
    label = np.arange(len(values))
    n = len(left)
    tasks = [(0, n, 0, n, 63, budget)] if own else [(0, n, n, len(values), 63, budget)]
    while tasks:
        a0, a1, b0, b1, bit, left_over = tasks.pop()
        if a0 == a1 or b0 == b1:
            continue
        la, lb = label[a0:a1], label[b0:b1]
        if la[0] == lb[0] and (la == la[0]).all() and (lb == la[0]).all():
            continue  # all in one component already
        if bit < 0 or (a1 - a0 <= LEAF and b1 - b0 <= LEAF):
            near = np.bitwise_count(values[a0:a1, None] ^ values[None, b0:b1]) <= budget
            for i in np.flatnonzero(near.any(1)):
                met = np.unique(np.append(label[b0:b1][near[i]], label[a0 + i]))
                for other in met[1:]:
                    label[label == other] = met[0]
            continue
        mask = np.uint64(1 << bit)
        am = a0 + int(np.count_nonzero((values[a0:a1] & mask) == 0))
        bm = b0 + int(np.count_nonzero((values[b0:b1] & mask) == 0))
        tasks += [(a0, am, b0, bm, bit - 1, left_over), (am, a1, bm, b1, bit - 1, left_over)]
        if left_over:
            tasks.append((a0, am, bm, b1, bit - 1, left_over - 1))
            if (a0, a1) != (b0, b1):
                tasks.append((am, a1, b0, bm, bit - 1, left_over - 1))
    rest = label != np.arange(len(values))
    return values[rest], values[label[rest]]


#: Hashes of a head and heads of a text: of pairs at 0.8 a share of 1 - (1 - 0.8 ** 3) ** 12 = 0.9998 agrees on a head.
HASHES, HEADS = 3, 12
#: Texts under one head are compared in pairs of blocks of about so many.
BLOCK = 1024
_DRAW = np.random.default_rng(17)
_TIMES, _PLUS = (_DRAW.integers(0, 1 << 64, HASHES * HEADS, np.uint64) for _ in range(2))
_TIMES |= np.uint64(1)


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles, of the same words as ``fingerprint``."""
    words = text.encode().lower().split()
    if len(words) <= size:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    return np.unique(np.array([xxhash.xxh64_intdigest(s, 5) for s in shingles], "<u8"))


def mark(text: str) -> int:
    """A signed 64-bit hash of a text's words in order; 0 without words."""
    words = text.encode().lower().split()
    return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words), 11)).view(np.int64)) if words else 0


def marks(df: DataFrame) -> DataFrame:
    """``df`` with ``mark`` of ``text``; a null text is empty."""
    return with_columns(df, lambda batch: [[mark(t) for t in strings(batch, "text")]], "mark bigint")


def heads(found: np.ndarray) -> list[int]:
    """Hashes of the ``HEADS`` groups of ``HASHES`` smallest hashes of a set."""
    if not len(found):
        return []
    least = np.full(HASHES * HEADS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(found), 4096):
        least = np.minimum(least, (found[i : i + 4096, None] * _TIMES + _PLUS).min(0))
    return [int(np.uint64(xxhash.xxh64_intdigest(x.tobytes())).view(np.int64)) for x in least.reshape(HEADS, HASHES)]


def near_copies(df: DataFrame, size: int = 5, budget: int = 20, similarity: float = 0.8) -> DataFrame:
    """One row per row of ``df`` (``doc_id``, ``text``): ``doc_id``, ``mark`` and
    ``component_id``, the smallest id reachable over links of texts whose sets of
    shingles of ``size`` words have at least ``similarity`` as exact Jaccard.

    Compared are the texts of the fingerprints that ``near_links`` joins, and, as texts
    at that similarity differ in more bits than a trie can search, those that agree on
    a head of smallest hashes; in both cases within ``budget`` bits of a fingerprint.
    Nulls and repeated ids are as in ``near_dedup``.
    """
    docs = df.select("doc_id", "text")

    def make(batch):
        texts = strings(batch, "text")
        return [[mark(t) for t in texts], [fingerprint(t, size) for t in texts], [heads(shingle_set(t, size)) for t in texts]]

    rows = stored(with_columns(docs, make, "mark bigint, simhash bigint, heads array<bigint>", drop=("text",)), "marks")
    classes = rows.groupBy("mark").agg(F.min("doc_id").alias("first_id"))
    texts = rows.select("mark", "simhash").distinct()
    joined = stored(components(near_links(texts)), "joined").select(F.col("node").alias("simhash"), F.col("root").alias("head"))
    tries = texts.join(joined, "simhash", "left").select("mark", "simhash", F.lit(HEADS).alias("run"), F.coalesce("head", "simhash").alias("head"))
    keyed = rows.select("mark", "simhash", F.posexplode("heads").alias("run", "head")).distinct().unionAll(tries)
    shared = keyed.groupBy("run", "head").count().where("count > 1")
    members = stored(keyed.join(shared, ["run", "head"]), "members")
    wanted = marks(docs).join(members.select("mark").distinct(), "mark", "left_semi").dropDuplicates(["mark"]).select("mark", "text")
    sets = with_columns(wanted, lambda batch: [[shingle_set(t, size).tobytes() for t in strings(batch, "text")]], "held binary", drop=("text",))
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    dealt = members.withColumn("own", F.pmod(F.xxhash64("mark"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    grouped = dealt.join(stored(sets, "sets"), "mark").select(
        "run", "head", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "mark", "simhash", "held"
    ).repartition("run", "head", "low", "high").sortWithinPartitions("run", "head", "low", "high")
    links = grouped.mapInArrow(lambda batches: _compared(batches, budget, similarity), "a bigint, b bigint")
    roots = stored(components(links), "roots").withColumnRenamed("node", "mark")
    rooted = classes.join(roots, "mark").select("mark", "root", "first_id")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = rooted.join(least, "root").select("mark", "component_id")
    named = classes.join(linked, "mark", "left").select("mark", F.coalesce("component_id", "first_id").alias("component_id"))
    return rows.select("doc_id", "mark").join(stored(named, "named"), "mark").select("doc_id", "mark", "component_id")


def _compared(batches, budget: int, similarity: float):
    """Links that span the near texts of each group of consecutive rows, across batches."""
    key, group = None, []
    for batch in batches:
        found: list = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:4] != key:
                found += near_links_of(group, key, budget, similarity)
                key, group = row[:4], []
            group.append(row[4:])
        yield _links_batch([tuple(np.array(found, np.int64).reshape(-1, 2).T)])
    yield _links_batch([tuple(np.array(near_links_of(group, key, budget, similarity), np.int64).reshape(-1, 2).T)])


def near_links_of(group: list, key: tuple | None, budget: int, similarity: float) -> list[tuple[int, int]]:
    """Spanning links of rows of block, mark, fingerprint and set; of two blocks only pairs across."""
    if len(group) < 2:
        return []
    across = key[2] != key[3]
    block = np.array([g[0] for g in group])
    prints = np.array([g[2] for g in group], np.int64).view(np.uint64)
    sets = [np.frombuffer(g[3], "<u8") for g in group]
    sizes = np.array([len(s) for s in sets])
    label, links = np.arange(len(group)), []
    for i in range(1, len(group)):
        near = np.bitwise_count(prints[:i] ^ prints[i]) <= budget
        near &= np.minimum(sizes[:i], sizes[i]) >= similarity * np.maximum(sizes[:i], sizes[i]) - 1e-9
        if across:
            near &= block[:i] != block[i]
        for j in np.flatnonzero(near):
            if label[i] != label[j]:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if both >= similarity * (sizes[i] + sizes[j] - both) - 1e-9:
                    links.append((group[i][1], group[j][1]))
                    label[label == label[j]] = label[i]
    return links
