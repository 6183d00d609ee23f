"""Interaction of quality filters, from a sparse document-term matrix.

Texts are cut into shards of bounded size. A shard's words are encoded by its own
dictionary first; then each distinct word of each shard gets its number in the
global dictionary, which holds every word of the corpus. What results is the
matrix in compressed sparse rows, a shard a row of a table: row pointers, word
numbers and counts. A row's sum is the number of words and its nonzero count the
number of different words.

The filters, each a condition that a text fails on:

* A: fewer than 50 words;
* B: 100 times the different words is below 65 times the words;
* C: 100 times the letters A to Z is above 5 times the code points;
* D: holds one of ``#$%&*|``;
* E: identical to the text of a smaller id.
"""

from __future__ import annotations

import hashlib
import zlib
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathe.llm.common import _starting, named_rows, stored, text_or_empty
from swathe.llm.words import coded_words, large_strings

FILTERS = "ABCDE"
#: Texts, and bytes of text, of one shard at most; a longer text is a shard of its own.
SHARD_ROWS, SHARD_BYTES = 1 << 16, 8 << 20

_DOCS = "array<struct<doc_id: bigint, part: string, digest: binary, c: boolean, d: boolean>>"
_SHARD = f"shard bigint, words array<string>, pointers binary, codes binary, counts binary, docs {_DOCS}"
_DOC = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), ("c", pa.bool_()), ("d", pa.bool_())])
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_STARTS_CODE_POINT = (np.arange(256) & 0xC0) != 0x80
_SIGNS = np.zeros(256, bool)
_SIGNS[list(b"#$%&*|")] = True


def encoded_shards(docs: DataFrame, most_rows: int = SHARD_ROWS, most_bytes: int = SHARD_BYTES) -> DataFrame:
    """Shards of ``doc_id``, ``text``, ``part`` with words encoded by the shard's own dictionary.

    Counts and the shard's own word numbers are 32-bit integers, row pointers 64-bit
    ones; all are packed as :func:`_packed` does it.
    """

    def run(batches):
        _starting(encoded_shards)
        at, held, rows, size = TaskContext.get().partitionId() << 33, [], 0, 0
        for batch in batches:
            start = 0
            for i, n in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
                if rows and (rows == most_rows or size + n > most_bytes):
                    yield _shard(at, [*held, batch.slice(start, i - start)])
                    pa.default_memory_pool().release_unused()
                    at, held, rows, size, start = at + 1, [], 0, 0, i
                rows, size = rows + 1, size + n
            held.append(batch.slice(start))
        if rows:
            yield _shard(at, held)

    return docs.select("doc_id", "text", "part").mapInArrow(run, _SHARD)


def _shard(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(parts)
    texts = pa.concat_arrays([large_strings(c) for c in rows.column(1).chunks])
    of_text, codes, words = coded_words(texts)
    width = max(1, len(words))
    cells = of_text * width
    cells += codes
    del of_text, codes
    cells.sort()
    first = np.flatnonzero(np.append(True, cells[1:] != cells[:-1])) if len(cells) else np.empty(0, np.int64)
    counts, cells = np.diff(np.append(first, len(cells))), cells[first]
    pointers = np.searchsorted(cells, np.arange(len(texts) + 1) * width)
    ends = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    utf8 = np.frombuffer(texts.buffers()[2] or b"", np.uint8)

    def total(of_kind: np.ndarray) -> np.ndarray:
        """How many bytes of a kind each text holds."""
        marked = np.append(np.flatnonzero(of_kind[utf8[ends[0] : ends[-1]]]), len(utf8) + 1) + ends[0]
        return np.diff(np.searchsorted(marked, ends))

    signs, digests = total(_SIGNS) > 0, [hashlib.sha256(utf8[i:j]).digest() for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]
    shouts = 100 * total(_UPPER) > 5 * (np.diff(ends) - total(~_STARTS_CODE_POINT))
    columns = [rows.column(0).combine_chunks(), rows.column(2).combine_chunks(), digests, shouts, signs]
    flat = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, _DOC)]
    docs = pa.StructArray.from_arrays(flat, fields=list(_DOC))
    one = lambda values, kind: pa.array([_packed(values, kind)], pa.binary())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string())),
            one(pointers, "<i8"), one(cells % width, "<i4"), one(counts, "<i4"),
            pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
        ],
        ["shard", "words", "pointers", "codes", "counts", "docs"],
    )


def _packed(values: np.ndarray, kind: str) -> bytes:
    """Whole numbers as compressed differences, which are small where they rise slowly."""
    return zlib.compress(np.diff(values, prepend=0).astype(kind).tobytes(), 1)


def _unpacked(packed: bytes, kind: str) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(packed), kind), dtype=kind)


def numbered(shards: DataFrame) -> DataFrame:
    """``shard``, ``code``, ``word``, ``word_id``: the global dictionary's number for every word of every shard.

    Equal words meet in one partition, in order, and are numbered as they pass
    by. A word takes one row for each shard that holds it, and no list of them.
    """
    words = shards.select(F.col("shard").alias("of_shard"), F.posexplode("words").alias("code", "word"))

    def run(batches):
        number, last = TaskContext.get().partitionId() << 33, None
        for batch in batches:
            if not batch.num_rows:
                continue
            word = batch.column(2)
            first = word[0].as_py()
            new = np.append(last is not None and first != last, pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False))
            ids = number + np.cumsum(new, dtype=np.int64)
            number, last = int(ids[-1]), word[len(word) - 1].as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids)], [*batch.schema.names, "word_id"])

    return words.repartition("word").sortWithinPartitions("word").mapInArrow(run, "of_shard bigint, code int, word string, word_id bigint")


def matrix(shards: DataFrame) -> DataFrame:
    """The document-term matrix: ``shard``, ``docs``, and the shard's compressed sparse
    rows as ``pointers``, ``word_ids`` (64-bit integers, rising in a row) and ``counts``."""

    def renumbered(key, own: pa.Table, numbers: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        names = np.empty(len(numbers), np.int64)
        names[numbers.column("code").to_numpy()] = numbers.column("word_id").to_numpy()
        pointers, ids = _unpacked(row["pointers"], "<i8"), names[_unpacked(row["codes"], "<i4")]
        order = np.lexsort((ids, np.repeat(np.arange(len(pointers) - 1), np.diff(pointers))))
        columns = {"pointers": pointers, "word_ids": ids[order], "counts": _unpacked(row["counts"], "<i4")[order]}
        out = own.select(["shard", "docs"])
        for name, values in columns.items():
            out = out.append_column(name, [[values.tobytes()]])
        return out

    fields = f"shard bigint, docs {_DOCS}, pointers binary, word_ids binary, counts binary"
    found = numbered(shards).drop("word")
    return shards.drop("words").groupBy("shard").cogroup(found.groupBy("of_shard")).applyInArrow(renumbered, fields)


def counted(sparse: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``digest``, ``c``, ``d`` and, from row sums and nonzero
    counts, ``n_words`` and ``n_distinct`` of every document."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                pointers, counts = np.frombuffer(row["pointers"], "<i8"), np.frombuffer(row["counts"], "<i4")
                total = np.append(0, np.cumsum(counts, dtype=np.int64))
                docs = pa.Table.from_pylist(row["docs"], schema=_DOC)
                yield from docs.append_column("n_words", [total[pointers[1:]] - total[pointers[:-1]]]).append_column(
                    "n_distinct", [np.diff(pointers)]
                ).to_batches()

    return sparse.select("docs", "pointers", "counts").mapInArrow(run, _DOC_FIELDS)


_DOC_FIELDS = "doc_id bigint, part string, digest binary, c boolean, d boolean, n_words bigint, n_distinct bigint"


def flagged(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part`` and ``failed``, a bit for each filter that a document fails, A the lowest.

    ``docs`` has ``doc_id``, ``text`` and ``source``; a null text or source is
    empty. A null id is smaller than none and has no smaller one.
    """
    named = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"), text_or_empty("source").alias("part")
    )
    shards = stored(encoded_shards(named), "shards")
    rows = stored(counted(matrix(shards)), "counted")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_rows"))
    rows = named_rows(rows, stored(first, "first"), "digest")
    fails = (
        F.col("n_words") < 50, 100 * F.col("n_distinct") < 65 * F.col("n_words"), F.col("c"), F.col("d"),
        F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)),
    )
    bits = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    return rows.select("doc_id", "part", bits.alias("failed"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For each ``part`` (a source), ``filter_order`` (all 120 orders of :data:`FILTERS`)
    and ``step`` (1 to 5, the filter at that place) the documents of the part:

    ``kept`` after this step, ``removed`` by it, ``redundant`` (fail this filter but
    were removed earlier), ``unique_fails`` (fail this filter only), ``good_lost``
    and ``toxic_lost`` (removed here with ``quality`` or ``toxic`` 1 in ``labels``),
    and ``shapley``, what the filter removes summed over all orders.

    Every row of ``docs`` counts as a document, repeated ones and those with a null
    id too; ids in several rows of ``labels`` have a label if one row says so. Each
    part has all its 600 rows; an empty table gives none. Other columns are not read.
    """
    said = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    rows = flagged(docs).join(said, "doc_id", "left")
    sums = rows.groupBy("part", "failed").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    masks = range(1 << len(FILTERS))
    names = ("n", "good", "toxic")
    # How many documents pass all filters of a set, for each of the 32 sets.
    passing = sums.groupBy("part").agg(
        *(F.array(*(F.sum(F.when(F.col("failed").bitwiseAND(F.lit(m)) == 0, F.col(c)).otherwise(0)) for m in masks)).alias(c) for c in names),
        F.array(*(F.sum(F.when(F.col("failed") == 1 << k, F.col("n")).otherwise(0)) for k in range(5))).alias("alone"),
    )
    passing = passing.withColumn("shapley", F.array(*(_shapley(k) for k in range(5))))
    steps = F.expr(f"array({', '.join(_step(order, k) for order in permutations(range(5)) for k in range(5))})")
    dealt = passing.select("*", F.explode(steps).alias("s"))

    def lost(c: str) -> Column:
        return F.expr(f"{c}[s.before] - {c}[s.after]")

    return dealt.select(
        "part", "s.filter_order", "s.step", F.expr("n[s.after]").alias("kept"), lost("n").alias("removed"),
        (F.expr("n[0] - n[shiftleft(1, s.filter)]") - lost("n")).alias("redundant"), F.expr("alone[s.filter]").alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.expr("shapley[s.filter]").alias("shapley"),
    )


def _step(order: tuple[int, ...], k: int) -> str:
    before, after = (sum(1 << f for f in order[:j]) for j in (k, k + 1))
    name = "".join(FILTERS[f] for f in order)
    return f"named_struct('filter_order', '{name}', 'step', {k + 1}, 'filter', {order[k]}, 'before', {before}, 'after', {after})"


def _shapley(k: int) -> Column:
    """Removed by filter ``k``, over all orders: each set of filters before it stands in so many of them."""
    others = [m for m in range(1 << 5) if not m & 1 << k]
    terms = [
        F.lit(factorial(m.bit_count()) * factorial(4 - m.bit_count())) * (F.col("n")[m] - F.col("n")[m | 1 << k]) for m in others
    ]
    return sum(terms[1:], terms[0])
