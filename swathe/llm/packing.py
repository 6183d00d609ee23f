"""Packing of tokenized documents into sequences of a fixed length.

Pieces are dealt at random into groups of bounded size, each packed by one
task: best fit in order of falling length, then a local search. The search takes
the emptiest bin and moves a document out of it, or exchanges one or two of its
documents for a shorter one of another underfull bin, where that raises the sum
of squared fills, until the bin is empty or nothing helps. A group ends with at
most a bin or so more than its tokens need, which is a few in ten thousand.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathe.llm.common import held, rows_from, strings

#: Pieces of a group, on average.
GROUP = 8192
#: Steps of the local search for each underfull bin.
STEPS = 8
#: Chunks remembered by a worker, and encoded in one call.
REMEMBERED, TOGETHER = 650_000, 256
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"
PLACED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


class Words:
    """Ids of texts by the tokenizer file ``word_bpe_49k``, chunk by chunk.

    That tokenizer drops white space and lets no token cross it, so a text's
    ids are those of its chunks between spaces and line ends, and a chunk seen
    before needs no second run. Most chunks are Latin letters with marks
    behind, which are tokens apart: the letters in lower case go in together, past the
    normalization, which leaves such letters as they are, and part again at the
    tokens that end a word. All other chunks go alone through the whole tokenizer.
    """

    SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer, normalizers

        self.whole, self.lower = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings in a text are ordinary text
        self.lower.normalizer = normalizers.Sequence([])
        self.marks: dict[str, bytes] = {}
        vocabulary = self.lower.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.letters: dict[str, bytes] = {}
        self.memory: dict[str, bytes] = {}

    def alone(self, chunks: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.whole.encode_batch_fast(chunks, add_special_tokens=False)]

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks into the memory."""
        match, letters = self.SIMPLE.fullmatch, self.letters
        simple, rest = [], []
        for chunk in chunks:
            found = match(chunk)
            if found:
                simple.append((chunk, found[1].lower(), found[2]))
            else:
                rest.append(chunk)
        new = list({w for _, w, _ in simple if w not in letters})
        if len(letters) + len(new) > REMEMBERED:
            letters.clear()
            new = list({w for _, w, _ in simple})
        for i in range(0, len(new), TOGETHER):
            part = new[i : i + TOGETHER]
            run = self.lower.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids
            ids = np.array(run, "<u4")
            ends = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
            packed = ids.tobytes()
            letters.update(zip(part, (packed[a:b] for a, b in zip([0, *ends], ends)), strict=True))
        marks = self.marks
        tails = [m for m in {m for _, _, m in simple} if m not in marks]
        if len(marks) + len(tails) > REMEMBERED:
            marks.clear()
            tails = list({m for _, _, m in simple})
        marks.update(zip(tails, self.alone(tails)))
        self.memory.update((c, letters[w] + marks[m]) for c, w, m in simple)
        for i in range(0, len(rest), 10_000):
            self.memory.update(zip(rest[i : i + 10_000], self.alone(rest[i : i + 10_000])))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, at = [], 0
        while at < len(texts):  # so many texts at a time that their chunks fit the memory
            split, seen, total = [], set(), 0
            while at < len(texts) and (not split or total + len(texts[at]) <= 2_000_000):
                chunks = texts[at].replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
                seen.update(chunks)
                split.append(chunks)
                total += len(texts[at])
                at += 1
            known = self.memory
            new = list(seen - known.keys())
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = list(seen)
            self.learn(new)
            out += [b"".join(map(known.__getitem__, chunks)) for chunks in split]
        return out


def words(path: str) -> Words:
    return held(__name__, path, lambda: Words(path))


def pieces(df: DataFrame, path: str, limit: int = 2048, end: int = 0, keep_ids: bool = True) -> DataFrame:
    """Documents as pieces of at most ``limit`` ids: ``doc_id``, ``piece``, ``start``,
    ``length``, ``ids_crc32`` and ``ids`` (packed, little-endian; null unless kept).

    A document is its text's ids and then ``end``; a null or empty text is
    ``end`` alone. Only documents longer than ``limit`` are cut. Repeated rows
    are documents of their own. Columns other than ``doc_id`` and ``text`` are
    not read.
    """

    def make(batch):
        rows = []
        closing = end.to_bytes(4, "little")
        ids = batch.column(0).to_pylist()
        for doc_id, packed in zip(ids, words(path).encode(strings(batch, "text"))):
            packed += closing
            for k, at in enumerate(range(0, len(packed), 4 * limit)):
                part = packed[at : at + 4 * limit]
                rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
        return list(map(list, zip(*rows))) or [[]] * 6

    return rows_from(df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), make, PIECES)


def pack(df: DataFrame, at_most: int, limit: int = 2048) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``, the place in that sequence.

    ``at_most`` is about the number of pieces and fixes the number of groups; it
    bounds the work of a task and changes nothing else. Pieces of one sequence
    follow each other without a gap from offset 0. An empty table stays empty.
    """
    groups = max(1, -(-at_most // GROUP))
    dealt = df.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.expr(f"pmod(xxhash64(monotonically_increasing_id()), {groups})").alias("dealt_to"),
    )

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins = fill(rows.column("length").to_pylist(), limit)
        first = rows.column("dealt_to")[0].as_py() << 32
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        lengths = rows.column("length").to_numpy()
        for k, members in enumerate(bins):
            sequence[members] = first + k
            offset[members] = np.cumsum(lengths[members]) - lengths[members]
        return rows.drop_columns(["dealt_to"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return dealt.groupBy("dealt_to").applyInArrow(run, PLACED)


def pack_documents(df: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """:func:`pieces` of ``df``, placed by :func:`pack`."""
    size = df.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    return pack(pieces(df, path, limit, keep_ids=False), size[0] + size[1] // limit, limit)


def fill(lengths: list[int], limit: int) -> list[list[int]]:
    """Bins of indexes into ``lengths``, which fall and are at most ``limit``."""
    bins = best_fit(lengths, limit)
    return improved(bins, lengths, limit)


def best_fit(lengths: list[int], limit: int) -> list[list[int]]:
    """Each length into the fullest bin with room for it, else into a new one."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms = 0  # bit r: some bin has room r
    for i, n in enumerate(lengths):
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[k].append(i)
        else:
            room, k = limit, len(bins)
            bins.append([i])
        by_room[room - n].append(k)
        rooms |= 1 << (room - n)
    return bins


def improved(bins: list[list[int]], lengths: list[int], limit: int) -> list[list[int]]:
    """Local search over the underfull bins; never more bins than before.

    Every step raises the sum of squared fills. The search ends when no step
    helps, when the bins are as few as the lengths need, or after as many steps
    as there are ``STEPS`` for each underfull bin.
    """
    size = np.asarray(lengths, np.int64)
    home = np.zeros(len(size), np.int64)
    for k, members in enumerate(bins):
        home[members] = k
    fills = np.bincount(home, size, len(bins)).astype(np.int64)
    need, left = -(-int(size.sum()) // limit), int((fills > 0).sum())
    stuck = np.zeros(len(bins), bool)
    for _ in range(STEPS * int((fills < limit).sum())):
        underfull = (fills < limit) & (fills > 0)
        sources = np.flatnonzero(underfull & ~stuck)
        if left <= need or not len(sources):
            break
        source = int(sources[fills[sources].argmin()])
        move = _best_move(source, np.flatnonzero(underfull), home, fills, size, limit)
        if move is None:
            stuck[source] = True
            continue
        target, out, back = move
        home[out], home[back] = target, source
        net = int(size[out].sum() - size[back].sum())
        fills[source] -= net
        fills[target] += net
        stuck[[source, target]] = False
        left -= fills[source] == 0
    order = np.argsort(home, kind="stable")
    return [m.tolist() for m in np.split(order, np.flatnonzero(np.diff(home[order])) + 1) if len(m)]


def _best_move(source: int, underfull: np.ndarray, home: np.ndarray, fills: np.ndarray, size: np.ndarray, limit: int):
    """Target, items that leave and items that come back, with the greatest gain in squared fill."""
    own = np.flatnonzero(home == source)
    targets = underfull[underfull != source]
    if not len(targets):
        return None
    allowed = np.zeros(len(fills), bool)
    allowed[targets] = True
    other = np.flatnonzero(allowed[home])
    i, j = np.triu_indices(len(own), 1)
    given = np.concatenate([size[own], size[own[i]] + size[own[j]]])

    def gains(net: np.ndarray, bins: np.ndarray) -> np.ndarray:
        rise = 2 * net * (fills[bins] - fills[source] + net)
        return np.where((net > 0) & (net <= limit - fills[bins]), rise, 0)

    moved = gains(size[own][:, None] + np.zeros(len(targets), np.int64), targets)
    swapped = gains(given[:, None] - size[other], home[other])
    if max(moved.max(), swapped.max()) <= 0:
        return None
    if moved.max() >= swapped.max():
        row, column = np.unravel_index(moved.argmax(), moved.shape)
        return int(targets[column]), own[[row]], own[:0]
    row, column = np.unravel_index(swapped.argmax(), swapped.shape)
    out = own[[row]] if row < len(own) else own[[i[row - len(own)], j[row - len(own)]]]
    return int(home[other[column]]), out, other[[column]]


def sequences(placed: DataFrame, parts: DataFrame) -> DataFrame:
    """``sequence_id``, ``ids`` of each whole sequence, from placed pieces and
    :func:`pieces` with their ids kept. ``(doc_id, piece)`` must be a key."""
    both = placed.join(parts.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    members = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most `limit` pieces
    return both.groupBy("sequence_id").agg(members.alias("m")).select(
        "sequence_id", F.aggregate("m", F.to_binary(F.lit(""), F.lit("hex")), lambda done, x: F.concat(done, x["ids"])).alias("ids")
    )
