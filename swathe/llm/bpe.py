"""Byte-level BPE by a segment tree over byte positions.

Each leaf holds the rank of the pair that starts at its position, joined with
the position, so that the root is the leftmost pair of the lowest rank. A merge
changes the leaves of the merged token and of its live neighbours, and their
paths to the root, and nothing else: a piece of n bytes costs O(n log n).

Short pieces are many and alike, so their trees lie side by side in one array
and take a merge each at a time. A long piece has a tree of its own.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import regex
from pyspark.sql import DataFrame

from swathe.llm.common import held, strings, with_columns

#: Pieces up to this length share arrays.
SHARED = 256
#: Positions in the arrays of one round, and pieces remembered by a worker.
POSITIONS, REMEMBERED = 1 << 18, 300_000
NONE = np.iinfo(np.int64).max


class Vocabulary:
    """Ranks of a file of base64 tokens and ranks, and the pairs that make them."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        # Rust's \s is the Unicode property; Python's also takes the four separators U+001C to U+001F.
        self.pieces = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.size = max(self.rank.values(), default=0) + 1
        self.bytes = [b""] * self.size
        for token, rank in self.rank.items():
            self.bytes[rank] = token
        self.byte = np.array([self.rank.get(bytes([i]), -1) for i in range(256)], np.int64)
        if (self.byte < 0).any():
            raise ValueError("every single byte must have a rank")
        get, pairs = self.rank.get, {}
        for token, rank in self.rank.items():
            for i in range(1, len(token)):
                a, b = get(token[:i]), get(token[i:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = rank
        self.pair = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in sorted(pairs)], np.int64)
        self.memory: dict[str, bytes] = {}

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that each pair makes, or -1."""
        if not len(self.keys):
            return np.full(len(left), -1)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], -1)

    def forest(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Packed ids of pieces of 2 to ``width`` bytes, ``width`` a power of two."""
        n = len(pieces)
        size = np.array([len(p) for p in pieces])
        row = np.repeat(np.arange(n), size)
        column = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        token = np.full(n * width, -1, np.int64)
        token[row * width + column] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.tile(np.arange(1, width + 1), n)
        after[np.arange(n) * width + size - 1] = width
        before = np.tile(np.arange(-1, width - 1), n)
        tree = np.full((n, 2 * width), NONE)
        spot = (row * width + column)[column < np.repeat(size, size) - 1]
        rank = self.merged(token[spot], token[spot + 1])
        tree[spot // width, width + spot % width] = np.where(rank < 0, NONE, rank * width + spot % width)
        half = width // 2
        while half:
            tree[:, half : 2 * half] = np.minimum(tree[:, 2 * half : 4 * half : 2], tree[:, 2 * half + 1 : 4 * half : 2])
            half //= 2
        tree = tree.reshape(-1)
        live = np.arange(n)
        while True:
            root = tree[live * 2 * width + 1]
            live, root = live[root < NONE], root[root < NONE]
            if not len(live):
                break
            base, at, new = live * width, root % width, root // width
            gone = after[base + at]
            follow = after[base + gone]
            token[base + at], token[base + gone], after[base + at] = new, -1, follow
            has = follow < width
            before[(base + follow)[has]] = at[has]
            leaf = np.full(len(live), NONE)
            rank = self.merged(new[has], token[(base + follow)[has]])
            leaf[has] = np.where(rank < 0, NONE, rank * width + at[has])
            tree[2 * base + width + at], tree[2 * base + width + gone] = leaf, NONE
            prior = before[base + at]
            has = prior >= 0
            rank = self.merged(token[(base + prior)[has]], new[has])
            tree[(2 * base + width + prior)[has]] = np.where(rank < 0, NONE, rank * width + prior[has])
            root = np.concatenate([2 * base, 2 * base, 2 * base[has]])
            node = np.concatenate([at, gone, prior[has]]) + width
            while node[0] > 1:
                node = node >> 1
                tree[root + node] = np.minimum(tree[root + 2 * node], tree[root + 2 * node + 1])
        kept = token >= 0
        ends = np.cumsum(kept.reshape(n, width).sum(1)) * 4
        packed = token[kept].astype("<u4").tobytes()
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def single(self, piece: bytes) -> bytes:
        """Packed ids of one long piece, by a tree in a list."""
        n = len(piece)
        width = 1 << max(1, (n - 1).bit_length())
        none, pair, size = 1 << 62, self.pair.get, self.size
        token = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        tree = [none] * (2 * width)
        for i in range(n - 1):
            rank = pair(token[i] * size + token[i + 1])
            if rank is not None:
                tree[width + i] = rank * width + i
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(i: int, value: int) -> None:
            i += width
            tree[i] = value
            while i > 1:
                i >>= 1
                low = min(tree[2 * i], tree[2 * i + 1])
                if tree[i] == low:
                    break
                tree[i] = low

        while tree[1] < none:
            new, at = divmod(tree[1], width)
            gone = after[at]
            follow = after[gone]
            token[at], token[gone], after[at] = new, -1, follow
            put(gone, none)
            rank = None
            if follow >= 0:
                before[follow] = at
                rank = pair(new * size + token[follow])
            put(at, none if rank is None else rank * width + at)
            prior = before[at]
            if prior >= 0:
                rank = pair(token[prior] * size + new)
                put(prior, none if rank is None else rank * width + prior)
        return np.array([t for t in token if t >= 0], "<u4").tobytes()

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces into the memory."""
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode()
            rank = self.rank.get(raw)
            if rank is not None:
                self.memory[piece] = rank.to_bytes(4, "little")
            elif len(raw) > SHARED:
                self.memory[piece] = self.single(raw)
            else:
                groups.setdefault(max(4, (len(raw) - 1).bit_length()), []).append((piece, raw))
        for bits, group in groups.items():
            step = max(1, POSITIONS >> bits)
            for i in range(0, len(group), step):
                part = group[i : i + step]
                self.memory.update(zip((p for p, _ in part), self.forest([r for _, r in part], 1 << bits)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, start = [], 0
        while start < len(texts):  # so many texts at a time that their pieces fit the memory
            split, seen, total = [], set(), 0
            while start < len(texts) and (not split or total + len(texts[start]) <= 2_000_000):
                pieces = self.pieces.findall(texts[start])
                seen.update(pieces)
                split.append(pieces)
                total += len(texts[start])
                start += 1
            known = self.memory
            new = {p for p in seen if p not in known}
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = seen
            self.learn(new)
            out += [b"".join([known[p] for p in pieces]) for pieces in split]
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One vocabulary per worker process."""
    return held(__name__, (path, pattern), lambda: Vocabulary(path, pattern))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids``, the tokens of the whole text as packed little-endian
    unsigned 32-bit integers.

    A null text is empty and has no ids. Each row is encoded by itself: repeated
    rows stay, other columns pass through, and a column named ``ids`` is
    replaced. There are no special tokens; their strings are ordinary text.
    """
    return with_columns(df, lambda batch: [vocabulary(path, pattern).encode(strings(batch, text))], "ids binary")


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the bytes that packed ids stand for; null for null."""

    def run(batch):
        decode = vocabulary(path, pattern).decode
        return [[None if x is None else decode(x) for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()]]

    return with_columns(df, run, "decoded binary")


def sha256(packed: bytes) -> str:
    return hashlib.sha256(packed).hexdigest()
