"""Byte-level BPE and packing against the libraries they must agree with."""

import base64
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import compare
from swathe.llm import bpe, packing

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
ROWS = [(1, "Hello  wörld, don't!\n\n x"), (2, ""), (3, None), (1, "Hello  wörld, don't!\n\n x"), (None, "a\x1cb\x85c\u3000d"), (4, "ab" * 3000)]
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def library():
    with open(BYTES, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return t


def packed(ids):
    return np.array(ids, "<u4").tobytes()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=300))
def test_bpe_agrees_on_any_text(library, text):
    vocabulary = bpe.vocabulary(BYTES, public_tokenizers.PATTERN)
    got = vocabulary.encode([text])[0]
    assert got == packed(library.encode_ordinary(text))
    assert vocabulary.decode(got) == text.encode()


def test_bpe_long_pieces_and_full_memory(library, monkeypatch):
    vocabulary = bpe.Vocabulary(BYTES, public_tokenizers.PATTERN)
    texts = ["x" * 5000, "abcdefgh" * 400, "ß" * 300, " ".join(f"word{i}x" for i in range(500)), "the the the"]
    want = [packed(library.encode_ordinary(t)) for t in texts]
    assert vocabulary.encode(texts) == want
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "POSITIONS", 32)
    vocabulary.memory.clear()
    assert [vocabulary.encode([t])[0] for t in texts] == want
    assert [vocabulary.single(t.encode()) for t in texts[:3]] == want[:3]


def test_bpe_rows(spark, library):
    df = spark.createDataFrame([(*r, "kept", "gone") for r in ROWS], SCHEMA + ", other string, IDS string")
    out = bpe.decode(bpe.encode(df, BYTES, public_tokenizers.PATTERN), BYTES, public_tokenizers.PATTERN).collect()
    assert [c.lower() for c in out[0].asDict()] == ["doc_id", "text", "other", "ids", "decoded"]
    for row in out:
        assert bytes(row["ids"]) == packed(library.encode_ordinary(row["text"] or ""))
        assert bytes(row["decoded"]) == (row["text"] or "").encode() and row["other"] == "kept"
    assert len(out) == len(ROWS)
    assert bpe.encode(df.limit(0), BYTES, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_words_agree_on_any_text(tokenizer, text):
    assert packing.words(WORDS).encode([text])[0] == packed(tokenizer.encode(text, add_special_tokens=False).ids)


def test_words_agree_on_documents(tokenizer, spark, sf, monkeypatch):
    texts = [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    texts += ["don't WE'LL, it's.", "Σας ΑΣ İx", "<|endoftext|> a|b | c", "e\u0301a \u0301x"]
    monkeypatch.setattr(packing, "REMEMBERED", 2000)
    got = packing.Words(WORDS).encode(texts)
    assert got == [packed(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=120))
def test_filled_bins_hold_everything_once(lengths):
    lengths = sorted(lengths, reverse=True)
    first, best = packing.best_fit(lengths, 100), packing.fill(lengths, 100)
    assert sorted(i for b in best for i in b) == list(range(len(lengths)))
    assert all(0 < sum(lengths[i] for i in b) <= 100 for b in best)
    assert -(-sum(lengths) // 100) <= len(best) <= len(first)


def test_search_empties_bins_that_best_fit_leaves():
    assert len(packing.best_fit([6, 5, 5, 4, 4, 3, 3], 10)) >= len(packing.fill([6, 5, 5, 4, 4, 3, 3], 10)) == 3
    lengths = sorted(np.random.default_rng(3).integers(30, 55, 300).tolist(), reverse=True)
    assert len(packing.fill(lengths, 100)) <= len(packing.best_fit(lengths, 100))


def check_packing(rows, tokenizer, docs, limit=2048):
    want = sorted(
        (str(d), k // limit, k, len(part := ids[k : k + limit]), zlib.crc32(packed(part)))
        for d, t in docs
        for ids in [tokenizer.encode(t or "", add_special_tokens=False).ids + [0]]
        for k in range(0, len(ids), limit)
    )
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= limit
    return len(bins)


def test_packing_rows(spark, tokenizer):
    df = spark.createDataFrame([(*r, 9, 9) for r in ROWS], SCHEMA + ", piece int, Offset int")
    check_packing(packing.pack_documents(df, WORDS).collect(), tokenizer, ROWS)
    assert packing.pack_documents(df.limit(0), WORDS).count() == 0


def test_sequences_join_their_pieces(spark, tokenizer):
    df = spark.createDataFrame([(1, "one two"), (2, "three"), (3, "four five six")], SCHEMA)
    parts = packing.pieces(df, WORDS, limit=4)
    placed = packing.pack(packing.pieces(df, WORDS, limit=4, keep_ids=False), 3, limit=4)
    whole = {r["sequence_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in packing.sequences(placed, parts).collect()}
    everything = [i for t in ("one two", "three", "four five six") for i in tokenizer.encode(t, add_special_tokens=False).ids + [0]]
    assert sorted(i for ids in whole.values() for i in ids) == sorted(everything)
    assert all(len(ids) <= 4 for ids in whole.values())


def test_queries(spark, sf, tokenizer, library):
    import hashlib

    entry = compare.load_entry().queries()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = entry["op7_packing"](spark, sf).collect()
    bins = check_packing(rows, tokenizer, docs)
    assert bins <= 1.01 * sum(r["length"] for r in rows) / 2048 + 1
    got = {r["doc_id"]: r for r in entry["op8_bpe"](spark, sf).collect()}
    for doc_id, text in docs:
        ids = library.encode_ordinary(text or "")
        row = got[doc_id]
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
