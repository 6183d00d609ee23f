"""SimHash near copies, fingerprints, and the pipeline."""

import hashlib
import random
import re

import compare
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from swathe.llm import components, fingerprints, simhash, stages

DOCS = "doc_id bigint, text string"


def brute_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_components(prints, budget=2):
    prints = np.array(prints, np.uint64)
    label = np.arange(len(prints))
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= budget) + i + 1:
            a, b = sorted((label[i], label[j]))
            label[label == b] = a
    return label


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def crowded(n, seed, heads=3):
    draw = np.random.default_rng(seed)
    base = draw.integers(0, 1 << 63, heads, dtype=np.uint64)
    values = base[draw.integers(0, heads, n)]
    for _ in range(6):
        flips = np.uint64(1) << draw.integers(0, 64, n).astype(np.uint64)
        values = np.where(draw.random(n) < 0.5, values ^ flips, values)
    return np.unique(values)


@pytest.mark.parametrize("leaf", [4, 128])
def test_trie_walk_spans_all_links(monkeypatch, leaf):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    for seed in range(6):
        values = crowded(300, seed)
        a, b = simhash.spanning_links(values, None)
        label = {int(v): int(v) for v in values} | {int(x): int(y) for x, y in zip(a, b)}
        assert same_partition([label[int(v)] for v in values], brute_components(values).tolist())
        left, right = values[::2], values[1::2]
        a, b = simhash.spanning_links(left, right)
        joined = {int(v): int(v) for v in values} | {int(x): int(y) for x, y in zip(a, b)}
        near = [(int(x), int(y)) for x in left for y in right if (int(x) ^ int(y)).bit_count() <= 2]
        assert all(joined[x] == joined[y] for x, y in near)


@pytest.mark.parametrize("large", [1 << 15, 20])
def test_links_of_a_table(spark, monkeypatch, large):
    monkeypatch.setattr(simhash, "LARGE", large)
    values = crowded(900, 42, 2)
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "simhash bigint")
    roots = {r["node"]: r["root"] for r in components.components(simhash.near_links(df)).collect()}
    got = [roots.get(int(v), int(v)) for v in values.view(np.int64)]
    assert same_partition(got, brute_components(values).tolist())


def test_components(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (200, 100), (None, 3)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components.components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 100}
    assert components.components(df.limit(0)).count() == 0


def test_near_dedup_edges(spark):
    text = " ".join(f"word{i}" for i in range(400))
    rows = [(5, text), (9, text), (9, text), (3, text.upper()), (2, None), (1, ""), (4, " \t"), (None, "lone text here"), (7, "quite another text"), (None, text)]
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], DOCS + ", SIMHASH int, component_id int")
    out = simhash.near_dedup(df).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in out) == sorted(
        [("5", "3"), ("9", "3"), ("9", "3"), ("3", "3"), ("2", "1"), ("1", "1"), ("4", "1"), ("None", "None"), ("7", "7"), ("None", "3")]
    )
    assert simhash.near_dedup(df.limit(0)).count() == 0
    kept = stages.one_of_each_group(spark, df, "")
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "7", "None"]


def test_simhash_query(spark, sf):
    rows = {r["doc_id"]: r for r in compare.load_entry().queries()["op9_simhash"](spark, sf).collect()}
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    prints = [brute_print(t) for _, t in docs]
    label = brute_components(prints)
    assert len(rows) == len(docs)
    for k, (doc_id, _) in enumerate(docs):
        assert rows[doc_id]["fingerprint"] == f"{prints[k]:016x}" and rows[doc_id]["component_id"] == docs[label[k]][0]


def test_stage_drops_planted_near_copies(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    draw = random.Random(12)
    rows = []
    for k in range(60):
        words = [f"w{draw.randrange(5000)}" for _ in range(200)]
        other = list(words)
        for i in draw.sample(range(10, 190), 1 + k % 6):
            other[i] = "changed"
        rows += [(k, " ".join(words)), (1000 + k, " ".join(other))]
    words = [f"v{draw.randrange(5000)}" for _ in range(300)]
    rows += [(2000 + k, " ".join(words[:k] + ["x"] + words[k + 1 :])) for k in range(50)]
    near = [k for k in range(60) if jaccard(rows[2 * k][1], rows[2 * k + 1][1]) >= 0.8]
    assert 20 < len(near) < 60
    kept = {r[0] for r in stages.one_of_each_group(spark, spark.createDataFrame(rows, DOCS), "").select("doc_id").collect()}
    assert kept == set(range(60)) | {1000 + k for k in range(60) if k not in near} | {2000}


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(text, following):
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def test_fingerprints_estimate_jaccard(spark, sf):
    rows = {r["doc_id"]: r for r in compare.load_entry().queries()["op6_fingerprints"](spark, sf).collect()}
    docs = sorted((tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()), reverse=True)
    errors, equal = [], {}
    for k, (doc_id, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        row, other = rows[doc_id], edited(text, following)
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(other.encode()).hexdigest()
        errors += [row["near_edited"] - jaccard(text, other), row["near_next"] - jaccard(text, following)]
        for t, f in ((text, row["fingerprint"]), (other, row["edited_fingerprint"])):
            assert equal.setdefault(t, f) == f and len(f) == 512
    assert np.abs(errors).mean() < 0.02 and np.abs(errors).max() < 0.2 and abs(np.mean(errors)) < 0.005


def test_short_texts_are_told_apart(spark):
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choices("abcdefghij", k=draw.randrange(1, 12)))) for i in range(300)]
    df = fingerprints.fingerprint(spark.createDataFrame(rows, DOCS), "text", "print")
    prints = {r["doc_id"]: r["print"] for r in df.collect()}
    pairs = spark.createDataFrame([(a, b, prints[a], prints[b]) for a, b in zip(range(299), range(1, 300))], "i int, j int, a string, b string")
    got = pairs.select("i", "j", fingerprints.likeness("a", "b").alias("near")).collect()
    assert np.mean([abs(r["near"] - jaccard(rows[r["i"]][1], rows[r["j"]][1])) for r in got]) < 0.03


def test_fingerprint_edges(spark, monkeypatch):
    rows = [(3, "c c"), (2, None), (2, None), (1, "a b c d e f g"), (None, "last"), (5, ""), (1 << 60, "big"), ((1 << 60) + 1, "bigger " * 3000)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], DOCS + ", fingerprint string, Next_text int")
    order = [(1 << 60) + 1, 1 << 60, 5, 3, 2, 2, 1, None]
    by_id = dict(rows)
    want = sorted((str(i), hashlib.sha256(edited(by_id[i] or "", by_id[order[(k + 1) % 8]] or "").encode()).hexdigest()) for k, i in enumerate(order))
    for run in (1024, 2):
        monkeypatch.setattr(fingerprints, "RUN", run)
        out = fingerprints.compare_with_next(df).collect()
        assert sorted((str(r["doc_id"]), r["edited_sha256"]) for r in out) == want
    by_row = {r["doc_id"]: r for r in out}
    assert by_row[5]["fingerprint"] == "" and by_row[5]["near_edited"] == 1.0 and by_row[5]["near_next"] == 0.0
    assert by_row[1]["near_next"] < 0.05
    alone = fingerprints.compare_with_next(df.where("doc_id = 1")).first()
    assert alone["near_next"] == 1.0
    assert fingerprints.compare_with_next(df.limit(0)).count() == 0


def test_runs_keep_the_order(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RUN", 7)
    ids = random.Random(6).sample(range(-500, 500), 300)
    df = spark.createDataFrame([(i, str(i)) for i in ids], DOCS)
    got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(df, ["text"]).collect()}
    ids = sorted(ids, reverse=True)
    assert got == {i: str(ids[(k + 1) % len(ids)]) for k, i in enumerate(ids)}


def test_native_plans(spark, sf):
    queries = compare.load_entry().queries()
    for name in ("op6_fingerprints", "op10_licenses"):
        plan = queries[name](spark, sf)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_stage_names():
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "secret_scan", "best_fit_packing"]


def test_toxicity_stage(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    marked = docs.withColumn("Score", F.lit(1.0)).withColumn("_kept_0", F.lit("x"))
    clean = stages.without_toxic(spark, marked, sf)
    assert clean.columns == marked.columns
    assert clean.exceptAll(marked).count() == 0 and 0 < clean.count() < marked.count()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    gone = marked.join(clean, "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.where("toxic = 1").count() >= 0.7 * gone.count()


def test_near_dedup_stage(spark, sf):
    """One of each component of all pairs of five-word Jaccard 0.8, whatever columns come along."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("Mark", F.lit(1)).withColumn("component_id", F.lit(""))
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))
    for j in range(len(rows)):
        for i in range(j):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                label = [label[i] if x == label[j] else x for x in label]
    first = {}
    for (doc_id, _), x in zip(rows, label):
        first.setdefault(x, doc_id)
    single = stages.one_of_each_group(spark, docs, sf)
    assert single.columns == docs.columns and single.exceptAll(docs).count() == 0
    assert sorted(r["doc_id"] for r in single.select("doc_id").collect()) == sorted(first.values())


def test_near_copies_edges(spark):
    long_ = " ".join(f"w{i}" for i in range(60_000))
    rows = [(4, None), (2, ""), (7, long_), (7, long_ + " more"), (None, long_), (9, "a b"), (9, "a b"), (1, "a  B"), (None, None), (5, "c " * 30_000), (6, "c c c c c")]
    df = spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", HEADS string")
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in simhash.near_copies(df).collect())
    assert got == sorted([
        ("4", "2"), ("2", "2"), ("None", "2"), ("7", "7"), ("7", "7"), ("None", "7"), ("9", "1"), ("9", "1"), ("1", "1"), ("5", "5"), ("6", "5"),
    ])
    assert simhash.near_copies(df.limit(0)).count() == 0


def test_near_copies_go_by_tries_of_fingerprints(spark, monkeypatch):
    """Texts whose fingerprints are within two bits are found without any head, and linked if similar enough."""
    monkeypatch.setattr(simhash, "heads", lambda found: [])
    draw, rows = random.Random(5), []
    for k in range(40):
        words = [f"w{draw.randrange(5000)}" for _ in range(400)]
        rows += [(k, " ".join(words)), (100 + k, " ".join(words[:200] + ["x"] + words[201:]))]
    # The same fingerprint by frequent shingles, but another set.
    rows += [(300, "a b c d e " * 60), (301, "a b c d e " * 60 + " ".join(f"v{i}" for i in range(40)))]
    prints = {k: simhash.fingerprint(t, 5) for k, t in rows}
    near = {k for k in range(40) if (prints[k] ^ prints[100 + k]) % (1 << 64) in _within_two_bits()}
    assert len(near) > 10 and prints[300] == prints[301]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {k: k - 100 if k - 100 in near else k for k, _ in rows}


def _within_two_bits():
    return {0} | {1 << i | 1 << j for i in range(64) for j in range(64)}


def test_secret_stage(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    blank = stages.secrets_blanked(spark, docs, sf)
    assert blank.columns == docs.columns and blank.count() == docs.count()
    assert blank.where("text rlike 'token = \"[0-9a-f]{30}'").count() == 0
    assert blank.where("n_chars <> char_length(text)").count() == 0


def test_packed_pipeline(spark, sf):
    packed = compare.load_entry().queries()["pipeline"](spark, sf)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    assert packed.count() > 0


def test_stages_on_empty_tables(spark, sf):
    import corpus_pipeline

    empty = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf)
        assert empty.count() == 0
