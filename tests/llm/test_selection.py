"""MinHash near-dedup, the audit of filters, and hard negatives, against brute force."""

import itertools
import random
import re

import compare
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from swathe.llm import audit, minhash, negatives

DOCS = "doc_id bigint, text string"


def brute_set(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return set(zip(words, words[1:])) if len(words) > 1 else {(w,) for w in words}


def brute_components(rows):
    """Smallest id reachable for each row of id and text, by all pairs."""
    sets = [brute_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            a, b = label[i], label[j]
            label = [a if x == b else x for x in label]
    ids = {}
    for (doc_id, _), x in zip(rows, label):
        if doc_id is not None:
            ids[x] = min(ids.get(x, doc_id), doc_id)
    return sorted((str(d), len(s), str(ids.get(x)), d == ids.get(x)) for (d, _), s, x in zip(rows, sets, label))


def found(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in df.collect())


def test_minhash_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = compare.load_entry().queries()["op11_minhash"](spark, sf)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert found(out) == brute_components(rows)


def test_minhash_edges(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [
        (5, text), (9, text), (9, text), (3, text.upper()), (2, None), (1, ""), (4, " \t"), (None, text), (None, None), (None, "lone text"),
        (7, "One"), (8, "one"), (6, "one one"), (10, "a b a b"), (11, "b a b"), (12, "x " * 60000), (13, "x\x0bx"), (14, "É é"), (15, "é é"),
    ]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], DOCS + ", KEPT int, set_key string")
    assert found(minhash.near_dedup(df)) == brute_components(rows)
    assert found(minhash.near_dedup(df.limit(0))) == []
    assert found(minhash.near_dedup(df.where("doc_id in (1, 2)"))) == [("1", 0, "1", True), ("2", 0, "2", True)]


def planted(seed):
    """Chains whose ends are far apart, a crowd around one text, and passages that many share without being near."""
    draw = random.Random(seed)
    rows, base = [], [f"w{draw.randrange(3000)}" for _ in range(150)]
    chain = list(base)
    for k in range(40):
        rows.append((k, " ".join(chain)))
        for i in draw.sample(range(150), 5):
            chain[i] = f"c{draw.randrange(9000)}"
    for k in range(60):
        own = list(base)
        for i in draw.sample(range(150), draw.randrange(0, 12)):
            own[i] = "changed"
        rows.append((100 + k, " ".join(own)))
    passage = [f"p{i}" for i in range(100)]
    for k in range(60):
        rows.append((200 + k, " ".join(passage + [f"q{draw.randrange(9000)}" for _ in range(20 + k % 25)])))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1024, 8])
def test_minhash_finds_every_link(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = planted(block)
    want = brute_components(rows)
    assert len({r[2] for r in want}) > 10 and found(minhash.near_dedup(spark.createDataFrame(rows, DOCS))) == want


def test_minima_estimate_similarity():
    draw = np.random.default_rng(3)
    for share in (0.3, 0.6, 0.9):
        errors = []
        for _ in range(40):
            values = draw.integers(0, 1 << 63, 600, dtype=np.uint64)
            both = int(600 * share)
            a, b = (np.unique(np.append(values[:both], draw.integers(0, 1 << 63, (600 - both) // 2, dtype=np.uint64))) for _ in range(2))
            x, y = minhash.signatures([a, b])
            errors.append((x == y).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    assert [len(s) for s in minhash.shingle_sets(pa.array(["a b a b", None, "", "z"]), 2)] == [2, 0, 0, 1]


def test_named_rows_of_heavy_keys(spark):
    from swathe.llm.common import named_rows

    rows = spark.range(3000).select(F.when(F.col("id") < 1500, 0).otherwise(F.col("id")).alias("k"), "id")
    names = rows.groupBy("k").agg(F.count("*").alias("n_rows"), F.min("id").alias("least"))
    out = named_rows(rows, names, "k")
    assert out.count() == 3000 and out.where("least <> k").count() == 0
    assert named_rows(rows.limit(0), names.limit(0), "k").count() == 0


def brute_audit(rows, labels):
    """Rows of id, text and source; labels of id, quality and toxic."""
    parts, first = {}, {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    good, toxic = ({d for d, *v in labels if d is not None and v[k] == 1} for k in (0, 1))
    for doc_id, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": doc_id is not None and text in first and doc_id > first[text],
        }
        parts.setdefault(source or "", []).append((fails, doc_id in good, doc_id in toxic))
    out = {}
    for part, docs in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = docs
            for k, f in enumerate(order):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                fail = [d for d in docs if d[0][f]]
                shapley[f] += len(gone)
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), len(fail) - len(gone), sum(sum(d[0].values()) == 1 for d in fail),
                    sum(d[1] for d in gone), sum(d[2] for d in gone), f,
                ]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return out


def test_audit_edges(spark, monkeypatch):
    draw = random.Random(5)
    long_ = " ".join(f"w{i}" for i in range(80))
    rows = [
        (1, long_, "a"), (2, long_, "a"), (2, long_, "b"), (2, long_, "b"), (None, long_, "a"), (3, None, None), (4, "", ""), (5, "A" * 99, None), (5, "a$", "b"),
        (6, "x " * 70000, "b"), (7, "Ä é ß " * 20, "c"), (-3, "#", "c"), (8, " \t\x0b", "c"), (9, "É" * 19 + "E", "c"), (10, "É" * 18 + "E", "c"), (None, None, None),
    ]
    rows += [(20 + k, " ".join(draw.choices(["Ab", "b", "c%", *map(str, range(40))], k=draw.randrange(40, 70))), draw.choice("ab")) for k in range(150)]
    labels = [(d, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for d, *_ in rows if draw.random() < 0.6] + [(None, 1, 1), (1, 1, 1), (1, 0, 0)]
    df = spark.createDataFrame([(*r, 0, "") for r in rows], DOCS + ", source string, PART int, digest string").repartition(3)
    marks = spark.createDataFrame([(*r, "") for r in labels], "doc_id bigint, quality int, toxic int, good string")
    want = brute_audit(rows, labels)
    shards = audit.encoded_shards
    for most in (4096, 7):
        monkeypatch.setattr(audit, "encoded_shards", lambda docs: shards(docs, most, 1 << 20))  # noqa: B023
        got = audit.audit(df, marks).collect()
        assert {tuple(r[:3]): list(r[3:]) for r in got} == want and len(got) == len(want) == 600 * 4
    assert audit.audit(df.limit(0), marks).count() == 0
    assert audit.audit(df, marks.limit(0)).agg(F.max("good_lost")).first()[0] == 0


def test_matrix_holds_every_word(spark):
    texts = ["b a a", None, "", "a c\nb b", "d"]
    df = spark.createDataFrame([(k, t or "", "") for k, t in enumerate(texts)], DOCS + ", part string").coalesce(1)
    shards = audit.encoded_shards(df, 2, 1 << 20)
    words = {r["word_id"]: r["word"] for r in audit.numbered(shards).collect()}
    assert sorted(words.values()) == ["a", "b", "c", "d"]
    got, rows = {}, audit.matrix(shards).collect()
    assert len(rows) == 3
    for row in rows:
        pointers, ids, counts = (np.frombuffer(row[c], t) for c, t in (("pointers", "<i8"), ("word_ids", "<i8"), ("counts", "<i4")))
        for k, doc in enumerate(row["docs"]):
            own = ids[pointers[k] : pointers[k + 1]]
            assert (np.diff(own) > 0).all()
            got[doc["doc_id"]] = {words[w]: c for w, c in zip(own.tolist(), counts[pointers[k] : pointers[k + 1]].tolist())}
    assert got == {k: {w: (t or "").split().count(w) for w in (t or "").split()} for k, t in enumerate(texts)}


def brute_negatives(rows, every):
    """Rows of id, vector and label."""
    rows = {(i, tuple(v), y) for i, v, y in rows if None not in (i, v, y) and all(x is not None and np.isfinite(x) for x in v)}
    whole = {r: [int(np.floor(256 * x)) for x in r[1]] for r in rows}
    out = []
    for a in rows:
        if a[0] % every:
            continue
        score = {r: sum(x * y for x, y in zip(whole[a], whole[r])) for r in rows if r[0] != a[0]}
        order = sorted(score, key=lambda r: (-score[r], r[0]))
        for p in [r for r in order if r[2] == a[2]][:5]:
            fit = [r for r in order if r[2] != a[2] and 50 * score[p] <= 100 * score[r] <= 95 * score[p]]
            out += [(a[0], p[0], k + 1, r[0], score[p], score[r]) for k, r in enumerate(fit[:3])]
    return sorted(out)


@pytest.mark.parametrize("held,block", [(16_384, 65_536), (3, 50)])
def test_hard_negatives(spark, monkeypatch, held, block):
    monkeypatch.setattr(negatives, "HELD", held)
    monkeypatch.setattr(negatives, "BLOCK", block)
    draw = np.random.default_rng(held)
    base = draw.normal(0.2, 1, (60, 6)).astype(np.float32)
    vectors = np.concatenate([base[draw.integers(0, 60, 400)], np.tile(base[:1], (150, 1)), draw.normal(0.2, 1, (50, 6)).astype(np.float32)])
    rows = [(k, v.tolist(), int(y)) for k, (v, y) in enumerate(zip(vectors, draw.integers(0, 4, 600)))]
    rows += rows[:30]
    rows += [(900, None, 1), (None, rows[0][1], 1), (910, [float("nan")] * 6, 1), (920, [None] * 6, 1), (930, [float("inf")] * 6, 0), (940, [0.0] * 6, 0), (950, rows[1][1], None)]
    rows += [(960, rows[2][1], 9), (960, rows[3][1], 1), (970, [-x for x in rows[0][1]], 2)]
    df = spark.createDataFrame([(*r, 1.0, 0) for r in rows], "vec_id bigint, embedding array<float>, label int, score double, Anchor int")
    out = negatives.hard_negatives(df, "vec_id % 10 = 0")
    want = brute_negatives(rows, 10)
    assert sorted(tuple(r) for r in out.collect()) == want and len(want) > 300
    assert negatives.hard_negatives(df.limit(0), "vec_id % 10 = 0").count() == 0
    assert negatives.hard_negatives(df, "vec_id = -1").count() == 0


def test_products_stay_exact():
    a = np.array([[float(1 << 28), 3.0]])
    assert negatives._products(a, a).tolist() == [[(1 << 56) + 9]]
    assert negatives._products(np.array([[1e30]]), np.array([[-1e30]])).tolist()[0][0] < -(1 << 61)


