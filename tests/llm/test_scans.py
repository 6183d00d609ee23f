"""Toxicity, secrets and licenses."""

import hashlib
import random
import re
import zlib

import compare
import pytest
from swathe.llm import licenses, secrets, toxicity

DOCS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def entry():
    return compare.load_entry().queries()


@pytest.fixture(scope="module")
def docs(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def test_folding():
    assert toxicity.fold("ІDІ0Т") == toxicity.fold("idiot") == "idiot"  # Cyrillic and a digit
    assert toxicity.fold("m\u200bor0n") == "moron" and toxicity.fold("ｓｔｕｐｉｄ") == "stupid"
    assert toxicity.fold("l0$er") == toxicity.fold("Loser") and toxicity.fold("idiot!") == "idiot!"
    assert toxicity.fold("ció") != toxicity.fold("cio")


def test_matching_and_exceptions():
    model = toxicity.Model({toxicity.fold("clown"): 2.0, toxicity.fold("idiot"): 3.0, toxicity.fold("idi"): 1.0})
    find = lambda text: model.found(model.matcher(), text)[2]
    assert find("You CL0WN, you idiots") == [toxicity.fold("clown"), "idiot"]
    assert find("a clown fish and a xclown") == [] and find("a clown fishy") == [toxicity.fold("clown")]
    assert find("") == []
    short, long = (model.score(*model.found(model.matcher(), t)[:2]) for t in ("idiot", "idiot " + "word " * 5000))
    assert 1 >= short > long > 0


def labelled(n=240):
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefgh", k=6)) for _ in range(400)]
    rows = []
    for i in range(n):
        text = draw.choices(words, k=40)
        if i % 4 == 0:
            for _ in range(3):
                text[draw.randrange(40)] = "zorp" + draw.choice(["", "ling", "ed"])
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    return rows


def test_lexicon_is_learnt(spark):
    rows = labelled()
    df = spark.createDataFrame([r[:2] for r in rows], DOCS)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:160]] + [(0, 0), (None, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.learn(df, labels)
    assert "zorp" in model.weights
    out = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    assert all(out[i]["predicted"] == y for i, _, y in rows)


def test_toxicity_edges(spark):
    rows = [(1, "IDIOT", "a", 1.0), (2, None, "b", 1.0), (3, "", "c", 1.0), (1, "IDIOT", "a", 1.0), (None, "fine " * 20_000, "d", 1.0)]
    df = spark.createDataFrame(rows, DOCS + ", predicted string, Score double")
    model = toxicity.learn(df, spark.createDataFrame([], "doc_id bigint, toxic int"))
    out = toxicity.score(df, model).collect()
    assert [r["predicted"] for r in out] == [1, 0, 0, 1, 0] and all(0 <= r["score"] <= 1 for r in out)
    assert out[1]["score"] == out[2]["score"] == min(r["score"] for r in out)
    assert toxicity.score(df.limit(0), model).count() == 0
    assert toxicity.learn(df.limit(0), spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int")).weights == model.weights


def test_toxicity_query_beyond_its_labels(spark, entry):
    sf = "/root/testdata/sf0.1"
    out = {r["doc_id"]: r for r in entry["op2_toxicity"](spark, sf).collect()}
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and (r["predicted"] == 1) == (r["score"] >= 0.3) for i, r in out.items())
    marked = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(out[i]["predicted"], y) for i, y in marked.items() if out[i]["held_out"]]
    right = sum(p == y == 1 for p, y in held)
    assert right / sum(y for _, y in held) > 0.75 and right / sum(p for p, _ in held) > 0.8


ASSIGN = re.compile(
    r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def brute_spans(text):
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def test_base_spans_against_brute_force():
    draw = random.Random(2)
    parts = ["token", "Secret", "api_key", "APIKEY", "passwd", "password", " ", "=", ":", '"', "'", "abc", "deadbeef" * 3, "AKIA", "ABCDEFGH12345678", "é", "x=y", "\n", "0" * 30]
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randrange(12)))
        assert ",".join(f"{k}:{a}:{b}" for a, b, k in secrets.base_spans(text)) == brute_spans(text)


def test_automaton_tells_formats_apart():
    draw = random.Random(1)
    hexes = ["".join(draw.choices("0123456789abcdef", k=40)) for _ in range(200)]
    automaton = secrets.Automaton(["key-" + h for h in hexes])
    assert len(automaton.table) < 60  # of some 8,800 of the prefix tree
    like = [automaton.likelihood("key-" + h) / 44 for h in ("".join(draw.choices("0123456789abcdef", k=40)), "ghijklmn" * 5)]
    assert like[0] > like[1] + 1
    assert secrets.Automaton([]).likelihood("abc") < 0 and secrets.Ordinary([]).likelihood("abc") < 0


def test_formats_add_spans_and_blanking(spark):
    draw = random.Random(4)
    token = "ghp_" + "".join(draw.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=36))
    plain = [(i, f"see mail{i}.example.com.archive and report-2020-final-{i}.txt") for i in range(50)]
    df = spark.createDataFrame(
        [(*r, "s", 1) for r in plain] + [(99, f"use {token} now; token = abcdefgh", "s", 1), (98, None, "s", 1), (97, "", "s", 1), (99, f"use {token} now; token = abcdefgh", "s", 1)],
        DOCS + ", Spans string, n_chars bigint",
    )
    model = secrets.learn(df.where("doc_id <> 99"))
    out = secrets.scan(df, model)
    kinds = [[s["kind"] for s in r["spans"]] for r in out.where("doc_id = 99").collect()]
    assert kinds == [["format", "assign"]] * 2
    assert out.where("doc_id < 99 and size(spans) > 0").count() == 0
    blank = secrets.blank(df, model)
    assert blank.columns == df.columns
    row = blank.where("doc_id = 99").first()
    assert row["text"] == "use [SECRET] now; [SECRET]" and row["n_chars"] == len(row["text"])
    assert blank.where("doc_id = 98").first()["text"] is None
    empty = df.limit(0)
    assert secrets.scan(empty, secrets.learn(empty)).count() == 0


def test_tokens_of_public_formats_inside_the_learnt_table(spark):
    draw = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    tokens = [p + "".join(draw.choices(letters, k=n)) for p, n in (("ghp_", 36), ("xoxb-", 40), ("AIza", 35)) for _ in range(17)]
    rows = [(i, f"see mail{i}.example.com.archive and report-2020-final-{i}.txt") for i in range(50)]
    rows += [(100 + i, f"use {t} now") for i, t in enumerate(tokens)]
    df = spark.createDataFrame(rows, DOCS)
    out = {r["doc_id"]: r["spans"] for r in secrets.scan(df, secrets.learn(df)).collect()}
    assert [i for i in out if out[i]] == [i for i in out if i >= 100]
    assert all((s["kind"], s["start"], s["end"]) == ("format", 4, 4 + len(tokens[i - 100])) for i in out if i >= 100 for s in out[i])


CONTEXTS = ("{}", "see {}.", "key={}", "GH_PAT={}", "https://host.example.com/{}?x=1", "cp data/{}/part-01.txt", "({}), then", "'{}'")


def test_tokens_in_context(spark):
    draw = random.Random(21)
    rows = [(i, f"see mail{i}.example.com.archive and report-2020-final-{i}.txt or https://www.example.org/a{i}/b-{i * 7919}/index.html") for i in range(60)]
    want = {}
    for name, *parts in secrets.FORMATS:
        if name in ("aws", "slack-user"):
            continue  # base patterns, wholly or in the part of hexadecimal digits
        for c, context in enumerate(CONTEXTS):
            for _ in range(3):
                token, doc_id = secrets.drawn(tuple(parts), draw), 1000 + len(want)
                before = "we use " + context.split("{}")[0]
                rows.append((doc_id, before + token + context.split("{}")[1]))
                want[doc_id] = (c, len(before), len(before) + len(token))
    df = spark.createDataFrame(rows, DOCS)
    out = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secrets.scan(df, secrets.learn(df)).collect()}
    for c, context in enumerate(CONTEXTS):
        own = [d for d in want if want[d][0] == c]
        assert sum(("format", *want[d][1:]) in out[d] for d in own) >= 0.95 * len(own), context
    assert not any(out[i] for i in range(60))


def test_labelled_formats_are_found_bare(spark):
    """A format that only labels show: twelve digits, a colour of letters and six of a few letters."""
    draw = random.Random(3)
    made = lambda: "zz" + "".join(draw.choices("0123456789", k=12)) + "-" + "".join(draw.choices("QRSTUV", k=6))
    rows = [(i, f"token = {made()}") for i in range(80)] + [(200 + i, f"a{i}.example.com/some-path-of-{i}-words and more") for i in range(200)]
    df = spark.createDataFrame(rows + [(900 + i, f"we met {made()} there") for i in range(10)], DOCS)
    model = secrets.learn(df)
    out = {r["doc_id"]: r["spans"] for r in secrets.scan(df, model).collect()}
    assert all([s["kind"] for s in out[900 + i]] == ["format"] for i in range(10)) and not any(out[200 + i] for i in range(200))
    assert secrets.shape("ab-1") == "4 -0a" and secrets.starts("ab.c-") == [0, 3]


def test_secrets_query(spark, sf, entry, docs):
    out = {r["doc_id"]: r for r in entry["op3_secrets"](spark, sf).collect()}
    assert len(out) == len(docs)
    for doc_id, text in docs:
        want = brute_spans(text or "")
        assert out[doc_id]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(out[doc_id]["spans"].split(","))


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, labels = [], set()
    for phrase, label in licenses.BASE.items():
        own = phrase.split()
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_license_base_against_brute_force(spark, sf, entry, docs):
    draw = random.Random(8)
    parts = ["MIT", "license", "Apache", "cc", "by", "GNU general", "public", "GPL", "é", "İ", ".", ",", "\n", "-", "0", "mit license mit license", "CC BY-NC 4.0"]
    made = [(i, "".join(draw.choices([*parts, " "], [*[1] * len(parts), 14], k=draw.randrange(40)))) for i in range(400)] + [(900, None), (900, None), (None, "MIT License"), (901, "cc by " * 3000)]
    out = licenses.scan(spark.createDataFrame([(*r, "x", 0) for r in made], DOCS + ", labels string, Row int")).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_base"], str(r["first_word"]), str(r["last_word"]), r["base_labels"]) for r in out)
    want = sorted((str(i), n, k, str(a), str(b), x) for i, t in made for n, k, a, b, x in [brute_base(t)])
    assert got == want
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in out)
    rows = {r["doc_id"]: r for r in entry["op10_licenses"](spark, sf).collect()}
    for doc_id, text in docs:
        r = rows[doc_id]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(text)
    assert licenses.scan(spark.createDataFrame([], DOCS)).count() == 0


def test_license_rules(spark):
    texts = {
        1: "Licensed under the Apache License, Version 2.0", 2: "SPDX-License-Identifier: GPL-3.0-or-later", 3: "All rights reserved.",
        4: "Released under CC BY-NC-SA 4.0 and the BSD 3-Clause license", 5: "a plain text", 6: "Permission is hereby granted, free of charge, to any person obtaining a copy",
    }
    out = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(list(texts.items()), DOCS)).collect()}
    assert out[1]["labels"] == "apache,apache-2.0" and out[1]["finds"] == 1  # the shorter finds lie inside
    assert out[2]["labels"] == "gpl-3.0" and out[2]["score"] == 0.99
    assert out[3]["labels"] == "proprietary" and out[6]["labels"] == "mit"
    assert out[4]["labels"] == "bsd-3-clause,cc-by,cc-by-nc-sa" and out[5]["score"] == 0 and out[5]["labels"] == ""
    assert len(licenses.rules()) > 300


def one_of(pattern):
    """A text that a pattern of the rules matches: first choices, optional parts left out."""
    from re import _constants as kinds
    from re import _parser

    def made(parsed):
        out = ""
        for kind, value in parsed:
            if kind is kinds.LITERAL:
                out += chr(value)
            elif kind is kinds.IN:
                out += chr(value[0][1] if value[0][0] is kinds.LITERAL else value[0][1][0])
            elif kind is kinds.BRANCH:
                out += made(value[1][0])
            elif kind is kinds.SUBPATTERN:
                out += made(value[3])
            elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
                out += made(value[2]) * value[0]
        return out

    return made(_parser.parse(pattern))


def test_license_gate_lets_every_rule_through(spark):
    samples = [*(one_of(r["regex"]) for r in licenses.rules()), *licenses.BASE]
    samples += ["cc attribution 4 0", "cc attribution noncommercial", "open rail m", "cc zero"]
    between = ("_", "__", " - ", " _ ", "\n", ".")
    rows = list(enumerate("x " + b.join(words.upper().split()) + ", y" for words in samples for b in between))
    out = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, DOCS)).collect()}
    for i, text in rows:
        r = out[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(text), text
        assert r["labels"], text
    named = {"photo under CC_BY, see page": "cc-by", "All_rights_reserved": "proprietary", "released into the public_domain": "public-domain",
             "CC Attribution 4.0": "cc-by", "open - rail": "openrail"}
    found = licenses.scan(spark.createDataFrame(list(enumerate(named)), DOCS)).collect()
    assert [r["labels"] for r in sorted(found, key=lambda r: r["doc_id"])] == list(named.values())
