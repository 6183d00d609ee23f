"""Toxicity by a weighted lexicon.

Text is folded first: compatibility forms and case, letters of other scripts
that look Latin, digits and signs that stand for letters, and invisible
characters. The lexicon holds beginnings of words. It is learnt from labelled
documents: of the beginnings that toxic documents have and clean ones lack,
those are taken that cover most of the toxic documents not covered yet, weighted
by their log-odds; a short list of common insults is always in it. An
Aho-Corasick automaton finds all of them in one pass over a text. Finds inside
an exception phrase count for nothing. The weight found, as it is and by length,
goes through a logistic function fitted to the same labels.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathe.llm.common import rows_from, strings, with_columns

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = str.maketrans(
    "абвгеёзіїјкмнорсстухѕԁԛԝһ" "αβγεηικνορτυχω" "ɑɡıʟ",
    "a6bree3iijkmhopcctyxsdqwh" "aβyenikvoptuxw" "agil",
)
INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯︀-️﻿]")
FOREIGN = re.compile("[ɐ-ʯͰ-ԯ]")
# Digits and signs that stand for letters. i and l are one letter, since 1 stands for both.
DIGITS = (("0", "o"), ("1", "i"), ("3", "e"), ("4", "a"), ("5", "s"), ("7", "t"), ("l", "i"))
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}
SIGN = re.compile(r"(?<=[^\W_])[@$!|](?=[^\W_])")
WORD = re.compile(r"[^\W\d_]+")

# Common insults, and phrases in which such a word is none.
INSULTS = ("idiot", "moron", "imbecile", "scumbag", "retard", "bastard", "asshole", "kill yourself", "go to hell", "piece of shit")
EXCEPTIONS = (
    "clown fish", "clownfish", "class clown", "circus clown", "trash can", "trash bin", "trash bag",
    "bastard file", "retardant", "retardation",
)

#: At most so many labelled rows, the first by hash of the id, are learnt from.
SAMPLE = 20_000
#: Lengths of beginnings, most candidates held, and the most that a beginning's
#: share of clean documents may be of its share of toxic ones.
LENGTHS, CANDIDATES, CLEAN_SHARE = range(3, 9), 50_000, 0.02
#: Least different documents a new term must add: so many, and this share of the toxic ones.
LEAST, LEAST_SHARE = 4, 0.01
#: A clean document counts as having a term if the term starts this share of its words.
DENSE = 0.004
#: Terms that no clean document has so are taken besides if this share of toxic documents has them.
FREQUENT = 0.05
#: A clean document that has a term costs as much as so many toxic ones are worth, at equal numbers of both.
COST = 5


def fold(text: str) -> str:
    text = text.casefold()
    if not text.isascii():
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text).casefold()
        text = INVISIBLE.sub("", text)
        if FOREIGN.search(text):
            text = text.translate(HOMOGLYPHS)
    for a, b in DIGITS:
        text = text.replace(a, b)
    if any(s in text for s in SIGNS):
        text = SIGN.sub(lambda m: SIGNS[m[0]], text)
    return text


def beginnings(text: str) -> set[str]:
    return {w[:n] for w in set(WORD.findall(fold(text))) for n in LENGTHS if len(w) >= n}


def dense_beginnings(text: str, among: frozenset) -> set[str]:
    words = WORD.findall(fold(text))
    counts = Counter(b for w in words for n in LENGTHS if len(w) >= n and (b := w[:n]) in among)
    return {b for b, n in counts.items() if n >= DENSE * len(words)}


@dataclass(frozen=True)
class Model:
    """Weights of folded word beginnings, exception phrases, and the logistic function's three coefficients."""

    weights: dict
    exceptions: tuple = EXCEPTIONS
    coefficients: tuple = (-5.0, 4.0, 10.0)

    def matcher(self):
        automaton = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            automaton.add_word(term, (len(term), weight, term))
        for phrase in self.exceptions:
            folded = fold(phrase)
            if folded not in self.weights:
                automaton.add_word(folded, (len(folded), 0.0, folded))
        automaton.make_automaton()
        return automaton

    def found(self, automaton, text: str) -> tuple[float, int, list[str]]:
        """Weight found, number of words, and the terms found, in order."""
        folded = fold(text)
        best: dict[int, tuple[float, int, str]] = {}
        excepted = []
        for end, (length, weight, term) in automaton.iter(folded) if len(automaton) else ():
            start = end - length + 1
            if start and folded[start - 1].isalpha():
                continue
            if not weight:
                if end + 1 == len(folded) or not folded[end + 1].isalpha():
                    excepted.append((start, end))
            elif weight > best.get(start, (0.0,))[0]:
                best[start] = (weight, end, term)
        kept = [(s, w, t) for s, (w, e, t) in sorted(best.items()) if not any(a <= s and e <= b for a, b in excepted)]
        return sum(w for _, w, _ in kept), len(folded.split()), [t for _, _, t in kept]

    def score(self, weight: float, words: int) -> float:
        z = sum(c * x for c, x in zip(self.coefficients, features(weight, words)))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def features(weight: float, words: int) -> tuple[float, float, float]:
    return 1.0, math.log1p(weight), weight / (words + 20)


def learn(df: DataFrame, labels: DataFrame) -> Model:
    """A model from documents (``doc_id``, ``text``) and labels (``doc_id``, ``toxic``).

    At most ``SAMPLE`` labelled ids are used, those of the lowest hash. An id
    labelled both ways is toxic, one with several texts counts with that of the
    lowest hash; null ids and labels are left out. What comes to
    the driver is bounded: candidate beginnings and counts, the candidates in
    each toxic sample row, and two numbers for each sample row. Without labels
    of both kinds the model is the fixed list of insults.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    found = df.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # One row for each id, however many rows share it.
    sample = found.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("toxic").alias("toxic")).persist()
    try:
        toxic, clean = sample.where("toxic = 1"), sample.where("toxic <> 1")
        n_toxic, n_clean = toxic.count(), clean.count()
        weights = {fold(i): 4.0 for i in INSULTS}
        if not n_toxic or not n_clean:
            return Model(weights)
        least = max(LEAST, math.ceil(LEAST_SHARE * n_toxic))
        common = _counted(toxic, None).where(F.col("n") >= least).orderBy(F.desc("n"), "term").limit(CANDIDATES)
        inside = {r["term"]: r["n"] for r in common.collect()}
        outside = {r["term"]: r["n"] for r in _counted(clean, frozenset(inside)).collect()}
        telling = frozenset(t for t, n in inside.items() if outside.get(t, 0) / n_clean <= CLEAN_SHARE * n / n_toxic)
        rows = rows_from(toxic.select("text"), _signed(telling), "sign bigint, terms array<string>")
        covers: dict[str, set[int]] = {}
        for row in rows.collect():
            for term in row["terms"]:
                covers.setdefault(term, set()).add(row["sign"])
        cost = {t: COST * outside.get(t, 0) * n_toxic / n_clean for t in covers}
        for term in _cover(covers, cost, least, FREQUENT * n_toxic):
            odds = math.log((inside[term] + 0.5) / (n_toxic + 1)) - math.log((outside.get(term, 0) + 0.5) / (n_clean + 1))
            weights[term] = max(odds, 0.1)
        model = Model(weights)
        marked = rows_from(sample.select("text", "toxic"), _measures(model), "weight double, words bigint, toxic int").collect()
        return Model(weights, model.exceptions, _fitted(marked))
    finally:
        sample.unpersist()


def score(df: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``df`` with ``score`` from 0 to 1, ``predicted`` (1 from ``threshold`` on) and
    ``matches``, the terms found in order.

    A null or empty text finds nothing and has the lowest score. Every row is
    scored by its text alone; other columns pass through, and those with the new
    names are replaced.
    """

    def make(batch):
        automaton = model.matcher()
        found = [model.found(automaton, t) for t in strings(batch, "text")]
        scores = [model.score(w, n) for w, n, _ in found]
        return [scores, [int(s >= threshold) for s in scores], [terms for _, _, terms in found]]

    return with_columns(df, make, "score double, predicted int, matches array<string>")


def _counted(df: DataFrame, among: frozenset | None) -> DataFrame:
    """``term``, ``n``: in how many rows a beginning stands, or stands densely if it must be one of ``among``."""

    def make(batch):
        counts: Counter = Counter()
        for text in strings(batch, "text"):
            counts.update(beginnings(text) if among is None else dense_beginnings(text, among))
        return [list(counts), list(counts.values())]

    return rows_from(df.select("text"), make, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def _signed(telling: frozenset):
    """A number that copies of a text mostly share, and the telling beginnings of the text."""

    def make(batch):
        rows = []
        for text in strings(batch, "text"):
            terms = beginnings(text)
            rows.append((min((zlib.crc32(t.encode()) for t in terms), default=0), sorted(terms & telling)))
        return [[s for s, _ in rows], [t for _, t in rows]]

    return make


def _cover(covers: dict[str, set[int]], cost: dict[str, float], least: float, frequent: float) -> list[str]:
    """Terms in the order of what they add to the documents covered, less their
    cost, down to ``least``; of equals the longer term. Then those without cost
    that ``frequent`` documents have, unless one is the beginning of another."""
    chosen, done, rest = [], set(), dict(covers)
    while rest:
        term = min(rest, key=lambda t: (cost[t] - len(rest[t] - done), -len(t), t))
        if len(rest[term] - done) - cost[term] < least:
            break
        done |= rest.pop(term)
        chosen.append(_longest(term, covers))
    for term in sorted(rest, key=lambda t: (-len(rest[t]), -len(t), t)):
        if len(rest[term]) < frequent:
            break
        if not cost[term] and not any(term.startswith(c) or c.startswith(term) for c in chosen):
            chosen.append(_longest(term, covers))
    return chosen


def _longest(term: str, covers: dict[str, set[int]]) -> str:
    return max((t for t in covers if t.startswith(term) and len(covers[t]) >= 0.95 * len(covers[term])), key=lambda t: (len(t), t))


def _measures(model: Model):
    def make(batch):
        automaton = model.matcher()
        found = [model.found(automaton, t) for t in strings(batch, "text")]
        return [[w for w, _, _ in found], [n for _, n, _ in found], batch.column(1).to_pylist()]

    return make


def _fitted(rows: list, ridge: float = 0.05, rounds: int = 30) -> tuple:
    """Coefficients of a logistic function by Newton's method."""
    rows = sorted(tuple(r) for r in rows)
    x = np.array([features(w, n) for w, n, _ in rows])
    y = np.array([t == 1 for _, _, t in rows], float)
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)
