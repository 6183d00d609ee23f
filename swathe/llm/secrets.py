"""Secret scans: fixed patterns, and formats inferred from labelled credentials.

A prefix tree of labelled credentials of one kind becomes a probabilistic
automaton: states whose frequencies of endings and of next characters do not
differ by more than Hoeffding's bound allows, all the way down, are merged.
Labelled credentials are parted by length and kinds of characters beforehand, so
that an automaton stands for one format. In every other long run of credential
characters the stretches between signs are candidates: each automaton walks on
from where one may begin, and a stretch that it takes whole is scored by how much
likelier it is than by a model of ordinary runs, per character.
"""

from __future__ import annotations

import math
import random
import re
import string
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swathe.llm.common import rows_from, stored, strings, with_columns

#: Kinds in the order of equal starts; the last is the method's own.
KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
WORDS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: A candidate is a whole run of these characters with a digit among them.
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
ALPHABET = string.ascii_letters + string.digits + "+/_.=-"
#: Documents learnt from (the first by hash of the id), credentials of a kind and their longest length.
SAMPLE, EXAMPLES, LONGEST = 20_000, 600, 128
#: Least score per character, in nats.
MARGIN = 0.3
#: The threshold is a multiple of one such part of a nat.
STEPS = 1000

_LETTERS, _ALNUM = string.ascii_letters, string.ascii_letters + string.digits
# Public formats of which examples are drawn: name and parts, each fixed or of so many characters of a set.
FORMATS = (
    ("github", "ghp_", (_ALNUM, 36, 36)),
    ("github-fine", "github_pat_", (_ALNUM, 22, 22), "_", (_ALNUM, 59, 59)),
    ("gitlab", "glpat-", (_ALNUM + "_-", 20, 20)),
    ("slack", "xoxb-", (_ALNUM, 40, 40)),
    ("slack-bot", "xoxb-", (string.digits, 10, 13), "-", (string.digits, 10, 13), "-", (_ALNUM, 24, 24)),
    ("slack-user", "xoxp-", (string.digits, 10, 13), "-", (string.digits, 10, 13), "-", (string.digits, 10, 13), "-", (string.digits + "abcdef", 32, 32)),
    ("google", "AIza", (_ALNUM + "_-", 35, 35)),
    ("stripe", "sk_live_", (_ALNUM, 24, 24)),
    ("sendgrid", "SG.", (_ALNUM + "_-", 22, 22), ".", (_ALNUM + "_-", 43, 43)),
    ("npm", "npm_", (_ALNUM, 36, 36)),
    ("aws", "AKIA", (string.ascii_uppercase + "234567", 16, 16)),
)
DRAWN = 400
#: Labelled credentials of one shape from which on they have an automaton.
SHAPED = 20


def drawn(parts: tuple, draw: random.Random) -> str:
    """An example of a public format."""
    return "".join(p if isinstance(p, str) else "".join(draw.choices(p[0], k=draw.randint(p[1], p[2]))) for p in parts)


def shape(value: str) -> str:
    """Length, and the kinds of characters in a credential: lower and upper letters, digits, and each sign."""
    kinds = {"a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c for c in value}
    return f"{len(value)} {''.join(sorted(kinds))}"


class Automaton:
    """Probabilistic automaton by state merging (ALERGIA)."""

    def __init__(self, words: list[str], alpha: float = 0.01, few: int = 6):
        self.bound, self.few = math.sqrt(0.5 * math.log(2 / alpha)), few
        self.next: list[dict[str, int]] = [{}]
        self.times: list[dict[str, int]] = [{}]
        self.seen, self.ends = [0], [0]
        for word in words:
            s = 0
            self.seen[0] += 1
            for c in word:
                self.times[s][c] = self.times[s].get(c, 0) + 1
                if c not in self.next[s]:
                    self.next[s][c] = len(self.next)
                    self.next.append({})
                    self.times.append({})
                    self.seen.append(0)
                    self.ends.append(0)
                s = self.next[s][c]
                self.seen[s] += 1
            self.ends[s] += 1
        self._merge()
        self._finish()

    def _differ(self, x: int, n: int, y: int, m: int) -> bool:
        return abs(x / n - y / m) > self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, a: int, b: int) -> bool:
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            n, m = self.seen[a], self.seen[b]
            if min(n, m) < self.few:
                continue  # too few to tell them apart
            if self._differ(self.ends[a], n, self.ends[b], m):
                return False
            for c in self.times[a].keys() | self.times[b].keys():
                if self._differ(self.times[a].get(c, 0), n, self.times[b].get(c, 0), m):
                    return False
                if c in self.next[a] and c in self.next[b]:
                    pairs.append((self.next[a][c], self.next[b][c]))
        return True

    def _merge(self) -> None:
        kept, is_kept = [0], {0}
        while True:
            found = [(s, c, t) for s in kept for c, t in self.next[s].items() if t not in is_kept]
            if not found:
                break
            parent, char, state = max(found, key=lambda f: (self.seen[f[2]], -f[2]))
            for other in kept:
                if self._compatible(other, state):
                    self.next[parent][char] = other
                    self._fold(other, state)
                    break
            else:
                kept.append(state)
                is_kept.add(state)

    def _fold(self, into: int, state: int) -> None:
        pairs = [(into, state)]
        while pairs:
            a, b = pairs.pop()
            self.seen[a] += self.seen[b]
            self.ends[a] += self.ends[b]
            for c, k in self.times[b].items():
                self.times[a][c] = self.times[a].get(c, 0) + k
                if c in self.next[a]:
                    pairs.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def _finish(self) -> None:
        """Reachable states as tables of log-probabilities; an unseen step stays and costs much."""
        order, at = [0], {0: 0}
        for s in order:
            for t in self.next[s].values():
                if t not in at:
                    at[t] = len(order)
                    order.append(t)
        self.table = []
        for s in order:
            total = self.seen[s] + 1.0
            self.table.append({c: (math.log(k / total), at[self.next[s][c]]) for c, k in self.times[s].items()})
        self.unseen = [math.log(1 / (self.seen[s] + 1.0) / len(ALPHABET)) for s in order]
        self.end = [math.log((self.ends[s] + 0.01) / (self.seen[s] + 1.0)) for s in order]
        del self.next, self.times, self.seen, self.ends

    def likelihood(self, word: str) -> float:
        total, s = 0.0, 0
        for c in word:
            step = self.table[s].get(c)
            if step is None:
                total += self.unseen[s]
            else:
                total += step[0]
                s = step[1]
        return total + self.end[s]


class Ordinary:
    """Pairs of neighbouring characters in runs that are no credentials."""

    def __init__(self, words: list[str], pairs: dict[str, int] | None = None):
        counts: dict[str, dict[str, int]] = {}
        for pair, n in (pairs_of(words) if pairs is None else pairs).items():
            counts.setdefault(pair[0], {})[pair[1]] = n
        size = len(ALPHABET) + 1
        self.table = {a: {b: math.log((n + 0.5) / (sum(row.values()) + 0.5 * size)) for b, n in row.items()} for a, row in counts.items()}
        self.rest = {a: math.log(0.5 / (sum(row.values()) + 0.5 * size)) for a, row in counts.items()}
        self.uniform = -math.log(size)

    def likelihood(self, word: str) -> float:
        total = 0.0
        for a, b in zip("^" + word, word + "$"):
            row = self.table.get(a)
            total += self.uniform if row is None else row.get(b, self.rest[a])
        return total


def pairs_of(words: list[str]) -> dict[str, int]:
    """How often each two characters are neighbours, ends of words included."""
    counts: dict[str, int] = {}
    for word in words:
        for a, b in zip("^" + word, word + "$"):
            counts[a + b] = counts.get(a + b, 0) + 1
    return counts


def _completed(steps: dict[str, tuple[float, int]]) -> dict[str, tuple[float, int]]:
    """The steps of a state with those of letters or digits that it lacks, where it has
    many of their kind: half as likely as the rarest, to where most of the kind lead."""
    out = dict(steps)
    for kind in (string.ascii_lowercase, string.ascii_uppercase, string.digits):
        seen = [steps[c] for c in kind if c in steps]
        if len(seen) >= 0.4 * len(kind) and len(steps) >= 8:
            targets = [t for _, t in seen]
            rare = (min(p for p, _ in seen) - math.log(2), max(sorted(set(targets)), key=targets.count))
            out.update((c, rare) for c in kind if c not in steps)
    return out


class Format:
    """An automaton of credentials and the lengths that it has seen."""

    def __init__(self, words: list[str]):
        self.table = [_completed(steps) for steps in Automaton(words).table]
        self.low, self.high = min(map(len, words)), max(map(len, words))
        self.spread = math.log(self.high - self.low + 1)

    def stretches(self, run: str, start: int):
        """Ends of the stretches of ``run`` from ``start`` that the automaton takes whole,
        and their log-likelihood. A stretch ends before a sign or with the run."""
        table, s, total = self.table, 0, -self.spread
        for i in range(start, min(len(run), start + self.high)):
            step = table[s].get(run[i])
            if step is None:
                return
            total, s = total + step[0], step[1]
            if i + 1 - start >= self.low and (i + 1 == len(run) or not run[i + 1].isalnum()):
                yield i + 1, total


@dataclass
class Model:
    formats: list[Format]
    ordinary: Ordinary
    threshold: float

    def best(self, run: str, start: int) -> tuple[float, int] | None:
        """Score and end of the stretch from ``start`` on that a format explains best:
        the score is in nats per character by which it beats ordinary text."""
        found = None
        for f in self.formats:
            for end, likely in f.stretches(run, start):
                gain = likely - self.ordinary.likelihood(run[start:end])
                if found is None or gain > found[0]:
                    found = (gain, end)
        return found and (found[0] / (found[1] - start + 1), found[1])

    def spans(self, run: str) -> list[tuple[int, int]]:
        """Stretches that score the threshold or more, from the left, without overlaps."""
        out, at = [], 0
        for start in starts(run):
            if start >= at and (found := self.best(run, start)) and found[0] >= self.threshold:
                out.append((start, found[1]))
                at = found[1]
        return out

    def score(self, run: str) -> float:
        """The highest score of a stretch of ``run``."""
        return max((b[0] for start in starts(run) if (b := self.best(run, start))), default=-math.inf)


def starts(run: str) -> list[int]:
    """Where a credential may begin: with the run or after a sign."""
    return [i for i in range(len(run)) if not i or not run[i - 1].isalnum()]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed patterns: start, end and kind, in order."""
    spans = []
    lower = text.lower()
    if any(w in lower for w in WORDS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    for run in RUN.finditer(text):
        if run.end() - run.start() >= 24:
            spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text, run.start(), run.end())]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str, spans: list[tuple[int, int, str]]):
    """Runs with a digit that no base span touches."""
    at = 0
    ordered = sorted(spans)
    for run in RUN.finditer(text):
        start, end = run.span()
        while at < len(ordered) and ordered[at][1] <= start:
            at += 1
        touched = any(s < end and e > start for s, e, _ in ordered[at : at + 8])
        if not touched and any(c.isdigit() for c in run[0]):
            yield start, end, run[0]


def all_spans(text: str, model: Model) -> list[tuple[int, int, str]]:
    """Base spans and those the formats add, by start and kind."""
    spans = base_spans(text)
    more = [(s + i, s + j, "format") for s, _, run in candidates(text, spans) for i, j in model.spans(run)]
    return sorted(spans + more, key=lambda s: (s[0], KINDS.index(s[2]))) if more else spans


def learn(df: DataFrame) -> Model:
    """A model from the credentials that the fixed patterns label in a sample of
    ``df`` (``doc_id``, ``text``), and from drawn examples of public formats.

    The sample is the ``SAMPLE`` ids of the lowest hash; at most ``EXAMPLES``
    different credentials of each kind, of at most ``LONGEST`` characters, come
    to the driver. Those of one kind and ``shape`` are one format, if there are
    ``SHAPED`` of them. Ordinary runs are the different runs of all documents that
    no fixed pattern touches, without those that hold a stretch of a public format,
    or one that a format of labelled credentials makes likelier by ``MARGIN`` than
    a model of all runs but the public formats does. Counts of their pairs make the
    model of ordinary runs. The threshold lies above all but a thousandth of their
    scores, in steps of a ``STEPS``-th; neither is sampled.
    """
    ids = df.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    sample = df.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")

    def labels(batch):
        rows = set()
        for text in strings(batch, "text"):
            for start, end, kind in base_spans(text):
                rows.add((kind, ASSIGN.fullmatch(text[start:end])[2] if kind == "assign" else text[start:end]))
        kept = sorted(r for r in rows if len(r[1]) <= LONGEST)
        return [[k for k, _ in kept], [v for _, v in kept]]

    def others(batch):
        return [sorted({run for text in strings(batch, "text") for _, _, run in candidates(text, base_spans(text))})]

    labelled = rows_from(sample.select("text"), labels, "kind string, value string").distinct()
    first = F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64("value"), "value"))
    rows = labelled.withColumn("n", first).where(F.col("n") <= EXAMPLES).select("kind", "value").collect()
    shapes: dict[str, list[str]] = {}
    for kind, value in sorted(tuple(r) for r in rows):
        shapes.setdefault(f"{kind} {shape(value)}", []).append(value)
    draw = random.Random(7)
    public = [Format([drawn(parts, draw) for _ in range(DRAWN)]) for _, *parts in FORMATS]
    own = [Format(values) for values in shapes.values() if len(values) >= SHAPED]
    runs = stored(rows_from(df.select("text"), others, "run string").distinct(), "runs")

    def likely(run: str, plain: Ordinary | None) -> bool:
        """Whether the run holds a public format, or that of labelled credentials rather than ``plain``, if given."""
        at = starts(run)
        if any(True for f in public for start in at for _ in f.stretches(run, start)):
            return True
        return plain is not None and Model(own, plain, MARGIN).score(run) >= MARGIN

    def ordinary(plain: Ordinary | None) -> Ordinary:
        def count(batch):
            pairs = pairs_of([run for run in strings(batch, "run") if not likely(run, plain)])
            return [list(pairs), list(pairs.values())]

        counted = rows_from(runs, count, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
        return Ordinary([], dict(tuple(r) for r in counted.collect()))

    plain = ordinary(None)
    model = Model(public + own, ordinary(plain), MARGIN)

    def steps(batch):
        counts: dict[int, int] = {}
        for run in strings(batch, "run"):
            if not likely(run, plain):
                step = math.floor(max(model.score(run), -100.0) * STEPS)  # a run that no format takes scores lowest
                counts[step] = counts.get(step, 0) + 1
        return [list(counts), list(counts.values())]

    scores = rows_from(runs, steps, "step bigint, n bigint").groupBy("step").agg(F.sum("n").alias("n")).collect()
    above = sum(r["n"] for r in scores) // 1000
    for step, n in sorted((tuple(r) for r in scores), reverse=True):
        above -= n
        if above < 0:
            return Model(model.formats, model.ordinary, max(MARGIN, (step + 1) / STEPS))
    return model


def scan(df: DataFrame, model: Model) -> DataFrame:
    """``df`` with ``spans``, an array of kind, start and end (code points, end
    exclusive) by start and kind.

    Spans of one kind do not overlap; those of kind ``format`` touch no other. A
    null or empty text has none. Rows are scanned one by one, whole; other
    columns pass through, and a column named ``spans`` is replaced.
    """

    def make(batch):
        return [[
            [{"kind": k, "start": s, "end": e} for s, e, k in all_spans(text, model)] for text in strings(batch, "text")
        ]]

    return with_columns(df, make, "spans array<struct<kind:string,start:bigint,end:bigint>>")


def blanked(text: str, spans: list, mark: str = "[SECRET]") -> str:
    """``text`` with each stretch of overlapping or touching spans replaced by ``mark``."""
    out, at = [], 0
    for start, end in _joined([(s["start"], s["end"]) for s in spans]):
        out += [text[at:start], mark]
        at = end
    return "".join(out) + text[at:]


def _joined(spans: list[tuple[int, int]]) -> list[list[int]]:
    joined: list[list[int]] = []
    for start, end in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    return joined


def blank(df: DataFrame, model: Model) -> DataFrame:
    """``df`` with the secrets in ``text`` blanked; ``n_chars``, if there, is counted
    anew. A null text stays null."""

    def make(batch):
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        return [[None if t is None else blanked(t, [{"start": s, "end": e} for s, e, _ in all_spans(t, model)]) for t in texts]]

    order = df.columns
    clean = with_columns(df, make, "text string")
    if "n_chars" in order:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(df.schema["n_chars"].dataType))
    return clean.select(*order)
