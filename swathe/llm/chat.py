"""Chat formatting: turns to text segments with loss flags, by a declarative template.

A finite-state machine reads the roles of a conversation in turn order. It says
whether each turn may stand where it does; every turn is written either way, so
that nothing is lost. The machine and the digests need a conversation in order,
so one task reads it, as a stream that holds one turn at a time however many
there are.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENTS = "conv_id bigint, position bigint, segment int, text string, loss boolean, state string, valid boolean"
DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, valid boolean"
)


@dataclass(frozen=True)
class Template:
    """Marks around each turn, the roles that carry loss, and the turns that may follow.

    A role without a mark of its own is named between ``other`` and ``named``.
    ``moves`` maps a state to the roles that may come next; the state is the
    last role. After a turn that may not come, or of an unknown role, the
    machine goes on from there.
    """

    opening: dict = field(default_factory=lambda: {
        "system": "### System: ", "user": "### User: ", "assistant": "### Assistant: ", "tool": "### Tool: ",
    })
    other: str = "### Role "
    named: str = ": "
    closing: str = " </turn>\n"
    control: str = "</turn>"
    loss: tuple = ("assistant",)
    moves: dict = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user", "tool"), "tool": ("assistant",),
    })
    final: tuple = ("assistant",)

    @property
    def controls(self) -> list[str]:
        return [*self.opening.values(), self.other, self.control]

    def escape(self, text: str) -> str:
        """A backslash before every backslash and every place where a control string starts."""
        pattern = r"\\|(?=" + "|".join(map(re.escape, self.controls)) + ")"
        return re.sub(pattern, lambda m: "\\" + m[0], text)

    def open(self, role: str) -> str:
        if role in self.opening:
            return self.opening[role]
        return self.other + re.sub(r"[\\:]", lambda m: "\\" + m[0], role) + self.named

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """Role and text of each turn of a formatted text; an error if it is none."""
        by_mark = {mark: role for role, mark in self.opening.items()}
        known = "|".join(map(re.escape, by_mark))
        turn = re.compile(
            rf"(?:(?P<known>{known})|{re.escape(self.other)}(?P<role>(?:\\.|[^\\:])*){re.escape(self.named)})"
            rf"(?P<text>(?:\\.|[^\\])*?){re.escape(self.closing)}",
            re.DOTALL,
        )
        turns, at = [], 0
        while at < len(formatted):
            m = turn.match(formatted, at)
            if m is None:
                raise ValueError(f"no turn at {at}")
            role = by_mark[m["known"]] if m["known"] else unescape(m["role"])
            turns.append((role, unescape(m["text"])))
            at = m.end()
        return turns


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def format_chat(df: DataFrame, template: Template | None = None) -> DataFrame:
    """Three segments for each turn: opening, text and closing.

    ``df`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are not
    read. Turns are taken in the order of ``turn`` (nulls first), then role,
    then text; repeated rows are turns of their own. A null role or text is the
    empty string, and rows without ``conv_id`` are one conversation. Segments of
    a conversation stand together and in order within a partition. ``loss`` is
    true of the texts of the template's loss roles alone; ``state`` is the
    machine's after the turn, and ``valid`` whether the turn could come there.
    """
    template = template or Template()
    turns = df.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        started, conv, position, state = False, None, 0, ""
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                rows = []
                for conv_id, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                    if not started or conv_id != conv:
                        started, conv, position, state = True, conv_id, 0, ""
                    valid = role in template.moves.get(state, ())
                    state = role if role in template.moves else ""
                    body = template.escape(text)
                    for k, part in enumerate((template.open(role), body, template.closing)):
                        rows.append((conv, position, k, part, k == 1 and role in template.loss, state, valid))
                    position += 1
                yield _batch(rows, SEGMENTS)

    return ordered.select("conv_id", "turn", "role", "text").mapInArrow(run, SEGMENTS)


def digests(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """What :func:`format_chat` wrote, read back: one row for each conversation.

    ``n_turns``; ``turns_sha256`` of role, line end, text and line end of each
    turn; ``loss_chars`` and ``loss_sha256`` of the unescaped text under the
    loss mask; ``formatted_chars``; and ``valid``: every turn could come where it
    stands and the last may be the last. The segments must come as
    :func:`format_chat` leaves them. No segments, no rows.
    """
    template = template or Template()

    def run(batches):
        key, held, now = None, [], None
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                batch, done = whole.slice(i, 512), []
                for conv_id, k, text, loss, state, valid in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3, 4, 5, 6))):
                    if now is None or conv_id != key:
                        if now is not None:
                            done.append(now.row(key, template))
                        key, now, held = conv_id, _Reader(), []
                    held.append(text)
                    if loss:
                        now.under_loss(unescape(text))
                    if k == 2:
                        now.turn("".join(held), template, state, valid)
                        held = []
                yield _batch(done, DIGESTS)
        if now is not None:
            yield _batch([now.row(key, template)], DIGESTS)

    return segments.mapInArrow(run, DIGESTS)


class _Reader:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0
        self.state, self.valid = "", True

    def under_loss(self, text: str) -> None:
        self.loss.update(text.encode())
        self.loss_chars += len(text)

    def turn(self, formatted: str, template: Template, state: str, valid: bool) -> None:
        for role, text in template.read(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        self.chars += len(formatted)
        self.state, self.valid = state, self.valid and valid

    def row(self, key, template: Template) -> tuple:
        valid = self.valid and self.state in template.final
        return (key, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, valid)


def _batch(rows: list[tuple], fields: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    names, types = zip(*(f.split() for f in fields.split(", ")))
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], list(names))
