"""Chat formatting: a finite-state machine over roles, a declarative template, loss flags per segment.

``format_chats`` turns rows (conversation, turn, role, text) into segments: the pieces of the
formatted conversation in order, each with a flag that says whether the loss covers it.  Control
strings inside a text are escaped, so the formatted text can be read back exactly (``read_back``).

Scale: one shuffle by conversation and a sort inside the partitions; rows then stream through in
Arrow batches with only the state of the current conversation in memory, so the longest
conversation needs no more memory than the shortest.  Texts never meet the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import cached_property
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import col


@dataclass(frozen=True)
class Template:
    """How turns are written, which roles the loss covers and which role may follow which.

    ``opening`` + role + ``middle`` + text + ``closing`` is a turn.  ``follows`` maps a state (the
    last role, or "" at the start) to the roles allowed next; ``final`` are the states in which a
    conversation may end.
    """

    opening: str = "### "
    middle: str = ": "
    closing: str = "</turn>\n"
    escape: str = "\\"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    loss_on_closing: bool = False
    follows: Mapping[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user", "tool"}),
            "tool": frozenset({"assistant"}),
        }
    )
    final: frozenset[str] = frozenset({"assistant"})

    @cached_property
    def _patterns(self) -> dict[str, re.Pattern]:
        """Marks (without outer white space) that a role or a text must not hold unescaped."""
        ends = sorted({self.opening.strip(), self.closing.strip()} - {""}, key=len, reverse=True)
        text = "|".join(map(re.escape, [self.escape, *ends]))
        role = "|".join(map(re.escape, [self.escape, *ends, self.middle.strip() or self.middle]))
        mark = re.escape(self.escape)
        piece = "((?:{0}(?:{1})|(?!{1}).)*+)"
        turn = [self.opening, piece.format(mark, role), self.middle, piece.format(mark, text), self.closing]
        turn[::2] = map(re.escape, turn[::2])
        return {
            "text": re.compile(text), "role": re.compile(role), "turn": re.compile("".join(turn), re.S),
            "in_text": re.compile(f"{mark}({text})"), "in_role": re.compile(f"{mark}({role})"),
        }

    def escaped(self, text: str, what: str = "text") -> str:
        return self._patterns[what].sub(lambda m: self.escape + m[0], text)

    def unescaped(self, text: str, what: str = "text") -> str:
        return self._patterns[f"in_{what}"].sub(lambda m: m[1], text)

    def turn(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The segments of a turn: (text, loss)."""
        learn = role in self.loss_roles
        return [
            (self.opening + self.escaped(role, "role") + self.middle, False),
            (self.escaped(text), learn),
            (self.closing, learn and self.loss_on_closing),
        ]

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of each turn of a formatted conversation; ValueError if it is not one."""
        turns, at = [], 0
        while at < len(formatted):
            found = self._patterns["turn"].match(formatted, at)
            if not found:
                raise ValueError(f"no turn at {at}")
            turns.append((self.unescaped(found[1], "role"), self.unescaped(found[2])))
            at = found.end()
        return turns


TEMPLATE = Template()

SEGMENTS = "conv_id long, turn long, step long, segment long, text string, loss boolean, turn_ok boolean, conv_ok boolean"


def format_chats(
    rows: DataFrame,
    template: Template = TEMPLATE,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Segments of all conversations, those of a conversation together and in order.

    ``step`` numbers the turns of a conversation from 0, ``segment`` its segments.  ``turn_ok``: the
    role may follow the state before (after a wrong role the machine goes on from that role).
    ``conv_ok`` is set on the last segment: all turns were right and the end is allowed.

    Rows are ordered by turn; equal turns by role, then text; repeated rows are turns of their own.
    Null role and text count as empty, null turns come first, rows without a conversation id form
    one conversation without id.  Wrong conversations are formatted like all others.
    """
    chosen = rows.select(
        col(conv).cast("long").alias("conv_id"),
        col(turn).cast("long").alias("turn"),
        F.coalesce(col(role), F.lit("")).alias("role"),
        F.coalesce(col(text), F.lit("")).alias("text"),
    )
    placed = chosen.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, right, step, segment = object(), "", True, 0, 0
        held: list[tuple] = []  # the last segment waits for the end of its conversation
        for batch in batches:
            out: list[tuple] = []
            for conv_id, number, speaker, said in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if conv_id != current:
                    out += [(*x[:7], right and state in template.final) for x in held]
                    held, current, state, right, step, segment = [], conv_id, "", True, 0, 0
                out += held
                allowed = speaker in template.follows.get(state, ())
                right, state = right and allowed, speaker
                pieces = template.turn(speaker, said)
                made = [
                    (conv_id, number, step, segment + k, piece, loss, allowed, None)
                    for k, (piece, loss) in enumerate(pieces)
                ]
                out += made[:-1]
                held, step, segment = made[-1:], step + 1, segment + len(pieces)
            if out:
                yield _batch(out, _SEGMENTS)
        if held:
            yield _batch([(*x[:7], right and state in template.final) for x in held], _SEGMENTS)

    return placed.mapInArrow(write, SEGMENTS)


_SEGMENTS = pa.schema(
    [
        ("conv_id", pa.int64()), ("turn", pa.int64()), ("step", pa.int64()), ("segment", pa.int64()),
        ("text", pa.string()), ("loss", pa.bool_()), ("turn_ok", pa.bool_()), ("conv_ok", pa.bool_()),
    ]
)
_REPORT = pa.schema(
    [
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
        ("valid", pa.bool_()), ("first_wrong_turn", pa.int64()),
    ]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


REPORT = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean, first_wrong_turn long"
)


def read_back(segments: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation, recovered from the formatted text of ``format_chats``.

    Roles and texts come from parsing the formatted turns, the loss text from the segments under
    the loss mask.  ``segments`` is the result of ``format_chats`` as it is (each conversation
    together and in order); stored segments are put in that order first with ``in_order``.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, open_turn, report = object(), [], None
        for batch in batches:
            out = []
            names = ("conv_id", "step", "text", "loss", "turn_ok", "conv_ok", "turn")
            for row in zip(*(batch.column(n).to_pylist() for n in names)):
                conv_id, step, text, loss, turn_ok, conv_ok, turn = row
                if report is None or conv_id != current:
                    if report is not None:
                        out.append(report.close(open_turn))
                    current, open_turn, report = conv_id, [], _Reader(conv_id, template)
                if open_turn and step != report.step:
                    report.turn(open_turn)
                    open_turn = []
                report.step = step
                open_turn.append(text)
                report.segment(text, loss, turn_ok, conv_ok, step)
            if out:
                yield _batch(out, _REPORT)
        if report is not None:
            yield _batch([report.close(open_turn)], _REPORT)

    return segments.mapInArrow(read, REPORT)


def in_order(segments: DataFrame) -> DataFrame:
    """Stored segments, each conversation together and in order again."""
    return segments.repartition("conv_id").sortWithinPartitions("conv_id", "segment")


class _Reader:
    """Running digests of one conversation."""

    def __init__(self, conv_id, template: Template) -> None:
        self.conv_id, self.template, self.step = conv_id, template, -1
        self.turns, self.loss = sha256(), sha256()
        self.n = self.loss_chars = self.chars = 0
        self.valid, self.wrong = None, None

    def segment(self, text: str, loss: bool, turn_ok: bool, conv_ok: bool | None, step: int) -> None:
        self.chars += len(text)
        if loss:
            plain = self.template.unescaped(text)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        if not turn_ok and self.wrong is None:
            self.wrong = step
        if conv_ok is not None:
            self.valid = conv_ok

    def turn(self, pieces: list[str]) -> None:
        for role, text in self.template.parse("".join(pieces)):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())

    def close(self, pieces: list[str]) -> tuple:
        self.turn(pieces)
        return (
            self.conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(),
            self.chars, bool(self.valid), self.wrong,
        )
