"""Conversation structure repair by Hirschberg divide and conquer.

The roles of a conversation are matched with the pattern (s?(ua)+)? at the least cost.  Four states say what the
repaired conversation holds so far: nothing, a leading system turn, ends with user, ends with assistant.  A forward
vector (the least cost to each state, and which state has the least audit) and a backward vector (the least cost from
each state to the end) meet in the middle of the conversation.  Of the states on a cheapest way the one with the least
audit is the crossing; both halves are solved in the same way.  Only a byte a turn and two vectors of four entries a
level are held, never a table of turns by states.

An audit is the initials of the edits in order: Keep, Rerole, Delete, Insert.  An insert belongs to the row edit after it (those
at the end to none), so each audit passes each crossing in one state, and audits that lead to different
states differ before either ends: comparing the left halves alone decides.

Scale: faults are found without texts (a digest stands for each; identical rows are counted before any shuffle).
Rows of a conversation come together twice, sorted, as a stream: their digests for the audit, their texts for the
digest of the repaired conversation, which is sequential by nature.  A task holds the audit of one conversation, a
byte a turn, and no texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache, lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import col, keep

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NONE, SYSTEM, USER, ASSISTANT = STATES = range(4)
FAR = 1 << 60

#: States that an inserted or reroled turn, and a kept turn of each initial, may lead to.
NEXT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: What the end costs, from each state: the missing turns are inserted.
END = {NONE: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}

#: A turn as a byte: what its initial is, whether it is cut short, whether it must go.
INITIALS = "sua "
GONE, CUT = 8, 4

SHORT = 64


@cache
def _moves(kind: int) -> dict[tuple[int, int], tuple[int, str]]:
    """(state before, state after) -> cheapest cost of a turn and its least edits, inserts before it included."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    extra = TRUNCATED if kind & CUT else 0
    for start in STATES:
        state, cost, edits = start, 0, ""
        for _ in range(3):  # two inserts lead back or to the same kind of turn; more never pay
            ways = [(state, DELETE, "D")]
            if not kind & GONE:
                ways.append((NEXT[state], REROLE + extra, "R"))
                if (state, INITIALS[kind & 3]) in KEPT:
                    ways.append((KEPT[state, INITIALS[kind & 3]], KEEP + extra, "K"))
            for to, price, letter in ways:
                found = (cost + price, edits + letter)
                best[start, to] = min(best.get((start, to), found), found)
            state, cost, edits = NEXT[state], cost + INSERT, edits + "I"
    return best


@lru_cache(1 << 14)
def _forward(vector: tuple, kind: int) -> tuple[int, tuple]:
    """One turn on: what all costs have in common, and for each state the rest of its cost and the place of its audit."""
    found: dict[int, tuple] = {}
    for (start, to), (price, edits) in _moves(kind).items():
        cost, place = vector[start]
        if cost < FAR:
            way = (cost + price, place, edits)
            found[to] = min(found.get(to, way), way)
    places = {to: k for k, (_, to) in enumerate(sorted((way[1:], to) for to, way in found.items()))}
    least = min(way[0] for way in found.values())
    return least, tuple((found[s][0] - least, places[s]) if s in found else (FAR, 0) for s in STATES)


@lru_cache(1 << 14)
def _backward(vector: tuple, kind: int) -> tuple:
    """One turn back: the cost from each state, less what all have in common."""
    out = [FAR] * 4
    for (start, to), (price, _) in _moves(kind).items():
        out[start] = min(out[start], min(price + vector[to], FAR))
    least = min(out)
    return tuple(c - least if c < FAR else FAR for c in out)


def _run_forward(kinds: bytes, lo: int, hi: int, start: int) -> tuple[int, tuple]:
    total, vector = 0, tuple((0, 0) if s == start else (FAR, 0) for s in STATES)
    for k in range(lo, hi):
        more, vector = _forward(vector, kinds[k])
        total += more
    return total, vector


def _crossing(vector: tuple, onward: tuple) -> int:
    """The state on a cheapest way whose audit so far is the least."""
    cheapest = min(v[0] + c for v, c in zip(vector, onward))
    return min((v[1], s) for s, (v, c) in enumerate(zip(vector, onward)) if v[0] + c == cheapest)[1]


def _edits(kinds: bytes, lo: int, hi: int, start: int, end: int, out: list[str]) -> None:
    """The least cheapest edits of turns lo..hi between two states, appended to ``out``."""
    if hi - lo == 1:
        out.append(_moves(kinds[lo])[start, end][1])
    elif hi > lo:
        mid = (lo + hi) // 2
        _, vector = _run_forward(kinds, lo, mid, start)
        onward = tuple(0 if s == end else FAR for s in STATES)
        for k in range(hi - 1, mid - 1, -1):
            onward = _backward(onward, kinds[k])
        state = _crossing(vector, onward)
        _edits(kinds, lo, mid, start, state, out)
        _edits(kinds, mid, hi, state, end, out)


def _repair(kinds: bytes) -> tuple[int, str]:
    total, vector = _run_forward(kinds, 0, len(kinds), NONE)
    ends = tuple(END[s] for s in STATES)
    state = _crossing(vector, ends)
    out: list[str] = []
    _edits(kinds, 0, len(kinds), NONE, state, out)
    return total + vector[state][0] + END[state], "".join(out) + "I" * (END[state] // INSERT)


_repair_short = lru_cache(1 << 16)(_repair)


def repair(kinds: bytes) -> tuple[int, str]:
    """(cost, audit) of a conversation given as a byte a turn (``kind_of``)."""
    return _repair_short(kinds) if len(kinds) <= SHORT else _repair(kinds)


def kind_of(initial: str, truncated: bool, gone: bool) -> int:
    place = INITIALS.find(initial) if initial else 3
    return (place if place >= 0 else 3) | (CUT if truncated else 0) | (GONE if gone else 0)


AUDITS = (
    "_conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)

LEGAL = {"su", "ua", "au"}
BLANK = r"[^\x20\x09-\x0D]"


def chat_rows(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Rows as the operator takes them: ``_conv, _turn, _role, _text, _gone`` (a gone row only says that the
    conversation exists).  Null roles and texts count as one space; other columns are left out."""
    space = F.lit(" ")
    return rows.select(
        col(conv).cast("long").alias("_conv"), col(turn).cast("long").alias("_turn"),
        F.coalesce(col(role).cast("string"), space).alias("_role"),
        F.coalesce(col(text).cast("string"), space).alias("_text"), F.lit(False).alias("_gone"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """``chat_rows`` with the planted faults of the test: by crc32(`conv:turn`) % 20 a row is dropped (0), emptied (1),
    loses its sentence ends (2), is repeated (3) or gets the role user (4).  In that key nulls count as one space."""
    space = F.lit(" ")
    fate = F.crc32(
        F.concat_ws(":", F.coalesce(F.col("_conv").cast("string"), space), F.coalesce(F.col("_turn").cast("string"), space))
        .cast("binary")
    ) % 20
    rows = rows.withColumn("_fate", fate).withColumns({
        "_text": F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.regexp_replace("_text", "[.!?]", "")).otherwise(F.col("_text")),
        "_role": F.when(F.col("_fate") == 4, "user").otherwise(F.col("_role")),
        "_gone": F.col("_gone") | (F.col("_fate") == 0),
    })
    times = F.array_repeat(F.lit(0), F.when(F.col("_fate") == 3, 2).otherwise(1))
    return rows.withColumn("_time", F.explode(times)).select("_conv", "_turn", "_role", "_text", "_gone")


def _digest() -> Column:
    return F.sha2(F.col("_text").cast("binary"), 256)


def faults(rows: DataFrame) -> DataFrame:
    """Distinct rows without texts: _conv, _turn, _role, _digest, _gone, _times, _blank, _cut, _first (no row of the
    conversation with its role and text stands before it)."""
    last = F.regexp_extract("_text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    seen = rows.select(
        "_conv", "_turn", "_gone",
        F.when(F.col("_gone"), "").otherwise(F.col("_role")).alias("_role"),
        F.when(F.col("_gone"), "").otherwise(_digest()).alias("_digest"),
        (~F.col("_gone") & ~F.col("_text").rlike(BLANK)).alias("_blank"),
        (~F.col("_gone") & ~last.isin(".", "!", "?")).alias("_cut"),
    )
    counted = seen.groupBy("_conv", "_turn", "_role", "_digest", "_gone").agg(
        F.count(F.lit(1)).alias("_times"), F.max("_blank").alias("_blank"), F.max("_cut").alias("_cut")
    )
    same = Window.partitionBy("_conv", "_role", "_digest", "_gone").orderBy(F.col("_turn").asc_nulls_first())
    return counted.withColumn("_first", F.row_number().over(same) == 1)


class _Tally:
    """What is held of the conversation that a stream is in."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.kinds, self.last, self.turn = conv, bytearray(), None, None
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role: str, times: int, blank: bool, cut: bool, first: bool) -> None:
        initial = role[:1]
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        self.illegal += times - 1
        self.last = initial
        if turn is not None and turn != self.turn:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
        if blank:
            self.blank += times
        elif first:
            self.truncated += cut
            self.duplicate += times - 1
        else:
            self.duplicate += times
        again = bytes([kind_of(initial, False, True)])
        own = bytes([kind_of(initial, cut, False)]) if first and not blank else again
        self.kinds += own + again * (times - 1)

    def row(self) -> tuple:
        cost, audit = repair(bytes(self.kinds))
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def audits(rows: DataFrame) -> DataFrame:
    """One row a conversation: _conv, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    order = ["_conv", F.col("_turn").asc_nulls_first(), "_role", "_digest"]
    ordered = faults(rows).repartition("_conv").sortWithinPartitions(*order).select(
        "_conv", "_turn", "_role", "_times", "_blank", "_cut", "_first", "_gone"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for conv, turn, role, times, blank, cut, first, gone in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv != conv:
                    if now:
                        done.append(now.row())
                    now = _Tally(conv)
                if not gone:
                    now.add(turn, role, times, blank, cut, first)
            if sum(len(row[-1]) + 64 for row in done) > 1 << 20:
                yield _audit_batch(done)
                done = []
        if now:
            done.append(now.row())
        if done:
            yield _audit_batch(done)

    return ordered.mapInArrow(run, AUDITS)


def _audit_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.string()]
    names = ["_conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


class _Writer:
    """Applies an audit to the turns of a conversation as they come; repaired turns go to ``emit``."""

    def __init__(self, audit: str, emit) -> None:
        self.audit, self.at, self.state, self.emit = audit, 0, NONE, emit

    def _written(self, role: str, text: str, edit: str) -> None:
        self.emit(role, text, edit)

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = NEXT[self.state]
            self._written("user" if self.state == USER else "assistant", "", "I")
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEPT[self.state, role[:1]]
            self._written(role, text, edit)
        elif edit == "R":
            self.state = NEXT[self.state]
            self._written("user" if self.state == USER else "assistant", text, edit)

    def close(self) -> None:
        self._inserts()


def _told(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of each conversation in order, after a row that holds its audit."""
    heads = found.select(
        "_conv", F.lit(0).alias("_part"), F.lit(None).cast("long").alias("_turn"), F.lit("").alias("_role"),
        F.lit("").alias("_digest"), F.lit("").alias("_text"), *[c for c in found.columns if c != "_conv"],
    )
    own = rows.where(~F.col("_gone")).select(
        "_conv", F.lit(1).alias("_part"), "_turn", "_role", _digest().alias("_digest"), "_text"
    )
    order = ["_conv", "_part", F.col("_turn").asc_nulls_first(), "_role", "_digest"]
    return heads.unionByName(own, allowMissingColumns=True).repartition("_conv").sortWithinPartitions(*order)


def _stored(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows, keep(audits(rows), "audits")


def repaired_digests(rows: DataFrame) -> DataFrame:
    """One row a conversation of ``rows`` (``chat_rows``): conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.

    Rows are taken by turn, nulls first; equal turns by role, then by the digest of the text; identical rows stand together.
    A row's first fault counts: blank, duplicate (its role and text came before), truncated.  ``gaps`` are the turns missing
    between the least and the greatest, ``illegal`` the neighbours that are not su, ua or au by their initials.  Conversations
    without rows have zeros, an empty audit and the digest of nothing; rows without an id form one conversation."""
    rows, found = _stored(rows)
    facts = found.columns[1:]
    told = _told(rows, found).select("_conv", "_part", "_role", "_text", *facts)
    schema = AUDITS.replace("_conv", "conv_id") + ", repaired_sha256 string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, writer, digest, first, done = None, None, None, True, []

        def emit(role: str, text: str, _: str) -> None:
            nonlocal first
            digest.update((role + ":" + text if first else "\n" + role + ":" + text).encode("utf-8", "surrogatepass"))
            first = False

        def close() -> None:
            writer.close()
            done.append(head + (digest.hexdigest(),))

        for batch in batches:
            parts, roles, texts = (batch.column(k).to_pylist() for k in (1, 2, 3))
            for k, part in enumerate(parts):
                if part == 0:
                    if writer:
                        close()
                    head = tuple(c[k].as_py() for c in (batch.column(0), *batch.columns[4:]))
                    writer, digest, first = _Writer(head[-1], emit), sha256(), True
                else:
                    writer.turn(roles[k], texts[k])
            if len(done) >= 4096:
                yield _digest_batch(done)
                done = []
        if writer:
            close()
        if done:
            yield _digest_batch(done)

    return told.mapInArrow(run, schema)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text, edit (K, R or I)."""
    rows, found = _stored(rows)
    told = _told(rows, found).select("_conv", "_part", "_role", "_text", "audit")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, writer, place, out, size = None, None, 0, [], 0

        def emit(role: str, text: str, edit: str) -> None:
            nonlocal place, size
            out.append((conv, place, role, text, edit))
            place, size = place + 1, size + len(text)

        for batch in batches:
            for c, part, role, text, audit in zip(*(x.to_pylist() for x in batch.columns)):
                if part == 0:
                    if writer:
                        writer.close()
                    conv, writer, place = c, _Writer(audit, emit), 0
                else:
                    writer.turn(role, text)
                if size > 1 << 22 or len(out) >= 1 << 14:
                    yield _turn_batch(out)
                    out, size = [], 0
        if writer:
            writer.close()
        if out:
            yield _turn_batch(out)

    return told.mapInArrow(run, "conv_id long, place long, role string, text string, edit string")


def _turn_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    names = ["conv_id", "place", "role", "text", "edit"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
