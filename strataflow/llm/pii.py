"""Personal data: patterns propose spans, checksums and ranges confirm them, context words score them.

``find_spans`` searches one text; ``personal_data`` applies it to a table in Arrow batches, without
a shuffle.  Every pattern is written so that a text of any shape takes time in proportion to its length.

Base kinds (email, ip, card, phone) are kept whatever their score.  The method adds account numbers
(iban, confirmed by mod 97) and numbers that only context makes personal (phone numbers in national
form, identity numbers): those are kept if their score reaches ``THRESHOLD``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from strataflow.llm.common import col

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "local_phone", "id_number")
KINDS = BASE + ADDED

#: Characters before a span (after it: half as many) in which context words count.
REACH = 40
THRESHOLD = 0.6
BOOST = 0.35

# Context words by kind (fixed values, lower case; English, German, French, Spanish).
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "kontakt", "correo", "courriel"),
    "ip": ("ip", "address", "adresse", "server", "host", "login", "client"),
    "card": ("card", "credit", "visa", "mastercard", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "id_number": ("ssn", "social security", "passport", "tax id", "ausweis", "passeport", "pasaporte"),
}
# Score before context (fixed values): how sure the pattern and its check are by themselves.
PRIOR = {
    "email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.95, "local_phone": 0.3, "id_number": 0.3,
}

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is entered at its first digit only: a later start in it fails or succeeds alike.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.)])\(?[0-9]{3,5}\)?[\x20./-][0-9]{3,4}(?:[\x20./-][0-9]{2,4}){1,2}(?![0-9.])")
_ID_NUMBER = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")


class Span(NamedTuple):
    """Code points ``start`` to ``end`` (exclusive) of a text."""

    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """The check of card numbers."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The check of account numbers: country and check digits moved to the end, letters as 10 to 35."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@``: the characters before it decide the start alone."""
    free = 0
    at = text.find("@")
    while at >= 0:
        found = _DOMAIN.match(text, at)
        start = at
        if found:
            while start > free and text[start - 1] in _LOCAL_CHARS:
                start -= 1
        if found and start < at:
            yield start, found.end()
            free = found.end()
            at = text.find("@", free)
        else:
            at = text.find("@", at + 1)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for found in _IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in found[0].split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            yield found.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 16:
            digits = found[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 8 <= sum(map(str.isdigit, found[0])) <= 15:
            yield found.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for found in _IBAN.finditer(text):
        account = found[0].replace(" ", "")
        if 15 <= len(account) <= 34 and mod97(account):
            yield found.span()


def _spans_of(pattern: re.Pattern) -> object:
    return lambda text: (found.span() for found in pattern.finditer(text))


_FINDERS = {
    "email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans,
    "local_phone": _spans_of(_LOCAL_PHONE), "id_number": _spans_of(_ID_NUMBER),
}
_CONTEXT = {
    kind: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, words)) + r")(?!\w)", re.I)
    for kind, words in CONTEXT.items()
}
_DIGIT = re.compile("[0-9]")


def score(kind: str, text: str, start: int, end: int) -> float:
    """The kind's prior, raised if one of its context words is near."""
    near = text[max(0, start - REACH) : start] + "\n" + text[end : end + REACH // 2]
    return min(1.0, PRIOR[kind] + (BOOST if _CONTEXT[kind].search(near) else 0.0))


def find_spans(text: str | None, threshold: float = THRESHOLD) -> list[Span]:
    """Spans by kind (in the order of ``KINDS``), then start.  Null and empty texts have none.

    Spans of one kind never overlap.  An added span that overlaps a base span is left out: the base
    one already covers it.
    """
    if not text:
        return []
    has_digit = _DIGIT.search(text) is not None
    base, added = [], []
    for kind in KINDS:
        if not has_digit and kind != "email":
            continue
        for start, end in _FINDERS[kind](text):
            if kind in BASE:
                base.append(Span(kind, start, end, score(kind, text, start, end)))
            else:
                value = score(kind, text, start, end)
                if value >= threshold:
                    added.append(Span(kind, start, end, value))
    if added and base:
        taken = sorted((s.start, s.end) for s in base)
        starts, reached = [start for start, _ in taken], list(accumulate((end for _, end in taken), max))
        added = [s for s in added if not _overlaps(s, starts, reached)]
    return base + added


def _overlaps(span: Span, starts: list[int], reached: list[int]) -> bool:
    """Whether a span meets one of those that begin at ``starts``; ``reached`` is the furthest end so far."""
    k = bisect_left(starts, span.end)
    return k > 0 and reached[k - 1] > span.start


OUT = "doc_id long, spans array<struct<kind:string,start:int,end:int,score:double>>"


def personal_data(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and spans of every row; repeated rows and null ids have rows of their own."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[s._asdict() for s in find_spans(t.as_py(), threshold)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(kind))], names=["doc_id", "spans"]
            )

    return docs.select(col(id_col).cast("long").alias("doc_id"), col(text).alias("text")).mapInArrow(search, OUT)


def mask(text: str | None, spans: Iterable[Span]) -> str | None:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first counts."""
    if text is None:
        return None
    out, at = [], 0
    for span in sorted(spans, key=lambda s: (s.start, -s.end)):
        if span.start >= at:
            out += [text[at : span.start], f"<{span.kind}>"]
            at = span.end
    return "".join([*out, text[at:]])

