"""BPE encoding and decoding by traversal of a trie of distinct words.

The last token of the encoding of a word's prefix depends on shorter prefixes alone: if ``t`` is the
last token of a prefix, then what precedes ``t`` is encoded as if it stood alone, and ``t`` may follow
that encoding's last token.  So the distinct words are put into a trie and a depth-first walk gives each
node its last token; an encoding is read off by walking back from the end of the word.  Prefixes that
words share are encoded once.  Whether two tokens may stand side by side is decided by merging the two
of them alone, and remembered.

The trie is held as its sorted words, whose order is the depth-first order; the walk needs only the
path from the root.

Scale: documents stream through Arrow batches in place, nothing is shuffled.  A task keeps the
encodings of the words it has met lately and forgets the older ones at a bound: that limits memory, not results.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from strataflow.llm.common import col

END = "</w>"
#: Letters of known words (about 20 bytes each), and pairs of tokens, that a task remembers at most.
MAX_LETTERS = 3_000_000
MAX_PAIRS = 300_000
#: Digests of texts that a task remembers at most.
MAX_TEXTS = 50_000
NEVER = 1 << 30


class Vocabulary(NamedTuple):
    """What a tokenizer file says: token ids, merge ranks, special strings, the word pattern."""

    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    special: dict[str, int]
    pattern: str


def load(path: str) -> Vocabulary:
    """A vocabulary with word ends from a tokenizer file (JSON)."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    if model["type"] != "BPE" or model.get("end_of_word_suffix") != END:
        raise ValueError("not a BPE vocabulary with word ends")
    merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    return Vocabulary(
        model["vocab"],
        {(a, b): rank for rank, (a, b) in enumerate(merges)},
        {t["content"]: t["id"] for t in spec["added_tokens"]},
        split["pattern"]["Regex"],
    )


def byte_symbols() -> list[str]:
    """A printable character for each byte: itself where it is printable, else the next from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Recent:
    """A mapping of two generations: when the young one is full it becomes the old one, and what was old is forgotten."""

    def __init__(self) -> None:
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.young[key] = found
        return found

    def age(self) -> None:
        self.old, self.young = self.young, {}


# Letters and numbers that Unicode 16.0 assigned; the tokenizer knows them, and none of later versions.
UNICODE_16 = (
    "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D40-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B-1138B 1138E-1138E "
    "11390-113B5 113B7-113B7 113D1-113D1 113D3-113D3 116D0-116E3 11BC0-11BE0 11BF0-11BF9 13460-143FA 16100-1611D "
    "16130-16139 16D40-16D6C 16D70-16D79 18CFF-18CFF 1CCF0-1CCF9 1E5D0-1E5ED 1E5F0-1E5FA"
)
# Capital letters of Unicode 16.0 and 17.0 and their small letters (first and last capital, first small).
CAPITALS = (
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3),
    (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B), (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB),
)
SMALL = {c: c - first + small for first, last, small in CAPITALS for c in range(first, last + 1)}
_NEW_CAPITAL = regex.compile("[" + "".join(f"{chr(first)}-{chr(last)}" for first, last, _ in CAPITALS) + "]")


@cache
def late_characters() -> str:
    """Ranges of the characters that the pattern's library counts as letters or numbers, but that Unicode had not assigned
    in the version that the tokenizer knows: to it they are other characters."""
    known = regex.compile(r"[\p{L}\p{N}]")
    own = [range(int(a, 16), int(b, 16) + 1) for a, b in (part.split("-") for part in UNICODE_16.split())]
    late = [
        c for c in range(0x80, 0x110000)
        if not 0xD800 <= c < 0xE000 and known.match(chr(c)) and unicodedata.category(chr(c)) == "Cn" and not any(c in r for r in own)
    ]
    ranges: list[list[int]] = []
    for c in late:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges)


class Encoder:
    """Encodes words by walking the trie of the words not met before."""

    def __init__(self, vocabulary: Vocabulary, max_letters: int = MAX_LETTERS) -> None:
        self.ids, self.ranks, self.special = vocabulary.ids, vocabulary.ranks, vocabulary.special
        self.next: dict[str, dict[str, int]] = {}
        for (a, b), rank in self.ranks.items():
            self.next.setdefault(a, {})[b] = rank
        self.longest = max(len(t.removesuffix(END)) for t in self.ids)
        self.symbols = dict(enumerate(byte_symbols()))
        self.word = regex.compile(vocabulary.pattern)
        late = late_characters()
        self.late = regex.compile(f"[{late}]") if late else None
        exact = vocabulary.pattern
        for name in (r"\p{L}", r"\p{N}"):
            exact = exact.replace(name, f"[{name}--[{late}]]")
        self.word_exact = regex.compile(exact, regex.V1) if late else self.word
        self.marks = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")"
        )
        self.max_letters = max_letters
        self.whole: dict[str, bool] = {}
        self.pairs = Recent()
        self.edges: tuple[dict, dict] = ({}, {})
        #: Of each word its packed ids, and the strings of its tokens as the decoder shows them; both age together.
        self.known, self.shown = Recent(), Recent()
        self.letters_known = 0

    # -- which tokens may end a prefix ------------------------------------------------------------

    def merge(self, parts: list[str], until: int = 1) -> list[str]:
        """Plain merging, lowest rank first, leftmost among equals, down to ``until`` parts."""
        while len(parts) > until:
            ranks = [self.ranks.get(pair, NEVER) for pair in zip(parts, parts[1:])]
            best = min(ranks)
            if best == NEVER:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    @staticmethod
    def letters(token: str) -> list[str]:
        """The symbols a token is made of; the last one keeps the word end."""
        body = token.removesuffix(END)
        out = list(body)
        if body != token and body:
            out[-1] += END
        return out

    def is_token(self, token: str) -> bool:
        """Merging the symbols of this vocabulary entry gives the entry."""
        found = self.whole.get(token)
        if found is None:
            found = self.whole[token] = self.merge(self.letters(token)) == [token]
        return found

    def _edge(self, token: str, side: int) -> list[tuple[str, int, int]]:
        """The pieces that lie at an end of a token while it is merged (side 0: its start, 1: its end):
        piece, rank of the merge that makes it, rank of the merge that uses it up."""
        found = self.edges[side].get(token)
        if found is None:
            found, piece, used = [], token, NEVER
            while True:
                halves = self.merge(self.letters(piece), until=2)
                made = self.ranks[halves[0], halves[1]] if len(halves) == 2 else -1
                found.append((piece, made, used))
                if made < 0:
                    break
                piece, used = halves[side], made
            self.edges[side][token] = found
        return found

    def may_follow(self, left: str, right: str) -> bool:
        """Merging the two tokens' symbols together gives just these two tokens: no pair of pieces
        that meet at the border is merged while both are there.  Of equal ranks the leftmost goes first."""
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs.young) >= MAX_PAIRS // 2:
                self.pairs.age()
            found = self.pairs.young[left, right] = self._stands(self._edge(left, 1), self._edge(right, 0))
        return found

    def _stands(self, lefts: list[tuple[str, int, int]], rights: list[tuple[str, int, int]]) -> bool:
        for x, made_x, used_x in lefts:
            after = self.next.get(x)
            if after:
                for y, made_y, used_y in rights:
                    rank = after.get(y)
                    if rank is not None:
                        time = max(rank, made_x, made_y)
                        if time < used_x and time <= used_y:
                            return False
        return True

    # -- the walk -----------------------------------------------------------------------------------

    def _last(self, word: str, depth: int, path: list[str | None], end: str = "") -> str:
        """The last token of the first ``depth`` symbols of ``word``; ``path`` has those of shorter prefixes."""
        whole, pairs = self.whole, self.pairs.young
        for start in range(max(0, depth - self.longest), depth):
            token = word[start:depth] + end
            good = whole.get(token)
            if good is None and token in self.ids:
                good = self.is_token(token)
            if good:
                before = path[start]
                # the encoding is unique: no other token fits
                if before is None or pairs.get((before, token)) or self.may_follow(before, token):
                    return token
        raise ValueError(f"no token ends {word[:depth]!r}")

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words that are not known.

        Sorted words are the trie in depth-first order: ``path`` holds the last tokens on the way from
        the root, and what a word shares with the one before is still on it.
        """
        if self.letters_known >= self.max_letters // 2:
            self.known.age()
            self.shown.age()
            self.letters_known = 0
        for mark, number in self.special.items():
            self.known.young[mark], self.shown.young[mark] = _packed([number]), mark.encode()
        known, shown = self.known.get, self.shown.get
        plain = [
            (w.encode().decode("latin-1").translate(self.symbols), w) for w in words if known(w) is None or shown(w) is None
        ]
        plain.sort()
        path: list[str | None] = [None]
        before = ""
        for word, original in plain:
            n = len(word)
            shared, most = 0, min(len(path) - 1, n - 1)
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del path[shared + 1 :]
            for depth in range(shared + 1, n):
                path.append(self._last(word, depth, path))
            before = word
            token: str | None = self._last(word, n, path, END)
            tokens, at = [], n
            while token is not None:
                tokens.append(token)
                at -= len(token.removesuffix(END)) if at == n else len(token)
                token = path[at]
            tokens.reverse()
            self.known.young[original] = _packed([self.ids[t] for t in tokens])
            self.shown.young[original] = " ".join(tokens).encode()
            self.letters_known += n

    # -- texts ------------------------------------------------------------------------------------

    @staticmethod
    def normalise(text: str) -> str:
        """NFC, then lower case letter by letter.  White space only separates words, so it stays."""
        text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
        if not text.isascii() and _NEW_CAPITAL.search(text):
            text = text.translate(SMALL)
        return text.lower()

    def words_of(self, text: str) -> list[str]:
        """The words of a text; special strings are words as they are."""
        if not any(s in text for s in self.special):
            return self._plain_words(text)
        out: list[str] = []
        for piece in self.marks.split(text):
            out += [piece] if piece in self.special else self._plain_words(piece)
        return out

    def _plain_words(self, text: str) -> list[str]:
        plain = self.normalise(text)
        pattern = self.word if plain.isascii() or self.late is None or not self.late.search(plain) else self.word_exact
        return pattern.findall(plain)

    def encode_both(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Of each text the packed token ids, and the decoded text in UTF-8."""
        split = [self.words_of(t) for t in texts]
        self.learn(set().union(*split))
        ids, shown = self.known.young.__getitem__, self.shown.young.__getitem__
        for words in split:
            yield b"".join(map(ids, words)), b" ".join(map(shown, words))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        return [np.frombuffer(ids, "<u4") for ids, _ in self.encode_both(texts)]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Decoder:
    """Ids back to text: the tokens' strings, joined by a space."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        both = {**vocabulary.ids, **vocabulary.special}
        self.tokens = np.empty(max(both.values()) + 1, object)
        self.tokens[:] = ""
        for token, number in both.items():
            self.tokens[number] = token

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(self.tokens[ids])


#: Bytes of text encoded at once; bounds the words in memory.
STEP = 1 << 20


def encode_documents(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """``docs`` with a column ``ids`` (array of token ids) and, if named, ``decoded`` (their text).

    Null and empty texts have no tokens and decode to an empty text; repeated rows are rows of their
    own; columns that have the names of new ones give way to them.  ``path`` is the tokenizer file, read once on the driver
    and sent to the tasks: a vocabulary of fixed size.
    """
    from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    taken = {ids.lower(), (decoded or ids).lower()} - {text.lower()}
    docs = docs.select(*[col(c) for c in docs.columns if c.lower() not in taken])
    place = docs.columns.index(text)
    fields = [StructField(ids, ArrayType(IntegerType()))]
    if decoded:
        fields.append(StructField(decoded, StringType()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)  # freed with the task, so that the worker is light for the next stage
        for batch in batches:
            for part in _steps(batch, place):
                both = list(encoder.encode_both([t or "" for t in part.column(place).to_pylist()]))
                out = part.append_column(ids, pa.array([np.frombuffer(i, "<u4") for i, _ in both], pa.list_(pa.int32())))
                if decoded:
                    out = out.append_column(decoded, pa.array([shown for _, shown in both], pa.binary()).cast(pa.string()))
                yield out

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *fields]))


def _steps(batch: pa.RecordBatch, place: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``STEP`` bytes of text each."""
    start = size = 0
    for k, length in enumerate(pc.binary_length(batch.column(place)).to_pylist()):
        size += length or 0
        if size >= STEP:
            yield batch.slice(start, k + 1 - start)
            start, size = k + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encoding_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens and digests of ids (little-endian 32-bit) and decoded text of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(load(path))

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = Encoder(shared.value), Recent()  # copies of a text met lately are not encoded again
        for batch in batches:
            for part in _steps(batch, 1):
                texts = [t or "" for t in part.column(1).to_pylist()]
                prints = [sha256(t.encode()).digest() for t in texts]
                new = {p: t for p, t in zip(prints, texts) if seen.get(p) is None}
                found = dict(zip(new, encoder.encode_both(list(new.values()))))
                for p, (ids, shown) in found.items():
                    seen.young[p] = len(ids) // 4, sha256(ids).hexdigest(), sha256(shown).hexdigest()
                n, ids, shown = zip(*map(seen.young.__getitem__, prints))
                if len(seen.young) >= MAX_TEXTS // 2:
                    seen.age()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(shown, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select(col(id_col).cast("long").alias("doc_id"), col(text).alias("text")).mapInArrow(digest, DIGESTS)
