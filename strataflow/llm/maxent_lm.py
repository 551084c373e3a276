"""Language-model scores: a hashed maximum-entropy model with class-factored softmax.

P(token | context) = P(class | context) * P(token | class).  The class is a softmax over hashed
features of the context (previous token, the token before it, both together); classes are frequency
bins of the frequent tokens and one class for all others.  Inside a class a token has its smoothed
relative frequency in the training part, the maximum-entropy solution without context features.

Training is distributed: each task makes gradient steps over all its training texts, starting from the
weights of the round before; the tasks' weights are averaged, each row by how often it was seen.
Counts, weights and scores use every text in full.

Scale: token counts are combined in the tasks before the shuffle.  The dictionary of frequent tokens
(at most ``TOP``) and the weights (``WEIGHTS`` bytes) have a fixed size and are broadcast; the count of
a rarer token is found by a shuffled join on its hash, so a frequent token never travels.  A 64-bit
hash stands for a token.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import col, keep
from strataflow.llm.words import NOT_SPACE, Chunk, chunks, find_words, mix

#: Most tokens in the dictionary.
TOP = 1 << 18
CLASSES = 32
BUCKETS = 1 << 12
FEATURES = 3
WEIGHTS = FEATURES * BUCKETS * CLASSES * 4
ROUNDS = 2
RATE = 0.4
#: Bytes of text in one gradient step.
STEP = 1 << 17
#: Rows of the weights that are averaged together.
BLOCK = 512
#: Distinct tokens a task holds before it passes its counts on.
HELD = 1 << 20

END = np.uint64(0x5EED_0000_0000_0001)
BEFORE = (np.uint64(0x5EED_0000_0000_0002), np.uint64(0x5EED_0000_0000_0003))


class Tokens(NamedTuple):
    """Token hashes of a chunk of texts, each text closed by END, and where each text begins."""

    hash: np.ndarray
    first: np.ndarray


def tokens_of(chunk: Chunk) -> Tokens:
    words = find_words(chunk, NOT_SPACE)
    n_words = np.diff(words.first)
    first = np.concatenate(([0], np.cumsum(n_words + 1)))
    out = np.full(first[-1], END, np.uint64)
    row = np.repeat(np.arange(len(n_words)), n_words)
    out[np.arange(len(words.hash)) + row] = words.hash
    return Tokens(out, first)


def is_training(doc_id: Column) -> Column:
    """The training part: crc32 of the id as text, modulo 5, is not 1 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 != 1


def token_counts(texts: DataFrame) -> DataFrame:
    """(h, c): how often each token occurs in column ``text``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            parts = [np.unique(tokens_of(c).hash, return_counts=True) for c in chunks(batch.column(0), 1 << 21)]
            held = _added([held, *parts])
            if len(held[0]) >= HELD:
                yield _counted(held)
                held = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        yield _counted(held)

    return texts.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    hashes, place = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
    return hashes, np.bincount(place, np.concatenate([c for _, c in parts]), len(hashes)).astype(np.int64)


def _counted(held: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held[0].view(np.int64)), pa.array(held[1])], names=["h", "c"])


class Dictionary(NamedTuple):
    """The frequent tokens by hash, with counts and classes; class 0 is everything else."""

    hash: np.ndarray
    count: np.ndarray
    klass: np.ndarray
    total: int
    distinct: int

    def place(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each token is in the dictionary, and whether it is there at all."""
        if not len(self.hash):
            return np.zeros(len(tokens), np.int64), np.zeros(len(tokens), bool)
        at = np.minimum(np.searchsorted(self.hash, tokens), len(self.hash) - 1)
        return at, self.hash[at] == tokens

    def rare_room(self) -> float:
        """What the counts (plus a half) of all rare tokens and one unknown token sum to."""
        return self.total - int(self.count.sum()) + 0.5 * (self.distinct - len(self.hash) + 1)

    def inside(self) -> np.ndarray:
        """log10 P(token | class) of each dictionary token."""
        mass = np.bincount(self.klass, self.count + 0.5, CLASSES)
        return np.log10((self.count + 0.5) / mass[self.klass])


def frequent_tokens(counts: DataFrame, top: int = TOP) -> Dictionary:
    """The dictionary: all tokens at least as frequent as a limit that at most ``top`` of them reach.

    The limit is read off a histogram of a few hundred count bins, so nothing is sorted in one task.
    Classes hold about equal shares of the training tokens."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    step = F.floor(F.log2("c") * 8).cast("int")
    bins = counts.groupBy(step.alias("b")).agg(F.count("*").alias("n"), F.min("c").alias("least")).collect()
    limit, taken = None, 0
    for b in sorted(bins, key=lambda r: -r["b"]):
        taken += b["n"]
        if taken > top:
            break
        limit = b["least"]
    rows = counts.where(F.col("c") >= limit).collect() if limit is not None else []
    hashes = np.array([r["h"] for r in rows], np.int64).view(np.uint64)
    count = np.array([r["c"] for r in rows], np.int64)
    order = np.lexsort((hashes, -count))
    share = np.cumsum(count[order]) / max(1, count.sum())
    klass = np.empty(len(rows), np.int64)
    klass[order] = 1 + np.minimum((share * (CLASSES - 1)).astype(np.int64), CLASSES - 2)
    order = np.argsort(hashes)
    return Dictionary(hashes[order], count[order], klass[order], int(total), int(distinct))


def features(tokens: Tokens) -> np.ndarray:
    """Bucket of each feature (row) at each token (column): previous, skipped, both."""
    h = tokens.hash
    back = []
    for k in (1, 2):
        shifted = np.empty_like(h)
        shifted[k:] = h[:-k] if len(h) > k else h[:0]
        for j in range(k):  # the first tokens of each text look at fixed marks
            at = tokens.first[:-1] + j
            at = at[at < tokens.first[1:]]
            shifted[at] = BEFORE[k - 1 - j]
        back.append(shifted)
    one, two = back
    both = mix(one * np.uint64(0x9E3779B97F4A7C15) + two)
    last = np.uint64(BUCKETS - 1)
    return np.stack([(x & last).astype(np.int64) for x in (mix(one), mix(two ^ np.uint64(0xA5A5)), both)])


def class_logs(weights: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Natural log of P(class | context): tokens by classes."""
    z = weights[0, buckets[0]]
    for f in range(1, FEATURES):
        z = z + weights[f, buckets[f]]
    z -= z.max(axis=1, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


class _Trainer:
    """Adaptive gradient steps on a task's texts."""

    def __init__(self, known: Dictionary, weights: np.ndarray | None) -> None:
        self.known = known
        shape = (FEATURES, BUCKETS, CLASSES)
        self.weights = np.zeros(shape, np.float32) if weights is None else weights.copy()
        self.squares = np.full(shape, 1.0, np.float32)
        self.seen = np.zeros((FEATURES, BUCKETS), np.float64)

    def step(self, tokens: Tokens) -> None:
        at, there = self.known.place(tokens.hash)
        target = np.where(there, self.known.klass[at], 0) if len(self.known.klass) else np.zeros(len(at), np.int64)
        buckets = features(tokens)
        slope = np.exp(class_logs(self.weights, buckets))
        slope[np.arange(len(target)), target] -= 1
        columns = np.ascontiguousarray(slope.T)
        for f in range(FEATURES):
            total = np.stack([np.bincount(buckets[f], c, BUCKETS) for c in columns], axis=1).astype(np.float32)
            self.squares[f] += total * total
            self.weights[f] -= RATE * total / np.sqrt(self.squares[f])
            self.seen[f] += np.bincount(buckets[f], minlength=BUCKETS)

    def blocks(self) -> pa.RecordBatch:
        weights = self.weights.reshape(-1, BLOCK, CLASSES)
        seen = self.seen.reshape(-1, BLOCK)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(len(seen)), pa.int32()),
                pa.array([s.tobytes() for s in seen], pa.binary()),
                pa.array([(w * s[:, None]).astype(np.float64).tobytes() for w, s in zip(weights, seen)], pa.binary()),
            ],
            names=["block", "seen", "weighted"],
        )


def train(texts: DataFrame, known: Dictionary, rounds: int = ROUNDS) -> np.ndarray:
    """Weights after ``rounds`` passes over all of column ``text``."""
    context = texts.sparkSession.sparkContext
    weights: np.ndarray | None = None
    schema = "block int, seen binary, weighted binary"
    for _ in range(rounds):
        shared = context.broadcast((known, weights))

        def learn(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trainer, worked = _Trainer(*shared.value), False
            for batch in batches:
                for chunk in chunks(batch.column(0), STEP):
                    trainer.step(tokens_of(chunk))
                    worked = True
            if worked:
                yield trainer.blocks()

        def average(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, seen, weighted = None, None, None
            for batch in batches:  # the rows of a block come one after the other
                for block, s, w in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    if block != current:
                        if current is not None:
                            yield _block(current, seen, weighted)
                        current, seen, weighted = block, 0.0, 0.0
                    seen = seen + np.frombuffer(s)
                    weighted = weighted + np.frombuffer(w).reshape(BLOCK, CLASSES)
            if current is not None:
                yield _block(current, seen, weighted)

        parts = texts.select("text").mapInArrow(learn, schema)
        means = parts.repartition("block").sortWithinPartitions("block").mapInArrow(average, schema)
        weights = np.zeros((FEATURES * BUCKETS // BLOCK, BLOCK, CLASSES), np.float32)
        for row in means.collect():  # the weights: WEIGHTS bytes, whatever the input
            weights[row["block"]] = np.frombuffer(row["weighted"], np.float32).reshape(BLOCK, CLASSES)
        weights = weights.reshape(FEATURES, BUCKETS, CLASSES)
    return weights


def _block(block: int, seen: np.ndarray, weighted: np.ndarray) -> pa.RecordBatch:
    mean = (weighted / np.maximum(seen, 1)[:, None]).astype(np.float32)
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), pa.array([b""], pa.binary()), pa.array([mean.tobytes()], pa.binary())],
        names=["block", "seen", "weighted"],
    )


PARTS = (
    "doc_id long, held_out boolean, n_tokens long, n_frequent long, base double, model double, "
    "rare array<long>, times array<int>"
)


def _scored_parts(docs: DataFrame, known: Dictionary, weights: np.ndarray) -> DataFrame:
    """Per row of (doc_id, held_out, text): what frequent tokens and classes add to the scores, and the rare tokens."""
    shared = docs.sparkSession.sparkContext.broadcast((known, weights))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights = shared.value
        inside, base = known.inside(), np.log10(known.count + 0.5)
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                tokens = tokens_of(chunk)
                at, there = known.place(tokens.hash)
                chosen = np.where(there, known.klass[at], 0) if len(inside) else np.zeros(len(at), np.int64)
                logs = _chosen_logs(weights, tokens, chosen) / np.log(10)
                frequent = np.where(there, base[at], 0.0) if len(inside) else np.zeros(len(at))
                model = logs + (np.where(there, inside[at], 0.0) if len(inside) else 0.0)
                starts = tokens.first[:-1]
                rare, times = _rare(tokens, there)
                part = batch.slice(chunk.lo, chunk.hi - chunk.lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1),
                        pa.array(np.diff(tokens.first), pa.int64()),
                        pa.array(np.add.reduceat(there.astype(np.int64), starts)),
                        pa.array(np.add.reduceat(frequent, starts)),
                        pa.array(np.add.reduceat(model, starts)),
                        rare, times,
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_frequent", "base", "model", "rare", "times"],
                )

    return docs.mapInArrow(run, PARTS)


def _chosen_logs(weights: np.ndarray, tokens: Tokens, chosen: np.ndarray, step: int = 1 << 15) -> np.ndarray:
    buckets = features(tokens)
    out = np.empty(len(chosen))
    for lo in range(0, len(chosen), step):
        logs = class_logs(weights, buckets[:, lo : lo + step])
        out[lo : lo + step] = logs[np.arange(len(logs)), chosen[lo : lo + step]]
    return out


def _rare(tokens: Tokens, there: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Distinct rare tokens of each row and how often each occurs."""
    places = np.flatnonzero(~there)
    row = np.searchsorted(tokens.first, places, "right") - 1
    hashes = tokens.hash[places]
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    begin = np.flatnonzero(new)
    times = np.diff(np.append(begin, len(row))).astype(np.int32)
    ends = np.searchsorted(row[begin], np.arange(len(tokens.first)))
    offsets = pa.array(ends, pa.int32())
    return (
        pa.ListArray.from_arrays(offsets, pa.array(hashes[begin].view(np.int64))),
        pa.ListArray.from_arrays(offsets, pa.array(times)),
    )


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", top: int = TOP, rounds: int = ROUNDS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts have one token, the end.  Repeated rows count and are scored like any others.
    Without any training text every token is unknown: its base probability is 1, so the base score is 0.
    """
    chosen = docs.select(
        col(id_col).cast("long").alias("doc_id"),
        (~is_training(col(id_col).cast("long"))).alias("held_out"),
        F.coalesce(col(text), F.lit("")).alias("text"),
    )
    training = chosen.where("not held_out")
    counts = keep(token_counts(training), "tokens")
    known = frequent_tokens(counts, top)
    weights = train(training, known, rounds)
    if weights is None:
        weights = np.zeros((FEATURES, BUCKETS, CLASSES), np.float32)

    parts = keep(_scored_parts(chosen, known, weights).withColumn("row", F.monotonically_increasing_id()), "parts")
    rare = parts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("t")).select(
        "row", F.col("t.rare").alias("h"), F.col("t.times").alias("times")
    )
    room = F.coalesce(F.col("c"), F.lit(0))
    sums = (
        rare.join(counts, "h", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(room + 0.5)).alias("logs"),
            F.sum(F.when(room > 0, F.col("times")).otherwise(0)).alias("n_counted"),
        )
    )
    logs = F.coalesce("logs", F.lit(0.0))
    n_rare = F.col("n_tokens") - F.col("n_frequent")
    return parts.drop("rare", "times").join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("n_counted", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * F.lit(float(np.log10(known.total + 0.5 * (known.distinct + 1))))).alias("base_score"),
        (F.col("model") + logs - n_rare * F.lit(float(np.log10(known.rare_room())))).alias("score"),
    )
