"""Hard-negative mining by angular triangle filtering.

Every vector is stored with its angles to a few reference directions and its norm.  By the triangle inequality on the
sphere the angle between two vectors lies between the greatest difference of their angles to a reference and the
least sum; its cosine times both norms bounds their score from both sides (rounded outwards).  Rows are kept in runs
of one label that lie close together, each with the range of its angles and norms.  Only where a run's bounds overlap a
score window that an anchor still wants is the integer score computed.  Bounds only save work: scores are exact.

Scale: rows are dealt over groups that fit in a worker (``GROUP_BYTES``) and stay there; anchors, a stated share of the
rows, are copied to every group and stream past it in batches.  A group answers with at most ``k`` rows for each
window of an anchor, and these meet in a shuffle by anchor.  Nothing is broadcast but the reference directions, nothing is
collected but the sample that they are chosen from (``SAMPLE`` vectors).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import col, keep

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: Window of a negative's score as hundredths of the positive's.
LOW, HIGH = 30, 90
LABELS = 10
REFERENCES, SAMPLE = 16, 1024
RUN = 256
#: Bytes of vectors that a worker holds; anchors taken at a time.
GROUP_BYTES, BATCH = 32 << 20, 256
#: Rows that are worth a group of their own.
LEAST_GROUP = 2048
#: Squares of norms (scaled) up to which scores, and hundreds of them, fit in 64 bits.
LARGEST = 1 << 56
#: What stored angles may be wrong by, at the most (they are 32-bit floating point numbers).
SLACK = 1e-5

PREPARED = "vec_id long, label long, vector binary, norm double, angles binary, near int"


def _matrix(column: pa.Array, kind, width: int | None = None) -> np.ndarray:
    """Equal numbers of values a row; shorter rows end in zeros."""
    parts = [np.frombuffer(b, kind) for b in column.to_pylist()]
    width = max([width or 0, *map(len, parts)])
    out = np.zeros((len(parts), width), kind)
    for row, part in zip(out, parts):
        row[: len(part)] = part
    return out


def _integers(rows: DataFrame, vec: str) -> DataFrame:
    """Rows whose vector takes part, with its components as 32-bit integers floor(``SCALE`` * x)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            good, found, norms = [], [], []
            values = lists.flatten().cast(pa.float64())
            nulls = np.asarray(values.is_null())
            numbers = values.fill_null(np.nan).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            for k, (start, end) in enumerate(zip(np.concatenate(([0], ends)), ends)):
                own = numbers[start:end]
                if nulls[start:end].any() or not np.isfinite(own).all():
                    continue
                own = np.floor(SCALE * own)
                square = float(own @ own)
                if square <= LARGEST:
                    good.append(k)
                    found.append(own.astype(np.int32).tobytes())
                    norms.append(np.sqrt(square))
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(good, pa.int64())) for c in batch.columns[:2]), pa.array(found, pa.binary()), pa.array(norms, pa.float64())],
                names=["vec_id", "label", "vector", "norm"],
            )

    chosen = rows.select("vec_id", "label", col(vec).cast("array<double>").alias("vector")).where("label is not null and vector is not null")
    return chosen.mapInArrow(run, "vec_id long, label long, vector binary, norm double")


def reference_directions(vectors: DataFrame, count: int = REFERENCES, sample: int = SAMPLE) -> np.ndarray:
    """Unit vectors far from each other, chosen from the ``sample`` vectors whose hashes are the smallest."""
    taken = vectors.where("norm > 0").select("vector").orderBy(F.xxhash64("vector"), "vector").limit(sample).toArrow()
    rows = _matrix(taken.column(0).combine_chunks(), np.int32).astype(float)
    if not len(rows):
        return np.zeros((0, 0))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    chosen, closest = [0], rows @ rows[0]
    while len(chosen) < min(count, len(rows)):
        chosen.append(int(closest.argmin()))
        closest = np.maximum(closest, rows @ rows[chosen[-1]])
    return rows[chosen]


def _with_angles(vectors: DataFrame, references: np.ndarray) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(2), np.int32, references.shape[1]).astype(float)
            wide = np.zeros((len(references), rows.shape[1]))
            wide[:, : references.shape[1]] = references
            norm = np.maximum(batch.column(3).to_numpy(), 1e-300)
            angles = np.arccos(np.clip(rows @ wide.T / norm[:, None], -1, 1)).astype(np.float32)
            near = angles.argmin(axis=1) if len(references) else np.zeros(len(rows))
            yield batch.append_column("angles", pa.array([a.tobytes() for a in angles], pa.binary())).append_column(
                "near", pa.array(near.astype(np.int32))
            )

    return vectors.mapInArrow(run, PREPARED)


def prepare(rows: DataFrame, id_col: str = "vec_id", vec: str = "embedding", label: Column | None = None) -> DataFrame:
    """The vectors that take part, stored once: row (a number of its own), vec_id, label, vector, norm, angles, near.

    Left out are rows with a null label, a null vector, a null or non-finite component, or a scaled norm above 2^28,
    whose scores could not be held.  Vectors of unequal length end in zeros.  Ids may repeat or be null."""
    label = F.col("label") if label is None else label
    named = rows.select(col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), col(vec).alias(vec))
    plain = keep(_integers(named, vec), "vectors")
    angled = _with_angles(plain, reference_directions(plain))
    return keep(angled.withColumn("row", F.monotonically_increasing_id()), "angles")


class _Group:
    """The rows of a group in runs of one label, nearest reference and similar angle."""

    def __init__(self, table: pa.Table) -> None:
        label, near, norm = (table.column(c).to_numpy() for c in ("label", "near", "norm"))
        angles = _matrix(table.column("angles").combine_chunks(), np.float32)
        own = angles[np.arange(len(near)), near] if angles.shape[1] else np.zeros(len(near))
        order = np.lexsort((own, near, label))
        self.label, self.norm, self.angles = label[order], norm[order], angles[order]
        self.row = table.column("row").to_numpy()[order]
        ids = table.column("vec_id").combine_chunks()
        self.nameless = np.asarray(ids.is_null())[order]
        self.id = ids.fill_null(0).to_numpy()[order]
        self.vectors = _matrix(table.column("vector").combine_chunks(), np.int32)[order]
        self.greatest = float(self.norm.max(initial=0))
        if len(order):
            new = np.flatnonzero(np.diff(self.label)) + 1
            edges = np.concatenate(([0], new, [len(order)]))
            self.start = np.concatenate([np.arange(a, b, RUN) for a, b in zip(edges, edges[1:])])
            self.end = np.append(self.start[1:], len(order))
            self.least_norm, self.most_norm = np.minimum.reduceat(self.norm, self.start), np.maximum.reduceat(self.norm, self.start)
            self.least_angle = np.minimum.reduceat(self.angles, self.start, axis=0).astype(float) - SLACK
            self.most_angle = np.maximum.reduceat(self.angles, self.start, axis=0).astype(float) + SLACK
        else:
            self.start = self.end = np.zeros(0, int)

    def bounds(self, angles: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each anchor with the rows of each run."""
        shape = (len(norm), len(self.start))
        apart, together = np.zeros(shape), np.full(shape, np.pi)
        for k in range(angles.shape[1]):
            own = angles[:, k, None].astype(float)
            low, high = self.least_angle[None, :, k], self.most_angle[None, :, k]
            apart = np.maximum(apart, np.maximum(low - own, own - high) - SLACK)
            together = np.minimum(together, np.minimum(own + high, 2 * np.pi - own - low) + SLACK)
        most, least = np.cos(np.minimum(apart, np.pi)), np.cos(np.clip(together, 0, np.pi))
        most = norm[:, None] * most * np.where(most > 0, self.most_norm, self.least_norm)
        least = norm[:, None] * least * np.where(least > 0, self.least_norm, self.most_norm)
        margin = 1 + 1e-9 * norm[:, None] * self.most_norm[None]
        return np.floor(least - margin), np.ceil(most + margin)

    def scores(self, anchors: np.ndarray, which: np.ndarray, product: float) -> np.ndarray:
        """Integer scores of anchors and rows; by floating point where its sums are exact."""
        kind = np.float32 if product < 1 << 24 else np.float64 if product < 1 << 53 else np.int64
        rows = self.vectors[which]
        width = max(anchors.shape[1], rows.shape[1])
        a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))).astype(kind) for m in (anchors, rows))
        return (a @ b.T).astype(np.int64)


def _best(group: _Group, batch: pa.RecordBatch, same_label: bool, k: int) -> tuple[np.ndarray, ...]:
    """For each anchor and window its best ``k`` rows of the group: anchor, window, row place, score."""
    label = batch.column("label").to_numpy()
    row = batch.column("row").to_numpy()
    norm = batch.column("norm").to_numpy()
    angles, vectors = _matrix(batch.column("angles"), np.float32), _matrix(batch.column("vector"), np.int32)
    low, high = (batch.column(c).flatten().to_numpy().reshape(batch.num_rows, -1) for c in ("low", "high"))
    least, most = group.bounds(angles, norm)
    allowed = (group.label[group.start][None] == label[:, None]) == same_label
    n, windows = low.shape
    floor = low.copy()
    held = [np.zeros(0, np.int64) for _ in range(4)]  # anchor, window, place, score
    runs_at_once = 8
    for first in range(0, len(group.start), runs_at_once):
        runs = np.arange(first, min(first + runs_at_once, len(group.start)))
        open_ = (low <= high)[:, None, :] & (most[:, runs, None] >= floor[:, None, :]) & (least[:, runs, None] <= high[:, None, :])
        wanted = allowed[:, runs] & open_.any(axis=2)
        if not wanted.any():
            continue
        rows_of = runs[wanted.any(axis=0)]
        some = np.flatnonzero(wanted.any(axis=1))
        which = np.concatenate([np.arange(group.start[r], group.end[r]) for r in rows_of])
        lengths = (group.end - group.start)[rows_of]
        use = np.repeat(wanted[np.ix_(some, rows_of - first)], lengths, axis=1) & (group.row[which][None] != row[some, None])
        scores = group.scores(vectors[some], which, float(norm[some].max()) * group.greatest + 1)
        new = []
        for w in range(windows):
            at, place = np.nonzero(use & (scores >= floor[some, w, None]) & (scores <= high[some, w, None]))
            new.append((some[at], np.full(len(at), w), which[place], scores[at, place]))
        held = [np.concatenate((old, *(part[c] for part in new))) for c, old in enumerate(held)]
        anchor, window, place, score = held
        order = np.lexsort((group.id[place], group.nameless[place], -score, window, anchor))
        cell = (anchor * windows + window)[order]
        starts = np.searchsorted(cell, cell, "left")
        stay = np.arange(len(cell)) - starts < k
        last = np.arange(len(cell)) - starts == k - 1
        held = [c[order][stay] for c in held]
        floor.reshape(-1)[cell[last]] = score[order][last]
    return tuple(held)


def _search(prepared: DataFrame, anchors: DataFrame, same_label: bool, k: int) -> DataFrame:
    """The best ``k`` rows of each anchor and window by (score, then vec_id): anchor, window, score, vec_id, place (from 1).

    ``anchors`` has the columns of ``prepared`` and ``low``, ``high``: windows of scores as 64-bit integers."""
    spark = prepared.sparkSession
    width = prepared.agg(F.max(F.length("vector"))).first()[0] or 0
    count = prepared.count()
    held = max(LEAST_GROUP, GROUP_BYTES // max(width, 1))
    groups = max(1, -(-count // held), min(spark.sparkContext.defaultParallelism, -(-count // LEAST_GROUP)))
    fields = ["row", "vec_id", "label", "vector", "norm", "angles", "near"]
    rows = prepared.select(
        F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("group"), F.lit(0).alias("part"), *fields,
        F.lit(None).cast("array<long>").alias("low"), F.lit(None).cast("array<long>").alias("high"),
    )
    everywhere = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(1).alias("part"), *fields, "low", "high"
    )
    dealt = rows.unionByName(everywhere).repartitionByRange(groups, "group").sortWithinPartitions("group", "part", "label")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, group = None, [], None
        for batch in batches:
            keys = batch.column("group").to_numpy() * 2 + batch.column("part").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1), len(keys)]
            for a, b in zip(edges, edges[1:]):
                piece = batch.slice(a, b - a)
                number, part = divmod(int(keys[a]), 2)
                if number != now:
                    now, parts, group = number, [], None
                if part == 0:
                    parts.append(piece)
                    continue
                if group is None:
                    group = _Group(pa.Table.from_batches(parts, batch.schema)) if parts else None
                    parts = []
                if group is None:
                    continue
                for at in range(0, piece.num_rows, BATCH):
                    asked = piece.slice(at, BATCH)
                    anchor, window, place, score = _best(group, asked, same_label, k)
                    ids = pa.array(group.id[place], pa.int64(), mask=group.nameless[place])
                    yield pa.RecordBatch.from_arrays(
                        [asked.column("row").take(pa.array(anchor)), pa.array(window.astype(np.int32)), pa.array(score), ids],
                        names=["anchor", "window", "score", "vec_id"],
                    )

    found = dealt.mapInArrow(run, "anchor long, window int, score long, vec_id long")
    order = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mine(
    prepared: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Of each row of ``prepared`` that ``anchors`` holds for: its first ``positives`` other rows of the same label, and for each of them
    the first ``negatives`` rows of other labels with low * positive_score <= 100 * score <= high * positive_score.  First means a higher
    score, then a smaller id (null ids last).  Rows that repeat an id are rows of their own."""
    asked = prepared.where(anchors)
    everything = [F.array(F.lit(end).cast("long")) for end in (-(1 << 62), 1 << 62)]
    best = keep(_search(prepared, asked.withColumns(dict(zip(("low", "high"), everything))), True, positives), "positives")
    best = best.select("anchor", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    wide = best.groupBy("anchor").agg(
        *[F.max(F.when(F.col("place") == k, F.col("positive_score"))).alias(f"s{k}") for k in range(1, positives + 1)]
    )
    # a window without a positive, or of a negative score, is empty
    ends = [(f"(s{k} * {low} + 99) div 100", f"(s{k} * {high}) div 100", f"s{k} >= 0") for k in range(1, positives + 1)]
    windows = wide.select(
        F.col("anchor").alias("row"),
        F.array(*[F.expr(f"if({some}, {least}, 1L)") for least, _, some in ends]).alias("low"),
        F.array(*[F.expr(f"if({some}, {most}, 0L)") for _, most, some in ends]).alias("high"),
    )
    found = _search(prepared, asked.join(windows, "row"), False, negatives).select(
        "anchor", (F.col("window") + 1).alias("place"), F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    names = asked.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return found.join(best, ["anchor", "place"]).join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
