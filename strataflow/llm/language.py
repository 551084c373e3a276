"""Language identification by fusing evidence: text, declared language, address suffix, host.

log P(language | evidence) = text likelihood + log P(declared | language) + log P(suffix | language)
+ log P(language | host), normalised.  Text likelihoods come from a naive Bayes model on hashed byte
trigrams; all other terms are counts over the whole table, gathered by grouped aggregation:

* the host prior is smoothed towards its parent domain's, that one towards the whole table's;
* how often a language is declared, or has an address suffix, is counted against the text's own verdict.

The model is fitted on a bounded sample of labelled rows (``SAMPLE`` per language, chosen by hash).
A row is rejected when its text gives evidence and the evidence as a whole does not settle on a
language, or when a long text reads as none of them; rows without letters are rejected too.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import col, fresh, keep
from strataflow.llm.words import chunks, mix

#: Labelled rows per language that the text model is fitted on, and characters of them in total.
SAMPLE = 2_000
#: Least share of the labelled rows that makes a label a language: there are at most 1 / LEAST_SHARE of them, whatever the column holds.
LEAST_SHARE = 1 / 256
BUCKETS = 1 << 15
#: The text's log likelihood counts at most as that of so many trigrams: neighbours are not independent.
TRUST = 60.0
#: Pseudo-counts with which a host's prior leans on its parent's, and of every other count.
LEAN = 20.0
HALF = 0.5
#: Least posterior of an accepted row; least average gain (nats a trigram) over unknown text, and the
#: trigrams from which on a text must reach it.
SURE = 0.5
FLOOR = -1.5
LONG = 100
SUFFIX = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "uk": "en", "us": "en"}


class Model(NamedTuple):
    """Languages and the log probability of each trigram bucket in each, minus that of unknown text."""

    languages: list[str]
    gain: np.ndarray


_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every byte trigram that has a letter at its middle; others are blanks."""
    if len(data) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    shown = np.where(_LETTER[data], data, 32).astype(np.uint32)
    code = np.full(len(data), 32, np.uint32)
    before, after = np.full(len(data), 32, np.uint32), np.full(len(data), 32, np.uint32)
    before[1:], after[:-1], code[:] = shown[:-1], shown[1:], shown
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    before[starts], after[ends] = 32, 32
    place = np.flatnonzero(code != 32)
    value = (before[place] << np.uint32(16)) | (code[place] << np.uint32(8)) | after[place]
    bucket = (mix(value.astype(np.uint64)) & np.uint64(BUCKETS - 1)).astype(np.int64)
    return bucket, np.searchsorted(offsets, place, "right") - 1


def fit(docs: DataFrame, text: str = "text", label: str = "lang", sample: int = SAMPLE) -> Model:
    """The text model from at most ``sample`` labelled rows of each language (those of smallest hash).

    Rows without label or text are passed over, and labels with less than ``LEAST_SHARE`` of the labelled rows are no
    languages.  Only trigram counts reach the driver: languages times ``BUCKETS`` at most."""
    labelled = docs.where(col(label).isNotNull() & (F.length(col(text)) > 0)).select(
        col(label).cast("string").alias("label"), col(text).alias("text")
    )
    # the limit on the hash that leaves about the sample; one row per label comes to the driver
    rank = F.xxhash64("text", "label")
    counted = labelled.groupBy("label").agg(F.count("*").alias("size"), F.min(rank).alias("lo"), F.max(rank).alias("hi"))
    counted = keep(counted, "labels")
    least = (counted.agg(F.sum("size")).first()[0] or 0) * LEAST_SHARE
    sizes = counted.where(F.col("size") >= least).collect()
    limits = {r["label"]: r["lo"] + (r["hi"] - r["lo"]) * min(sample, r["size"]) // r["size"] for r in sizes}
    if not limits:
        return Model([], np.zeros((0, BUCKETS)))
    limit = F.element_at(F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]), F.col("label"))
    # copies share a hash: only one of them counts
    chosen = labelled.where(F.col("label").isin(*limits)).where(rank <= limit).select("label", "text").dropDuplicates()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist(), object)
            for chunk in chunks(batch.column(1)):
                bucket, row = _trigrams(chunk.data, chunk.offsets)
                mine = labels[chunk.lo : chunk.hi]
                for name in set(mine):
                    own = bucket[(mine == name)[row]]
                    held[name] = held.get(name, 0) + np.bincount(own, minlength=BUCKETS)
        for name, counts in held.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(some)), pa.array(some.astype(np.int32)), pa.array(counts[some].astype(np.int64))],
                names=["label", "bucket", "n"],
            )

    rows = chosen.mapInArrow(count, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n")).collect()
    names = sorted({r["label"] for r in rows})
    counts = np.zeros((len(names), BUCKETS))
    for r in rows:
        counts[names.index(r["label"]), r["bucket"]] = r["n"]
    seen = max(1, int((counts.sum(axis=0) > 0).sum()))
    share = (counts + HALF) / (counts.sum(axis=1, keepdims=True) + HALF * BUCKETS)
    return Model(names, np.log(share) - np.log(1.0 / seen) if names else counts)


def text_scores(docs: DataFrame, model: Model, text: str, name: str, keep_text: bool = True) -> DataFrame:
    """``docs`` with column ``name``: gains (one per language), letters (number of trigrams); on request without the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS numbers
    place = docs.columns.index(text)
    kind = pa.struct([("gains", pa.list_(pa.float64())), ("letters", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value.gain
        for batch in batches:
            gains, letters = [], []
            for chunk in chunks(batch.column(place)):
                bucket, row = _trigrams(chunk.data, chunk.offsets)
                rows = chunk.hi - chunk.lo
                letters.append(np.bincount(row, minlength=rows))
                gains.append(np.stack([np.bincount(row, g[bucket], rows) for g in gain], axis=1).astype(float) if len(gain) else np.zeros((rows, 0)))
            total = np.concatenate(gains) if gains else np.zeros((0, len(gain)))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(total) + 1) * total.shape[1], pa.int32()), pa.array(total.reshape(-1))
            )
            counts = pa.array(np.concatenate(letters) if letters else np.zeros(0, np.int64), pa.int64())
            scored = batch.append_column(name, pa.StructArray.from_arrays([lists, counts], fields=list(kind)))
            yield scored if keep_text else scored.select([c for k, c in enumerate(scored.schema.names) if k != place])

    out = T.StructType([T.StructField("gains", T.ArrayType(T.DoubleType())), T.StructField("letters", T.LongType())])
    fields = [f for k, f in enumerate(docs.schema.fields) if keep_text or k != place]
    return docs.mapInArrow(run, T.StructType([*fields, T.StructField(name, out)]))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#:]*)", 1))


def parent_of(host: Column) -> Column:
    """The last two labels of a host; hosts without a dot have no parent."""
    return F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -2))


def suffix_of(host: Column) -> Column:
    """The language that an address suffix speaks for, if any."""
    last = F.substring_index(host, ".", -1)
    table = F.create_map(*[F.lit(x) for pair in SUFFIX.items() for x in pair])
    return F.when(F.contains(host, F.lit(".")), F.element_at(table, last))


def markup_language(html: Column) -> Column:
    """The language an HTML page declares (``lang`` of its html element), without region."""
    tag = r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})"
    found = F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), tag, 1))
    return F.when(found != "", found)


def _soft(scores: Column) -> Column:
    """Probabilities from log scores."""
    top = F.array_max(scores)
    raised = F.transform(scores, lambda s: F.exp(s - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def _tempered(part: Column) -> Column:
    """Text log likelihoods, scaled down where there are many trigrams."""
    scale = F.lit(TRUST) / F.greatest(F.lit(TRUST), part["letters"].cast("double"))
    return F.transform(part["gains"], lambda g: g * scale)


def _sums(probabilities: Column, n: int) -> list[Column]:
    """Exact (order-free) sums of the probabilities, in millionths."""
    return [F.sum(F.round(F.element_at(probabilities, k + 1) * 1_000_000).cast("long")).alias(f"p{k}") for k in range(n)]


def identify(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    declared: str | None = None,
    host: str | None = None,
    suffix: str | None = None,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with a struct ``language``: best, posterior, letters, accepted.

    Texts are scored twice, for the counts and for the verdict, so that they are never stored; with ``keep_text=False`` the
    result is without them, and they are scored once.

    ``declared``, ``host`` and ``suffix`` name columns with the declared language, the host (or source)
    and the suffix's language; a missing column or a null is no evidence.  Null and empty texts have no
    letters and are rejected.  Repeated rows are judged alike.  A column ``language`` gives way to the new one.
    """
    n = len(model.languages)
    score, h, p, d, x = (fresh(docs, name) for name in ("score", "host", "parent", "declared", "suffix"))
    none = F.lit(None).cast("string")
    named = docs.withColumns(
        {
            h: F.coalesce(col(host).cast("string"), F.lit("")) if host else F.lit(""),
            d: F.lower(col(declared)) if declared else none,
            x: F.lower(col(suffix)) if suffix else none,
        }
    ).withColumn(p, F.coalesce(parent_of(F.col(h)), F.lit("")))
    # counts need no texts, so only the scores' own columns go to the shuffle
    scored = text_scores(named, model, text, score, keep_text)
    own = [c for c in docs.columns if c.lower() != "language" and (keep_text or c != text)]
    if not keep_text:
        scored = keep(scored, "scores")
    if not n:
        empty = F.struct(
            none.alias("best"), F.lit(0.0).alias("posterior"), F.col(f"{score}.letters").alias("letters"), F.lit(False).alias("accepted")
        )
        return scored.withColumn("language", empty).select(*[col(c) for c in own], "language")

    soft = _soft(_tempered(F.col(score)))
    voting = scored.where(F.col(f"{score}.letters") > 0).withColumn(score, soft)
    groups = keep(voting.groupBy(h, p, d, x).agg(*_sums(F.col(score), n)), "votes")
    hosts = keep(_host_priors(groups, h, p, n), "hosts")
    said = _told(groups, d, model.languages)
    meant = _told(groups, x, model.languages)

    joined = scored.join(hosts, h, "left")
    unknown = F.array(*[F.lit(float(v)) for v in _overall(groups, n)])
    evidence = [_tempered(F.col(score)), F.coalesce(F.col("prior"), unknown), said(F.col(d)), meant(F.col(x))]
    total = F.array(*[sum((F.element_at(e, k + 1) for e in evidence[1:]), F.element_at(evidence[0], k + 1)) for k in range(n)])
    posterior = _soft(total)
    best = F.array_position(posterior, F.array_max(posterior)).cast("int")
    languages = F.array(*[F.lit(name) for name in model.languages])
    letters = F.col(f"{score}.letters")
    reads = (letters < LONG) | (F.array_max(F.col(f"{score}.gains")) > letters * FLOOR)
    verdict = F.struct(
        F.element_at(languages, best).alias("best"),
        F.array_max(posterior).alias("posterior"),
        letters.alias("letters"),
        ((letters > 0) & reads & (F.array_max(posterior) >= SURE)).alias("accepted"),
    )
    verdict_name = fresh(docs, "verdict")
    return joined.withColumn(verdict_name, verdict).select(*[col(c) for c in own], F.col(verdict_name).alias("language"))


def _overall(groups: DataFrame, n: int) -> list[float]:
    sums = groups.agg(*[F.coalesce(F.sum(f"p{k}"), F.lit(0)).alias(f"p{k}") for k in range(n)]).first()
    counts = np.array([float(v) / 1e6 for v in sums]) + HALF
    return list(np.log(counts / counts.sum()))


def _host_priors(groups: DataFrame, h: str, p: str, n: int) -> DataFrame:
    """(host, prior): log P(language | host), smoothed by the parent's, that by the whole table's."""
    names = [f"p{k}" for k in range(n)]
    table = [float(np.exp(v)) for v in _overall(groups, n)]
    by_host = groups.groupBy(h, p).agg(*[(F.sum(c) / 1e6).alias(c) for c in names])
    by_parent = groups.groupBy(p).agg(*[(F.sum(c) / 1e6).alias(f"q{k}") for k, c in enumerate(names)])
    q_total = sum((F.col(f"q{k}") for k in range(1, n)), F.col("q0"))
    p_total = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    # the empty parent is no domain: hosts without one lean on the table directly
    own = F.col(p) != ""
    middle = [
        F.when(own, (F.col(f"q{k}") + LEAN * table[k]) / (q_total + LEAN)).otherwise(F.lit(table[k])) for k in range(n)
    ]
    prior = F.array(*[F.log((F.col(c) + LEAN * m) / (p_total + LEAN)) for c, m in zip(names, middle)])
    known = by_host.join(by_parent, p).where(F.col(h) != "")
    return known.select(h, prior.alias("prior"))


def _told(groups: DataFrame, name: str, languages: Sequence[str]):
    """log P(value told | language) as a function of the column; no evidence for null or unknown values.

    Values other than the languages are one value, so the table has (languages + 1) squared entries."""
    n = len(languages)
    shown = F.when(F.col(name).isin(*languages), F.col(name)).otherwise(F.lit("?"))
    rows = (
        groups.where(F.col(name).isNotNull())
        .groupBy(shown.alias("v"))
        .agg(*[F.sum(f"p{k}").alias(f"p{k}") for k in range(n)])
        .collect()
    )
    counts = {r["v"]: np.array([float(r[f"p{k}"]) / 1e6 for k in range(n)]) for r in rows}
    total = sum(counts.values(), np.zeros(n))
    nothing = F.array(*[F.lit(0.0)] * n)

    def evidence(value: Column) -> Column:
        chosen = nothing
        for v, c in sorted(counts.items()):
            if v != "?":
                logs = np.log((c + HALF) / (total + HALF * (n + 1)))
                chosen = F.when(value == v, F.array(*[F.lit(float(y)) for y in logs])).otherwise(chosen)
        return chosen

    return evidence


def keep_identified(docs: DataFrame, **columns) -> DataFrame:
    """``docs`` without rejected rows; columns as they were."""
    name = "language"
    model = columns.pop("model")
    if name in {c.lower() for c in docs.columns}:
        other = fresh(docs, "own_language")
        original = next(c for c in docs.columns if c.lower() == name)
        judged = identify(docs.withColumnRenamed(original, other), model, **columns)
        return judged.where("language.accepted").drop("language").withColumnRenamed(other, original)
    return identify(docs, model, **columns).where("language.accepted").drop("language")
