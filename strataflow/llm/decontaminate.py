"""Benchmark decontamination: a hash set of the benchmark's word windows, scanned over all documents.

Windows are ``WINDOW`` consecutive words of an item; an item of fewer words is one window.  A task
hashes every window of a document with numpy, looks the hashes up in the set and compares the words
of each hit with the item's before it counts.

The set is broadcast only while its bytes are at most ``BROADCAST_BYTES``, counted before; a larger
benchmark is joined by shuffle instead (``_hits_by_join``), with the same result.  Documents are
scanned in place: the broadcast way shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import col, fresh, keep
from strataflow.llm.url_rules import lower_ascii
from strataflow.llm.words import ALNUM, Chunk, Words, chunks, find_words, windows

WINDOW = 13
#: Documents with at least this share of hit words (1 in so many) count as contaminated.
SHARE = 20
#: Largest broadcast, in bytes of window text.
BROADCAST_BYTES = 32 << 20

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def benchmark_windows(items: DataFrame, item: str = "item_id", text: str = "text", n: int = WINDOW) -> DataFrame:
    """Distinct windows: item (as text), n_words, window (words joined by a space).

    Items without a word have none.  Items that repeat are one; a null id is an empty one."""
    worded = items.select(F.coalesce(col(item).cast("string"), F.lit("")).alias("item"), _words(col(text)).alias("words"))
    size = F.size("words")
    starts = F.sequence(F.lit(0), F.greatest(size - n, F.lit(0)))
    window = F.transform(starts, lambda i: F.array_join(F.slice("words", i + 1, n), " "))
    return (
        worded.where(size > 0)
        .select("item", F.least(size, F.lit(n)).alias("n_words"), F.explode(window).alias("window"))
        .distinct()
    )


OUT = T.StructType(
    [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
     T.StructField("items", T.ArrayType(T.StringType()))]
)
_OUT = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string()))])


class _Windows:
    """The benchmark's windows by length, as sorted hashes, with the words behind each."""

    def __init__(self, rows: Iterable[tuple[str, int, str]]) -> None:
        self.items: dict[bytes, list[str]] = {}
        by_length: dict[int, list[bytes]] = {}
        for item, n, window in rows:
            text = window.encode()
            if text not in self.items:
                by_length.setdefault(n, []).append(text)
            self.items.setdefault(text, []).append(item)
        self.sets = {n: np.sort(_window_hashes(texts, n)) for n, texts in sorted(by_length.items())}

    def scan(self, chunk: Chunk, words: Words) -> Iterator[tuple[int, int, bytes]]:
        """(number of the first word, length, window) of every window that occurs."""
        for n, known in self.sets.items():
            hashes, first = windows(words, n)
            if not len(hashes):
                continue
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            for w in first[known[place] == hashes]:
                text = b" ".join(
                    chunk.data[words.start[k] : words.end[k]].tobytes() for k in range(w, w + n)
                )
                if text in self.items:
                    yield int(w), n, text


def _window_hashes(texts: list[bytes], n: int) -> np.ndarray:
    parts = [windows(find_words(c, ALNUM), n)[0] for c in chunks(pa.array(texts, pa.binary()))]
    return np.unique(np.concatenate(parts))


def _scan_batch(texts: pa.Array, known: _Windows) -> pa.Array:
    n_words, n_hit, items = [], [], []
    for chunk in chunks(texts):
        words = find_words(chunk, ALNUM)
        per_row = np.diff(words.first)
        hit = np.zeros(len(words.hash) + 1, np.int32)
        found: dict[int, set[str]] = {}
        for w, n, window in known.scan(chunk, words):
            hit[w] += 1
            hit[w + n] -= 1
            row = int(np.searchsorted(words.first, w, "right")) - 1
            found.setdefault(row, set()).update(known.items[window])
        covered = np.concatenate(([0], np.cumsum(np.cumsum(hit[:-1]) > 0)))
        n_words.append(per_row)
        n_hit.append(covered[words.first[1:]] - covered[words.first[:-1]])
        items += [sorted(found.get(r, ())) for r in range(len(per_row))]
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.StructArray.from_arrays(
        [pa.array(join(n_words), pa.int64()), pa.array(join(n_hit), pa.int64()), pa.array(items, pa.list_(pa.string()))],
        fields=list(_OUT),
    )


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = WINDOW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: its columns, and ``found`` = (n_words, n_hit, items, contaminated).

    ``items``: the items that have an occurring window, sorted as text.  A document without words
    (null or empty text too) has no hit and is not contaminated.  ``found`` takes another name if ``docs``
    has a column of that name: see ``found_column``.
    """
    name = found_column(docs)
    known = keep(benchmark_windows(items, item_id, item_text, n), "windows")
    size = known.agg(F.sum(F.octet_length("window") + F.octet_length("item"))).first()[0] or 0
    hits = _hits_by_scan if size <= broadcast_bytes else _hits_by_join
    found = hits(docs, known, text, name)
    part = lambda f: F.col(f"{name}.{f}")
    contaminated = (part("n_hit") > 0) & (part("n_hit") * SHARE >= part("n_words"))
    return found.withColumn(name, F.struct(part("n_words"), part("n_hit"), part("items"), contaminated.alias("contaminated")))


def found_column(docs: DataFrame) -> str:
    return fresh(docs, "found")


def _hits_by_scan(docs: DataFrame, known: DataFrame, text: str, name: str) -> DataFrame:
    rows = [tuple(r) for r in known.select("item", "n_words", "window").collect()]  # bounded: see the caller
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    place = docs.columns.index(text)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows_known = _Windows(shared.value)
        for batch in batches:
            yield batch.append_column(name, _scan_batch(batch.column(place), windows_known))

    return docs.mapInArrow(scan, T.StructType([*docs.schema.fields, T.StructField(name, OUT)]))


def _hits_by_join(docs: DataFrame, known: DataFrame, text: str, name: str) -> DataFrame:
    """The same by an equi-join of window hashes, for benchmarks of any size.

    Only hashes and places travel; the words are compared for the hits alone.  Documents are keyed by a
    row number that is stored first, so that it holds in every later read."""
    key = fresh(docs, "row")
    rows = keep(docs.withColumn(key, F.monotonically_increasing_id()), "scanned")
    worded = rows.select(key, _words(col(text)).alias("w"))
    lengths = [r[0] for r in known.select("n_words").distinct().collect()]  # at most WINDOW values
    size = F.size("w")

    def of_length(n: int) -> Column:
        starts = F.when(size >= n, F.sequence(F.lit(0), size - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(
            starts,
            lambda i: F.struct(i.alias("at"), F.lit(n).alias("n"), F.xxhash64(F.array_join(F.slice("w", i + 1, n), " ")).alias("h")),
        )

    places = F.concat(*[of_length(n) for n in lengths])
    candidates = worded.select(key, F.explode(places).alias("p")).select(key, "p.*")
    hashed = known.select(F.xxhash64("window").alias("h"), "n_words", "window", "item")
    near = candidates.join(hashed.select("h", "n_words").distinct(), (hashed["h"] == candidates["h"]) & (F.col("n") == F.col("n_words")), "left_semi")
    confirmed = (
        near.join(worded, key)
        .withColumn("window", F.array_join(F.slice("w", F.col("at") + 1, F.col("n")), " "))
        .join(known.withColumnRenamed("n_words", "n"), ["window", "n"])
    )
    words_hit = confirmed.select(key, F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("k"))
    n_hit = words_hit.distinct().groupBy(key).agg(F.count("*").alias("n_hit"))
    items = confirmed.groupBy(key).agg(F.array_sort(F.collect_set("item")).alias("items"))
    joined = (
        rows.join(worded.select(key, size.cast("long").alias("_n_words")), key)
        .join(n_hit.withColumnRenamed("n_hit", "_n_hit"), key, "left")
        .join(items.withColumnRenamed("items", "_items"), key, "left")
    )
    found = F.struct(
        F.col("_n_words").alias("n_words"),
        F.coalesce("_n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("_items", F.array().cast("array<string>")).alias("items"),
    )
    return joined.withColumn(name, found).select(*docs.columns, name)


def remove_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without contaminated documents; columns as they were."""
    name = found_column(docs)
    return find_contamination(docs, items, **options).where(f"not `{name}`.contaminated").select(*[col(c) for c in docs.columns])


def cut_spans(text: str | None, known: list[tuple[str, int, str]]) -> str | None:
    """The text without its hit words, the rest as it was: the alternative to dropping a document."""
    if not text:
        return text
    data = text.encode()
    rows = pa.array([data], pa.binary())
    chunk = next(chunks(rows, max(len(data), 1)))
    words = find_words(chunk, ALNUM)
    hit = np.zeros(len(words.hash), bool)
    for w, n, _ in _Windows(known).scan(chunk, words):
        hit[w : w + n] = True
    gone = np.zeros(len(data), bool)
    for k in np.flatnonzero(hit):
        gone[words.start[k] : words.end[k]] = True
    return bytes(np.frombuffer(data, np.uint8)[~gone]).decode()
