"""Near-duplicate detection by a multi-index Hamming join of minhash signatures.

A document's signature has ``CHUNKS`` chunks of ``WIDTH`` symbols, each the low ``BITS`` bits of a
minimum over its shingles.  Two signatures that differ in at most ``MAX_DISTANCE`` symbols must, by the
pigeonhole principle, have a chunk with at most ``ERRORS`` wrong symbols.  Each chunk is entered into
the index once for every choice of ``WIDTH - ERRORS`` of its symbols, so all pairs within the distance
(and many beyond it) meet under some key.  A pair of similarity 0.8 is missed with a probability of
about 10^-7.  Pairs that meet are confirmed on their full shingle sets.

No group is ever expanded into all its pairs.  Copies of one word sequence are one node.  Under each
key the nodes are first compared with one of them, its centre; linked nodes become components; further
rounds take other centres.  Nodes still outside their key's largest component are then compared with the
others of the key; where a key is crowded, only with those that share one of their rarest shingles, as any
similar text must.  This makes the search complete: whatever meets under a key is compared, known to be
connected or known to differ.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import col, fresh, keep
from strataflow.llm.words import NOT_SPACE, Words, chunks, find_words, mix, windows

SHINGLE = 5
PERCENT = 80
CHUNKS, WIDTH, ERRORS, BITS = 12, 5, 1, 16
SIZE = CHUNKS * WIDTH
MAX_DISTANCE = CHUNKS * (ERRORS + 1) - 1
#: Signatures that differ in more symbols are not compared in full: at the similarity bound that
#: loses less than one pair in 10^6.
FAR = 28
#: Nodes of one key up to which all of them may be compared; in larger keys only those that share a rare shingle.
CROWDED = 16

_rng = np.random.default_rng(20_11)
_FACTORS = _rng.integers(0, 1 << 63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CHOICES = [
    [chunk * WIDTH + k for k in chosen]
    for chunk in range(CHUNKS)
    for chosen in combinations(range(WIDTH), WIDTH - ERRORS)
]

SKETCH = "doc_id long, print long, digest binary, n_shingles long, signature binary"


def _distinct_windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of runs of n words in each row, and the row of each; rows in order."""
    hashes, first = windows(words, n)
    row = np.searchsorted(words.first, first, "right") - 1
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], row[new]


def _signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The signature of each row that has shingles; the others have zeros."""
    out = np.zeros((len(counts), SIZE), np.uint16)
    some = counts > 0
    if some.any():
        starts = (np.cumsum(counts) - counts)[some]
        for k in range(SIZE):
            least = np.minimum.reduceat(hashes * _FACTORS[k], starts)
            out[some, k] = (mix(least) >> np.uint64(64 - BITS)).astype(np.uint16)
    return out


def sketch(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per row: id, a print of the raw text, a digest of the word sequence, set size, signature.

    A row of fewer words than a shingle has the whole sequence as its only one, and no signature (it
    can only equal its copies); a row without words has an empty set and no digest."""
    chosen = docs.select(
        col(id_col).cast("long").alias("doc_id"), F.xxhash64(col(text)).alias("print"), col(text).alias("text")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                words = find_words(chunk, NOT_SPACE)
                n_words = np.diff(words.first)
                hashes, row = _distinct_windows(words, shingle)
                counts = np.bincount(row, minlength=chunk.hi - chunk.lo)
                signature = _signatures(hashes, counts)
                n_shingles = np.where(n_words < shingle, np.minimum(n_words, 1), counts)
                digests = [
                    blake2b(b" ".join(chunk.data[a:b].tobytes().split()), digest_size=16).digest() if n else None
                    for a, b, n in zip(chunk.offsets, chunk.offsets[1:], n_words)
                ]
                signed = [s.tobytes() if n else None for s, n in zip(signature, counts)]
                part = batch.slice(chunk.lo, chunk.hi - chunk.lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(digests, pa.binary()),
                        pa.array(n_shingles, pa.int64()), pa.array(signed, pa.binary()),
                    ],
                    names=["doc_id", "print", "digest", "n_shingles", "signature"],
                )

    return chosen.mapInArrow(run, SKETCH)


def index_keys(nodes: DataFrame) -> DataFrame:
    """(key, node, n): the index entries of every signature."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signature = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(-1, SIZE).astype(np.uint64)
            keys = np.empty((len(signature), len(_CHOICES)), np.uint64)
            for k, chosen in enumerate(_CHOICES):
                value = np.full(len(signature), k + 1, np.uint64)
                for symbol in chosen:
                    value = mix(value * np.uint64(0x9E3779B97F4A7C15) + signature[:, symbol])
                keys[:, k] = value
            times = len(_CHOICES)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.reshape(-1).view(np.int64)),
                    pa.array(np.repeat(batch.column(0).to_numpy(), times)),
                    pa.array(np.repeat(batch.column(1).to_numpy(), times)),
                ],
                names=["key", "node", "n"],
            )

    signed = nodes.where("signature is not null").select("node", "n", "signature")
    return signed.mapInArrow(run, "key long, node long, n long")


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those pairs (u, v) whose full shingle sets are similar enough; sets are built only where the
    signatures differ in at most ``FAR`` symbols."""
    left = texts.select("node", "signature", "text").toDF("u", "s", "a")
    right = texts.select("node", "signature", "text").toDF("v", "t", "b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, t = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, SIZE) for c in (2, 3))
            close = batch.filter(pa.array((s != t).sum(axis=1) <= FAR))
            for at in range(0, close.num_rows, 64):
                part = close.slice(at, 64)
                sets = [_sets(part.column(c), shingle) for c in (4, 5)]
                good = []
                for a, b in zip(*sets):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    good.append(100 * both >= percent * (len(a) + len(b) - both))
                yield part.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    both = pairs.join(left, "u").join(right, "v").select("u", "v", "s", "t", "a", "b")
    return both.mapInArrow(run, "u long, v long")


def _sets(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    out = []
    for chunk in chunks(texts):
        hashes, row = _distinct_windows(find_words(chunk, NOT_SPACE), shingle)
        ends = np.searchsorted(row, np.arange(1, chunk.hi - chunk.lo))
        out += np.split(hashes, ends)
    return out


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of an undirected graph of links (u, v); root: its smallest node.

    Alternates two star steps until nothing changes: every node points its larger neighbours to its
    smallest neighbour, then its smaller ones.  A node of any degree is a minimum and a join, never a list.
    """
    edges = keep(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        edges = keep(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _apart(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """Index entries with their components, of the keys that hold more than one."""
    labelled = entries.join(roots, "node", "left").select(
        "key", "node", "n", F.coalesce("root", "node").alias("root")
    )
    mixed = labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    return labelled.join(mixed.select("key"), "key", "left_semi")


def _similar_size(percent: int):
    return (F.col("n") * 100 >= F.col("m") * percent) & (F.col("m") * 100 >= F.col("n") * percent)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("node", "other").alias("u"), F.greatest("node", "other").alias("v")).distinct()


def _with_centre(entries: DataFrame, percent: int, *salt: str) -> DataFrame:
    """Pairs of each node of a key and the key's centre: the node whose hash is the smallest.

    Without salt, keys with common nodes mostly share a centre: few pairs that link most copies.
    Salted by the key, each key has a centre of its own, so a node meets as many centres as it has keys."""
    rank = F.xxhash64("node", *[F.col(x) for x in salt])
    centre = entries.groupBy("key").agg(F.min_by(F.struct("node", "n", "root"), rank).alias("c"))
    pairs = entries.join(centre, "key").where("root <> c.root").select(
        "node", "n", F.col("c.node").alias("other"), F.col("c.n").alias("m")
    )
    return _ordered(pairs.where(_similar_size(percent)))


def _rest(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes outside their key's largest component and all nodes of other components there."""
    sizes = entries.groupBy("key", "root").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("key").agg(F.max_by("root", F.struct("size", "root")).alias("main"))
    outside = entries.join(largest, "key").where("root <> main").drop("main")
    others = entries.select("key", F.col("node").alias("other"), F.col("n").alias("m"), F.col("root").alias("r"))
    met = outside.join(others, "key").where("root <> r")
    return _ordered(met.where(_similar_size(percent)))


def _shingles(nodes: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """(node, n, root, shingle): the shingle hashes of ``nodes`` (node, n, root)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(3)):
                hashes, row = _distinct_windows(find_words(chunk, NOT_SPACE), shingle)
                own = batch.slice(chunk.lo, chunk.hi - chunk.lo).select([0, 1, 2]).take(pa.array(row))
                yield own.append_column("shingle", pa.array(hashes.view(np.int64)))

    return nodes.join(texts.select("node", "text"), "node").mapInArrow(run, "node long, n long, root long, shingle long")


def _dense(entries: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs of nodes of crowded keys that their rarest shingles leave possible.

    With every set in the same order, rarest shingles first, two sets that are similar enough share one
    among their first n - ceil(percent * n / 100) + 1 (of the smaller set: among fewer still), and from the
    first shared one on both are long enough for the overlap the link needs.  So no link is lost, while texts
    that share common passages but differ in their own words never meet."""
    rows = keep(_shingles(entries.select("node", "n", "root").distinct(), texts, shingle), "shingles")
    counts = rows.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1")
    own = Window.partitionBy("node")
    # shingles of one node alone come first in its order and meet nobody
    place = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("times", "shingle"))
    placed = rows.join(counts, "shingle").withColumn("place", place)
    first = keep(placed.where(f"place <= n - ceil({percent} * n / 100) + 1").drop("times"), "first-shingles")
    enough = f"{100 + percent} * (1 + least(n - place, m - at)) >= {percent} * (n + m)"
    (a, b), (c, d) = _sides(keep(_with_main(first), "main-shingles"), percent)
    met = a.join(b, "shingle").unionByName(c.join(d, "shingle")).where("root <> r").where("m < n or (m = n and other < node)")
    return _ordered(met.where(enough).where(_similar_size(percent)))


def _with_main(first: DataFrame) -> DataFrame:
    """``first`` with the largest component of each shingle, of the shingles that hold more than one."""
    sizes = first.groupBy("shingle", "root").agg(F.count("*").alias("size"))
    mains = sizes.groupBy("shingle").agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.count("*").alias("roots"))
    return first.join(mains.where("roots > 1").drop("roots"), "shingle")


def _sides(first: DataFrame, percent: int) -> list[tuple[DataFrame, DataFrame]]:
    """The sides of the joins on shingles: larger sets, smaller sets.  In each, one side holds only nodes outside their
    shingle's largest component, so that a group never meets itself; together they hold every pair of two components."""
    fewer = first.where(f"place <= n - ceil({2 * percent} * n / {100 + percent}) + 1").select(
        "shingle", F.col("node").alias("other"), F.col("n").alias("m"), F.col("root").alias("r"), F.col("place").alias("at"), "main"
    )
    return [
        (first.where("root <> main").drop("main"), fewer.drop("main")),
        (first.where("root = main").drop("main"), fewer.where("r <> main").drop("main")),
    ]


def _last_round(entries: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """All pairs of different components that meet under a key and may be links."""
    entries = keep(entries, "apart")
    crowded = entries.groupBy("key").agg(F.count("*").alias("size")).where(f"size > {CROWDED}").select("key")
    few = _rest(entries.join(crowded, "key", "left_anti"), percent)
    return few.union(_dense(entries.join(crowded, "key", "left_semi"), texts, shingle, percent)).distinct()


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: doc_id, print, n_shingles, component_id, kept.

    Rows are linked if 100 * intersection >= percent * union of their shingle sets; ``component_id`` is
    the smallest id reachable and ``kept`` marks it.  Rows without words (null and empty texts) are
    linked with nothing, not even each other.  Null ids never become a component's id unless it has no other;
    rows that repeat an id are linked like others, and are all kept if the id is the component's.
    """
    return _rooted(docs, id_col, text, shingle, percent).drop("root")


def _rooted(docs: DataFrame, id_col: str, text: str, shingle: int, percent: int) -> DataFrame:
    """``near_groups`` with ``root``, which tells components apart whatever their ids; null for rows without words."""
    rows = keep(sketch(docs, id_col, text, shingle), "sketch")
    nodes = keep(
        rows.where("digest is not null")
        .groupBy("digest")
        .agg(
            F.min(F.struct("doc_id", "print")).alias("first"),
            F.min("doc_id").alias("least"),  # unlike the struct's it passes over nulls
            F.max("n_shingles").alias("n"),
            F.max("signature").alias("signature"),
        )
        .select(
            F.monotonically_increasing_id().alias("node"), "digest", "least", "n", "signature",
            F.col("first.doc_id").alias("doc_id"), F.col("first.print").alias("print"),
        ),
        "nodes",
    )
    entries = index_keys(nodes)
    shared = entries.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
    entries = keep(entries.join(shared, "key", "left_semi"), "index")
    texts = keep(_texts(docs, id_col, text, nodes, entries), "texts")

    roots = entries.sparkSession.createDataFrame([], "node long, root long")
    found, compared = [], []
    for k, pairs_of in enumerate((
        lambda e: _with_centre(e, percent),
        lambda e: _with_centre(e, percent, "key"),
        lambda e: _last_round(e, texts, shingle, percent),
    )):
        pairs = pairs_of(_apart(entries, roots))
        for before in compared:
            pairs = pairs.join(before, ["u", "v"], "left_anti")
        pairs = keep(pairs, "pairs")
        compared.append(pairs)
        links = keep(_confirmed(pairs, texts, shingle, percent), "links")
        found.append(links)
        edges = links
        if k:
            edges = links.union(roots.select("node", "root"))
        roots = components(edges)

    labelled = nodes.join(roots, "node", "left").select("digest", "least", F.coalesce("root", "node").alias("root"))
    ids = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    by_digest = labelled.join(ids, "root").select("digest", "root", "component_id")
    joined = rows.join(by_digest, "digest", "left").withColumn(
        "component_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    )
    return joined.select(
        "doc_id", "print", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "root"
    )


def _texts(docs: DataFrame, id_col: str, text: str, nodes: DataFrame, entries: DataFrame) -> DataFrame:
    """(node, signature, text) of the nodes that share a key with another; repeated rows combined before the shuffle."""
    wanted = nodes.join(entries.select("node").distinct(), "node", "left_semi").select("node", "signature", "doc_id", "print")
    raw = docs.select(col(id_col).cast("long").alias("doc_id"), F.xxhash64(col(text)).alias("print"), col(text).alias("text"))
    same = raw["doc_id"].eqNullSafe(wanted["doc_id"]) & (raw["print"] == wanted["print"])
    found = raw.join(wanted, same).select("node", "signature", "text")
    return found.groupBy("node").agg(F.first("signature").alias("signature"), F.first("text").alias("text"))


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one row of each component; columns as they were.

    Rows that repeat both id and text are one row.  Of a component the row with its smallest id stays (a null id only
    if there is no other), then the one with the smallest print; components that share an id, or have none, keep a row each."""
    key = fresh(docs, "print")
    groups = _rooted(docs, id_col, text, shingle, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "print")).alias("first")
    stays = groups.where("root is not null").groupBy("root").agg(first).select("first.doc_id", "first.print")
    empty = groups.where("root is null").select("doc_id", "print").distinct()
    kept = stays.union(empty).toDF(f"{key}_id", f"{key}_kept")
    marked = docs.withColumn(key, F.xxhash64(col(text)))
    same = col(id_col).cast("long").eqNullSafe(F.col(f"{key}_id")) & (F.col(key) == F.col(f"{key}_kept"))
    return marked.join(kept, same, "left_semi").dropDuplicates([id_col, key]).drop(key)
