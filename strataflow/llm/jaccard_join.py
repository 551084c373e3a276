"""N-gram Jaccard self join by a partition of the universe of shingles.

Two sets of sizes a and b with similarity p/100 differ in at most (a + b)(100 - p)/(100 + p) elements.  The universe is
hashed into segments, so a difference falls into segments, and by the pigeonhole principle few differences leave many
segments equal.  Sets are grouped by size bands; a band is a scheme with its own number of segments, and a set also takes part in
the schemes of larger sets that it may be linked with.

A set enters a scheme with the part of it that lies in each segment: its hash and, in schemes of small sets, the hashes of the part
without one element (the one-deletion neighbourhood).  A segment is worth 1 if equality is found by its hash, 2 if one
difference is found too.  The larger set of a pair must probe segments worth more than all differences; any such allocation is complete.
The allocation goes by cost: all entries are counted, segments whose entries nobody shares cost nothing, then those
with the shortest lists are taken.  Most sets need not probe any shared entry and are done.

Where a set has too few segments with elements for its allocation, its scheme moves to the next form (plain, with deletions, single
elements), so the join is exact for every input.  Pairs are verified on full sets.  Groups are never expanded into
all pairs: lists are first compared with one of their sets, the centre; what is then known to be connected is not
compared again, and crowded lists go on by their rarest shingles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import col, keep
from strataflow.llm.near_dedup import _distinct_windows, _shingles, _with_main, components
from strataflow.llm.words import NOT_SPACE, chunks, find_words, mix

SHINGLE = 5
PERCENT = 80
#: A band ends at this multiple of its beginning; sets up to SINGLES elements have a segment for each element.
RATIO = 1.5
SINGLES = 13
#: Bands that end below this have deletions; up to the next one small segments, so that few of them are empty.
SMALL, MIDDLE = 96, 300
PLAIN, DELETIONS, ELEMENTS = range(3)
#: Lists longer than this are compared by rare shingles in the last round.
CROWDED = 16

#: Word sequences that a task remembers, so as not to enter copies again; forgetting only repeats entries.
REMEMBERED = 1 << 17

#: Bits of a key: it only brings sets together, they are told apart when they are compared.
KEY_BITS = 48
#: Words of 64 bits that hold whether an odd number of a set's elements falls on each bit.  Bits in which two sets differ are
#: never more than elements in which they differ, so a pair beyond the bound need not be compared.
PARITY = 8
PARITIES = [f"p{k}" for k in range(PARITY)]

SKETCH = (
    "doc_id long, print long, node long, digest binary, n_shingles long, scheme int, worth long, need long, form int, "
    + ", ".join(f"{p} long" for p in PARITIES)
)


class Schemes:
    """Bands of sizes, and for each its segments and its form."""

    def __init__(self, percent: int, forms: dict[int, int] | None = None) -> None:
        self.percent, self.forms = percent, forms or {}
        self.edges = [1, SINGLES + 1]
        while self.edges[-1] < 1 << 40:
            self.edges.append(int(self.edges[-1] * RATIO) + 1)

    def differences(self, total):
        """The greatest number of elements in which sets of ``total`` elements together may differ."""
        return total * (100 - self.percent) // (100 + self.percent)

    def scheme(self, n: int) -> int:
        return int(np.searchsorted(self.edges, n, "right")) - 1

    def form(self, scheme: int) -> int:
        if scheme in self.forms:
            return self.forms[scheme]
        return ELEMENTS if scheme == 0 else DELETIONS if self.edges[scheme + 1] <= SMALL else PLAIN

    def segments(self, scheme: int) -> int:
        most = self.edges[scheme + 1] - 1
        need = self.differences(2 * most) + 1
        if most < SMALL:
            return -(-need // 2) + 4
        # 2.5 or 3.75 elements a segment at similarity 0.8; in proportion otherwise
        return int(need * (1.8 if most < MIDDLE else 1.2)) + 1

    def larger(self, n: int) -> list[int]:
        """Schemes above its own whose sets a set of n elements may be linked with."""
        return list(range(self.scheme(n) + 1, self.scheme(n * 100 // self.percent) + 1))

    def _segment(self, elements: np.ndarray, scheme: int) -> tuple[np.ndarray, np.ndarray, np.uint64]:
        """A hash of each element and its segment in a scheme, and the salt of the scheme."""
        salt = np.uint64((scheme * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1))
        spread = mix(elements * np.uint64(0xD6E8FEB86659FD93) + salt)
        count = np.uint64(self.segments(scheme))
        return spread, ((spread >> np.uint64(32)) * count >> np.uint64(32)).astype(np.int64), salt

    def worth(self, elements: np.ndarray, scheme: int) -> int:
        """What all segments of a set are worth in a scheme."""
        form = self.form(scheme)
        if form == ELEMENTS:
            return len(elements)
        size = np.bincount(self._segment(elements, scheme)[1])
        return int(np.minimum(size, 2 if form == DELETIONS else 1).sum())

    def entries(self, elements: np.ndarray, scheme: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Keys of a set in a scheme, the slot of each, and what all segments are worth.

        A slot is what the segment is worth, plus four times its number (from 1) where a segment has several keys."""
        form, count = self.form(scheme), self.segments(scheme)
        spread, segment, salt = self._segment(elements, scheme)
        if form == ELEMENTS:
            keys = mix(elements ^ salt) >> np.uint64(64 - KEY_BITS)
            return keys.view(np.int64), np.ones(len(elements), np.int64), len(elements)
        sums = np.zeros(count, np.uint64)
        np.add.at(sums, segment, spread)
        size = np.bincount(segment, minlength=count)
        some = np.flatnonzero(size)
        worth = np.where((size >= 2) & (form == DELETIONS), 2, 1)

        def key(of: np.ndarray, value: np.ndarray) -> np.ndarray:
            return mix(mix(value + of.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) ^ salt) >> np.uint64(64 - KEY_BITS)

        keys, slots = key(some, sums[some]), np.ones(len(some), np.int64)
        if form == DELETIONS:
            slots = some * 4 + 4 + worth[some]
            cut = size[segment] >= 2  # an empty part is no entry
            keys = np.concatenate((keys, key(segment[cut], (sums[segment] - spread)[cut])))
            slots = np.concatenate((slots, (segment * 4 + 4 + worth[segment])[cut]))
        return keys.view(np.int64), slots, int(worth[some].sum())


def _sets(batch: pa.RecordBatch, texts: pa.Array, shingle: int) -> Iterator[tuple]:
    """Runs of rows: first row, end, and for each the digest of its words, their number, and its distinct shingles."""
    for chunk in chunks(texts):
        words = find_words(chunk, NOT_SPACE)
        n_words = np.diff(words.first)
        hashes, row = _distinct_windows(words, shingle)
        ends = np.searchsorted(row, np.arange(chunk.hi - chunk.lo + 1))
        rows = []
        for k, n in enumerate(n_words):
            own = chunk.data[chunk.offsets[k] : chunk.offsets[k + 1]].tobytes()
            digest = blake2b(b" ".join(own.split()), digest_size=16).digest() if n else None
            rows.append((digest, int(n), hashes[ends[k] : ends[k + 1]]))
        yield chunk.lo, chunk.hi, rows


def _parity(elements: np.ndarray) -> list[int]:
    bit = (mix(elements * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(32)) % np.uint64(64 * PARITY)
    odd = np.bincount(bit.astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def sketch(docs: DataFrame, schemes: Schemes, id_col: str, text: str, shingle: int) -> DataFrame:
    """Per row: id, a print of the text, a digest of the word sequence and its first 64 bits (``node``), set size, and what the
    segments of its scheme are worth against what it needs."""
    chosen = docs.select(
        col(id_col).cast("long").alias("doc_id"), F.xxhash64(col(text)).alias("print"), col(text).alias("text")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * PARITY]
        names = ["doc_id", "print", "node", "digest", "n_shingles", "scheme", "worth", "need", "form", *PARITIES]
        for batch in batches:
            for lo, hi, sets in _sets(batch, batch.column(2), shingle):
                rows = []
                for digest, n, elements in sets:
                    node = int.from_bytes(digest[:8], "little", signed=True) if n else None
                    if n < shingle:
                        rows.append((node, digest, min(n, 1), *[None] * (4 + PARITY)))
                        continue
                    own, size = schemes.scheme(len(elements)), len(elements)
                    worth, need = schemes.worth(elements, own), schemes.differences(2 * size) + 1
                    rows.append((node, digest, size, own, worth, need, schemes.form(own), *_parity(elements)))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(c, t) for c, t in zip(zip(*rows), types))], names=names
                )

    return chosen.mapInArrow(run, SKETCH)


def _sketched(docs: DataFrame, id_col: str, text: str, shingle: int, percent: int) -> tuple[DataFrame, Schemes]:
    """The stored sketch, and the forms that give every set an allocation."""
    forms: dict[int, int] = {}
    while True:
        schemes = Schemes(percent, forms)
        rows = keep(sketch(docs, schemes, id_col, text, shingle), "sketch")
        # at most one row a band; the bands grow by a factor, so there are some dozens
        short = rows.where("worth < need").groupBy("scheme").agg(F.max("form").alias("form")).collect()
        if not short:
            return rows, schemes
        forms = forms | {r["scheme"]: r["form"] + 1 for r in short}


def _entries(docs: DataFrame, schemes: Schemes, text: str, shingle: int) -> DataFrame:
    """(key, node, slot) of all sets; the slot of an entry in the scheme of larger sets is 0.

    Entries go from the texts straight into the shuffle, they are never stored unshared.  Copies of a word sequence are entered
    once a task (while it is remembered), so a group of copies of any size adds a few rows to its keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            keys, slots, nodes, size = [], [], [], 0

            def entered() -> pa.RecordBatch:
                node = np.repeat(np.array(nodes, np.int64), [*map(len, keys)])
                columns = [np.concatenate(keys), node, np.concatenate(slots).astype(np.int32)]
                return pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["key", "node", "slot"])

            for _, _, sets in _sets(batch, batch.column(0), shingle):
                for digest, n, elements in sets:
                    if n < shingle or digest in seen:
                        continue
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(digest)
                    own, slot, _ = schemes.entries(elements, schemes.scheme(len(elements)))
                    others = [schemes.entries(elements, k)[0] for k in schemes.larger(len(elements))]
                    keys.append(np.concatenate((own, *others)))
                    slots.append(np.concatenate((slot, np.zeros(len(keys[-1]) - len(own), np.int64))))
                    nodes.append(int.from_bytes(digest[:8], "little", signed=True))
                    size += len(keys[-1])
                if size > 1 << 17:
                    yield entered()
                    keys, slots, nodes, size = [], [], [], 0
            if nodes:
                yield entered()

    return docs.select(col(text).alias("text")).mapInArrow(run, "key long, node long, slot int")


def _shared(entries: DataFrame) -> DataFrame:
    """Entries whose key more than one set has, once each, with the length of the key's list: one shuffle."""
    list_ = Window.partitionBy("key")
    counted = entries.withColumns({
        "size": F.count("*").over(list_), "lo": F.min("node").over(list_), "hi": F.max("node").over(list_)
    })
    return counted.where("lo <> hi").groupBy("key", "node", "slot").agg(F.max("size").alias("size"))


def _allocated(shared: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, node) of the shared entries that a set probes: what is missing after all unshared segments, shortest lists first.

    Sets whose unshared segments are worth enough are done, and their entries travel no further."""
    number = F.shiftright("slot", 2)
    segment = F.when(number > 0, number.cast("long")).otherwise(F.col("key"))  # a set has one form, so these never mix
    own = shared.where("slot > 0").withColumns({"segment": segment, "value": F.col("slot").bitwiseAND(3)})
    most = own.groupBy("node").agg(F.sum("value").alias("most"))  # several entries of a segment count each: at least the true sum
    asking = nodes.join(most, "node").where("worth - most < need").select("node", "worth", "need")
    rows = own.join(asking, "node").repartition("node")
    segment, of_node = Window.partitionBy("node", "segment"), Window.partitionBy("node")
    once = F.when(F.row_number().over(segment.orderBy("key")) == 1, F.col("value")).otherwise(0)
    costs = rows.withColumns({"cost": F.sum("size").over(segment), "once": once})
    upto = F.sum("once").over(of_node.orderBy("cost", "segment"))  # a range frame: entries of a segment are peers
    placed = costs.withColumns({"before": upto - F.col("value"), "shared": F.sum("once").over(of_node)})
    return placed.where("before < need - (worth - shared)").select("key", "node").distinct()


def _lists(shared: DataFrame, probes: DataFrame) -> DataFrame:
    """(key, node, probes) of all entries of the keys that some set probes: one shuffle by key."""
    possible = _passing(shared.select("key", "node"), "key", probes)
    both = possible.withColumn("probes", F.lit(False)).unionByName(probes.withColumn("probes", F.lit(True)))
    entries = both.repartition("key").groupBy("key", "node").agg(F.max("probes").alias("probes"))
    return entries.withColumn("asked", F.max("probes").over(Window.partitionBy("key"))).where("asked").drop("asked")


def _met(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of a probing set and a set of another component in the same list, no larger and large enough."""
    probing = lists.where("probes").select("key", "node", "n", "root")
    others = lists.select("key", F.col("node").alias("other"), F.col("n").alias("m"), F.col("root").alias("r"))
    met = probing.join(others, "key").where("root <> r").where(f"m <= n and m * 100 >= n * {percent}")
    return met.select(F.least("node", "other").alias("u"), F.greatest("node", "other").alias("v")).distinct()


def _with_centre(lists: DataFrame, percent: int, *salt: str) -> DataFrame:
    """Pairs of each set of a list with the list's centre, the set of the smallest hash."""
    rank = F.xxhash64("node", *salt)
    centre = lists.groupBy("key").agg(F.min_by(F.struct("node", "n", "root"), rank).alias("c"))
    close = f"n * 100 >= c.n * {percent} and c.n * 100 >= n * {percent}"
    pairs = lists.join(centre, "key").where("root <> c.root").where(close)
    return pairs.select(F.least("node", "c.node").alias("u"), F.greatest("node", "c.node").alias("v")).distinct()


def _apart(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """Lists that hold several components and a set that probes, with the component of each set."""
    labelled = lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    return labelled.join(mixed.select("key"), "key", "left_semi")


def _last(lists: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """All pairs of different components that a probe brings together and that may be links."""
    lists = keep(lists, "apart")
    crowded = lists.groupBy("key").agg(F.count("*").alias("size")).where(f"size > {CROWDED}").select("key")
    few = _met(lists.join(crowded, "key", "left_anti"), percent)
    many = lists.join(crowded, "key", "left_semi").select("node", "n", "root").distinct()
    return few.union(_by_rare_shingles(many, nodes, texts, shingle, percent)).distinct()


def _by_rare_shingles(sets: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs of sets (node, n, root) of different components that may be links by their rarest shingles.

    With every set in one order, rarest shingles first, two similar sets share one among their first ones, where both are still
    long enough for the overlap they need; and their parities differ in no more bits than they may differ in elements.
    Of each pair one set lies outside its shingle's largest component, so that a group never meets itself."""
    rows = keep(_shingles(sets, texts, shingle), "shingles")
    counts = rows.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1")
    own = Window.partitionBy("node")
    # shingles of one set alone come first in its order and meet nobody
    place = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("times", "shingle"))
    placed = rows.join(counts, "shingle").withColumn("place", place)
    first = placed.where(f"place <= n - ceil({percent} * n / 100) + 1").drop("times")
    first = keep(_with_main(first.join(nodes.select("node", *PARITIES), "node")), "first-shingles")
    smaller = first.where(f"place <= n - ceil({2 * percent} * n / {100 + percent}) + 1").select(
        "shingle", F.col("node").alias("other"), F.col("n").alias("m"), F.col("root").alias("r"), F.col("place").alias("at"), "main",
        *[F.col(p).alias(f"{p}_") for p in PARITIES],
    )
    outside, inside = first.where("root <> main").drop("main"), first.where("root = main").drop("main")
    may = (
        f"root <> r and (m < n or (m = n and other < node)) and m * 100 >= n * {percent} "
        f"and {100 + percent} * (1 + least(n - place, m - at)) >= {percent} * (n + m) and {_alike(percent)}"
    )
    met = [
        side.join(others.drop("main"), "shingle").where(may).select("node", "other")
        for side, others in ((outside, smaller), (inside, smaller.where("r <> main")))
    ]
    return met[0].unionByName(met[1]).select(F.least("node", "other").alias("u"), F.greatest("node", "other").alias("v")).distinct()


def _alike(percent: int) -> str:
    """The parities of two sets differ in no more bits than sets of their sizes may differ in elements."""
    bits = " + ".join(f"bit_count({p} ^ {p}_)" for p in PARITIES)
    return f"({bits}) <= (n + m) * {100 - percent} div {100 + percent}"


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that sizes and parities allow."""
    left = nodes.select(F.col("node").alias("u"), "n", *PARITIES)
    right = nodes.select(F.col("node").alias("v"), F.col("n").alias("m"), *[F.col(p).alias(f"{p}_") for p in PARITIES])
    return pairs.join(left, "u").join(right, "v").where(_alike(percent)).select("u", "v")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    left = _passing(texts, "node", pairs.select(F.col("u").alias("node"))).toDF("u", "a")
    right = _passing(texts, "node", pairs.select(F.col("v").alias("node"))).toDF("v", "b")

    def sets(column: pa.Array) -> list[np.ndarray]:
        out = []
        for chunk in chunks(column):
            hashes, row = _distinct_windows(find_words(chunk, NOT_SPACE), shingle)
            out += np.split(hashes, np.searchsorted(row, np.arange(1, chunk.hi - chunk.lo)))
        return out

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                good = []
                for a, b in zip(sets(part.column(2)), sets(part.column(3))):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    good.append(100 * both >= percent * (len(a) + len(b) - both))
                yield part.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


#: Slots of the filter that rows pass before they are shuffled: a table of at most so many numbers is broadcast.
SLOTS = 1 << 20


def _passing(rows: DataFrame, name: str, wanted: DataFrame) -> DataFrame:
    """The rows whose value of a column may occur in ``wanted``: most others stop at a filter of fixed size, unshuffled."""
    slot = F.pmod(F.xxhash64(name), F.lit(SLOTS)).cast("int")
    return rows.join(F.broadcast(wanted.select(slot.alias("_slot")).distinct()), slot == F.col("_slot"), "left_semi")


def _texts(docs: DataFrame, id_col: str, text: str, wanted: DataFrame) -> DataFrame:
    """(node, text) of ``wanted`` (node, doc_id, print)."""
    raw = docs.select(col(id_col).cast("long").alias("doc_id"), F.xxhash64(col(text)).alias("print"), col(text).alias("text"))
    raw = _passing(raw, "print", wanted)
    same = raw["doc_id"].eqNullSafe(wanted["doc_id"]) & (raw["print"] == wanted["print"])
    return raw.join(wanted, same).groupBy("node").agg(F.first("text").alias("text"))


def similarity_classes(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, group_size.

    Rows are linked if 100 * intersection >= percent * union of their sets of shingles; ``component_id`` is the smallest id
    reachable, ``group_size`` the number of rows of the component.  A row of fewer words than a shingle has the whole
    sequence as its one element; rows without words (null and empty texts) are linked with nothing, not even each other.  Null ids never become
    a component's id unless it has no other.  Rows that repeat an id are linked like others.

    64 bits of a digest stand for a word sequence, and a 64-bit hash for a shingle."""
    rows, schemes = _sketched(docs, id_col, text, shingle, percent)
    nodes = keep(
        rows.where("digest is not null").groupBy("digest", "node").agg(
            F.min(F.struct("doc_id", "print")).alias("first"),
            F.min("doc_id").alias("least"),  # unlike the struct's it passes over nulls
            F.max("n_shingles").alias("n"), F.max("worth").alias("worth"), F.max("need").alias("need"),
            F.count("*").alias("copies"), *[F.max(p).alias(p) for p in PARITIES],
        ),
        "nodes",
    )
    shared = keep(_shared(_entries(docs, schemes, text, shingle)), "shared")
    probes = keep(_allocated(shared, nodes), "probes")
    lists = keep(_lists(shared, probes).join(nodes.select("node", "n"), "node"), "lists")
    met = keep(nodes.join(lists.select("node").distinct(), "node", "left_semi"), "met")
    wanted = keep(met.select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.print").alias("print")), "wanted")
    texts = keep(_texts(docs, id_col, text, wanted), "texts")

    roots = rows.sparkSession.createDataFrame([], "node long, root long")
    compared = []
    for k, pairs_of in enumerate((
        lambda part: _with_centre(part, percent),
        lambda part: _with_centre(part, percent, "key"),
        lambda part: _last(part, met, texts, shingle, percent),
    )):
        pairs = pairs_of(_apart(lists, roots))
        for before in compared:
            pairs = pairs.join(before, ["u", "v"], "left_anti")
        compared.append(keep(_possible(pairs, met, percent), "pairs"))
        links = _verified(compared[-1], texts, shingle, percent)
        roots = components(links.union(roots.select("node", "root")) if k else links)

    labelled = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = labelled.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("copies").alias("group_size"))
    by_digest = labelled.join(classes, "root").select("digest", "component_id", "group_size")
    alone = F.col("digest").isNull()
    return rows.select("doc_id", "digest", "n_shingles").join(by_digest, "digest", "left").select(
        "doc_id", "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.lit(1).cast("long")).otherwise(F.col("group_size")).alias("group_size"),
    )
