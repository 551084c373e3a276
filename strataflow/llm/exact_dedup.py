"""Exact deduplication by deterministic block naming, in DataFrame operations only.

A text without white space is cut into blocks of ``BLOCK`` characters.  Distinct blocks are sorted
and numbered; the number is the block's name.  Then adjacent names are paired, distinct pairs are
sorted and numbered, and so on, until each text has a single name.  Texts of equal block count have
equal names if and only if they are equal: names are handed out per distinct block and per distinct
pair, so no step can confuse two texts.

Scale: the text is shuffled once, as distinct blocks combined before the shuffle.  Everything after
carries names (two integers a block, half as many at each level).  A text that a third of all rows
share is one block list after the combine; joins put the unique names on one side, so adaptive
execution can split the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import col, fresh, keep

BLOCK = 1024
SPACE = r"[\x20\x09-\x0D]"
#: Names are numbered inside so many ranges of the fingerprint, each sorted on its own.
RANGES = 65_536


def squeeze(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", "")


def _fingerprint(*columns: Column, bits: int) -> Column:
    value = F.xxhash64(*columns)
    return value if bits >= 64 else F.pmod(value, F.lit(1 << bits))


def _numbered(distinct: DataFrame, key: Column, *order: str) -> DataFrame:
    """A distinct integer ``name`` per row of ``distinct``: its rank in its range, and the range."""
    part = F.pmod(key, F.lit(RANGES))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(*order)).cast("long")
    named = distinct.withColumn("_range", part)
    return named.withColumn("name", rank * F.lit(RANGES) + F.col("_range")).drop("_range")


def block_names(blocks: DataFrame, bits: int = 64) -> DataFrame:
    """Names of the distinct blocks in column ``block``: (print, block, name).

    Blocks are sorted by fingerprint, and by text where two blocks share one.  ``block`` is null
    where the fingerprint belongs to a single block, so that the text goes no further; where it
    belongs to several, each has a row with its text.
    """
    prints = blocks.select(_fingerprint(F.col("block"), bits=bits).alias("print"), "block")
    # the least and the greatest text of a fingerprint tell whether it has one block or several
    ends = prints.groupBy("print").agg(F.min("block").alias("lo"), F.max("block").alias("hi"))
    ends = keep(
        ends.select("print", F.when(F.col("lo") != F.col("hi"), F.lit(True)).alias("shared")), "prints"
    )
    shared = ends.where("shared").select("print")
    single = ends.where("shared is null").select("print", F.lit(None).cast("string").alias("block"))
    if not shared.isEmpty():
        several = prints.join(shared, "print", "left_semi").distinct()
        single = single.unionByName(several)
    return _numbered(single, F.col("print"), "print", "block")


def document_names(docs: DataFrame, text: str = "text", block: int = BLOCK, bits: int = 64) -> DataFrame:
    """``docs`` with ``level`` and ``name``: two rows agree in both if and only if their squeezed
    texts are equal.  Also ``_rid`` (a row number) and ``text_sha256`` and ``n_points`` of the text.

    Columns of ``docs`` other than the text stay (they must not have these names).  ``bits`` shortens the
    fingerprint; a test uses it to force shared ones.
    """
    pattern = F.lit("(?s).{1,%d}" % block)
    squeezed = squeeze(F.col(text))
    pieces = F.regexp_extract_all(squeezed, pattern, F.lit(0))
    cut = F.when(F.size(pieces) == 0, F.array(F.lit(""))).otherwise(pieces)

    names = keep(block_names(docs.select(F.explode(cut).alias("block")), bits), "blocks")
    other = [c for c in docs.columns if c != text]
    collided = not names.where("block is not null").isEmpty()
    rows = keep(
        docs.withColumn("_squeezed", squeezed).select(
            *other,
            F.monotonically_increasing_id().alias("_rid"),
            F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_points"),
            F.sha2(F.col("_squeezed").cast("binary"), 256).alias("text_sha256"),
            F.transform(
                F.when(F.col("_squeezed") == "", F.array(F.lit(""))).otherwise(
                    F.regexp_extract_all("_squeezed", pattern, F.lit(0))
                ),
                lambda b: F.struct(
                    _fingerprint(b, bits=bits).alias("print"),
                    (b if collided else F.lit(None).cast("string")).alias("block"),
                ),
            ).alias("blocks"),
        ),
        "documents",
    )
    placed = rows.select("_rid", F.size("blocks").alias("n"), F.posexplode("blocks").alias("pos", "b"))
    placed = placed.select("_rid", "n", "pos", F.col("b.print").alias("print"), F.col("b.block").alias("block"))
    if collided:
        alike = F.col("p.print") == F.col("q.print")
        same = F.col("q.block").isNull() | (F.col("p.block") == F.col("q.block"))
        level = placed.alias("p").join(names.alias("q"), alike & same).select("_rid", "n", "pos", "name")
    else:
        level = placed.drop("block").join(names.drop("block"), "print").select("_rid", "n", "pos", "name")
    level = keep(level, "level0")
    deepest = level.agg(F.max("n")).first()[0] or 1

    done, depth = [], 0
    while True:
        done.append(level.where("n = 1").select("_rid", F.lit(depth).alias("level"), "name"))
        if deepest <= 1:
            break
        deepest, depth = (deepest + 1) // 2, depth + 1
        level = keep(_paired(level.where("n > 1")), f"level{depth}")
    final = done[0]
    for part in done[1:]:
        final = final.unionByName(part)
    return rows.drop("blocks").join(final, "_rid")


def _paired(level: DataFrame) -> DataFrame:
    """The next level: names of adjacent pairs; the last of an odd number is paired with nothing (-1)."""
    place = F.col("pos") % 2
    pairs = level.groupBy("_rid", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
        F.max("n").alias("n"),
        F.max(F.when(place == 0, F.col("name"))).alias("a"),
        F.coalesce(F.max(F.when(place == 1, F.col("name"))), F.lit(-1)).alias("b"),
    )
    names = _numbered(pairs.select("a", "b").distinct(), F.xxhash64("a", "b"), "a", "b")
    return pairs.join(names, ["a", "b"]).select(
        "_rid", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", "name"
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when equal without white space.  Of equal texts the one with the most code points
    stays, then the smallest id.  Null text: empty.  A null id loses every tie against another; rows that
    repeat id and text are members of their own, and all carry the id that stays: exactly one of them is kept.  An empty table gives no row.
    """
    return _grouped(docs, id_col, text).drop("n_points", "print")


def _grouped(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """``exact_groups`` with ``n_points`` and a ``print`` of the text as it is, which tell a row from others of its id and group."""
    named = document_names(
        docs.select(col(id_col).cast("long").alias("doc_id"), F.xxhash64(col(text)).alias("print"), col(text).alias("text"))
    )
    # longest first, then the smallest id, then the print and the row number among repeated ids
    order = F.struct(
        F.col("n_points").alias("l"), F.bitwise_not("doc_id").alias("i"), F.col("print").alias("p"), (-F.col("_rid")).alias("r")
    )
    groups = named.groupBy("level", "name").agg(F.count("*").alias("group_size"), F.max(order).alias("best"))
    joined = named.join(groups, ["level", "name"])
    return joined.select(
        "doc_id",
        F.bitwise_not("best.i").alias("keep_id"),
        "group_size",
        (F.col("_rid") == -F.col("best.r")).alias("kept"),
        "text_sha256",
        "n_points",
        "print",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` drops; columns as they were.

    Rows that repeat both id and text are copies too: one of them stays (combined before any shuffle)."""
    key = fresh(docs, "row")
    kept = _grouped(docs, id_col, text).where("kept")
    row = F.struct(F.col("text_sha256").alias("a"), F.col("n_points").alias("b"), F.col("print").alias("c"))
    kept = kept.select(F.col("doc_id").alias(f"{key}_id"), row.alias(f"{key}_kept"))
    digest = F.sha2(squeeze(col(text)).cast("binary"), 256)
    n_points = F.coalesce(F.length(col(text)), F.lit(0)).cast("long")
    marked = docs.withColumn(key, F.struct(digest.alias("a"), n_points.alias("b"), F.xxhash64(col(text)).alias("c")))
    same = col(id_col).cast("long").eqNullSafe(F.col(f"{key}_id")) & (F.col(key) == F.col(f"{key}_kept"))
    return marked.join(kept, same, "left_semi").dropDuplicates([id_col, key]).drop(key)
