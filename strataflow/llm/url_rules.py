"""URL allow and block rules: expand each URL into host-suffix and path-prefix expressions, equi-join
them with the rules on a short digest prefix, confirm full digests, apply the precedence.

Both sides of the join hold expressions, never pairs of URL and rule.  The expressions of a URL are
bounded by the rules' shapes (label counts of their hosts times lengths of their paths), not by the
length of the URL.  A verdict depends on the URL alone, so each distinct URL is judged once and the
verdicts are joined back; the unique side of that join lets adaptive execution split a hot URL.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import col, fresh

#: Hexadecimal digits of the digest that are joined on; the rest is compared afterwards.
PREFIX = 8

# Production rules (fixed values): host, path, verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
DEFAULT = "allow"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    text = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    """Rules as a table: host, path, verdict.  Larger lists are read from any source with these columns."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT, prefix: int = PREFIX
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``; columns that already have these names give way.

    A rule fits its host and all subdomains if the path starts with the rule's.  The longest rule
    (host and path together) wins; of equally long ones block comes before allow, then the smaller
    text.  Without a rule: null and ``default``.  Null rules' hosts or paths count as empty; a null
    or malformed URL has empty host and path, which a rule with both empty fits.
    """
    shaped = rules.select(
        lower_ascii(F.coalesce("host", F.lit(""))).alias("r_host"),
        F.coalesce("path", F.lit("")).alias("r_path"),
        F.coalesce("verdict", F.lit(default)).alias("r_verdict"),
    ).withColumn("labels", F.size(F.split("r_host", r"\.", -1)))
    # lengths of URL parts: at most a few thousand different values however many rules there are
    shapes = shaped.agg(F.collect_set("labels").alias("l"), F.collect_set(F.length("r_path")).alias("p")).first()
    labels, lengths = sorted(shapes["l"]), sorted(shapes["p"])

    digest = F.sha2(F.concat_ws("\n", "r_host", "r_path").cast("binary"), 256)
    indexed = shaped.select(
        F.concat("r_host", "r_path").alias("rule"), "r_verdict", digest.alias("r_digest"),
        F.substring(digest, 1, prefix).alias("r_key"),
    )

    host, path = split_url(F.col("_url"))
    urls = pages.select(F.coalesce(col(url), F.lit("")).alias("_url")).distinct()
    urls = urls.select("_url", host.alias("host"), path.alias("path"))
    count = F.size(F.split("host", r"\.", -1))
    ends = [F.when(count >= n, F.substring_index("host", ".", -n)) for n in labels]
    starts = [F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]
    expressions = urls.select(
        "_url", F.explode(F.array_compact(F.array(*ends))).alias("suffix"), "path"
    ).select("_url", "suffix", F.explode(F.array_compact(F.array(*starts))).alias("start")) if labels else None
    if expressions is None:
        return _with_verdict(pages, urls, None, url, default)
    full = F.sha2(F.concat_ws("\n", "suffix", "start").cast("binary"), 256)
    keyed = expressions.select("_url", full.alias("digest"), F.substring(full, 1, prefix).alias("key"))
    hits = keyed.join(indexed, F.col("key") == F.col("r_key")).where(F.col("digest") == F.col("r_digest"))
    rank = F.struct(
        F.length("rule").alias("n"), (F.col("r_verdict") == "block").alias("b"), "r_verdict", "rule"
    )
    best = hits.groupBy("_url").agg(F.max(rank).alias("best"))
    return _with_verdict(pages, urls, best, url, default)


def _with_verdict(pages: DataFrame, urls: DataFrame, best: DataFrame | None, url: str, default: str) -> DataFrame:
    if best is None:
        judged = urls.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    else:
        judged = urls.join(best, "_url", "left").select(
            "_url", "host", "path", F.col("best.rule").alias("rule"),
            F.coalesce("best.r_verdict", F.lit(default)).alias("verdict"),
        )
    key = fresh(pages, "judged_url")
    own = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    keyed = pages.select(*[col(c) for c in own], F.coalesce(col(url), F.lit("")).alias(key))
    return keyed.join(judged.withColumnRenamed("_url", key), key, "left").drop(key)
