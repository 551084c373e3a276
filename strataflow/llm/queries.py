"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import bpe, chat, conversation_repair, decontaminate, exact_dedup, hard_negatives, html_text
from strataflow.llm import jaccard_join, language, maxent_lm, near_dedup, pii, url_rules
from strataflow.llm.common import table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"  # a text that holds the template's own marks
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(hard).alias("text"),
    )
    return chat.read_back(chat.format_chats(chats.unionByName(extra)))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))

    def listed(spans) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    counts = [number(kind).alias(f"n_{kind}") for kind in pii.BASE]
    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    part = F.col(decontaminate.found_column(docs))
    return found.select(
        "doc_id",
        part["n_words"].alias("n_words"),
        part["n_hit"].alias("n_hit"),
        F.size(part["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(part["items"], ","), 256).alias("items_sha256"),
        part["contaminated"].alias("contaminated"),
    )


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_rules.judge_urls(pages, url_rules.rule_table(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, then pages (``kind``): each by its own evidence, the text model fitted on labelled documents.

    ``doc_id`` is null on pages, ``page_id`` on documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    model = language.fit(docs)
    pages = table(spark, sf_dir, "pages").select(
        "page_id", language.markup_language(F.col("html")).alias("lang"), language.host_of(F.col("url")).alias("host"), "html"
    )
    pages = html_text.extract(pages).withColumn("suffix", language.suffix_of(F.col("host")))
    none = F.lit(None).cast("long")
    return _judged(
        language.identify(docs, model, declared="lang", host="source", keep_text=False), "document", F.col("doc_id"), none
    ).unionByName(
        _judged(language.identify(pages, model, declared="lang", host="host", suffix="suffix", keep_text=False), "page", none, F.col("page_id"))
    )


def _judged(rows: DataFrame, kind: str, doc_id: Column, page_id: Column) -> DataFrame:
    part = F.col("language")
    return rows.select(
        doc_id.cast("long").alias("doc_id"), part["best"].alias("language"), part["posterior"].alias("posterior"),
        part["letters"].alias("letters"), part["accepted"].alias("accepted"),
        F.lit(kind).alias("kind"), page_id.cast("long").alias("page_id"),
    )


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score_documents(table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_dedup.near_groups(table(spark, sf_dir, "documents"), shingle=4)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = jaccard_join.similarity_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "n_shingles", "component_id")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 100; a seventh of the labels is moved to the next class."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = hard_negatives.prepare(table(spark, sf_dir, "embeddings"), label=moved)
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.chat_rows(table(spark, sf_dir, "conversations"))
    return conversation_repair.repaired_digests(conversation_repair.damaged(rows))


QUERIES = (
    op1_chat_format, op2_exact_dedup, op3_bpe, op4_personal_data, op5_decontamination, op6_url_rules, op7_language_id, op8_lm_scores, op9_near_dedup,
    op10_html_text, op11_jaccard_join, op12_hard_negatives, op13_conversation_repair,
)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES} | {"pipeline": corpus_pipeline.run}


SQL = {
    "op12_hard_negatives": """
        WITH given AS (
            SELECT row_number() OVER () AS r, vec_id,
                   CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label, embedding
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        v AS (SELECT r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM given),
        s AS (
            SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id, a.label = b.label AS same,
                   list_dot_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r),
        p AS (
            SELECT ar, anchor_id, br, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id, positive_score,
               score AS negative_score
        FROM p JOIN s ON p.ar = s.ar AND NOT same
         AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        WINDOW w AS (PARTITION BY p.ar, p.br ORDER BY score DESC, s.vec_id)
        QUALIFY row_number() OVER w <= 10
    """,
    "op2_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS squeezed
            FROM documents),
        g AS (
            SELECT *, first_value(doc_id) OVER w AS keep_id,
                   count(*) OVER (PARTITION BY squeezed) AS group_size, row_number() OVER w AS place
            FROM d WINDOW w AS (PARTITION BY squeezed ORDER BY n DESC, doc_id))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(squeezed) AS text_sha256 FROM g
    """,
    "op5_decontamination": r"""
        WITH b AS (
            SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        k AS (
            SELECT DISTINCT item, least(len(w), 13) AS n, list_slice(w, i + 1, i + 13) AS v
            FROM b, unnest(range(0, greatest(len(w) - 13, 0) + 1)) AS t(i) WHERE len(w) > 0),
        d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        lengths AS (SELECT DISTINCT n FROM k),
        p AS (
            SELECT r, i, n, list_slice(w, i + 1, i + n) AS v
            FROM d, lengths, unnest(range(0, len(w) - n + 1)) AS t(i) WHERE len(w) >= n),
        h AS (SELECT r, i, p.n, item FROM p JOIN k ON k.n = p.n AND k.v = p.v),
        c AS (
            SELECT r, count(DISTINCT j) AS n_hit
            FROM (SELECT DISTINCT r, i, n FROM h), unnest(range(i, i + n)) AS t(j) GROUP BY r),
        f AS (
            SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
            FROM h GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN c USING (r) LEFT JOIN f USING (r)
    """,
    "op6_url_rules": r"""
        WITH u AS (
            SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS p FROM pages),
        s AS (SELECT page_id, CASE WHEN p > 0 THEN substr(url, p + 3) ELSE '' END AS rest FROM u),
        h AS (
            SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM s),
        x AS (
            SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
            FROM h),
        r(rh, rp, rv) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
                   ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        m AS (
            SELECT page_id, rh || rp AS rule, rv,
                   row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) AS place
            FROM x JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
        SELECT x.page_id, host, path, rule, coalesce(rv, 'allow') AS verdict
        FROM x LEFT JOIN m ON m.page_id = x.page_id AND place = 1
    """,
}


def oracles() -> dict[str, str]:
    return dict(SQL)
