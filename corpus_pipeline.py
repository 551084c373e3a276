"""A training-data pipeline over ``documents``: five stages, each an operator of ``strataflow.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``, whole rows with whole texts.  ``run`` writes each stage's result to the shared folder and
reads it back as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strataflow.llm import bpe, decontaminate, exact_dedup, language, near_dedup
from strataflow.llm.common import keep, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; the declared language and the source are evidence beside the text."""
    return language.keep_identified(docs, model=language.fit(docs), declared="lang", host="source")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal without white space, the longest (then the smallest id)."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the smallest id."""
    return near_dedup.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words are not, for a twentieth or more, passages of the benchmark."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, and digests of token ids and decoded text."""
    return bpe.encoding_digests(docs, TOKENIZER)


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: Language models, minhash and BPE are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
