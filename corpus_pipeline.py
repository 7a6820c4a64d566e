"""A training corpus from raw documents, as stages of one operator each."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from gaugewright.llm.byte_bpe import encode_documents, read_ranks
from gaugewright.llm.common import stage
from gaugewright.llm.exact_dedup import exact_dedup
from gaugewright.llm.mixing import mix_documents
from gaugewright.llm.quality import good_documents
from gaugewright.llm.simhash import near_dedup

VOCABULARY = "byte_bpe_50k.tiktoken"


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the quality rules, without the lines that fail them; n_chars is that of what stays.

    A NULL text fails. Repeated rows are judged alike, each by itself, and so is a text of any length.
    """
    return good_documents(docs).withColumn("n_chars", F.length("text").cast("long"))


def exact(spark, docs, sf_dir):
    """One document of each group of equal texts: the one with the smallest id, NULL last.

    A NULL text counts as empty. A repeated row stays once.
    """
    return exact_dedup(docs)


def near(spark, docs, sf_dir):
    """One document of each component of near copies: the one with the smallest id, NULL last.

    A NULL text counts as empty. A repeated row stays once.
    """
    return near_dedup(docs)


def mixing(spark, docs, sf_dir):
    """Documents repeated or left out so that the sources come near their target weights.

    NULL is a source of its own, the last. Texts without a word are left out. Rows with equal ids, sizes and sources are
    interchangeable.
    """
    return mix_documents(docs)


def tokens(spark, docs, sf_dir):
    """doc_id, n_tokens and ids of every document that the mix takes, once per copy. A NULL text has no tokens."""
    return encode_documents(docs, read_ranks(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("mixing", mixing),
    ("byte_bpe", tokens),
]

# The similarity links, the rounded rates and the merges are beyond SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
