"""The operators applied to their whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers

from gaugewright.llm.byte_bpe import encode_documents, read_ranks
from gaugewright.llm.exact_dedup import exact_groups
from gaugewright.llm.html_text import main_text
from gaugewright.llm.language import languages
from gaugewright.llm.mixing import mix_report
from gaugewright.llm.passage_quality import passage_quality
from gaugewright.llm.quality import quality_report
from gaugewright.llm.ranked_search import ranked
from gaugewright.llm.simhash import near_groups
from gaugewright.llm.spelling import spelling_variants
from gaugewright.llm.suffix_dedup import without_repeats
from gaugewright.llm.toxicity import toxicity
from gaugewright.llm.warc import archive_and_read_back

VOCABULARY = "byte_bpe_50k.tiktoken"


def table(spark, sf_dir, name, *columns):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_suffix_dedup(spark, sf_dir):
    return without_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), digests=True)


def op2_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents", "doc_id", "text")).drop("row_key")


def op3_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    ranks = read_ranks(public_tokenizers.path(VOCABULARY))
    return encode_documents(docs, ranks, public_tokenizers.PATTERN, digests=True)


def op4_html_text(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op5_quality_rules(spark, sf_dir):
    return quality_report(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_language(spark, sf_dir):
    return languages(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op7_simhash_near_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_groups(docs).select("doc_id", "fingerprint", "component_id")


def op8_toxicity(spark, sf_dir):
    return toxicity(
        table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op9_warc_index(spark, sf_dir):
    captures = archive_and_read_back(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_mixing(spark, sf_dir):
    return mix_report(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op11_quality_model(spark, sf_dir):
    return passage_quality(
        table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op12_ranked_search(spark, sf_dir):
    return ranked(
        table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op13_spelling_variants(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_html_text": op4_html_text,
    "op5_quality_rules": op5_quality_rules,
    "op6_language": op6_language,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_warc_index": op9_warc_index,
    "op10_mixing": op10_mixing,
    "op11_quality_model": op11_quality_model,
    "op12_ranked_search": op12_ranked_search,
    "op13_spelling_variants": op13_spelling_variants,
}
