"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldkeel.llm import (
    bit_slices,
    byte_bpe,
    collocations,
    decontaminate,
    embeddings,
    html_text,
    language_id,
    pii,
    simhash,
    spelling,
    token_counts,
    toxicity,
    url_rules,
)
from goldkeel.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


# The rules of the url query: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "documents"))


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, folder, "documents"), vocabulary, public_tokenizers.PATTERN)


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, folder, "pages"), rules)


def op7_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    hexadecimal = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexadecimal.alias("fingerprint"), "component_id")


def op8_embedding_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded="decoded")
    return byte_bpe.digests(encoded, ranks, decoded="decoded")


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op12_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return bit_slices.top_k(table(spark, folder, "embeddings"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_html_extraction,
        op3_toxicity,
        op4_token_counts,
        op5_decontamination,
        op6_url_filters,
        op7_simhash_near_duplicates,
        op8_embedding_near_duplicates,
        op9_byte_bpe,
        op10_pii,
        op11_phrase_collocations,
        op12_exact_top_k,
        op13_spelling_variants,
    )
}
