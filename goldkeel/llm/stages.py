"""The stages of the corpus pipeline: one operator each, its decision applied.

Each takes (spark, docs, folder) and returns the columns of ``docs``, but for
the last, which returns tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldkeel.llm import byte_bpe, decontaminate, pii, simhash, toxicity
from goldkeel.llm.common import columns, fresh, table
from goldkeel.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep documents that score below the threshold. Null and empty texts
    score like texts without a listed word and stay; repeated rows each have
    their score. Very long texts are scored whole. Extra columns of any name
    stay; an empty table stays empty."""
    model = toxicity.learn(toxicity.training_rows(docs, table(spark, folder, "labels")))
    score = fresh("toxicity", docs)
    scored = docs.withColumn(score, toxicity.toxicity(F.col("text"), model))
    return scored.where(F.col(score) < toxicity.THRESHOLD).select(*columns(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep documents that hold no benchmark passage. Null and empty texts hold
    none; repeated rows stay or go together. Very long texts are searched
    whole. Extra columns of any name stay; an empty table stays empty."""
    matches = fresh("matches", docs)
    found = decontaminate.with_matches(docs, table(spark, folder, "benchmark"), matches)
    return found.where(F.size(matches) == 0).select(*columns(docs))


def mask_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep all documents, personal data in their texts replaced by marks.
    ``n_chars`` is that of the new text. Null and empty texts, repeated rows
    and extra columns of any name stay as they are; very long texts are
    searched whole. An empty table stays empty."""
    clean = pii.masked(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return clean.select(*columns(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep one document of each near-duplicate group, that with the smallest
    id; of near copies that share this id, the one with the smallest text and
    columns. Documents that share an id but are not near copies all stay, as do
    rows without an id, which are in no group. Null and empty texts are near
    copies of each other. Very long texts are compared whole. Extra columns of
    any name stay; an empty table stays empty."""
    found = stage(simhash.grouped(docs.select("doc_id", "text")), "near")
    first = F.col("doc_id") == F.col("component_id")
    ids = found.where("doc_id is not null").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("times"), F.count(F.when(first, 1)).alias("firsts")
    )
    ids = stage(ids.where("firsts > 0"), "firsts")
    # An id that only one row has tells that row.
    kept = docs.join(ids.where("times = 1").select("doc_id"), "doc_id", "left_semi").select(*columns(docs))
    repeated = ids.where("times > 1").select("doc_id")
    if not repeated.isEmpty():
        fp, group = fresh("fp", docs), fresh("group", docs)
        groups = found.where(first).join(repeated, "doc_id", "left_semi")
        groups = groups.select("doc_id", F.col("fp").alias(fp), F.col("group").alias(group)).distinct()
        marked = simhash.fingerprints(docs.join(repeated, "doc_id", "left_semi"), "text", to=fp)
        rows = F.struct(*columns(docs)).alias("row")
        near = marked.join(groups, ["doc_id", fp]).select(group, rows)
        kept = kept.unionByName(near.groupBy("row.doc_id", group).agg(F.min("row").alias("row")).select("row.*"))
    return kept.unionByName(docs.where("doc_id is null"))


def encode_tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): the last is whether decoding the
    tokens gives the text back, which it always must. Null texts count as
    empty, which have no tokens; very long ones are encoded whole. Repeated rows
    and null ids stay, other columns are not read. An empty table gives none."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = docs.select("doc_id", "text")
    encoded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded="decoded")
    text = F.coalesce("text", F.lit("")).cast("binary")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == text).alias("round_trip"),
    )
