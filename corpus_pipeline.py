"""A training corpus from raw documents: five operators, one after the other.

Toxic documents go, recurring lines go, one document of each group of near copies stays, sources
are mixed to their target weights, and what is left becomes tokens. Each stage is written as
Parquet, and the next one reads that table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sendgate.llm import bpe, jaccard_join, line_dedup, mixing, toxicity
from sendgate.llm.common import small_batches
from sendgate.llm.queries import (
    held_out,
    public_vocabulary,
    source_mix,
    source_tree,
    text_tokens,
)
from sendgate.session import keep

# The mix takes this share of the tokens that reach it; no document is taken twice.
MIX_SHARE = 0.8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score below 0.5; held-out labels are not learned from."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    return toxicity.score_texts(docs, model).where("predicted = 0").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts less recurring lines; n_chars follows the text."""
    shorter = line_dedup.drop_recurring_lines(docs, tree=line_dedup.WHOLE)
    cut = F.size("dropped") > 0
    n_chars = F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return shorter.withColumn("n_chars", n_chars).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the first in the table."""
    small_batches(spark)
    return jaccard_join.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A share of the tokens, domains, languages and sources at their target weights."""
    mix = source_mix(MIX_SHARE, epochs=1)
    return mixing.mix_sources(docs, source_tree(), text_tokens(), mix).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of what they decode to."""
    small_batches(spark)
    texts = docs.select("doc_id", "lang", "source", "text")
    return bpe.encode_and_decode(texts, public_vocabulary(), keep_ids=True, sizes=bpe.FRUGAL)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", tokenize),
]

# SQL cannot express the trained classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), "stage")
    return docs
