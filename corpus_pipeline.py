"""A corpus from documents to packed sequences, stage by stage.

Each stage takes the documents that the stage before it kept and returns documents with the same columns; the last one returns the
packed pieces. ``run`` writes every stage to the shared folder and reads it back, so a lost executor repeats no earlier stage.

The stages cannot all be said in SQL (trained piece probabilities, tokenizer ids), so ``ORACLE_SQL`` is None and the tests hold
each stage against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelattice.llm import language, line_dedup, mixing, ngram_join, packing
from hirelattice.llm.common import let_workers_import
from hirelattice.session import materialise

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SHINGLE_WORDS, SIMILARITY = 5, 80  # near-duplicate documents: five words, a Jaccard similarity of 0.8


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or without a language that reaches half of the probability go."""
    let_workers_import(spark)
    return language.keep_identified(docs, PIECES)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and nearly repeated lines go; documents of which nothing is left go with them."""
    cleaned = line_dedup.cleaned(docs)
    left = F.trim(F.translate("text", "\n\t\r", "   ")) != ""
    kept = cleaned.where((F.col("n_removed") == 0) | left)
    before = F.col("row")["n_chars"]
    chars = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(before).cast(docs.schema["n_chars"].dataType)
    changed = {"text": F.col("text"), "n_chars": chars}
    return kept.select(*(changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate documents the one with the smallest id stays."""
    let_workers_import(spark)
    return ngram_join.keep_one(docs, SHINGLE_WORDS, SIMILARITY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences that follow the order of the mix."""
    let_workers_import(spark)
    return packing.pack(docs, WORDS, in_order=True)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
