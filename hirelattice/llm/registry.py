"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelattice.llm import (
    alignment, chat, language, licenses, line_dedup, mixing, near_vectors, ngram_join, oracles, packing, quality, substring, topk,
    whitening,
)
from hirelattice.llm.common import let_workers_import

Query = Callable[[SparkSession, str], DataFrame]
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def _on(table: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        let_workers_import(spark)
        return operator(spark.read.parquet(f"{folder}/{table}.parquet"))

    return query


def queries() -> dict[str, Query]:
    return {
        "op1_topk_search": _on("embeddings", lambda df: topk.search(df, F.col("vec_id") % 50 == 0)),
        "op2_chat_formatting": _on("conversations", chat.render),
        "op3_quality_classifier": _on("documents", quality.classify),
        "op4_best_fit_packing": _on("documents", lambda df: packing.pack(df, WORDS)),
        "op5_ngram_jaccard_join": _on("documents", ngram_join.join_components),
        "op6_embedding_near_dedup": _on("embeddings", near_vectors.link_vectors),
        "op7_mixing": _on("documents", mixing.report),
        "op8_line_dedup": _on("documents", line_dedup.report),
        "op8_line_dedup_any_length": _on("documents", lambda df: line_dedup.report(df, min_exact=1)),
        "op9_license_scan": _on("documents", licenses.scan),
        "op10_language_id": _on("documents", lambda df: language.identify(df, PIECES)),
        "op11_substring_dedup": _on("documents", lambda df: substring.remove_repeats(df).drop("repeats")),
        "op12_cross_tokenizer_alignment": _on("documents", lambda df: alignment.align(df, BYTES, PIECES)),
        "op13_embedding_whitening": _on("embeddings", whitening.whiten),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_topk_search": topk.ORACLE,
        "op2_chat_formatting": chat.ORACLE,
        "op5_ngram_jaccard_join": oracles.JACCARD_JOIN,
        "op6_embedding_near_dedup": oracles.NEAR_VECTORS,
        "op7_mixing": mixing.ORACLE,
        "op8_line_dedup": line_dedup.ORACLE,
        "op8_line_dedup_any_length": line_dedup.ORACLE,
        "op11_substring_dedup": oracles.SUBSTRINGS,
    }
