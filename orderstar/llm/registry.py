"""Registered queries of the text operators (``opN_<name>``) and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderstar.llm import (
    code_compression,
    contextual_pii,
    conversation_trie,
    jaccard_join,
    piece_transducer,
    pseudo_likelihood,
    quality_rules,
    sentence_spans,
    string_tiling,
    suffix_intervals,
    token_files,
    toxicity,
    vector_packing,
)
from orderstar.llm.sparkops import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": lambda spark, sf_dir: quality_rules.digest(documents(spark, sf_dir)),
    "op2_toxicity": lambda spark, sf_dir: toxicity.digest(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")),
    "op3_contextual_pii": lambda spark, sf_dir: contextual_pii.digest(documents(spark, sf_dir)),
    "op4_token_files": lambda spark, sf_dir: token_files.digest(documents(spark, sf_dir)),
    "op5_jaccard_join": lambda spark, sf_dir: jaccard_join.similar_classes(documents(spark, sf_dir)),
    "op6_pseudo_likelihood": lambda spark, sf_dir: pseudo_likelihood.digest(documents(spark, sf_dir)),
    "op7_piece_transducer": lambda spark, sf_dir: piece_transducer.digest(documents(spark, sf_dir)),
    "op8_string_tiling": lambda spark, sf_dir: string_tiling.digest(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")),
    "op9_sentence_spans": lambda spark, sf_dir: sentence_spans.digest(documents(spark, sf_dir)),
    "op10_suffix_intervals": lambda spark, sf_dir: suffix_intervals.digest(documents(spark, sf_dir)),
    "op11_conversation_trie": lambda spark, sf_dir: conversation_trie.digest(table(spark, sf_dir, "conversations")),
    "op12_code_compression": lambda spark, sf_dir: code_compression.digest(table(spark, sf_dir, "embeddings")),
    "op13_vector_packing": lambda spark, sf_dir: vector_packing.digest(documents(spark, sf_dir)),
}

ORACLE: dict[str, str] = {
    "op1_quality_rules": quality_rules.SQL,
    "op11_conversation_trie": conversation_trie.SQL,
    "op12_code_compression": code_compression.SQL,
}
