"""Corpus preparation: five stages over the ``documents`` table of a folder.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as parquet and read again as
the next one's ``docs``. All but the last return the columns of their input.

1. ``toxicity``: documents whose segment score reaches the threshold go.
2. ``jaccard_join``: of every group of near copies (five-word shingles, similarity 0.8) the smallest doc_id stays (of two
   texts under that id, one). Other texts of an id that goes are judged by their own group.
3. ``decontamination``: documents that contain a benchmark item go.
4. ``pii``: spans of personal data are replaced by their kind; ``n_chars``, where there is one, follows the new text.
5. ``pieces``: the ids of the texts (and the checks of their round trip).

Cases: texts that are null or empty pass the first three stages; a document without an id is never dropped as a copy;
repeated rows (equal id and text) are one document and stay or go together; an empty table gives empty results; further columns are kept by all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstar.llm import contextual_pii, jaccard_join, piece_transducer, string_tiling, toxicity
from orderstar.llm.sparkops import documents, reachable, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reachable(spark)
    return toxicity.keep_clean(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reachable(spark)
    gone = stage(jaccard_join.copies(docs).select(F.col("doc_id").alias("gone"), F.col("h").alias("gone_h")), "copies")
    same = (docs["doc_id"].cast("long") == gone["gone"]) & (F.xxhash64(docs["text"].cast("string")) == gone["gone_h"])
    return docs.join(gone, same, "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reachable(spark)
    return string_tiling.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reachable(spark)
    out = contextual_pii.mask(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reachable(spark)
    return piece_transducer.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("decontamination", decontaminate),
    ("pii", mask_personal_data),
    ("pieces", encode_pieces),
]

#: The stages need trained scores, tilings and merges, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one written table after the other."""
    docs = documents(spark, sf_dir)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
