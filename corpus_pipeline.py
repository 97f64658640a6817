"""A training corpus from raw documents: language, near copies, benchmark leaks, personal data, packing."""

from __future__ import annotations

import os
import secrets
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.arrays import written
from tradewind.llm.decontamination import decontaminated
from tradewind.llm.languages import identified
from tradewind.llm.near_duplicates import near_duplicate_groups
from tradewind.llm.packing import packed
from tradewind.llm.pseudonyms import pseudonymised
from tradewind.session import run_folder, shared_folder, workers_find_package

#: Key of the pseudonyms: set one in the environment to link documents of several runs. Without one, every process draws its own, so that
#: nobody can undo the pseudonyms.
KEY = os.environ.get("CORPUS_PSEUDONYM_KEY") or secrets.token_hex(16)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language."""
    return identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, similarity 0.8): the one with the least doc_id.

    Rows are told apart by a written row number, so that of rows that repeat a doc_id, or have none, only one of a group stays as
    well; a row without an id only where no other is in its group. Texts without words are copies of nothing.
    """
    row = "_row_"
    while row in docs.columns:
        row += "_"
    docs = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = near_duplicate_groups(docs.select(F.col(row).alias("doc_id"), "text"), percent=80)
    ids = docs.select(F.col(row).alias("_number_"), F.col("doc_id").cast("long").alias("_id_"))
    joined = groups.join(ids, groups["doc_id"] == ids["_number_"])
    first = F.min(F.struct(F.col("_id_").isNull(), "_id_", "_number_")).getField("_number_")
    kept = joined.groupBy("component_id").agg(first.alias(row)).select(row)
    return docs.join(kept, row, "left_semi").drop(row)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonymisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with keyed pseudonyms in place of personal data."""
    return pseudonymised(docs, KEY)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids, in sequences of 2048 tokens, neighbours together."""
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pseudonymisation", pseudonymisation),
    ("packing", packing),
]

#: A trained network and a tokenizer are beyond SQL; the tests hold the run against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; each result is written and read again as the next one's input.

    Only the last result outlives the run.
    """
    workers_find_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    with run_folder(spark) as folder:
        for name, stage in STAGES:
            path = f"{out if name == STAGES[-1][0] else folder}/{name}"
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
