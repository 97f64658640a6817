"""Registered queries of the training-data operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.conversations import audited, damaged
from tradewind.llm.decontamination import contaminated
from tradewind.llm.expected import EXPECTED  # noqa: F401
from tradewind.llm.fill_in_middle import infilled, restored
from tradewind.llm.fingerprints import fingerprinted
from tradewind.llm.fm_index import without_earlier_passages
from tradewind.llm.languages import predicted
from tradewind.llm.licenses import scanned
from tradewind.llm.near_duplicates import near_duplicate_groups
from tradewind.llm.packing import packed
from tradewind.llm.pseudonyms import pseudonyms
from tradewind.llm.quality import scored
from tradewind.llm.suffix_repeats import without_repeats
from tradewind.llm.urls import judged
from tradewind.session import workers_find_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def with_workers(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_find_package(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = with_workers
    return run


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted(table(spark, sf_dir, "documents"))


@query
def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted(table(spark, sf_dir, "documents"))


@query
def op4_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", pseudonyms(F.col("text"), "corpus").alias("p")).select("doc_id", "p.*")


@query
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_earlier_passages(table(spark, sf_dir, "documents"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents")).drop("ids")


@query
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents"), percent=85)


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents"))


@query
def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return audited(damaged(conversations), conversations)


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = infilled(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
