"""The training-data pipeline over ``documents``: rules, lines, near duplicates, benchmarks, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's documents. All but the last keep the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import decontaminate, line_dedup, near_dup, packing, quality_rules
from tidegauge.llm.common import documents, ship, staged
from tidegauge.queries.base import Registry

register = Registry()


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the limits of their language and source let through."""
    return quality_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that occurred before, exactly or within a few edits."""
    shortened = line_dedup.without_repeats(docs)
    return shortened.withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Copies lose most of their lines in the stage before, so documents that are left are linked by the
    texts they came with first, and then by what is left of them.
    """
    whole = documents(spark, sf_dir).select("doc_id", "text")
    apart = staged(near_dup.deduplicated(docs, whole), "apart")
    return near_dup.deduplicated(apart)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    ship(spark)
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.clean_documents(docs, benchmark)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of fixed size, each source at its share of the tokens."""
    ship(spark)
    # Workers outlive the stage; small caches leave the memory to the stages of the next run.
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), cached_words=30_000)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontaminate", benchmarks),
    ("packing", windows),
]

# Edit distances, linked groups and token ids have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


@register("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed pieces."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
