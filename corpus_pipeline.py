"""Documents to packed training sequences: quality rules, line and near-duplicate removal, mixing, packing.

Every stage works on all that the one before it kept and, but for the last, returns the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditspark.llm import line_dedup, mixing, packing, quality, simhash
from creditspark.session import fresh_dir

REPEAT_LIMIT = 2.0


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def line_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later documents lose the blocks that earlier ones hold; n_chars follows the text."""
    columns = docs.columns
    return line_dedup.remove_repeats(docs).selectExpr(
        *["cast(length(text) as bigint) as n_chars" if c == "n_chars" else f"`{c}`" for c in columns]
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word similarity of 0.8 or more) stays."""
    return simhash.keep_similar(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to ``REPEAT_LIMIT`` times as often."""
    return mixing.mix(docs, whole=True, repeat_limit=REPEAT_LIMIT, carry=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document of the mix goes."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_repeats),
    ("simhash_near_dedup", near_duplicates),
    ("source_mixing", source_mix),
    ("best_fit_packing", packed),
]
ORACLE_SQL = None  # alignment, components and token ids are past SQL; tests/llm/test_pipeline.py has them by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; what stages hand on is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            folder = fresh_dir(spark, f"pipeline-{name}")
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
