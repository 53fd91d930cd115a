"""Documents to training tokens in five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pedalytics.llm import decontamination, minhash_dedup, quality, sentencepiece, suffix_dedup
from pedalytics.session import stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return quality.Resampler(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).keep(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8), whatever its id."""
    return minhash_dedup.one_of_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what stands earlier in the corpus; documents of which nothing is left go."""
    return suffix_dedup.without_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontamination.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of what is left."""
    return sentencepiece.encoded(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", minhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding", sentencepiece_encoding),
]

# Resampling, connected components and piece paths are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, function) in enumerate(STAGES, 1):
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{n}")
    return docs
