"""The corpus pipeline: five stages over ``documents``, each on what the one
before it kept. All but the last return the columns of documents; the last
writes the token shards and returns what they hold per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from signalbox.llm import decontamination, mixing, near_dups, quality_cnn, wavelet
from signalbox.llm.common import store
from signalbox.llm.ship import ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that the quality classifier rejects go."""
    ship(spark)
    return quality_cnn.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of near-duplicates one document stays."""
    ship(spark)
    return near_dups.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that contain a benchmark item go."""
    ship(spark)
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: per document and pass, the words that the mix takes."""
    ship(spark)
    return mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: token shards as wavelet matrices, read back per document."""
    ship(spark)
    return wavelet.token_report(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mix", mix), ("tokens", tokens)]

#: SQL cannot express the classifier or the tokenizer; the tests hold every
#: stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
