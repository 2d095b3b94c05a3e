"""Registered queries of the thirteen operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (ball_codes, bucket_repeats, decontamination, fingerprints, html_consensus, merkle, mixing,
               near_dups, pii_boost, quality_cnn, secrets, sharding, wavelet)
from .ship import ship

Query = Callable[[SparkSession, str], DataFrame]

#: Shards of the sharding query.
SHARDS = 8


def _on(fn: Callable[..., DataFrame], *tables: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(*[spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables])
    return query


def queries() -> dict[str, Query]:
    return {
        "op1_document_fingerprints": _on(fingerprints.edit_report, "documents"),
        "op2_token_output": _on(wavelet.token_report, "documents"),
        "op3_quality_classifier": _on(quality_cnn.quality_report, "documents", "labels"),
        "op4_secret_scan": _on(secrets.scan, "documents"),
        "op5_near_dedup": _on(near_dups.duplicate_report, "documents"),
        "op6_source_mixing": _on(mixing.mix_report, "documents"),
        "op7_sharding": _on(lambda d: sharding.shard_slots(d, sharding.tree(SHARDS)), "documents"),
        "op8_html_extraction": _on(html_consensus.main_texts, "pages"),
        "op9_decontamination": _on(decontamination.contamination_report, "documents", "benchmark"),
        "op10_personal_data": _on(pii_boost.pii_report, "documents"),
        "op11_vector_codes": _on(ball_codes.code_report, "embeddings"),
        "op12_merkle_manifest": _on(merkle.manifest_report, "documents"),
        "op13_suffix_dedup": _on(bucket_repeats.repeat_report, "documents"),
    }


def oracle_sql() -> dict[str, str]:
    """The other operators hash, learn or tokenize; tests hold them against brute force."""
    return {"op5_near_dedup": near_dups.oracle(), "op9_decontamination": decontamination.oracle(),
            "op11_vector_codes": ball_codes.oracle(), "op12_merkle_manifest": merkle.oracle(), "op13_suffix_dedup": bucket_repeats.oracle()}
