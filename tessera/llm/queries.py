"""Queries of this subpackage for the driver, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, fingerprints, language_id, oracles, packing, quality, secrets, simhash, substring_dedup, toxicity, url_filters
from tessera.llm._shared import table

Query = Callable[[SparkSession, str], DataFrame]


def _over_documents(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: op(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_substring_dedup": _over_documents(substring_dedup.op1),
        "op2_secret_scans": _over_documents(secrets.op2),
        "op3_bpe": _over_documents(bpe.op3),
        "op4_simhash": _over_documents(simhash.op4),
        "op5_url_filters": lambda spark, sf_dir: url_filters.op5(spark, table(spark, sf_dir, "pages")),
        "op6_quality_rules": _over_documents(quality.op6),
        "op7_toxicity": lambda spark, sf_dir: toxicity.op7(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
        "op8_fingerprints": _over_documents(fingerprints.op8),
        "op9_packing": _over_documents(packing.op9),
        "op10_language_id": _over_documents(language_id.op10),
    }


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
