"""Folds and labelled pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.blocking import METHODS


def fold_bucket(entity_id: Column) -> Column:
    """The first 32 bits of the id's MD5, modulo 10,000."""
    return F.conv(F.substring(F.md5(entity_id.cast("string")), 1, 8), 16, 10).cast("long") % 10_000


def is_val(entity_id: Column, fraction: float) -> Column:
    return fold_bucket(entity_id) < round(fraction * 10_000)


def pair_hash(seed: int) -> Column:
    return (F.col("sid").cast("long") * 2654435761 + F.col("tid").cast("long") * 40503 + seed) % 1000000007


def negatives(candidates: DataFrame, truth: DataFrame, per_pos: int = 5, seed: int = 42) -> DataFrame:
    """Up to per_pos candidates without a link for each link of a query; queries without links give none."""
    links = truth.groupBy("sid").agg(F.count("*").alias("n_pos"))
    rows = candidates.join(truth.select("sid", "tid"), ["sid", "tid"], "left_anti").join(links, "sid")
    w = Window.partitionBy("sid").orderBy(pair_hash(seed), "tid")
    return rows.withColumn("rn", F.row_number().over(w)).where("rn <= n_pos * %d" % per_pos).drop("rn", "n_pos")


def positives(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """All links, retrieved or not."""
    rows = truth.select("sid", "tid").join(candidates, ["sid", "tid"], "left")
    none = {m: F.lit(False) for m in METHODS} | {"n_rare_shared": F.lit(0), "tfidf_rank": F.lit(0), "tfidf_score": F.lit(0.0)}
    return rows.withColumns({c: F.coalesce(c, x) for c, x in none.items()})


def train_pairs(candidates: DataFrame, truth: DataFrame, per_pos: int = 5, seed: int = 42, fraction: float = 0.1) -> DataFrame:
    """Positives and negatives cannot overlap, so the union needs no distinct."""
    rows = positives(candidates, truth).withColumn("label", F.lit(1)).unionByName(negatives(candidates, truth, per_pos, seed).withColumn("label", F.lit(0)))
    return rows.withColumn("is_val", is_val(F.col("sid"), fraction))
