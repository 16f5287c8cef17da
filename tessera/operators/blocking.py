"""Candidate pairs: exact, suffix-stripped, street-number and rare-token blocks, and their merge.

Postings stay exploded, one row for each (country, key, tid).  Every cap has a
total order.  Queries have sid, targets tid; both carry the normalised columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

METHODS = ("e_name", "e_ss", "rare", "addr", "tfidf")
REFERENCE_ROWS = 272_474


@dataclass(frozen=True)
class BlockConfig:
    """Cut-offs.  max_cluster and rare_tokens may be None: no cap."""

    max_cluster: int | None = 500
    rare_max_df: int = 10
    addr_max_df: int = 50
    rare_tokens: int | None = 6
    min_df: int = 3
    max_df: int = 1500
    k: int = 50

    def scaled(self, target_rows: int) -> BlockConfig:
        """Frequency cut-offs in proportion to the number of targets (round half to even)."""
        x = target_rows / REFERENCE_ROWS
        return BlockConfig(self.max_cluster, max(2, round(self.rare_max_df * x)), max(2, round(self.addr_max_df * x)), self.rare_tokens, self.min_df, max(self.min_df, round(self.max_df * x)), self.k)


def _capped(rows: DataFrame, cap: int | None) -> DataFrame:
    if cap is None:
        return rows
    w = Window.partitionBy("country", "key").orderBy("tid")
    return rows.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= cap).drop("rn")


def exact_postings(targets: DataFrame, column: str, cfg: BlockConfig) -> DataFrame:
    rows = targets.where(F.col(column) != "").select("country", F.col(column).alias("key"), "tid")
    return _capped(rows, cfg.max_cluster)


def address_postings(targets: DataFrame, cfg: BlockConfig) -> DataFrame:
    rows = targets.where((F.col("street_num") != "") & (F.length("street_num") <= 6)).select("country", F.col("street_num").alias("key"), "tid")
    df = rows.groupBy("country", "key").agg(F.count("*").alias("df")).where(F.col("df") <= cfg.addr_max_df)
    return _capped(rows.join(df, ["country", "key"]), cfg.max_cluster)


def name_tokens(rows: DataFrame, of: str) -> DataFrame:
    return rows.select("country", of, F.explode(F.split("name_tok", " ")).alias("key")).where(F.col("key") != "")


def rare_postings(targets: DataFrame, cfg: BlockConfig) -> DataFrame:
    """df counts occurrences, also those within one name; tokens seen once are dropped."""
    rows = name_tokens(targets, "tid")
    df = rows.groupBy("country", "key").agg(F.count("*").alias("df")).where(F.col("df").between(2, cfg.rare_max_df))
    return rows.join(df, ["country", "key"]).select("country", "key", "tid", "df").distinct()


def pairs(found: DataFrame, method: str) -> DataFrame:
    """The columns of a candidate pair, for one method."""
    have = found.columns
    extra = {"n_rare_shared": F.lit(0), "tfidf_rank": F.lit(None), "tfidf_score": F.lit(None)}
    kinds = {"n_rare_shared": "int", "tfidf_rank": "int", "tfidf_score": "double"}
    flags = [F.lit(m == method).alias(m) for m in METHODS]
    return found.select("sid", "tid", *flags, *[(F.col(c) if c in have else x).cast(kinds[c]).alias(c) for c, x in extra.items()])


def _exact_found(queries: DataFrame, postings: DataFrame, column: str, method: str) -> DataFrame:
    q = queries.where(F.col(column) != "").select("sid", "country", F.col(column).alias("key"))
    return pairs(q.join(postings, ["country", "key"]), method)


def exact_block(queries: DataFrame, targets: DataFrame, column: str, method: str, cfg: BlockConfig) -> DataFrame:
    return _exact_found(queries, exact_postings(targets, column, cfg), column, method)


def _address_found(queries: DataFrame, postings: DataFrame) -> DataFrame:
    q = queries.where((F.col("street_num") != "") & (F.length("street_num") <= 6)).select("sid", "country", F.col("street_num").alias("key"))
    return pairs(q.join(postings, ["country", "key"]), "addr")


def address_block(queries: DataFrame, targets: DataFrame, cfg: BlockConfig) -> DataFrame:
    return _address_found(queries, address_postings(targets, cfg))


def rare_block(queries: DataFrame, targets: DataFrame, cfg: BlockConfig) -> DataFrame:
    return _rare_found(queries, rare_postings(targets, cfg), cfg)


def _rare_found(queries: DataFrame, postings: DataFrame, cfg: BlockConfig) -> DataFrame:
    """Pairs that share one of the query's rarest tokens; a token repeated in the query counts as often."""
    df = postings.select("country", "key", "df").distinct()
    rarest = Window.partitionBy("sid").orderBy("df", "key")
    q = name_tokens(queries, "sid").join(df, ["country", "key"])
    if cfg.rare_tokens is not None:
        q = q.withColumn("rn", F.row_number().over(rarest)).where(F.col("rn") <= cfg.rare_tokens)
    q = q.groupBy("sid", "country", "key").agg(F.count("*").alias("times"))
    found = q.join(postings.drop("df"), ["country", "key"]).groupBy("sid", "tid").agg(F.sum("times").alias("n_rare_shared"))
    return pairs(found, "rare")


def merge(*found: DataFrame) -> DataFrame:
    """One row for each pair, with every method that found it, its best rank and score."""
    rows = found[0]
    for other in found[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy("sid", "tid").agg(*[F.bool_or(m).alias(m) for m in METHODS], F.min("tfidf_rank").alias("tfidf_rank"), F.min("tfidf_score").alias("tfidf_score"), F.max("n_rare_shared").alias("n_rare_shared"))


def postings_of(targets: DataFrame, cfg: BlockConfig) -> dict[str, DataFrame]:
    """The posting tables of all methods, to be kept and looked up again."""
    return {"name": exact_postings(targets, "name_norm", cfg), "ss": exact_postings(targets, "name_ss", cfg), "addr": address_postings(targets, cfg), "rare": rare_postings(targets, cfg)}


def look_up(queries: DataFrame, postings: dict[str, DataFrame], cfg: BlockConfig) -> DataFrame:
    """The merged pairs of all posting tables."""
    found = (_exact_found(queries, postings["name"], "name_norm", "e_name"), _exact_found(queries, postings["ss"], "name_ss", "e_ss"))
    return merge(*found, _address_found(queries, postings["addr"]), _rare_found(queries, postings["rare"], cfg))


def join_blocks(queries: DataFrame, targets: DataFrame, cfg: BlockConfig) -> DataFrame:
    return look_up(queries, postings_of(targets, cfg), cfg)


def left_out(targets: DataFrame, cfg: BlockConfig) -> DataFrame:
    """Rows (rule, keys, postings): what the caps and frequency windows of the posting tables leave out."""

    def sizes(rows: DataFrame) -> DataFrame:
        return rows.groupBy("country", "key").agg(F.count("*").alias("df"))

    name, ss = (sizes(targets.where(F.col(c) != "").select("country", F.col(c).alias("key"))) for c in ("name_norm", "name_ss"))
    street = sizes(targets.where((F.col("street_num") != "") & (F.length("street_num") <= 6)).select("country", F.col("street_num").alias("key")))
    token = sizes(name_tokens(targets, "tid"))
    long = targets.where(F.length("street_num") > 6).select(F.col("street_num").alias("key"), F.lit(1).alias("over"))
    over = lambda d: d.withColumn("over", F.greatest(F.col("df") - F.lit(cfg.max_cluster), F.lit(0)) if cfg.max_cluster is not None else F.lit(0))
    rules = {
        "name_cluster": over(name),
        "ss_cluster": over(ss),
        "street_too_long": long,
        "street_frequent": street.withColumn("over", F.when(F.col("df") > cfg.addr_max_df, F.col("df")).otherwise(0)),
        "token_single": token.withColumn("over", F.when(F.col("df") < 2, F.col("df")).otherwise(0)),
        "token_frequent": token.withColumn("over", F.when(F.col("df") > cfg.rare_max_df, F.col("df")).otherwise(0)),
    }
    out = None
    for rule, rows in rules.items():
        row = rows.where("over > 0").agg(F.lit(rule).alias("rule"), F.count("*").alias("keys"), F.coalesce(F.sum("over"), F.lit(0)).cast("long").alias("postings"))
        out = row if out is None else out.union(row)
    return out
