"""Entity tables, target union and ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.stages import stage


def dense_ids(rows: DataFrame, by: str, name: str) -> DataFrame:
    """Adds a 0-based rank of `by`, whatever the partitioning, without one task that sees all rows: ranks within
    sorted ranges are offset by the counts of the ranges before."""
    ranged = rows.repartitionByRange(by).withColumn("part", F.spark_partition_id())
    ranged = ranged.withColumn("own", F.row_number().over(Window.partitionBy("part").orderBy(by)) - 1)
    ranged = stage(ranged)
    counts = ranged.groupBy("part").count()
    before = counts.select("part", F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return ranged.join(F.broadcast(before), "part").select(*rows.columns, (F.col("before") + F.col("own")).alias(name))


def queries_of(entities: DataFrame) -> DataFrame:
    return entities.where("source_no = 1").withColumnRenamed("entity_id", "sid")


def target_union(entities: DataFrame) -> DataFrame:
    second, third = (entities.where(f"source_no = {n}") for n in (2, 3))
    return second.unionByName(third).withColumnRenamed("entity_id", "tid")


def explode_truth(truth: DataFrame) -> DataFrame:
    """(source1_entity_id, entity_id) of a comma-joined list; an empty list gives no row."""
    ids = F.array_remove(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), "")
    return truth.select("source1_entity_id", F.explode(ids).alias("entity_id"))


def truth_pairs(truth: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """Links as (sid, tid); those to entities that are not there are dropped.  queries: source1_entity_id, sid."""
    return explode_truth(truth).join(queries, "source1_entity_id").join(targets, "entity_id").select("sid", "tid").distinct()


def cluster_profile(rows: DataFrame, key: str | Column, cap: int) -> DataFrame:
    """How many clusters of equal keys there are of each size, and whether they pass the cap."""
    sizes = rows.groupBy(F.col(key).alias("key") if isinstance(key, str) else key.alias("key")).agg(F.count("*").alias("cluster_size"))
    return sizes.groupBy("cluster_size").agg(F.count("*").alias("clusters"), F.max((F.col("cluster_size") > cap).cast("int")).alias("over_cap"))


def development_sample(queries: DataFrame, targets: DataFrame, links: DataFrame, matched: int, single: int, many: int, extra: int, least: int = 5, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Queries and targets to develop with: `matched` queries with a link, `single` ones without, `many` with `least`
    links or more, all targets they link to and up to `extra` others of each source.  links: source1_entity_id,
    entity_id.  Sizes are parameters, so each sort by hash is a bounded top-k."""
    counts = links.groupBy(F.col("source1_entity_id").alias("entity_id")).agg(F.count("*").alias("n"))
    known = queries.select("entity_id").distinct().join(counts, "entity_id", "left").na.fill(0, ["n"])
    kinds = (("n > 0", matched), ("n = 0", single), (f"n >= {least}", many))
    parts = [sample_by_hash(known.where(c), "entity_id", n, seed) for c, n in kinds]
    chosen = stage(parts[0].union(parts[1]).union(parts[2]).select("entity_id").distinct())
    linked = links.join(chosen.withColumnRenamed("entity_id", "source1_entity_id"), "source1_entity_id", "left_semi").select("entity_id").distinct()
    others = targets.join(linked, "entity_id", "left_anti")
    extras = [sample_by_hash(others.where(f"source_no = {n}"), "entity_id", extra, seed) for n in (2, 3)]
    return queries.join(chosen, "entity_id", "left_semi").select(*queries.columns), targets.join(linked, "entity_id", "left_semi").select(*targets.columns).unionByName(extras[0].unionByName(extras[1]))


def sample_by_hash(rows: DataFrame, by: str, n: int, seed: int = 42) -> DataFrame:
    """n rows that do not depend on the layout."""
    return rows.withColumn("h", F.md5(F.concat(F.col(by).cast("string"), F.lit(f"-{seed}")))).orderBy("h", by).limit(n).drop("h")


def sample_report(queries: DataFrame, second: DataFrame, third: DataFrame, lists: DataFrame) -> DataFrame:
    """Rows (what, key, n) about a sample: rows of each source, queries by country, queries by number of links, links.
    lists: source1_entity_id, ids."""
    rows = lambda what, d, key: d.groupBy(key.cast("string").alias("key")).agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "key", "n")
    out = rows("country", queries, F.col("country")).union(rows("n_matches", lists, F.size("ids")))
    for name, d in (("source1", queries), ("source2", second), ("source3", third)):
        out = out.union(d.agg(F.count("*").alias("n")).select(F.lit("rows"), F.lit(name), "n"))
    return out.union(lists.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("n")).select(F.lit("links"), F.lit("all"), "n"))
