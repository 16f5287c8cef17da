"""Match lists and their validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lists(queries: DataFrame, found: DataFrame) -> DataFrame:
    """One row for each query: its different targets in order of their id as text, comma-joined, maybe empty."""
    ids = found.groupBy("sid").agg(F.array_sort(F.collect_set(F.col("tid").cast("string"))).alias("ids"))
    joined = queries.select("sid").join(ids, "sid", "left")
    return joined.select("sid", F.coalesce(F.array_join("ids", ","), F.lit("")).alias("matched_entity_ids"), F.greatest(F.coalesce(F.size("ids"), F.lit(0)), F.lit(0)).alias("n_ids"))


def validate(queries: DataFrame, targets: DataFrame | None, matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows (rule, violations) for lists made by `lists`: one line for each query, known ids, no repeats, matches
    within candidates.  Without targets, ids are not looked up."""
    ids = lambda d: d.select("sid", F.explode(F.array_remove(F.split("matched_entity_ids", ","), "")).alias("id"))
    m, c = ids(matches), ids(candidates)
    rules = {
        "missing_query": queries.select("sid").join(matches, "sid", "left_anti"),
        "unknown_query": matches.join(queries, "sid", "left_anti"),
        "repeated_query": matches.groupBy("sid").count().where("count > 1"),
        "repeated_id": m.groupBy("sid", "id").count().where("count > 1"),
        "unknown_id": None if targets is None else m.join(targets.select(F.col("tid").cast("string").alias("id")), "id", "left_anti"),
        "match_not_candidate": m.join(c, ["sid", "id"], "left_anti"),
    }
    out = None
    for name, rows in rules.items():
        if rows is None:
            continue
        row = rows.agg(F.count("*").alias("violations")).select(F.lit(name).alias("rule"), "violations")
        out = row if out is None else out.union(row)
    return out
