"""Recall gate, entity-level F0.5, threshold sweep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.blocking import METHODS

#: Thresholds tried.
GRID = sorted({round(x, 4) for x in [*(k / 100 for k in range(10, 50, 5)), *(k / 100 for k in range(50, 90, 2)), *(k / 100 for k in range(90, 101)), 0.995, 0.999, 0.9999]})
RANKS = (1, 5, 10, 20, 50)
GATE = 0.97


def f05(p: Column, r: Column) -> Column:
    return F.when(p + r == 0, 0.0).otherwise(1.25 * p * r / (0.25 * p + r))


def entity_f05(tp: Column, n_pred: Column, n_true: Column) -> Column:
    """Empty truth: 1 for an empty prediction, else 0; empty prediction against a truth: 0."""
    return F.when(n_true == 0, (n_pred == 0).cast("double")).when(n_pred == 0, 0.0).otherwise(f05(tp / n_pred, tp / n_true))


def per_entity(queries: DataFrame, predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """sid, tp, n_pred, n_true, f05 of every query, also of those without any pair."""
    pred, true = (x.select("sid", "tid").distinct() for x in (predicted, truth))
    rows = pred.withColumn("p", F.lit(1)).join(true.withColumn("t", F.lit(1)), ["sid", "tid"], "full")
    counts = rows.groupBy("sid").agg(F.count("p").alias("n_pred"), F.count("t").alias("n_true"), F.count(F.col("p") + F.col("t")).alias("tp"))
    rows = queries.select("sid").join(counts, "sid", "left").na.fill(0, ["n_pred", "n_true", "tp"])
    return rows.withColumn("f05", entity_f05(F.col("tp"), F.col("n_pred"), F.col("n_true")))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / b)


def pair_metrics(entities: DataFrame, only_truth: bool = True) -> DataFrame:
    """Micro counts and ratios of per_entity rows, over queries with a truth."""
    rows = entities.where("n_true > 0") if only_truth else entities
    c = rows.agg(F.coalesce(F.sum("tp"), F.lit(0)).alias("tp"), F.coalesce(F.sum(F.col("n_pred") - F.col("tp")), F.lit(0)).alias("fp"), F.coalesce(F.sum(F.col("n_true") - F.col("tp")), F.lit(0)).alias("fn"))
    p, r = _ratio(F.col("tp"), F.col("tp") + F.col("fp")), _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select("tp", "fp", "fn", F.round(p, 6).alias("pair_precision"), F.round(r, 6).alias("pair_recall"), F.round(f05(p, r), 6).alias("pair_f05"))


def submission_score(entities: DataFrame) -> DataFrame:
    macro = entities.agg(F.round(F.avg("f05"), 6).alias("macro_f05"), F.count("*").alias("n_s1"), F.sum(F.expr("int(n_true = 0)")).alias("singletons"), F.sum(F.expr("int(n_true = 0 and n_pred = 0)")).alias("singletons_empty"))
    return macro.crossJoin(F.broadcast(pair_metrics(entities)))  # one row and one row


def recall_report(queries: DataFrame, candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """One row; gate_pass tells whether pair recall reaches the gate."""
    e = per_entity(queries, candidates, truth)
    some = F.expr("int(n_true > 0)")
    c = e.agg(F.count("*").alias("n"), F.sum("n_true").alias("true"), F.sum("tp").alias("hit"), F.sum("n_pred").alias("pairs"), F.sum(some).alias("linked"), F.sum(F.expr("int(n_true > 0 and tp > 0)")).alias("one"), F.sum(F.expr("int(n_true > 0 and tp = n_true)")).alias("every"))
    at_least = lambda name: F.greatest(F.col(name), F.lit(1))
    return c.select(
        F.col("true").alias("truth_pairs"),
        F.col("hit").alias("retrieved_pairs"),
        F.round(F.col("hit") / at_least("true"), 4).alias("pair_recall"),
        F.round(F.col("one") / at_least("linked"), 4).alias("coverage_one"),
        F.round(F.col("every") / at_least("linked"), 4).alias("coverage_all"),
        F.round(F.col("true") / at_least("linked"), 3).alias("mean_truth"),
        F.round(F.col("pairs") / at_least("n"), 2).alias("candidates_per_query"),
        (F.col("hit") / at_least("true") >= GATE).alias("gate_pass"),
    )


def require_gate(report: DataFrame) -> None:
    row = report.first()
    if not row.gate_pass:
        raise RuntimeError(f"pair recall {row.pair_recall} is below {GATE}")


def recall_by_method(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    hits = truth.select("sid", "tid").distinct().join(candidates, ["sid", "tid"], "left")
    shares = F.array(*[F.struct(F.lit(m).alias("method"), F.coalesce(F.col(m), F.lit(False)).alias("hit")) for m in METHODS])
    rows = hits.select(F.explode(shares).alias("x")).groupBy("x.method").agg(F.sum(F.expr("int(x.hit)")).alias("hits"), F.round(F.avg(F.expr("int(x.hit)")), 4).alias("recall"))
    return rows.select("method", "hits", "recall")


def recall_by_rank(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    hits = truth.select("sid", "tid").distinct().join(candidates.select("sid", "tid", "tfidf_rank"), ["sid", "tid"], "left")
    within = F.array(*[F.struct(F.lit(k).alias("k"), F.coalesce(F.col("tfidf_rank") <= k, F.lit(False)).alias("hit")) for k in RANKS])
    return hits.select(F.explode(within).alias("x")).groupBy("x.k").agg(F.sum(F.expr("int(x.hit)")).alias("hits"), F.round(F.avg(F.expr("int(x.hit)")), 4).alias("recall"))


def threshold_sweep(spark: SparkSession, queries: DataFrame, scored: DataFrame, truth: DataFrame) -> DataFrame:
    """threshold, macro_f05, avg_preds over all given queries.  A pair is counted at the highest threshold it passes
    and summed downwards for each query, so pairs are never multiplied by the grid."""
    truth = truth.select("sid", "tid").distinct().join(queries.select("sid"), "sid", "left_semi")
    n_true = truth.groupBy("sid").agg(F.count("*").alias("n_true"))
    grid = F.array(*[F.lit(t) for t in GRID])
    rows = scored.join(queries.select("sid"), "sid", "left_semi").withColumn("top", F.size(F.filter(grid, lambda t: t <= F.col("score")))).where("top > 0")
    rows = rows.join(truth.withColumn("hit", F.lit(1)), ["sid", "tid"], "left").groupBy("sid", "top").agg(F.count("*").alias("n"), F.count("hit").alias("tp"))
    rows = rows.select("sid", F.explode(F.slice(grid, F.lit(1), F.col("top"))).alias("threshold"), "n", "tp").groupBy("sid", "threshold").agg(F.sum("n").alias("n_pred"), F.sum("tp").alias("tp"))
    rows = rows.join(n_true, "sid", "left").na.fill(0, ["n_true"])
    by = rows.groupBy("threshold").agg(F.sum(entity_f05(F.col("tp"), F.col("n_pred"), F.col("n_true"))).alias("f"), F.sum(F.expr("int(n_true = 0)")).alias("spoilt"), F.sum("n_pred").alias("preds"))
    base = queries.select("sid").join(n_true, "sid", "left").agg(F.count("*").alias("n"), F.sum(F.expr("int(n_true is null)")).alias("empty"))
    points = spark.createDataFrame([(t,) for t in GRID], "threshold double").crossJoin(F.broadcast(base))  # 42 rows and one row
    rows = points.join(by, "threshold", "left").na.fill(0)
    n = F.greatest("n", F.lit(1))
    return rows.select("threshold", F.round((F.col("f") + F.col("empty") - F.col("spoilt")) / n, 6).alias("macro_f05"), F.round(F.col("preds") / n, 6).alias("avg_preds"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The best point; ties go to the highest threshold."""
    return sweep.orderBy(F.col("macro_f05").desc(), F.col("threshold").desc()).limit(1)


def require_coverage(queries: DataFrame, scored: DataFrame, truth: DataFrame, least: float = GATE) -> None:
    """Stops if too few links of the queries were scored at all."""
    links = truth.select("sid", "tid").distinct().join(queries.select("sid"), "sid", "left_semi")
    n, hit = links.count(), links.join(scored.select("sid", "tid"), ["sid", "tid"], "left_semi").count()
    if n and hit / n < least:
        raise RuntimeError(f"only {hit} of {n} links were scored")
