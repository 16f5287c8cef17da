"""A linking project: every stage from raw tables to match lists, each a table in one folder.

Input of a split: `<base>/<split>/source{1,2,3}` as .tsv or .parquet, and truth.tsv
where there is one.  Each stage's table is written to `<base>/<split>/stages` and
read again by later runs; it is built anew where its settings, or a table that it
came from, have changed.  The long stages (normalised entities, candidates,
features, scores) are written in shards by the hash of an id, each with a marker,
so that a run that is lost goes on where it stopped.  Fitted models, reports and
lists lie beside them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as N
from tessera.operators import blocking, entities, evaluate, features, labels, model, output, tfidf
from tessera.operators.blocking import BlockConfig
from tessera.sources import tables


@dataclass(frozen=True)
class Settings:
    """scale: frequency cut-offs in proportion to the number of targets.  patience: rounds of boosting without a
    gain on the validation fold after which the rest is left out (0: none is).  shard_rows: entities or queries of a
    shard."""

    blocks: BlockConfig = BlockConfig()
    scale: bool = True
    val: float = 0.1
    per_pos: int = 5
    seed: int = 42
    trees: int = 60
    depth: int = 6
    rate: float = 0.05
    leaf: int = 50
    patience: int = 50
    linear: bool = False
    shard_rows: int = 1_000_000


class Project:
    def __init__(self, spark: SparkSession, base: str, settings: Settings | None = None):
        self.spark, self.base, self.settings = spark, base.rstrip("/"), settings or Settings()

    def _at(self, split: str, name: str) -> str:
        return f"{self.base}/{split}/{name}"

    def _made(self, split: str, name: str) -> object:
        """When a stage was finished; what depends on it notes this."""
        note = tables.manifest(self.spark, self._at(split, f"stages/{name}"))
        return note and note["finished_at"]

    def _stage(self, split: str, name: str, of: tuple[str, ...], build: Callable[[], DataFrame], **about: object) -> DataFrame:
        source = {x: self._made(split, x) for x in of}
        return tables.traced(self.spark, self._at(split, f"stages/{name}"), build, source=source, **about)

    def _shards(self, rows: int) -> int:
        return max(1, -(-rows // self.settings.shard_rows))

    def _sharded(self, split: str, name: str, of: tuple[str, ...], rows: int, by: str, build: Callable[[Callable], DataFrame], **about: object) -> DataFrame:
        """A stage in shards by the hash of `by`.  build: gets a function that takes a shard's rows of a table."""
        source, n = {x: self._made(split, x) for x in of}, self._shards(rows)
        share = lambda k: lambda d: d.where(F.pmod(F.xxhash64(F.col(by)), F.lit(n)) == k) if n > 1 else d
        return tables.sharded(self.spark, self._at(split, f"stages/{name}"), n, lambda k: build(share(k)), source=source, **about)

    def _rows(self, split: str, name: str) -> int:
        return tables.manifest(self.spark, self._at(split, f"stages/{name}"))["rows"]

    # entities

    def raw(self, split: str, number: int) -> DataFrame:
        paths = [self._at(split, f"source{number}.{kind}") for kind in ("parquet", "tsv")]
        return tables.scan_source(self.spark, next((p for p in paths if tables.exists(self.spark, p)), paths[-1]))

    def _side(self, split: str, name: str, of: str, numbers: tuple[int, ...]) -> DataFrame:
        rows = None
        for n in numbers:
            d = self.raw(split, n).select("entity_id", F.coalesce("country", F.lit("")).alias("country"), F.col("business_name").alias("name"), F.col("business_address").alias("address"), F.lit(n).alias("source_no"))
            rows = d if rows is None else rows.unionByName(d)
        note = tables.manifest(self.spark, self._at(split, f"stages/{name}_normal"))
        count = note["rows"] if note else rows.count()
        normal = self._sharded(split, f"{name}_normal", (), count, "entity_id", lambda share: N.normalize(share(rows)))
        return self._stage(split, name, (f"{name}_normal",), lambda: entities.dense_ids(normal, "entity_id", of))

    def queries(self, split: str) -> DataFrame:
        return self._side(split, "queries", "sid", (1,))

    def targets(self, split: str) -> DataFrame:
        return self._side(split, "targets", "tid", (2, 3))

    def has_truth(self, split: str) -> bool:
        return tables.exists(self.spark, self._at(split, "truth.tsv"))

    def truth(self, split: str) -> DataFrame:
        q = self.queries(split).select(F.col("entity_id").alias("source1_entity_id"), "sid")
        t = self.targets(split).select("entity_id", "tid")
        return self._stage(split, "truth", ("queries", "targets"), lambda: entities.truth_pairs(tables.read_ground_truth(self.spark, self._at(split, "truth.tsv")), q, t))

    # candidates

    def index(self, split: str) -> tuple[dict[str, DataFrame], BlockConfig]:
        """Posting tables, vocabulary and weights of the targets, and the cut-offs they were made with."""
        t = self.targets(split)
        cfg = self.settings.blocks
        if self.settings.scale:
            cfg = cfg.scaled(tables.manifest(self.spark, self._at(split, "stages/targets"))["rows"])
        about = {"blocks": asdict(replace(cfg, k=0))}  # the index itself does not depend on K
        found = {n: self._stage(split, f"index_{n}", ("targets",), lambda d=d: d, **about) for n, d in blocking.postings_of(t, cfg).items()}
        vocab = self._stage(split, "index_vocab", ("targets",), lambda: tfidf.vocabulary(t, cfg), **about)
        weights = self._stage(split, "index_weights", ("targets", "index_vocab"), lambda: tfidf.weights(t, "tid", vocab), **about)
        return found | {"vocab": vocab, "weights": weights}, cfg

    def candidates(self, split: str) -> DataFrame:
        q = self.queries(split)
        index, cfg = self.index(split)

        def build(share: Callable) -> DataFrame:
            some = share(q)
            near = blocking.pairs(tfidf.nearest(some, index["vocab"], index["weights"], cfg), "tfidf")
            return blocking.merge(blocking.look_up(some, index, cfg), near)

        of = ("queries", *(f"index_{n}" for n in index))
        return self._sharded(split, "candidates", of, self._rows(split, "queries"), "sid", build, tfidf_k=cfg.k)

    def recall(self, split: str, gate: bool = False) -> DataFrame:
        """The recall report, also written; with `gate`, too low a recall is an error."""
        report = evaluate.recall_report(self.queries(split), self.candidates(split), self.truth(split))
        tables.write_report(report, self._at(split, "reports/recall"))
        report = self.spark.read.json(self._at(split, "reports/recall"))
        if gate:
            evaluate.require_gate(report)
        return report

    # learning

    def _val(self, split: str) -> DataFrame:
        """sid, is_val: the fold is a matter of the entity."""
        return self.queries(split).select("sid", labels.is_val(F.col("entity_id"), self.settings.val).alias("is_val"))

    def pairs(self, split: str) -> DataFrame:
        s, c, t = self.settings, self.candidates(split), self.truth(split)
        build = lambda: labels.train_pairs(c, t, s.per_pos, s.seed, s.val).drop("is_val").join(self._val(split), "sid")
        return self._stage(split, "pairs", ("queries", "candidates", "truth"), build, per_pos=s.per_pos, seed=s.seed, val=s.val)

    def features(self, split: str, of: str = "candidates", val_only: bool = False) -> DataFrame:
        """Features of all candidates, of those of the validation fold, or (of="pairs") of the labelled pairs."""
        rows = self.pairs(split) if of == "pairs" else self.candidates(split)
        k, about = self.settings.blocks.k, {"val": self.settings.val if val_only else None}
        if val_only:
            rows = rows.join(self._val(split).where("is_val").select("sid"), "sid", "left_semi")
        q, t = self.queries(split), self.targets(split)
        build = lambda share: features.pair_features(share(rows), share(q), t, k)
        return self._sharded(split, f"features_{of}{'_val' * val_only}", ("queries", "targets", of), self._rows(split, "queries"), "sid", build, tfidf_k=k, **about)

    def train(self, split: str) -> DataFrame:
        """Fits and writes the model; returns (and writes) its report: pairs and AUC of both folds, K, importances."""
        s, rows = self.settings, self.features(split, "pairs")
        fitted = model.train(rows, features.FEATURES, s.trees, s.depth, s.rate, s.seed, s.linear, s.leaf, s.patience)
        model.save(fitted, self._at(split, "model"))
        folds = {n: rows.where(c) for n, c in (("train", "not is_val"), ("val", "is_val"))}
        gains = model.importance(fitted)
        report = self.spark.createDataFrame([(n, d.count(), model.auc(fitted, d), s.blocks.k, gains) for n, d in folds.items()], "fold string, pairs long, auc double, tfidf_k int, importance map<string,double>")
        tables.write_report(report, self._at(split, "reports/model"))
        return report

    def scores(self, split: str, model_split: str = "train", val_only: bool = False) -> DataFrame:
        """sid, tid, score; features made with another K than the model's are refused."""
        rows = self.features(split, "candidates", val_only)
        name = f"features_candidates{'_val' * val_only}"
        note = tables.read_report(self.spark, self._at(model_split, "reports/model"))[0]
        tables.require_same_k(self.spark, self._at(split, f"stages/{name}"), note["tfidf_k"])
        fitted = model.load(self._at(model_split, "model"))
        build = lambda share: model.score(fitted, share(rows), features.FEATURES).select("sid", "tid", "score")
        return self._sharded(split, f"scores{'_val' * val_only}", (name,), self._rows(split, "queries"), "sid", build, model=f"{model_split} {fitted.uid}")

    def threshold(self, split: str = "train") -> float:
        """Sweeps the validation fold, writes the curve and its best point, and returns that threshold."""
        q, scored, truth = self._val(split).where("is_val").select("sid"), self.scores(split, split, True), self.truth(split)
        evaluate.require_coverage(q, scored, truth)
        tables.write_report(evaluate.threshold_sweep(self.spark, q, scored, truth), self._at(split, "reports/thresholds"))
        best = evaluate.best_threshold(self.spark.read.json(self._at(split, "reports/thresholds"))).first()
        tables.write_report(self.spark.createDataFrame([best]), self._at(split, "reports/threshold"))
        return best.threshold

    def chosen_threshold(self, split: str) -> float:
        """That of the split, or else of the training split."""
        for s in (split, "train"):
            if tables.exists(self.spark, self._at(s, "reports/threshold")):
                return tables.read_report(self.spark, self._at(s, "reports/threshold"))[0]["threshold"]
        raise ValueError(f"no threshold for {split}: sweep one or give one")

    # output

    def _lists(self, split: str, found: DataFrame) -> DataFrame:
        """Every query once, with the ids of its targets in order."""
        named = found.select("sid", "tid").join(self.targets(split).select("tid", "entity_id"), "tid")
        ids = named.groupBy("sid").agg(F.array_sort(F.collect_set("entity_id")).alias("ids"))
        q = self.queries(split).select("sid", F.col("entity_id").alias("source1_entity_id"))
        return q.join(ids, "sid", "left").select("source1_entity_id", F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))

    def write(self, split: str, model_split: str = "train", threshold: float | None = None, out: str | None = None) -> DataFrame:
        """Writes matches and candidates below `out` (lists of the split); returns (and writes) their summary."""
        least = self.chosen_threshold(split) if threshold is None else threshold
        out = out or self._at(split, "lists")
        scores, candidates = self.scores(split, model_split), self.candidates(split)
        if not tables.same_pairs(scores, candidates):
            raise RuntimeError("the scored pairs are not the candidates")
        tables.write_matches(self._lists(split, scores.where(F.col("score") >= least)), f"{out}/matches")
        tables.write_matches(self._lists(split, candidates), f"{out}/candidates", "candidate_entity_ids")
        size = F.size("ids")
        lines = tables.read_matches(self.spark, f"{out}/matches")
        summary = lines.agg(F.lit(least).alias("threshold"), F.count("*").alias("lines"), F.count(F.when(size > 0, 1)).alias("matched"), F.coalesce(F.sum(size), F.lit(0)).alias("ids"))
        tables.write_report(summary, self._at(split, "reports/lists"))
        return self.spark.read.json(self._at(split, "reports/lists"))

    def evaluate(self, split: str, path: str | None = None, out: str | None = None) -> DataFrame:
        """Scores a written match list against the truth; also written, to `out` if given."""
        lines = tables.read_matches(self.spark, path or self._at(split, "lists/matches"))
        found = lines.select(F.col("source1_entity_id").alias("sid"), F.explode("ids").alias("tid"))
        q, t = (d.select(of, "entity_id") for d, of in ((self.queries(split), "sid"), (self.targets(split), "tid")))
        truth = self.truth(split).join(q, "sid").select("tid", F.col("entity_id").alias("sid")).join(t, "tid").select("sid", F.col("entity_id").alias("tid"))
        report = evaluate.submission_score(evaluate.per_entity(q.select(F.col("entity_id").alias("sid")), found, truth))
        tables.write_report(report, out or self._at(split, "reports/score"))
        return report

    def validate(self, split: str, matches: str | None = None, candidates: str | None = None, check_ids: bool = True) -> DataFrame:
        """Rows (rule, violations) of two written lists.  check_ids: also look ids up among the targets."""
        m = tables.read_match_lines(self.spark, matches or self._at(split, "lists/matches"))
        c = tables.read_match_lines(self.spark, candidates or self._at(split, "lists/candidates"), "candidate_entity_ids")
        q, t = (d.select(F.col("entity_id").alias(of)) for d, of in ((self.queries(split), "sid"), (self.targets(split), "tid")))
        return output.validate(q, t if check_ids else None, m, c)

    def sample(self, split: str, to: str, matched: int = 6000, single: int = 2000, many: int = 2000, extra: int = 120_000) -> None:
        """Writes a smaller split to develop with, sources and truth, and a report of it: sizes, queries by country
        and by number of links."""
        raw = {n: self.raw(split, n).select(*tables.ENTITY.names).withColumn("source_no", F.lit(n)) for n in (1, 2, 3)}
        truth = tables.read_ground_truth(self.spark, self._at(split, "truth.tsv"))
        q, t = entities.development_sample(raw[1], raw[2].unionByName(raw[3]), entities.explode_truth(truth), matched, single, many, extra, seed=self.settings.seed)
        q.drop("source_no").write.mode("overwrite").parquet(self._at(to, "source1.parquet"))
        for n in (2, 3):
            t.where(f"source_no = {n}").drop("source_no").write.mode("overwrite").parquet(self._at(to, f"source{n}.parquet"))
        kept = truth.join(q.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
        tables.write_matches(kept.select("source1_entity_id", tables.ids_of("matched_entity_ids").alias("ids")), self._at(to, "truth.tsv"))
        made = {n: self.spark.read.parquet(self._at(to, f"source{n}.parquet")) for n in (1, 2, 3)}
        tables.write_report(entities.sample_report(made[1], made[2], made[3], kept.select("source1_entity_id", tables.ids_of("matched_entity_ids").alias("ids"))), self._at(to, "reports/sample"))

    # whole runs

    def fit(self, split: str = "train", gate: bool = True) -> float:
        """Training from raw tables to a threshold."""
        self.recall(split, gate)
        self.train(split)
        return self.threshold(split)

    def link(self, split: str, model_split: str = "train", threshold: float | None = None) -> DataFrame:
        """Linking from raw tables to validated lists."""
        summary = self.write(split, model_split, threshold)
        broken = self.validate(split).where("violations > 0").collect()
        if broken:
            raise RuntimeError(f"lists break rules: {broken}")
        return summary
