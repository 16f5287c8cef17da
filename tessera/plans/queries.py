"""Queries over the driver's tables.

Adapter: documents stand for entities.  source = 1 + doc_id % 3 (1 asks, 2 and 3
are targets), country = lang, name = the first 8 words, address = the next 16;
equal texts within a language are the ground truth.  The queries named `_whole`
have all other words in the address.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as N
from tessera.operators import blocking, entities, evaluate, features, labels, model, output, tfidf
from tessera.operators.blocking import BlockConfig
from tessera.operators.stages import shared_folder, stage
from tessera.sources import tables

CFG = BlockConfig(max_df=300)  # for tables of thousands of rows, and the least for others
VAL, PER_POS, SEED, THRESHOLD = 0.3, 5, 42, 0.6
Query = Callable[[SparkSession, str], DataFrame]
_all: dict[str, Query] = {}


def query(f: Query) -> Query:
    """Registers a query; whole numbers become BIGINT and flags 0 or 1."""

    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = f(spark, sf_dir)
        return df.select(*[F.col(c).cast("bigint" if t in ("int", "smallint", "tinyint", "boolean") else t).alias(c) for c, t in df.dtypes])

    _all[f.__name__] = run
    return run


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """whole: the address is all that follows the name."""
    # 24 words are wanted; the limit leaves room for an empty piece before them and keeps the rest of a long text whole
    words = F.filter(F.split("text", r"\s+", -1 if whole else 26), lambda x: x != "")
    d = read(spark, sf_dir, "documents").withColumn("w", words)
    length = F.greatest(F.size("w"), F.lit(0)) if whole else F.lit(16)
    return d.select(F.col("doc_id").alias("entity_id"), (1 + F.col("doc_id") % 3).alias("source_no"), F.col("lang").alias("country"), F.array_join(F.slice("w", 1, 8), " ").alias("name"), F.array_join(F.slice("w", F.lit(9), length), " ").alias("address"))


def cfg_of(target_rows: int) -> BlockConfig:
    """The frequency cut-offs of BlockConfig.scaled() at the reference's proportions, CFG's at least."""
    big = BlockConfig().scaled(target_rows)
    return replace(CFG, **{f: max(getattr(CFG, f), getattr(big, f)) for f in ("rare_max_df", "addr_max_df", "max_df")})


class Data:
    """Tables that several queries share, each staged on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, whole: bool = False):
        self.spark, self.dir = spark, sf_dir
        norm = stage(N.normalize(raw(spark, sf_dir, whole)))
        self.q, self.t = entities.queries_of(norm), entities.target_union(norm)

    @cached_property
    def cfg(self) -> BlockConfig:
        return cfg_of(self.t.count())

    def truth(self) -> DataFrame:
        d = read(self.spark, self.dir, "documents").select("doc_id", "lang", "text", (1 + F.col("doc_id") % 3).alias("s"))
        q, t = (d.where(c).select(F.col("doc_id").alias(i), "lang", "text") for c, i in (("s = 1", "sid"), ("s > 1", "tid")))
        return q.join(t, ["lang", "text"]).select("sid", "tid").distinct()

    @cached_property
    def _candidates(self) -> DataFrame:
        return stage(blocking.merge(blocking.join_blocks(self.q, self.t, self.cfg), tfidf.tfidf_block(self.q, self.t, self.cfg)))

    def candidates(self) -> DataFrame:
        return self._candidates

    def scored(self) -> DataFrame:
        d = features.attach(self.candidates(), self.q, self.t)
        return features.rule_score(features.sets(features.scalar(d, CFG.k))).select("sid", "tid", "score")

    def val(self) -> DataFrame:
        return self.q.where(labels.is_val(F.col("sid"), VAL)).select("sid")

    def matched(self) -> DataFrame:
        return self.scored().where(F.col("score") >= THRESHOLD).select("sid", "tid")


@query
def norm_name(spark, sf_dir):
    return N.normalize(raw(spark, sf_dir)).select("entity_id", "name_norm", "name_nchar")


@query
def norm_name_suffix_stripped(spark, sf_dir):
    return N.normalize(raw(spark, sf_dir)).select("entity_id", "name_ss")


@query
def norm_name_tokens(spark, sf_dir):
    return N.normalize(raw(spark, sf_dir)).select("entity_id", "name_tok", "name_num")


@query
def norm_address(spark, sf_dir):
    return N.normalize(raw(spark, sf_dir)).select("entity_id", "addr_norm", "addr_num", "addr_nchar", "has_addr")


def _customer_addresses(spark, sf_dir):
    address = F.concat(F.lpad(F.col("c_custkey").cast("string"), 5, "0"), F.lit(" "), "c_mktsegment", F.lit(" Rd, Apt "), F.col("c_nationkey").cast("string"), F.lit(" Bldg "), F.col("c_nationkey").cast("string"), F.lit("b"))
    return N.normalize(read(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"), address.alias("address")))


@query
def addr_meta(spark, sf_dir):
    return _customer_addresses(spark, sf_dir).select("c_custkey", "addr_norm", "unit_num", "bldg_num", "postal")


@query
def street_number(spark, sf_dir):
    return _customer_addresses(spark, sf_dir).select("c_custkey", "street_num")


@query
def number_sets(spark, sf_dir):
    urls = read(spark, sf_dir, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"), F.col("url").alias("text"))
    names = read(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")), F.col("c_name"))
    return urls.union(names).select("id", N.number_set(N.normalize_text(F.col("text"))).alias("numbers"))


@query
def entity_ids(spark, sf_dir):
    rows = raw(spark, sf_dir).where("source_no = 1").select("entity_id")
    return entities.dense_ids(rows, "entity_id", "id")


@query
def target_union(spark, sf_dir):
    return entities.target_union(raw(spark, sf_dir)).select("tid", "source_no", "country", "name")


@query
def ground_truth_pairs(spark, sf_dir):
    return Data(spark, sf_dir).truth()


@query
def truth_from_lists(spark, sf_dir):
    """Comma-joined lists of the next two entities and one that is not there, as (sid, tid)."""
    d = raw(spark, sf_dir)
    following = F.concat_ws(",", F.col("entity_id") + 1, F.col("entity_id") + 2, F.concat(F.lit("x"), F.col("entity_id")))
    lists = d.where("source_no = 1").select(F.col("entity_id").cast("string").alias("source1_entity_id"), following.alias("matched_entity_ids"))
    q, t = (x.select(F.col("entity_id").cast("string").alias(name), F.col("entity_id").alias(of)) for x, name, of in ((d.where("source_no = 1"), "source1_entity_id", "sid"), (d.where("source_no > 1"), "entity_id", "tid")))
    return entities.truth_pairs(lists, q, t)


@query
def stats_name(spark, sf_dir):
    return blocking.exact_postings(Data(spark, sf_dir).t, "name_norm", CFG)


@query
def stats_ss(spark, sf_dir):
    return blocking.exact_postings(Data(spark, sf_dir).t, "name_ss", CFG)


def _street_numbers(spark, sf_dir, table, key, of):
    """Addresses of a table of accounts: the whole units of the balance are the street number."""
    d = read(spark, sf_dir, table)
    prefix = key[0]
    address = F.concat(F.abs(F.col(f"{prefix}_acctbal")).cast("long").cast("string"), F.lit(" Main Rd"))
    rows = N.normalize(d.select(F.col(key).alias(of), F.lit("x").alias("country"), F.col(f"{prefix}_name").alias("name"), address.alias("address")))
    return rows.select(of, "country", "street_num")


@query
def stats_addr(spark, sf_dir):
    rows = _street_numbers(spark, sf_dir, "customer", "c_custkey", "tid")
    return blocking.address_postings(rows, cfg_of(rows.count()))


@query
def stats_rare_token(spark, sf_dir):
    d = Data(spark, sf_dir)
    return blocking.rare_postings(d.t, d.cfg)


def _block(spark, sf_dir, make):
    d = Data(spark, sf_dir)
    return make(d.q, d.t, d.cfg)


@query
def block_exact_name(spark, sf_dir):
    return _block(spark, sf_dir, lambda q, t, cfg: blocking.exact_block(q, t, "name_norm", "e_name", cfg)).select("sid", "tid")


@query
def block_suffix(spark, sf_dir):
    return _block(spark, sf_dir, lambda q, t, cfg: blocking.exact_block(q, t, "name_ss", "e_ss", cfg)).select("sid", "tid")


@query
def block_address(spark, sf_dir):
    """Suppliers look for customers with their street number."""
    q, t = _street_numbers(spark, sf_dir, "supplier", "s_suppkey", "sid"), _street_numbers(spark, sf_dir, "customer", "c_custkey", "tid")
    return blocking.address_block(q, t, cfg_of(t.count())).select("sid", "tid")


@query
def block_rare(spark, sf_dir):
    return _block(spark, sf_dir, lambda q, t, cfg: blocking.rare_block(q, t, cfg)).select("sid", "tid", "n_rare_shared")


@query
def candidate_merge(spark, sf_dir):
    return _block(spark, sf_dir, lambda q, t, cfg: blocking.join_blocks(q, t, cfg)).select("sid", "tid", "e_name", "e_ss", "rare", "addr", "n_rare_shared")


@query
def tfidf_vocab(spark, sf_dir):
    d = Data(spark, sf_dir)
    return tfidf.vocabulary(d.t, d.cfg).withColumn("idf", F.round("idf", 6))


@query
def tfidf_weights(spark, sf_dir):
    d = Data(spark, sf_dir)
    return tfidf.weights(d.t, "tid", tfidf.vocabulary(d.t, d.cfg)).withColumn("w", F.round("w", 6))


@query
def tfidf_topk(spark, sf_dir):
    return _block(spark, sf_dir, lambda q, t, cfg: tfidf.topk(q, t, cfg))


@query
def norm_whole(spark, sf_dir):
    return N.normalize(raw(spark, sf_dir, True)).select("entity_id", "name_norm", "addr_norm", "addr_num", "addr_nchar")


@query
def tfidf_vocab_whole(spark, sf_dir):
    d = Data(spark, sf_dir, True)
    return tfidf.vocabulary(d.t, d.cfg).withColumn("idf", F.round("idf", 6))


@query
def tfidf_topk_whole(spark, sf_dir):
    """Over whole texts, with long vectors and long posting lists.  They are read once, so nothing is staged."""
    norm = N.normalize(raw(spark, sf_dir, True))
    q, t = entities.queries_of(norm), entities.target_union(norm)
    return tfidf.topk(q, t, cfg_of(t.count()))


@query
def tfidf_kept_index(spark, sf_dir):
    """The same from a vocabulary and weights that were written and read again."""
    d = Data(spark, sf_dir)
    base = f"{shared_folder(spark)}/index-{uuid.uuid4().hex}"
    vocab = tables.staged(spark, f"{base}/vocab", lambda: tfidf.vocabulary(d.t, d.cfg))
    weights = tables.staged(spark, f"{base}/weights", lambda: tfidf.weights(d.t, "tid", vocab))
    return tfidf.nearest(d.q, vocab, weights, d.cfg)


@query
def scaled_cutoffs(spark, sf_dir):
    """The frequency cut-offs for as many targets as each table has rows."""
    found = []
    for name in ("customer", "documents", "events", "lineitem", "orders", "part"):
        n = read(spark, sf_dir, name).count()
        cfg = BlockConfig().scaled(n)
        found.append((name, n, cfg.rare_max_df, cfg.addr_max_df, cfg.max_df))
    return spark.createDataFrame(found, "name string, targets long, rare_max_df long, addr_max_df long, max_df long")


@query
def cut_postings(spark, sf_dir):
    """How many postings each cap and frequency window leaves out, so that nothing is dropped unseen."""
    d = Data(spark, sf_dir)
    return blocking.left_out(d.t, d.cfg)


@query
def candidates_all(spark, sf_dir):
    return Data(spark, sf_dir).candidates()


@query
def recall_report(spark, sf_dir):
    d = Data(spark, sf_dir)
    return evaluate.recall_report(d.q, d.candidates(), d.truth())


@query
def recall_by_method(spark, sf_dir):
    d = Data(spark, sf_dir)
    return evaluate.recall_by_method(d.candidates(), d.truth())


@query
def recall_by_rank(spark, sf_dir):
    d = Data(spark, sf_dir)
    return evaluate.recall_by_rank(d.candidates(), d.truth())


@query
def fold_assign(spark, sf_dir):
    rows = raw(spark, sf_dir).where("source_no = 1")
    return rows.select("entity_id", labels.fold_bucket(F.col("entity_id")).alias("bucket"), labels.is_val(F.col("entity_id"), VAL).alias("is_val"))


@query
def fold_summary(spark, sf_dir):
    val = labels.is_val(F.col("entity_id"), VAL).cast("int")
    return raw(spark, sf_dir).where("source_no = 1").agg(F.count("*").alias("n"), F.sum(val).alias("n_val"), F.round(F.avg(val), 4).alias("fraction"))


@query
def train_positives(spark, sf_dir):
    d = Data(spark, sf_dir)
    return labels.positives(d.candidates(), d.truth())


@query
def train_negatives(spark, sf_dir):
    d = Data(spark, sf_dir)
    return labels.negatives(d.candidates(), d.truth(), PER_POS, SEED).select("sid", "tid")


@query
def train_pairs(spark, sf_dir):
    d = Data(spark, sf_dir)
    return labels.train_pairs(d.candidates(), d.truth(), PER_POS, SEED, VAL).select("sid", "tid", "label", "is_val")


def _rounded(df: DataFrame, names) -> DataFrame:
    return df.select("sid", "tid", *[F.round(c, 6).alias(c) if dict(df.dtypes)[c] == "double" else F.col(c) for c in names])


@query
def features_scalar(spark, sf_dir):
    d = Data(spark, sf_dir)
    return _rounded(features.scalar(features.attach(d.candidates(), d.q, d.t), CFG.k), features.SCALAR)


@query
def features_set(spark, sf_dir):
    d = Data(spark, sf_dir)
    return _rounded(features.sets(features.attach(d.candidates(), d.q, d.t)), features.SETS[:-1])


@query
def feature_cross(spark, sf_dir):
    d = Data(spark, sf_dir)
    return _rounded(features.sets(features.attach(d.candidates(), d.q, d.t)), features.SETS[-1:])


@query
def features_fuzzy(spark, sf_dir):
    d = Data(spark, sf_dir)
    return _rounded(features.fuzzy(features.attach(d.candidates(), d.q, d.t)), features.FUZZY)


@query
def rule_score(spark, sf_dir):
    return Data(spark, sf_dir).scored()


@query
def threshold_sweep(spark, sf_dir):
    d = Data(spark, sf_dir)
    return evaluate.threshold_sweep(spark, d.val(), d.scored(), d.truth())


@query
def best_threshold(spark, sf_dir):
    return evaluate.best_threshold(threshold_sweep(spark, sf_dir))


@query
def match_lists(spark, sf_dir):
    d = Data(spark, sf_dir)
    return output.lists(d.q, d.matched())


@query
def candidate_lists(spark, sf_dir):
    d = Data(spark, sf_dir)
    return output.lists(d.q, d.candidates())


@query
def macro_f05(spark, sf_dir):
    d = Data(spark, sf_dir)
    return evaluate.per_entity(d.q, d.matched(), d.truth()).agg(F.round(F.avg("f05"), 6).alias("macro_f05"))


@query
def pair_metrics(spark, sf_dir):
    d = Data(spark, sf_dir)
    return evaluate.pair_metrics(evaluate.per_entity(d.q, d.matched(), d.truth()))


@query
def submission_score(spark, sf_dir):
    d = Data(spark, sf_dir)
    return evaluate.submission_score(evaluate.per_entity(d.q, d.matched(), d.truth()))


@query
def validate_output(spark, sf_dir):
    d = Data(spark, sf_dir)
    return output.validate(d.q.select("sid"), d.t, output.lists(d.q, d.matched()), output.lists(d.q, d.candidates()))


@query
def validate_faults(spark, sf_dir):
    """Lists with faults of every rule, by the last digits of the query's id."""
    d = Data(spark, sf_dir)
    lists = output.lists(d.q, d.candidates())
    own, ids = F.col("sid") % 10, F.col("matched_entity_ids")
    comma = F.when(ids == "", "").otherwise(",")
    first = F.split(ids, ",")[0]
    faulty = F.when(own == 1, F.concat(ids, comma, F.lit("nobody"))).when((own == 2) & (ids != ""), F.concat(ids, comma, first)).when(own == 3, F.concat(ids, comma, F.lit("-1,-1"))).otherwise(ids)
    rows = lists.where(own != 4).select("sid", faulty.alias("matched_entity_ids"))
    rows = rows.union(rows.where(own == 5)).union(rows.where(own == 6).select(-F.col("sid") - 1, "matched_entity_ids"))
    return output.validate(d.q.select("sid"), d.t, rows, lists)


@query
def match_lines(spark, sf_dir):
    """Match lists as written to text and read again."""
    d = Data(spark, sf_dir)
    path = f"{shared_folder(spark)}/lists-{uuid.uuid4().hex}"
    made = output.lists(d.q, d.matched()).select(F.col("sid").cast("string").alias("source1_entity_id"), tables.ids_of("matched_entity_ids").alias("ids"))
    tables.write_matches(made, path)
    return tables.read_matches(spark, path).select("source1_entity_id", F.array_join("ids", ",").alias("matched_entity_ids"))


@query
def entity_lines(spark, sf_dir):
    """Entities as written to tab-separated text, with one column more, and read again."""
    path = f"{shared_folder(spark)}/entities-{uuid.uuid4().hex}/source.tsv"
    rows = raw(spark, sf_dir).select(F.col("entity_id").cast("string"), F.col("name").alias("business_name"), F.col("address").alias("business_address"), "country", F.lit("more").alias("extra"))
    rows.write.options(sep="\t", header=True, quote='"', escape='"', emptyValue="").csv(path)
    back = tables.scan_source(spark, path)
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in back.columns])


@query
def name_cluster_profile(spark, sf_dir):
    return entities.cluster_profile(read(spark, sf_dir, "part"), N.normalize_text(F.col("p_name")), 30)


@query
def country_consistency(spark, sf_dir):
    """Links by the languages of their ends, over equal texts of any language."""
    d = read(spark, sf_dir, "documents").select("doc_id", "lang", "text", (1 + F.col("doc_id") % 3).alias("s"))
    # counted on each side first: a text with many copies is one row a language, not all its pairs
    q, t = (d.where(c).groupBy("text", F.col("lang").alias(f"{x}_lang")).agg(F.count("*").alias(x)) for c, x in (("s = 1", "q"), ("s > 1", "t")))
    return q.join(t, "text").groupBy("q_lang", "t_lang").agg(F.sum(F.col("q") * F.col("t")).alias("links"))


@query
def dev_sample(spark, sf_dir):
    return entities.sample_by_hash(raw(spark, sf_dir).where("source_no = 1").select("entity_id", "country"), "entity_id", 50, SEED)


def _development(spark, sf_dir):
    """Queries and targets to develop with: 20 linked, 10 single, 5 of two links or more, 15 more of each source."""
    d = raw(spark, sf_dir).select("entity_id", "source_no", "country")
    links = Data(spark, sf_dir).truth().select(F.col("sid").alias("source1_entity_id"), F.col("tid").alias("entity_id"))
    q, t = entities.development_sample(d.where("source_no = 1"), d.where("source_no > 1"), links, 20, 10, 5, 15, least=2, seed=SEED)
    return q, t, links


@query
def dev_split(spark, sf_dir):
    q, t, _ = _development(spark, sf_dir)
    return q.unionByName(t)


@query
def dev_split_report(spark, sf_dir):
    q, t, links = _development(spark, sf_dir)
    lists = q.select(F.col("entity_id").alias("source1_entity_id")).join(links.groupBy("source1_entity_id").agg(F.collect_list("entity_id").alias("ids")), "source1_entity_id", "left")
    lists = lists.withColumn("ids", F.coalesce("ids", F.array().cast("array<bigint>")))
    return entities.sample_report(q, t.where("source_no = 2"), t.where("source_no = 3"), lists)


def _model(spark, sf_dir):
    d = Data(spark, sf_dir)
    rows = labels.train_pairs(d.candidates(), d.truth(), PER_POS, SEED, VAL)
    return d, stage(features.pair_features(rows, d.q, d.t, CFG.k))


@query
def gbt_train_metrics(spark, sf_dir):
    _, rows = _model(spark, sf_dir)
    fitted = model.train(rows, features.FEATURES, trees=20, depth=5, rate=0.2, leaf=5, patience=0)
    points = [("train", "not is_val"), ("val", "is_val")]
    return spark.createDataFrame([(n, rows.where(c).count(), model.auc(fitted, rows.where(c))) for n, c in points], "fold string, pairs long, auc double")


@query
def gbt_scores(spark, sf_dir):
    d, rows = _model(spark, sf_dir)
    fitted = model.train(rows, features.FEATURES, trees=20, depth=5, rate=0.2, leaf=5, patience=0)
    return model.score(fitted, features.pair_features(d.candidates(), d.q, d.t, CFG.k), features.FEATURES).select("sid", "tid", "score")


def queries() -> dict[str, Query]:
    return dict(_all)
