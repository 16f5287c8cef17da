import math
import random
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tessera.operators import blocking, entities, evaluate, features, labels, model, output, tfidf
from tessera.operators.blocking import BlockConfig
from tessera.sources import tables

CFG = BlockConfig(max_cluster=3, rare_max_df=4, addr_max_df=3, rare_tokens=2, min_df=1, max_df=100, k=3)
KIND = "country string, name_norm string, name_ss string, name_tok string, name_num string, name_nchar int, addr_norm string, addr_tok string, addr_num string, addr_nchar int, street_num string, unit_num string, postal string"


def rows(spark, of, values):
    """values: (id, country, name, address, street)."""
    full = [(i, c, n, n, n, "", len(n), a, a, s, len(a), s, "", "") for i, c, n, a, s in values]
    return spark.createDataFrame(full, f"{of} long, {KIND}").repartition(3)


@pytest.fixture
def sides(spark):
    q = rows(spark, "sid", [(1, "DE", "acme foo foo", "main", "5"), (2, "US", "acme foo", "", ""), (3, "XX", "acme foo", "main", "5"), (4, "DE", "", "", "")])
    t = rows(spark, "tid", [(10 + i, "DE", "acme foo foo", "main", "5") for i in range(3)] + [(20, "DE", "foo bar", "side", "1234567"), (21, "US", "acme foo", "x", "9"), (22, "DE", "", "", "")])
    return q, t


def test_blocks_stay_in_a_country(sides):
    q, t = sides
    found = {(r.sid, r.tid) for r in blocking.exact_block(q, t, "name_norm", "e_name", CFG).collect()}
    assert found == {(1, 10), (1, 11), (1, 12), (2, 21)}
    assert {(r.sid, r.tid) for r in blocking.address_block(q, t, CFG).collect()} == {(1, 10), (1, 11), (1, 12)}


def test_caps(sides, spark):
    _, t = sides
    many = rows(spark, "tid", [(i, "DE", "same", "a", "7") for i in range(10)])
    assert sorted(r.tid for r in blocking.exact_postings(many, "name_norm", CFG).collect()) == [0, 1, 2]
    assert blocking.address_postings(many, CFG).count() == 0  # too frequent


def test_rare_tokens_count_occurrences(sides):
    q, t = sides
    df = {(r.country, r.key): r.df for r in blocking.rare_postings(t, CFG).collect()}
    assert df == {("DE", "acme"): 3}  # foo: 7 occurrences; single tokens go
    assert {(r.sid, r.tid): r.n_rare_shared for r in blocking.rare_block(q, t, CFG).collect()} == {(1, 10): 1, (1, 11): 1, (1, 12): 1}
    wide = BlockConfig(rare_max_df=9, rare_tokens=6)
    assert {r.n_rare_shared for r in blocking.rare_block(q, t, wide).where("sid = 1 and tid < 20").collect()} == {3}  # foo twice


def test_merge_keeps_provenance(sides):
    q, t = sides
    got = {(r.sid, r.tid): r for r in blocking.merge(blocking.join_blocks(q, t, CFG), tfidf.tfidf_block(q, t, CFG)).collect()}
    assert (got[1, 10].e_name, got[1, 10].addr, got[1, 10].rare, got[1, 10].tfidf) == (True, True, True, True)
    assert got[1, 10].tfidf_rank == 1 and got[1, 10].tfidf_score == pytest.approx(1)
    assert all(k[0] != 3 for k in got)


def test_topk_ties_and_order(sides, spark):
    q, t = sides
    first = sorted(map(tuple, tfidf.topk(q, t, CFG).collect()))
    assert [r[1] for r in first if r[0] == 1] == [10, 11, 12]
    again = sorted(map(tuple, tfidf.topk(q.repartition(5), t.orderBy("tid", ascending=False), CFG).collect()))
    assert first == again


def plain_topk(q, t, k):
    """Row by row: idf of the targets of a country, unit vectors, products, six places, smaller ids first."""
    split = lambda r: f"{r.name_tok} {r.addr_tok}".split()
    out = set()
    for country in {r.country for r in q}:
        own = {r.tid: split(r) for r in t if r.country == country}
        df = Counter(x for w in own.values() for x in set(w))

        def vector(words):
            w = {x: (1 + math.log(n)) * (math.log((1 + len(own)) / (1 + df[x])) + 1) for x, n in Counter(words).items() if x in df}
            norm = math.sqrt(sum(v * v for v in w.values()))
            return {x: v / norm for x, v in w.items()}

        vectors = {i: vector(w) for i, w in own.items()}
        for r in q:
            if r.country == country:
                mine = vector(split(r))
                scores = {i: round(sum(v * w.get(x, 0) for x, v in mine.items()), 6) for i, w in vectors.items()}
                best = sorted((-s, i) for i, s in scores.items() if s > 0)[:k]
                out |= {(r.sid, i, -s, n + 1) for n, (s, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("block, chunk, cells", [(50_000, 50_000, 1 << 22), (7, 5, 20), (1000, 3, 1)])
def test_topk_against_plain(spark, monkeypatch, block, chunk, cells):
    """Whatever the blocks of targets, chunks of queries and cells at once; with a country that has most rows."""
    r = random.Random(block)
    words = [f"w{i}" for i in range(25)]
    make = lambda i: (i, "DE" if r.random() < 0.8 else r.choice(["US", "FR"]), " ".join(r.choices(words, k=r.randrange(6))), " ".join(r.choices(words, k=r.randrange(9))), "")
    q = rows(spark, "sid", [make(i) for i in range(60)] + [(99, None, "w1 w2", "w3", "")])
    t = rows(spark, "tid", [make(100 + i) for i in range(90)] + [(999, None, "w1 w2", "w3", "")])
    for name, n in (("BLOCK", block), ("CHUNK", chunk), ("CELLS", cells)):
        monkeypatch.setattr(tfidf, name, n)
    got = {(x.sid, x.tid, x.tfidf_score, x.tfidf_rank) for x in tfidf.topk(q, t, BlockConfig(min_df=1, max_df=1000, k=4)).collect()}
    assert got == plain_topk(q.where("country is not null").collect(), t.collect(), 4)


def counted(k):
    """In place of the products: a row for each row of targets that comes."""

    def run(batches):
        for b in batches:
            own = b.filter(pc.equal(b.column("kind"), 0))
            n = own.num_rows
            yield pa.RecordBatch.from_arrays([own.column("id"), pa.array([0] * n, pa.int64()), pa.array([1.0] * n)], names=["sid", "tid", "tfidf_score"])

    return run


def test_copies_do_not_follow_the_shuffle_partitions(spark, monkeypatch):
    """A target goes to as many groups as the pairs are worth, also where a session has many partitions."""

    q = rows(spark, "sid", [(i, "DE", "word", "", "") for i in range(1300)])
    t = rows(spark, "tid", [(5000 + i, "DE", "word", "", "") for i in range(10)])
    monkeypatch.setattr(tfidf, "_products", counted)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        cfg = BlockConfig(min_df=1, max_df=10**6, k=10**6)
        vocab = tfidf.vocabulary(t, cfg)
        assert tfidf.topk(q, t, cfg).count() == 10
        assert tfidf.nearest(q, vocab, tfidf.weights(t, "tid", vocab), cfg).count() == 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_vectors_travel_in_pieces(spark, monkeypatch):
    """Of long texts too, what is shuffled is no row for each token: one for each task that weighs tokens, at most."""
    r = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    make = lambda of, ids: rows(spark, of, [(i, "DE", "", " ".join(r.sample(words, 200)), "") for i in ids])
    monkeypatch.setattr(tfidf, "_products", counted)
    cfg = BlockConfig(min_df=1, max_df=10**6, k=10**6)
    assert tfidf.topk(make("sid", range(20)), make("tid", range(100, 140)), cfg).count() <= 4 * 40


def test_scaled_config():
    full = BlockConfig().scaled(10_320_219)
    assert (full.rare_max_df, full.addr_max_df, full.max_df) == (379, 1894, 56_814)
    assert BlockConfig().scaled(100).max_df == 3


def test_folds_and_hash(spark):
    df = spark.createDataFrame([("S1-1", 2206820, 10320218)], "id string, sid int, tid int")
    assert df.select(labels.fold_bucket(df.id)).first()[0] == 2941
    assert df.select(labels.pair_hash(42)).first()[0] == 884871763


def test_negatives(spark):
    cand = spark.createDataFrame([(s, t, False, False, False, False, True, 1, 0.5, 0) for s in (1, 2, 3) for t in range(10)], "sid int, tid int, e_name boolean, e_ss boolean, rare boolean, addr boolean, tfidf boolean, tfidf_rank int, tfidf_score double, n_rare_shared int")
    truth = spark.createDataFrame([(1, 0), (2, 0), (2, 1), (2, 77)], "sid int, tid int")
    got = labels.negatives(cand, truth, per_pos=2).groupBy("sid").count().collect()
    assert {r.sid: r["count"] for r in got} == {1: 2, 2: 6}
    pairs = labels.train_pairs(cand, truth, per_pos=9)
    assert {(r.sid, r.tid): (r.label, r.tfidf) for r in pairs.where("label = 1").collect()} == {(1, 0): (1, True), (2, 0): (1, True), (2, 1): (1, True), (2, 77): (1, False)}
    assert pairs.where("label = 0").groupBy("sid").count().where("sid = 1").first()["count"] == 9


def test_entity_metric(spark):
    q = spark.createDataFrame([(i,) for i in range(6)], "sid int")
    pred = spark.createDataFrame([(0, 1), (0, 2), (2, 9), (4, 1), (4, 2), (4, 3), (5, 1), (5, 1)], "sid int, tid int")
    true = spark.createDataFrame([(0, 1), (0, 2), (3, 1), (4, 1), (4, 2), (5, 1)], "sid int, tid int")
    got = {r.sid: r.f05 for r in evaluate.per_entity(q, pred, true).collect()}
    assert got == {0: 1.0, 1: 1.0, 2: 0.0, 3: 0.0, 4: pytest.approx(0.7142857142857143), 5: 1.0}
    micro = evaluate.pair_metrics(evaluate.per_entity(q, pred, true)).first()
    assert (micro.tp, micro.fp, micro.fn) == (5, 1, 1)


def test_sweep_against_plain(spark):
    q = spark.createDataFrame([(i,) for i in range(4)], "sid int")
    scored = spark.createDataFrame([(0, 1, 0.95), (0, 2, 0.5), (1, 1, 0.2), (2, 5, 0.05), (9, 9, 1.0)], "sid int, tid int, score double")
    true = spark.createDataFrame([(0, 1), (3, 1)], "sid int, tid int")
    got = {r.threshold: r for r in evaluate.threshold_sweep(spark, q, scored, true).collect()}
    assert len(got) == len(evaluate.GRID) == 42
    for t, r in got.items():
        kept = scored.where(scored.score >= t).select("sid", "tid")
        want = evaluate.per_entity(q, kept, true).agg({"f05": "avg", "n_pred": "avg"}).first() if t in (0.1, 0.2, 0.5, 0.96, 1.0) else None
        assert want is None or (r.macro_f05, r.avg_preds) == (pytest.approx(want["avg(f05)"], abs=1e-6), pytest.approx(want["avg(n_pred)"], abs=1e-6))
    assert evaluate.best_threshold(evaluate.threshold_sweep(spark, q, scored, true)).first().threshold == 0.95


def test_guards(spark):
    q = spark.createDataFrame([(1,), (2,)], "sid int")
    true = spark.createDataFrame([(1, 1), (2, 2)], "sid int, tid int")
    with pytest.raises(RuntimeError):
        evaluate.require_coverage(q, true.where("sid = 1"), true)
    evaluate.require_coverage(q, true, true)
    with pytest.raises(RuntimeError):
        evaluate.require_gate(evaluate.recall_report(q, true.where("sid = 1"), true))


def test_lists_and_validation(spark):
    q = spark.createDataFrame([(1,), (2,), (3,)], "sid int")
    t = spark.createDataFrame([(5,), (10,), (11,)], "tid int")
    found = spark.createDataFrame([(1, 5), (1, 10), (1, 10), (3, 11)], "sid int, tid int")
    lists = output.lists(q, found)
    assert {r.sid: (r.matched_entity_ids, r.n_ids) for r in lists.collect()} == {1: ("10,5", 2), 2: ("", 0), 3: ("11", 1)}
    assert {r.rule: r.violations for r in output.validate(q, t, lists, lists).collect() if r.violations} == {}
    broken = spark.createDataFrame([(1, "5,5,99"), (1, ""), (7, "")], "sid int, matched_entity_ids string")
    assert {r.rule: r.violations for r in output.validate(q, t, broken, lists).collect()} == {"missing_query": 2, "unknown_query": 1, "repeated_query": 1, "repeated_id": 1, "unknown_id": 1, "match_not_candidate": 1}


def test_truth_lists(spark):
    truth = spark.createDataFrame([("a", "x,y"), ("b", ""), ("c", None), ("d", "x,gone")], "source1_entity_id string, matched_entity_ids string")
    q = spark.createDataFrame([(c, i) for i, c in enumerate("abcd")], "source1_entity_id string, sid int")
    t = spark.createDataFrame([("x", 10), ("y", 11)], "entity_id string, tid int")
    assert {tuple(r) for r in entities.truth_pairs(truth, q, t).collect()} == {(0, 10), (0, 11), (3, 10)}


def test_dense_ids(spark):
    df = spark.createDataFrame([(f"e{i:03d}",) for i in range(200)], "entity_id string").repartition(7)
    got = {r.entity_id: r.id for r in entities.dense_ids(df, "entity_id", "id").collect()}
    assert got == {f"e{i:03d}": i for i in range(200)}


def test_features_both_empty(sides, spark):
    cand = spark.createDataFrame([(4, 22, False, False, False, False, False, 0, None, None)], "sid long, tid long, e_name boolean, e_ss boolean, rare boolean, addr boolean, tfidf boolean, n_rare_shared int, tfidf_rank int, tfidf_score double")
    r = features.pair_features(cand, *sides, k=50).first()
    assert (r.n_jaccard, r.n_num_jaccard, r.n_fuzz_ratio, r.a_jaccard, r.a_num_jaccard, r.a_fuzz_ratio, r.n_fuzz_set) == (1.0, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0)
    assert (r.n_exact, r.a_missing_both, r.n_len_diff, r.r_tfidf_rank_norm) == (1, 1, 0.0, 0.0)
    assert all(f in r.asDict() for f in features.FEATURES) and len(features.FEATURES) == 32


def test_model(spark):
    rows = spark.createDataFrame([(i, float(i % 10), float(i % 7), int(i % 10 > 5), i % 4 == 0) for i in range(400)], "sid int, a double, b double, label int, is_val boolean")
    fitted = model.train(rows, ("a", "b"), trees=3, depth=2, rate=0.2, leaf=5, patience=0)
    assert model.auc(fitted, rows.where("is_val")) > 0.95
    assert model.score(fitted, rows, ("a", "b")).where("score between 0 and 1").count() == 400
    with pytest.raises(ValueError):
        model.score(fitted, rows, ("b", "a"))
    assert model.auc(model.train(rows, ("a", "b"), linear=True), rows) > 0.95


def test_sources(spark, tmp_path):
    path = str(tmp_path / "source1.tsv")
    (tmp_path / "source1.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\textra\nE1\tACME "X" GMBH\t"Main, ""1"""\tDE\t5\nE2\t\t\tGB\t6\n')
    got = tables.scan_source(spark, path)
    assert got.columns == tables.ENTITY.names
    assert got.orderBy("entity_id").collect()[0].business_address == 'Main, "1"'
    (tmp_path / "truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\nE1\tA,B\nE2\t\n")
    assert [r.matched_entity_ids for r in tables.read_ground_truth(spark, str(tmp_path / "truth.tsv")).orderBy("source1_entity_id").collect()] == ["A,B", ""]
    lists = spark.createDataFrame([("E2", []), ("E1", ["A", "B"])], "source1_entity_id string, ids array<string>")
    tables.write_matches(lists, str(tmp_path / "out"))
    assert [(r.source1_entity_id, r.ids) for r in tables.read_matches(spark, str(tmp_path / "out")).orderBy("source1_entity_id").collect()] == [("E1", ["A", "B"]), ("E2", [])]
    with pytest.raises(ValueError):
        tables.read_matches(spark, path)


def test_stages_resume(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    for _ in range(2):
        assert tables.staged(spark, str(tmp_path / "t"), build, tfidf_k=50).count() == 5
    assert len(calls) == 1 and tables.manifest(spark, str(tmp_path / "t"))["rows"] == 5
    tables.require_same_k(spark, str(tmp_path / "t"), 50)
    tables.require_same_k(spark, str(tmp_path / "none"), 50)
    with pytest.raises(ValueError):
        tables.require_same_k(spark, str(tmp_path / "t"), 100)


def test_cutoffs_of_queries_follow_the_targets():
    from tessera.plans import queries

    assert queries.cfg_of(6_666) == queries.cfg_of(54_000) == queries.CFG
    big = queries.cfg_of(10_000_000)
    assert (big.max_df, big.rare_max_df, big.addr_max_df) == (55_051, 367, 1_835)
    d = object.__new__(queries.Data)
    d.t = type("T", (), {"count": lambda self: 10_000_000})()
    assert d.cfg == big
