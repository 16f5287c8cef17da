"""Shards, set equality, early stopping and the sample report."""

import pytest

from tessera.operators import blocking, entities, model
from tessera.operators.blocking import BlockConfig
from tessera.sources import tables


def test_a_lost_run_goes_on_at_its_first_missing_shard(spark, tmp_path):
    built, path = [], str(tmp_path / "stage")

    def build(k):
        if k == 2 and len(built) < 3:
            built.append(-1)
            raise RuntimeError("lost")
        built.append(k)
        return spark.range(k * 10, k * 10 + 10)

    with pytest.raises(RuntimeError, match="lost"):
        tables.sharded(spark, path, 4, build, a=1)
    assert built == [0, 1, -1] and tables.manifest(spark, path) is None
    assert sorted(r.id for r in tables.sharded(spark, path, 4, build, a=1).collect()) == list(range(40))
    assert built == [0, 1, -1, 2, 3] and tables.manifest(spark, path)["rows"] == 40
    tables.sharded(spark, path, 4, build, a=1)
    assert len(built) == 5
    tables.sharded(spark, path, 4, build, a=2)
    assert built[5:] == [0, 1, 2, 3]
    assert tables.sharded(spark, path, 2, build, a=2).count() == 20 and built[9:] == [0, 1]


def test_same_pairs_is_about_sets(spark):
    of = lambda *rows: spark.createDataFrame(rows, "sid long, tid long")
    a = of((1, 2), (1, 3), (2, 2))
    assert tables.same_pairs(a, of((2, 2), (1, 3), (1, 2)))
    assert not tables.same_pairs(a, of((1, 2), (1, 3), (2, 3)))  # as many, but others
    assert not tables.same_pairs(a, of((1, 2), (1, 3), (1, 3)))
    assert not tables.same_pairs(a, of((1, 2), (1, 3)))


def test_best_round():
    assert model.best_round([5, 4, 3, 3, 3, 3, 1], 3) == 3
    assert model.best_round([5, 4, 3, 3, 3, 3, 1], 4) == 7
    assert model.best_round([1.0], 1) == 1


def test_importance_and_early_stopping(spark):
    rows = spark.createDataFrame([(i, float(i % 10), float(i % 7), int(i % 10 > 5), i % 4 == 0) for i in range(400)], "sid int, a double, b double, label int, is_val boolean")
    fitted = model.train(rows, ("a", "b"), trees=6, depth=2, rate=0.3, leaf=5, patience=2)
    assert 1 <= fitted.stages[-1].getNumTrees <= 6
    shares = model.importance(fitted)
    assert list(shares)[0] == "a" and shares["a"] > 0.9 and sum(shares.values()) == pytest.approx(1)
    assert list(model.importance(model.train(rows, ("a", "b"), linear=True))) == ["a", "b"]


def test_sample_report(spark):
    q = spark.createDataFrame([("a", "DE"), ("b", "DE"), ("c", "US")], "entity_id string, country string")
    lists = spark.createDataFrame([("a", ["x", "y"]), ("b", []), ("c", [])], "source1_entity_id string, ids array<string>")
    got = {(r.what, r.key): r.n for r in entities.sample_report(q, q.limit(2), q.limit(1), lists).collect()}
    assert got == {("country", "DE"): 2, ("country", "US"): 1, ("n_matches", "2"): 1, ("n_matches", "0"): 2, ("rows", "source1"): 3, ("rows", "source2"): 2, ("rows", "source3"): 1, ("links", "all"): 2}


def test_no_cap(spark):
    """Without caps nothing is left out by them."""
    t = spark.createDataFrame([(i, "DE", "acme", "acme", "acme foo", "5") for i in range(9)], "tid long, country string, name_norm string, name_ss string, name_tok string, street_num string")
    capped, free = BlockConfig(max_cluster=3, rare_max_df=20), BlockConfig(max_cluster=None, rare_tokens=None, rare_max_df=20)
    assert blocking.exact_postings(t, "name_norm", capped).count() == 3 and blocking.exact_postings(t, "name_norm", free).count() == 9
    out = {r.rule: (r["keys"], r.postings) for r in blocking.left_out(t, capped).collect()}
    assert out["name_cluster"] == out["ss_cluster"] == (1, 6) and out["street_frequent"] == out["token_single"] == (0, 0)
    assert {r.postings for r in blocking.left_out(t, free).collect()} == {0}
