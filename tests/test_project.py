"""A linking project from raw files to lists, over businesses made up here."""

import random
from dataclasses import replace

import pytest

from tessera import __main__ as cli
from tessera.operators.blocking import BlockConfig
from tessera.plans.project import Project, Settings
from tessera.sources import tables

SMALL = Settings(BlockConfig(min_df=1, max_df=200, k=10), scale=False, val=0.4, linear=True)
HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


def write_split(folder, n, seed):
    """n businesses; each third has no target, each fifth has one in both other sources."""
    r = random.Random(seed)
    folder.mkdir(parents=True)
    words = [f"{a}{b}" for a in "bar cel dor fim gul".split() for b in "ado ine oka um ert".split()]
    sources, truth = {1: [], 2: [], 3: []}, []
    for i in range(n):
        name, street = " ".join(r.sample(words, 3)), f"{r.randrange(1, 90)} {r.choice(words)} Rd"
        country = r.choice(["DE", "US"])
        sources[1].append((f"S1-{i}", f"{name} Ltd", street, country))
        links = [] if i % 3 == 0 else [2, 3] if i % 5 == 0 else [2 + i % 2]
        for s in links:
            sources[s].append((f"S{s}-{i}", name.upper(), street.replace("Rd", "Road"), country))
        truth.append((f"S1-{i}", ",".join(f"S{s}-{i}" for s in links)))
    for s in (2, 3):
        sources[s] += [(f"S{s}-x{i}", " ".join(r.sample(words, 3)), f"{r.randrange(1, 90)} {r.choice(words)} Street", "DE") for i in range(n // 2)]
    for s, rows in sources.items():
        (folder / f"source{s}.tsv").write_text(HEAD + "".join("\t".join(x) + "\n" for x in rows))
    (folder / "truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join("\t".join(x) + "\n" for x in truth))
    return dict(truth)


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("project")
    write_split(base / "train", 90, 1)
    truth = write_split(base / "test", 60, 2)
    project = Project(spark, str(base), SMALL)
    return project, truth, project.fit("train"), project.link("test").first(), base


def test_links_are_found(spark, done):
    project, truth, threshold, summary, base = done
    assert 0 < threshold <= 1 and summary.threshold == threshold
    found = {r.source1_entity_id: r.ids for r in tables.read_matches(spark, f"{base}/test/lists/matches").collect()}
    assert set(found) == set(truth) and summary.lines == 60 and summary.ids == sum(map(len, found.values()))
    assert all(ids == sorted(set(ids)) for ids in found.values())
    report = project.evaluate("test").first()
    right = sum(found[k] == [x for x in v.split(",") if x] for k, v in truth.items())
    assert report.n_s1 == 60 and report.macro_f05 > 0.9 and right >= 54
    assert project.recall("test", gate=True).first().pair_recall == 1.0
    assert {r.fold: r.tfidf_k for r in spark.read.json(f"{base}/train/reports/model").collect()} == {"train": 10, "val": 10}


def test_broken_lists_are_told(spark, done):
    project, truth, _, _, base = done
    path = base / "broken.tsv"
    lines = [f"{k}\t\n" for k in truth][2:] + ["S1-5\tS2-5,S2-5,nobody\n", "S1-x\t\n"]
    path.write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(lines))
    broken = {r.rule: r.violations for r in project.validate("test", str(path)).collect()}
    assert broken["missing_query"] == 2 and broken["unknown_query"] == 1 and broken["repeated_query"] == 1
    assert broken["repeated_id"] == 1 and broken["unknown_id"] == 1
    last = {r.source1_entity_id: r.ids for r in tables.read_matches(spark, str(path)).collect()}
    assert last["S1-5"] == ["S2-5", "S2-5", "nobody"]


def test_tables_are_kept_and_follow_their_settings(spark, done):
    project, _, _, _, base = done
    made = lambda name: tables.manifest(spark, f"{base}/train/stages/{name}")["finished_at"]
    before = {n: made(n) for n in ("queries", "index_weights", "candidates", "pairs")}
    project.pairs("train")
    assert before == {n: made(n) for n in before}
    other = Project(spark, str(base), Settings(BlockConfig(min_df=1, max_df=200, k=3), scale=False, val=0.4, linear=True))
    other.pairs("train")
    assert made("index_weights") == before["index_weights"] and made("candidates") > before["candidates"] and made("pairs") > before["pairs"]
    with pytest.raises(ValueError):
        other.scores("train")  # the model was trained with another K


def test_scores_of_other_pairs_are_refused(spark, done):
    """As many scores as candidates, but one pair is another."""
    project, *_, base = done
    path = f"{base}/test/stages/scores"
    rows = spark.createDataFrame(spark.read.parquet(f"{path}/shard-00000").collect(), "sid long, tid long, score double")
    one = rows.orderBy("sid", "tid").first()
    other = rows.where(f"not (sid = {one.sid} and tid = {one.tid})").union(spark.createDataFrame([(one.sid, 10**9, 0.5)], "sid long, tid long, score double"))
    faulty = Project(spark, str(base), SMALL)
    faulty.scores = lambda *a, **k: other
    with pytest.raises(RuntimeError, match="not the candidates"):
        faulty.write("test")


def test_shards_give_the_same_lists(spark, done, tmp_path):
    project, *_, base = done
    lists = lambda p: sorted((r.source1_entity_id, r.ids) for r in tables.read_matches(spark, p).collect())
    want = lists(f"{base}/test/lists/matches")
    cut = Project(spark, str(base), replace(SMALL, shard_rows=17))
    assert cut.write("test", out=str(tmp_path)).first().lines == 60
    assert lists(f"{tmp_path}/matches") == want
    assert tables.manifest(spark, f"{base}/test/stages/candidates")["shards"] == 4


def test_commands(spark, done, tmp_path):
    *_, base = done
    run = lambda *argv: cli.run(spark, [*argv, "--base", str(base), "--no-scale", "--min-df", "1"])
    run("sample", "--to", "dev", "--matched", "10", "--single", "5", "--many", "0", "--extra", "7")
    queries = run("normalize", "--split", "dev")
    assert queries.count() == 15 and sorted(r.sid for r in queries.select("sid").collect()) == list(range(15))
    report = {(r.what, r.key): r.n for r in spark.read.json(f"{base}/dev/reports/sample").collect()}
    assert report["rows", "source1"] == 15 and sum(n for (what, _), n in report.items() if what == "n_matches") == 15 and report["links", "all"] >= 10
    assert {r.rule for r in run("validate", "--split", "test").collect()} >= {"missing_query"} and "unknown_id" not in {r.rule for r in run("validate", "--split", "test").collect()}
    assert "unknown_id" in {r.rule for r in run("validate", "--split", "test", "--check-ids").collect()}
    run("evaluate", "--split", "test", "--out", str(tmp_path / "score"))
    assert spark.read.json(str(tmp_path / "score")).first().n_s1 == 60
    parsed = cli.parser().parse_args(["train", "--base", "x", "--early-stopping", "7", "--min-data-in-leaf", "9", "--num-leaves", "63"])
    assert (parsed.patience, parsed.leaf, parsed.num_leaves) == (7, 9, 63)
    assert run("recall", "--split", "dev").first().truth_pairs >= 10
    assert run("index", "--split", "dev").count() > 0
    assert run("features", "--split", "dev", "--of", "pairs").where("label = 1").count() >= 10
    with pytest.raises(SystemExit):
        cli.run(spark, ["nothing", "--base", "x"])
