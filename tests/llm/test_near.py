import random
import time
from itertools import combinations

import numpy as np

import corpus_pipeline
from tessera.llm import near
from tests.llm import test_pipeline
from tests.llm.test_pipeline import groups


def changed(r, text, n):
    words = text.split()
    for k in r.sample(range(len(words)), n):
        words[k] = f"x{r.random()}"
    return " ".join(words)


def test_near_copies_of_any_distance(spark, make):
    r = random.Random(5)
    texts = []
    for n in (40, 100, 400):
        for _ in range(12):
            base = " ".join(f"w{r.randrange(3000)}" for _ in range(n))
            texts += [base] + [changed(r, base, max(1, n * k // 1000)) for k in (5, 10, 16, 20, 24, 30, 60)]
    chain = [f"c{k}" for k in range(300)]
    texts += [" ".join(chain[k : k + 200]) for k in range(0, 90, 10)]  # neighbours are similar, the ends are not
    texts += ["a b", "A  b", "a c", "", ""]
    want = groups(texts)
    docs = make(texts)
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == want


def test_pipeline_links_at_0_8(spark, tmp_path):
    """texts[21] of test_pipeline has similarity 0.93 to texts[5] and 7 other bits of SimHash."""
    texts = test_pipeline.texts.__wrapped__()
    docs = {i: t for i, t in enumerate(texts) if t and not test_pipeline.measures(t)[5] and "|" not in t}
    kept = [list(docs)[k] for k in groups(list(docs.values()))]
    assert 5 in kept and 21 not in kept and 20 not in kept
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(kept)


def test_one_doc_id_with_different_texts(spark, make):
    r = random.Random(6)
    a, b, c = (" ".join(f"w{r.randrange(3000)}" for _ in range(200)) for _ in range(3))
    rows = [(7, a), (7, b), (3, c), (7, changed(r, c, 1)), (9, a), (7, a), (7, a.upper())]
    for _ in range(2):
        rows.reverse()
        kept = corpus_pipeline.near_dedup(spark, make([t for _, t in rows], [i for i, _ in rows]), "").collect()
        found = sorted((d.doc_id, d.text.lower()) for d in kept)
        assert found == sorted([(3, c), (7, a), (7, b)])


def test_pairs_come_from_simhash():
    """Fingerprints against plain majorities; texts of similarity 0.8 meet in some table, strangers do not stay together."""
    r = np.random.default_rng(4)
    bits = lambda own, k: [(int(h) + (k // 64 + 1) * 0x9E3779B97F4A7C15) % 2**64 for h in own]

    def bit(x, k):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
        x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
        x ^= x >> 31
        return x.to_bytes(8, "little")[k % 64 // 8] >> (7 - k % 8) & 1

    own = r.integers(0, 1 << 64, 600, np.uint64)
    votes = near.votes(own, 150)
    assert votes.tolist() == [sum(2 * bit(x, k) - 1 for x in bits(own, k)) for k in range(150)]
    [print_] = near.fingerprints([own], 4, 20)
    votes = near.votes(own, 128 + 80)
    assert [int(x) % 2**64 for x in print_[:2]] == [sum(int(v > 0) << k for k, v in enumerate(votes[i : i + 64])) for i in (0, 64)]
    for s in range(4):
        part = votes[128 + 20 * s : 148 + 20 * s]
        value = sum(int(v > 0) << k for k, v in enumerate(part))
        unsure = sorted(range(20), key=lambda k: abs(part[k]))[: near.FLIPS]
        want = {s << 48 | value ^ sum(1 << k for k in some) for n in range(near.FLIPS + 1) for some in combinations(unsure, n)}
        assert set(near.places(print_[None])[0, 8 * s : 8 * s + 8].tolist()) == want
    pairs = [r.integers(0, 1 << 64, 2 * 180 - 160, np.uint64) for _ in range(200)]
    a, b = (near.fingerprints([p[at] for p in pairs], *near.layout(100)) for at in (slice(0, 180), slice(20, 200)))
    met = [set(x) & set(y) for x, y in zip(near.places(a).tolist(), near.places(b).tolist(), strict=True)]
    assert sum(map(bool, met)) >= 198
    sketch = np.concatenate((a[:, :2], b[:, :2])).view(np.uint64)
    for n in (3, 200):  # by shifts, and by growing
        some = np.concatenate((sketch[:n], sketch[200 : 200 + n]))
        assert sorted(map(sorted, near._close(np.zeros(2 * n, np.int64), some))) == [[k, n + k] for k in range(n)]


def joined(plan):
    """Rows that each join of a plan that ran has made."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan" or name.endswith("QueryStage"):
        return joined(plan.executedPlan() if name == "AdaptiveSparkPlan" else plan.plan())
    own = [plan.metrics().get("numOutputRows").get().value()] if "Join" in name else []
    return sum((joined(plan.children().apply(i)) for i in range(plan.children().size())), own)


def test_sets_of_a_family_are_not_read_for_each_bucket(spark, make):
    """Texts that meet in many buckets and are not similar enough, and one pair among them that is."""
    r = random.Random(9)
    base = " ".join(f"w{k}" for k in range(200))
    texts = [changed(r, base, 4) for _ in range(150)]
    texts.append(changed(r, texts[70], 1))
    assert groups(texts) == list(range(150))
    docs = make(texts)
    run = near._printed(*near.layout(len(texts)))
    prints = near.settled(docs.select("doc_id", near.version().alias("version"), "text").mapInArrow(run, "doc_id long, version long, node long, n long, print array<long>"))
    links = near.near_links(docs, prints)
    of = {x.node: x.doc_id for x in prints.collect()}
    assert {tuple(sorted((of[a], of[b]))) for a, b in links.collect()} == {(70, 150)}
    rows = joined(links._jdf.queryExecution().executedPlan())
    assert len(rows) >= 2 and sum(rows) < 60 * len(texts)


def test_parities_bound_the_difference():
    """Rows that stay are at least those of which another root of the same lead is similar enough."""
    r = np.random.default_rng(7)
    sets, leads = [], []
    for lead, count in ((1, 1), (2, 40), (3, 100), (4, 2)):
        pool = r.integers(0, 1 << 64, 400, np.uint64)
        for _ in range(count):
            n = r.integers(1, 30) if lead == 4 else r.integers(280, 400)
            sets.append(np.unique(r.choice(pool, n, replace=False)))
            leads.append(lead)
    odd = np.array([near.parities(x) for x in sets]).view(np.uint64)
    size, root = np.array([len(x) for x in sets]), np.arange(len(sets)) // 2
    for a, b in combinations(range(len(sets)), 2):
        apart = int(np.bitwise_count(odd[a] ^ odd[b]).sum())
        assert apart <= len(np.setxor1d(sets[a], sets[b])) and (apart - len(np.setxor1d(sets[a], sets[b]))) % 2 == 0
    similar = lambda a, b: 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))
    want = {x for p in combinations(range(len(sets)), 2) if leads[p[0]] == leads[p[1]] and root[p[0]] != root[p[1]] and similar(*p) for x in p}
    stay = set(np.flatnonzero(near._alive(np.array(leads), root, size, odd)).tolist())
    assert want <= stay and 10 < len(want) and len(stay) < len(sets)
    few = np.array([near.parities(sets[0])] * 30_000 + [near.parities(x) for x in sets[50:52]]).view(np.uint64)  # one large component
    root, size = np.array([1] * 30_000 + [2, 3]), np.array([len(sets[0])] * 30_000 + [len(x) for x in sets[50:52]])
    began = time.process_time()
    assert not near._alive(np.zeros(len(few), np.int64), root, size, few)[:30_000].any() and time.process_time() - began < 2
