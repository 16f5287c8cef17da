import os
import random

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_quality import brute as measures
from tests.llm.test_secrets import everything


def sentence(r):
    return " ".join("".join(r.choices("abcdefghijklmn", k=r.randrange(2, 9))) for _ in range(12)).capitalize() + "."


@pytest.fixture
def texts():
    r = random.Random(8)
    texts = ["\n".join(sentence(r) for _ in range(r.randrange(6, 14))) for _ in range(40)]
    passage = " ".join(sentence(r) for _ in range(5))
    for i in (3, 9, 15):
        texts[i] += "\n" + passage
    texts[20] = texts[4]
    texts[21] = texts[5].replace(".", ";", 1)
    texts[22] += "\ntoken = " + "'04dbebab91ab85687d33eeaaf9ac699e1188f962' and more."
    texts += [None, "", "too short.", "\n".join(" | ".join(f"m{i}{k}" for k in range(12)) for i in range(9))]
    return texts


def groups(texts, words=5):
    """The places of the texts that stay: the first of each component of Jaccard similarity 0.8 or more."""
    split = [t.lower().split() for t in texts]
    sets = [{tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set() for w in split]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return [i for i in range(len(texts)) if find(i) == i]


def brute(texts):
    docs = {i: t for i, t in enumerate(texts) if t and not measures(t)[5] and "|" not in t}
    stay = groups(list(docs.values()))
    docs = {i: t for k, (i, t) in enumerate(docs.items()) if k in stay}
    seen, out = set(), {}
    for i in sorted(docs):
        words, gone = docs[i].split(), set()
        for s in range(len(words) - 19):
            window = tuple(words[s : s + 20])
            gone |= set(range(s, s + 20)) if window in seen else set()
            seen.add(window)
        text = " ".join(w for k, w in enumerate(words) if k not in gone) if gone else docs[i]
        for a, _, b in reversed(everything(text)):
            text = text[:a] + "[REDACTED]" + text[b:] if not any(x < a < y for x, _, y in everything(text)) else text
        out[i] = text
    return out


def test_stages_and_run(spark, texts, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    want = brute(texts)
    got = {r.doc_id: r.text for r in docs.collect()}
    assert got == want
    assert 20 not in got and "[REDACTED]" in got[22] and 0 < len(got[9]) < len(texts[9])
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(want)
    filled = {}
    for r in packed:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert max(filled.values()) <= 1024 and np.mean(list(filled.values())) > 700


def test_odd_tables(spark, make):
    r = random.Random(1)
    good, other = ("\n".join(sentence(r) for _ in range(12)) for _ in range(2))
    secret = other + "\ntoken = 'abcdef0123' it said."
    stages = dict(corpus_pipeline.STAGES)
    names = make([]).columns
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, make([]), "")
        assert empty.count() == 0 and (name == "packing" or empty.columns == names), name
    docs = make([good, good, None, "", secret, secret, "x"], [None, None, 3, 4, 5, 5, None])
    texts = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    assert texts(stages["quality rules"](spark, docs, "")) == sorted([(None, good), (None, good), (5, secret), (5, secret)], key=str)
    assert texts(stages["near dedup"](spark, docs, "")) == sorted([(None, good), (None, good), (None, "x"), (3, None), (5, secret)], key=str)
    assert texts(stages["substring dedup"](spark, docs, "")) == texts(docs)
    assert [r.text.count("[REDACTED]") for r in stages["secret scans"](spark, docs, "").where("doc_id = 5").collect()] == [1, 1]
    packed = stages["packing"](spark, docs, "").collect()
    assert sum(r.length == 1 and r.doc_id in (3, 4) for r in packed) == 2 and sum(r.start == 0 for r in packed) == 7
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed)


def test_rows_of_one_doc_id_are_not_lost(spark, make):
    """Two texts of one doc_id both stay, unless they are near copies; the same rows for any partitions."""
    r = random.Random(3)
    a, b, c = (" ".join(f"w{r.randrange(3000)}" for _ in range(200)) for _ in range(3))
    near_a = a.replace(a.split()[7], "changed", 1)
    docs = make([a, b, near_a, c, c, a], [7, 7, 7, 9, 9, 8])
    want = None
    for n in (1, 4, 23):
        kept = corpus_pipeline.near_dedup(spark, docs.repartition(n), "").collect()
        assert [x.doc_id for x in kept].count(7) == 2 and [x.doc_id for x in kept].count(9) == 1 and len(kept) == 3
        assert want in (None, sorted(map(repr, kept)))
        want = sorted(map(repr, kept))


def test_stage_tables_are_removed(spark, tmp_path):
    from tessera.llm._shared import shared_dir

    r = random.Random(5)
    good = "\n".join(sentence(r) for _ in range(12))
    spark.createDataFrame([(1, good, "en", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 1
    [made] = [x for x in set(os.listdir(folder)) - before if x.startswith("pipeline-")]
    assert os.listdir(f"{folder}/{made}") == [str(len(corpus_pipeline.STAGES) - 1)]


def test_no_local_folder_on_a_cluster():
    from tessera.llm import _shared

    class Cluster:
        """A session of several machines that names no checkpoint folder."""

        def __init__(self, master):
            self.sparkContext = self._jsc = self.conf = self
            self.master = master

        def __getattr__(self, name):
            return {"sc": lambda: self, "getCheckpointDir": lambda: self, "isEmpty": lambda: True, "get": lambda key, default=None: default}[name]

    for master in ("spark://somewhere:7077", "local-cluster[3,2,1024]", "yarn"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            _shared.shared_dir(Cluster(master))
