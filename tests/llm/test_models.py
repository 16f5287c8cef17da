import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import _words, language_id, toxicity
from tessera.llm.language_id import op10
from tessera.llm.toxicity import BITS, Rows, _fit, chosen_features, features, op7, risk

LETTERS = {"aa": "aeioubcd", "bb": "äöüßstrk", "cc": "ñáéíllrj"}


def fold(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture
def corpus(spark):
    r = random.Random(5)
    docs, labels = [], []
    for i in range(900):
        lang = r.choice(list(LETTERS))
        words = ["".join(r.choices(LETTERS[lang], k=r.randrange(2, 8))) for _ in range(r.randrange(5, 150))]
        toxic = r.random() < 0.2
        if toxic:
            for _ in range(1 + len(words) // 30):
                words[r.randrange(len(words))] = r.choice(["Vileword,", "nasty!", "awfulness"])
        docs.append((i, " ".join(words), lang, "s", 1, 9))
        if r.random() < 0.7:
            labels.append((i, 1, int(toxic), toxic))
    schema = "doc_id long, text string, lang string, source string, n_chars long, score int"
    return spark.createDataFrame(docs, schema).repartition(3), spark.createDataFrame([x[:3] for x in labels], "doc_id long, quality int, toxic int"), dict((x[0], x[2]) for x in labels), {d[0]: d[2] for d in docs}


def test_toxicity_held_out(corpus):
    docs, labels, truth, _ = corpus
    rows = {r.doc_id: r for r in op7(docs, labels).collect()}
    assert len(rows) == 900 and all(r.held_out == fold(i) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for i, r in rows.items())
    held = [i for i in truth if fold(i)]
    assert sum(rows[i].predicted == truth[i] for i in held) >= 0.95 * len(held)
    again = {r.doc_id: r.score for r in op7(docs.repartition(5), labels.repartition(2)).collect()}
    assert all(abs(again[i] - rows[i].score) < 1e-9 for i in rows)


def test_no_learning_from_held_out(corpus, spark):
    docs, labels, truth, _ = corpus
    flipped = spark.createDataFrame([(i, 1, 1 - t if fold(i) else t) for i, t in truth.items()], "doc_id long, quality int, toxic int")
    a, b = (dict((r.doc_id, r.score) for r in op7(docs, x).collect()) for x in (labels, flipped))
    assert max(abs(a[i] - b[i]) for i in a) < 1e-9


def test_features_against_plain():
    texts = ["one two one two one", "", "alphabet, alphabet", "x" * 5000]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    doc, feature = features(data, offsets)
    # words and prefixes of 4 to 7 bytes, each once by itself and once more if it is dense
    assert [int((doc == d).sum()) for d in range(4)] == [4, 0, 10, 5]
    assert len(set(zip(doc.tolist(), feature.tolist(), strict=True))) == len(doc)


def test_risk_is_not_driven_below_zero():
    positives = [np.array([1, 2])] * 40
    unlabelled = [np.array([1, 2])] * 10 + [np.array([3])] * 90
    weights, base = _fit(positives, unlabelled, 0.1)
    assert weights[1] > 0 and base < 0
    assert 1 / (1 + np.exp(-(weights[1] + weights[2] + base))) > 0.5


def test_toxicity_defined_cases(make, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert op7(make([]), none).count() == 0
    assert [r.predicted for r in op7(make([None, "", "a"], [None, 2, 2]), none).collect()] == [0, 0, 0]
    odd = spark.createDataFrame([(None, 1, 1), (1, None, None), (1, 1, 1), (1, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    assert op7(make(["a", "bad", None]), odd).count() == 3


def test_languages_held_out(corpus):
    docs, _, _, truth = corpus
    rows = {r.doc_id: r for r in op10(docs).collect()}
    held = [i for i in truth if fold(i)]
    assert sum(rows[i].lang_pred == truth[i] for i in held) >= 0.98 * len(held)
    assert all(r.held_out == fold(i) and 0 <= r.score <= 1 for i, r in rows.items())


def test_language_defined_cases(make):
    assert op10(make([])).count() == 0
    rows = op10(make([None, "", "123 !", "word word", "x" * 50_000], [None, 1, 1, 2, 3])).collect()
    assert sorted(r.lang_pred for r in rows) == ["en", "en", "und", "und", "und"]
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")


def test_grams_are_those_of_the_padded_text():
    texts = ["ab", "", "c\td é"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    found, at = language_id.grams(data, offsets)
    alone = [language_id.grams(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0] for t in texts]
    for k, want in enumerate(alone):
        assert (found[at[k] : at[k + 1]] == want).all()
        assert len(want) == 2 * (len(texts[k].encode()) + 2) - 3
    assert toxicity.MODELS == 3


def plain_features(text):
    """Sets of (prefix length or 0, bytes, dense) of a lower-cased text: words are runs of a-z, 0-9 and bytes from 0x80."""
    words = re.findall(rb"[a-z0-9\x80-\xff]+", text.encode())
    count = Counter((n, w[:n] if n else w) for n in (0, 4, 5, 6, 7) for w in words if len(w) > n)
    return {(*x, dense) for x, k in count.items() for dense in (0, 1) if not dense or k >= 2 and k * 125 >= len(words)}


def of_texts(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(t) for t in raw])


def test_features_against_a_plain_set_builder():
    r = random.Random(1)
    texts = [" ".join(r.choices(["nasty", "nastiness", "été", "a", "x1", "longerword", "longerwords", "dog's"], k=r.randrange(300))) for _ in range(40)] + ["", "a" * 9000]
    doc, feature = features(*of_texts(texts))
    got = [set(feature[doc == k].tolist()) for k in range(len(texts))]
    # features have names of their own: each plain one always the same number, different ones different numbers
    name = {}
    for t in sorted({x for t in texts for x in plain_features(t)}):
        alone = [k for k, text in enumerate(texts) if t in plain_features(text)]
        rest = [k for k in range(len(texts)) if k not in alone]
        own = set.intersection(*(got[k] for k in alone)) - set().union(*(got[k] for k in rest))
        assert own, t
        name[t] = own
    assert all(len(got[k]) == len(plain_features(t)) for k, t in enumerate(texts))


def plain_risk(positives, unlabelled, w, base, prior):
    """By a loop: prior * E_P[loss(f)] and E_U[loss(-f)] - prior * E_P[loss(-f)]."""
    f = lambda x: sum(w.get(int(c), 0.0) for c in x) + base
    loss = lambda z: math.log1p(math.exp(-z)) if z > 0 else -z + math.log1p(math.exp(z))
    mean = lambda v: sum(v) / len(v)
    return prior * mean([loss(f(x)) for x in positives]), mean([loss(-f(x)) for x in unlabelled]) - prior * mean([loss(-f(x)) for x in positives])


def test_risk_and_slopes_against_a_loop_and_differences():
    r = random.Random(2)
    chosen = [3, 5, 8, 13]
    rows = lambda n: [np.array(sorted(r.sample(range(16), r.randrange(6))), int) for _ in range(n)]
    p, u = rows(30), rows(70)
    place = np.full(16, -1)
    place[chosen] = range(4)
    xp, xu = Rows(p, place, 5), Rows(u, place, 5)
    for seed in range(5):
        w = np.random.default_rng(seed).normal(size=5)
        named = lambda v: (dict(zip(chosen, v[:4], strict=True)), v[4])
        own, rest, own_slope, rest_slope = risk(xp, xu, w, 0.15)
        assert np.allclose((own, rest), plain_risk(p, u, *named(w), 0.15))
        for k in range(5):
            step = np.eye(5)[k] * 1e-5
            up, down = plain_risk(p, u, *named(w + step), 0.15), plain_risk(p, u, *named(w - step), 0.15)
            assert np.allclose((own_slope[k], rest_slope[k]), [(a - b) / 2e-5 for a, b in zip(up, down, strict=True)], atol=1e-6)


def test_every_feature_that_passes_is_kept():
    """Ties in the test, and more features than any bound."""
    wide = np.arange(9000)
    chosen = chosen_features([wide] * 40, [wide] * 4 + [np.array([9001])] * 200)
    assert (chosen == wide).all()
    weights, _ = _fit([wide] * 40, [wide] * 4 + [np.array([9001])] * 200, 0.1, rounds=20)
    assert len(weights) == 1 << BITS and (weights[:9000] == weights[0]).all() and weights[0] and not weights[9000:].any()


def test_hot_and_long_rows_keep_the_sample_bounded(make, spark, monkeypatch):
    """A third of all rows are one toxic document, and one text is longer than the sample allows."""
    r = random.Random(3)
    texts = ["nasty vile words here"] * 300 + [" ".join(r.choices("abcdefgh", k=20)) for _ in range(600)] + ["nasty " * 100_000]
    ids = [2] * 300 + list(range(3, 603)) + [1002]
    labels = spark.createDataFrame([(i, 1, int(i in (2, 1002))) for i in {*ids}], "doc_id long, quality int, toxic int")
    docs = make(texts, ids)
    positives, unlabelled, _ = toxicity.sample(docs, labels)
    assert len(positives) == 1 and len(unlabelled) <= 602
    assert op7(docs, labels).count() == len(texts)


def plain_grams(text):
    """Byte n-grams of a text set off by spaces."""
    raw = b" " + re.sub(rb"[\x20\x09-\x0d]", b" ", text.encode()) + b" "
    grams = [raw[i : i + k] for k in (2, 3) for i in range(len(raw) - k + 1)]
    place = lambda g: ((int.from_bytes(g, "little") * 0x9E3779B1 + len(g) * 0x85EBCA6B) & 0xFFFFFFFF) >> 16
    return [place(g) for g in grams]


def test_grams_sums_and_softmax_against_plain(monkeypatch):
    r = random.Random(4)
    texts = ["", "a", "été\tdog", *(" ".join(r.choices(["ab", "öß", "c"], k=r.randrange(60))) for _ in range(30)), "long text " * 400]
    found, at = language_id.grams(*of_texts(texts))
    assert [sorted(found[a:b].tolist()) for a, b in zip(at, at[1:], strict=False)] == [sorted(plain_grams(t)) for t in texts]
    table = np.random.default_rng(1).normal(size=(3, language_id.BUCKETS)).astype(np.float32)
    want = [[sum(float(row[g]) for g in plain_grams(t)) for row in table] for t in texts]
    for size in (1 << 19, 1000, 37, 7):
        monkeypatch.setattr(language_id, "_SLICE", size)
        total, count = language_id.sums(table, *of_texts(texts))
        assert np.allclose(total, want, atol=1e-3) and count.tolist() == [len(plain_grams(t)) for t in texts]
    z = [[1.0, 2.0, -3.0], [1000.0, 0.0, 0.0]]
    plain = [[math.exp(x - max(row)) / sum(math.exp(y - max(row)) for y in row) for x in row] for row in z]
    assert np.allclose(language_id._softmax(np.array(z)), plain)


def test_one_step_of_descent_against_plain(monkeypatch):
    """Two documents, one batch, one epoch: embeddings and weights move against the slope of the mean log loss."""
    monkeypatch.setattr(language_id, "EPOCHS", 1)
    rows = [("aa", np.array([[1, 2], [3, 1]], "<i4")), ("bb", np.array([[2, 9], [2, 2]], "<i4")), ("aa", np.array([[1, 9], [1, 1]], "<i4"))]
    model = language_id.fit(rows, seed=3)
    rng = np.random.default_rng(3)
    order = rng.permutation(3)
    embedding = rng.uniform(-1, 1, (language_id.BUCKETS, language_id.DIMENSIONS)) / language_id.DIMENSIONS
    learn = order[1:]  # a fifth, at least one, sets temperature and threshold
    rng.shuffle(learn)
    weights, bias = np.zeros((language_id.DIMENSIONS, 2)), np.zeros(2)
    new_e, new_w, new_b = embedding.copy(), weights.copy(), bias.copy()
    for k in learn:
        lang, counts = rows[k]
        share = counts[1] / counts[1].sum()
        x = sum(s * embedding[b] for b, s in zip(counts[0], share, strict=True))
        z = x @ weights + bias
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        slope = (p - np.array([lang == "aa", lang == "bb"])) / len(learn)
        new_w -= language_id.RATE * np.outer(x, slope)
        new_b -= language_id.RATE * slope
        for b, s in zip(counts[0], share, strict=True):
            new_e[b] -= language_id.RATE * s * (weights @ slope)
    assert np.allclose(model.table, new_e @ new_w, atol=1e-5) and np.allclose(model.bias, new_b)


def test_long_texts_of_both_models(make, spark):
    r = random.Random(6)
    long = " ".join("".join(r.choices("aeioubcd", k=5)) for _ in range(300_000))
    docs = make([long, "short words", long, None, "x"], [1, 2, 3, 4, 6])
    labels = spark.createDataFrame([(2, 1, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")
    scores = {x.doc_id: x.score for x in op7(docs, labels).collect()}
    langs = {x.doc_id: (x.lang_pred, x.score) for x in op10(docs).collect()}
    assert scores[1] == scores[3] and langs[1] == langs[3] and langs[4] == ("und", 0.0)
    assert len(_words._powers) == 0 or max(len(v[0]) for v in _words._powers.values()) <= 4 * _words.CHUNK_BYTES
