import hashlib

from tessera.llm import substring_dedup as module
from tessera.llm.substring_dedup import op1, repeat_levels, substring_dedup


def brute(rows, length):
    """rows: (doc_id, text), unique ids."""
    words = {i: (t or "").encode().split() for i, t in rows}
    first = {}
    for i in sorted(k for k in words if k is not None):
        for s in range(len(words[i]) - length + 1):
            first.setdefault(tuple(words[i][s : s + length]), (i, s))
    out = {}
    for i, w in words.items():
        gone = set()
        for s in range(len(w) - length + 1):
            if i is not None and first[tuple(w[s : s + length])] != (i, s):
                gone.update(range(s, s + length))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def result(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


def test_against_brute_force(make, prose):
    for seed in (1, 2):
        texts = prose(seed=seed)
        want = brute(list(enumerate(texts)), 20)
        assert result(op1(make(texts))) == want
        assert sum(x[1] for x in want.values()) > 500


def test_other_lengths(make, prose):
    texts = prose(seed=3)
    for length in (2, 5, 12):
        assert result(substring_dedup(make(texts), length)) == brute(list(enumerate(texts)), length)


def test_batches_agree(spark, make, prose):
    texts = prose(n=80, seed=4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert result(op1(make(texts))) == brute(list(enumerate(texts)), 20)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_null_id_and_repeated_rows(make):
    text = " ".join(f"w{i}" for i in range(30))
    rows = op1(make([text, text, text, "x " + text], [None, 4, 4, 9])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in rows) == [(0, 0), (4, 0), (4, 0), (9, 30)]


def test_equal_ids_other_texts(make):
    text = " ".join(f"w{i}" for i in range(25))
    rows = op1(make([text, "y " + text], [4, 4])).collect()
    assert sorted((r.n_words, r.n_removed) for r in rows) == [(25, 0), (26, 25)]


def test_empty_table(make, spark):
    assert op1(make([])).count() == 0


def test_long_text(make):
    text = " ".join(f"w{i % 5000}" for i in range(20_000))
    [row] = op1(make([text])).collect()
    assert (row.n_words, row.n_removed) == (20_000, 15_000)


def test_levels(make):
    text = " ".join(f"w{i}" for i in range(50))
    assert repeat_levels(make([text, text])) == [(20, 31), (40, 11), (80, 0)]


def test_small_buckets_agree(make, prose, monkeypatch):
    texts = prose(n=70, seed=13)
    monkeypatch.setattr(module, "BUCKET", 30)
    assert result(op1(make(texts))) == brute(list(enumerate(texts)), 20)


def test_packing_of_windows():
    r = module.np.random.default_rng(1)
    for ids, versions in ((r.integers(-(2**62), 2**62, 50), r.integers(-9, 9, 50)), (r.integers(0, 9, 50), module.np.zeros(50, int))):
        doc = module.np.sort(ids)
        given = (r.integers(0, 2**63, 50).astype(module.np.uint64), r.integers(0, 2**16, 50).astype(module.np.uint16), doc, versions, r.integers(0, 70_000, 50))
        for a, b in zip(given, module._unpacked(module._packed(*given)), strict=True):
            assert (a == b).all()
