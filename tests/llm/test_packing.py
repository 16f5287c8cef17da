import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tessera.llm.packing import nnls, op9, pack, plan


def check(rows, texts, window):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    ids = [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]
    got, placed = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.start, r.length))
        placed[r.sequence_id].append((r.offset, r.length))
        want = ids[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
    assert set(got) == set(range(len(texts)))
    for i, x in got.items():
        at = 0
        for start, length in sorted(x):
            assert start == at and length > 0
            at += length
        assert at == len(ids[i])
    for x in placed.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= window


def test_against_the_tokenizer(make, prose):
    texts = prose(n=120, seed=9)
    check(op9(make(texts)).collect(), texts, 1024)
    check(pack(make(texts), window=16).collect(), texts, 16)


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_each_piece_once(seed):
    have = np.zeros(1025, np.int64)
    have[1:] = np.random.default_rng(seed).poisson([0.3, 5, 60, 1][seed], 1024)
    used, tokens, room = np.zeros(1025, np.int64), 0, 0
    for recipe, n in plan(have):
        total = sum(a * b for a, b in recipe)
        assert 0 < total <= 1024 and n > 0
        room += n * (total if total & (total - 1) == 0 else 1024)
        tokens += n * total
        for length, copies in recipe:
            used[length] += n * copies
    assert (used == have).all()
    assert room <= [1.05, 1.01, 1.01, 1.03][seed] * tokens


@pytest.mark.parametrize("count", [1, 7])
def test_lengths_that_are_equally_frequent(count):
    """Ties in the histogram: the same plan each time, and every piece in it."""
    have = np.full(1025, count, np.int64)
    have[0] = 0
    made = plan(have)
    assert made == plan(have.copy())
    used = np.zeros(1025, np.int64)
    for recipe, n in made:
        assert sum(a * b for a, b in recipe) <= 1024
        for length, copies in recipe:
            used[length] += n * copies
    assert (used == have).all()


def test_long_texts(make, prose):
    r = np.random.default_rng(3)
    words = [w for t in prose(n=20, seed=2) if t for w in t.split()]
    long = " ".join(r.choice(words, 120_000))
    texts = [long, "z" * 100_000, "short", long[:70_000], "\n".join(r.choice(words, 30_000))]
    check(op9(make(texts)).collect(), texts, 1024)


def test_least_squares():
    rows = np.array([[1, 3, 0], [2, 2, 0], [4, 0, 0]])
    assert np.allclose(nnls(rows, np.array([0, 5, 8, 5, 2]), 2000), [5, 4, 2], atol=1e-3)


def test_defined_cases(make):
    assert op9(make([])).count() == 0
    [a, b] = op9(make([None, ""], [None, 3])).collect()
    assert {a.length, b.length, a.doc_tokens} == {1}
    rows = op9(make(["same text"] * 3, [5, 5, 5])).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3
