import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm.fingerprints import _RUN, as_hex, fingerprint, likeness, op8, sketch_texts

MASK = (1 << 64) - 1


def mix(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ x >> shift) * factor) & MASK
    return x ^ x >> 31


def plain_sketch(text, bins=64):
    """Symbol by symbol: runs, three tosses (two for bytes), cuts at local maxima, names by content, until one phrase."""
    raw = text.encode()
    code = [mix((b + 1) * 0xD1342543DE82EF95 & MASK) for b in raw]
    base = 0x9E3779B97F4A7C15 | 1
    level = [(raw[i], code[i], 1) for i in range(len(raw))]
    best, scale, first = [None] * bins, 1.0, True
    while level:
        runs = []
        for symbol, name, weight in level:
            if runs and runs[-1][0] == symbol:
                runs[-1][2] += weight
                runs[-1][3] += 1
            else:
                runs.append([symbol, name, weight, 1])
        for r in runs:
            if r[3] > 1:
                r[1] = mix(r[1] + r[3] * int(_RUN) & MASK)
        labels = [r[0] for r in runs]
        for _ in range(2 if first else 3):
            made = []
            for k, x in enumerate(labels):
                differ = x ^ labels[k - 1] if k else 1  # neighbours differ
                bit = (differ & -differ).bit_length() - 1
                made.append(2 * bit + (x >> bit & 1))
            labels = made
        cuts = [k for k in range(len(runs)) if k == 0 or k < len(runs) - 1 and labels[k] > labels[k - 1] and labels[k] >= labels[k + 1]]
        phrases = []
        for a, b in zip(cuts, [*cuts[1:], len(runs)], strict=True):
            name = mix(sum(runs[k][1] * pow(base, k - a, 1 << 64) for k in range(a, b)) & MASK)
            phrases.append((name, name, sum(r[2] for r in runs[a:b])))
        for _, name, weight in phrases:
            h = mix(name + int(_RUN) & MASK)
            draw = -np.log((np.float32(h >> 40) + np.float32(0.5)) / np.float32(1 << 24)) / (np.float32(weight) * np.float32(scale))
            rank = int(np.float32(draw).view(np.uint32)) << 32 | name >> 32 | 1
            if best[h % bins] is None or rank < best[h % bins]:
                best[h % bins] = rank
        if len(phrases) == 1:
            break
        level, first, scale = phrases, False, scale / 2
    return [0 if x is None else x & 0xFFFFFFFF for x in best]


def test_parsing_against_symbol_by_symbol(prose):
    r = random.Random(9)
    texts = [t for t in prose(n=40, seed=3) if t] + ["", "a", "ab", "aaaa", "abab" * 50, "été" * 9, "".join(r.choices("ab", k=3000)), "".join(chr(r.randrange(32, 1000)) for _ in range(2000))]
    assert sketch_texts(texts).tolist() == [plain_sketch(t) for t in texts]


def brute(rows):
    """rows: (doc_id, text) with different texts for equal ids in order of their hash."""
    hashed = lambda t: (xxhash.xxh64_intdigest((t or "").encode(), 42) ^ 1 << 63) - (1 << 63)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashed(r[1])))
    out = []
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1] or ""
        text = text or ""
        n = len(text)
        edited = text[: n - n // 3] + after[: n // 3]
        own, changed, other = (sketch_texts([t]) for t in (text, edited, after))
        out.append((i, n, hashlib.sha256(edited.encode()).hexdigest(), as_hex(own)[0], as_hex(changed)[0], float(likeness(own, changed)[0]), float(likeness(own, other)[0])))
    return out


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def test_against_brute_force(make, prose, spark):
    texts = prose(n=90, seed=12)
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    want = sorted(brute(list(zip(ids, texts, strict=True))), key=key)
    assert sorted(map(tuple, op8(make(texts, ids)).collect()), key=key) == want
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert sorted(map(tuple, op8(make(texts, ids)).collect()), key=key) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_defined_cases(make):
    assert op8(make([])).count() == 0
    for texts, ids in ((["only one here"], [5]), ([None], [None]), (["a b c", "d e f", "a b c"], [3, 3, 3]), (["aaa bbb", "ccc ddd eee", None], [None, 1, None])):
        assert sorted(map(tuple, op8(make(texts, ids)).collect()), key=key) == sorted(brute(list(zip(ids, texts, strict=True))), key=key)


def test_equal_texts_and_neighbours():
    r = random.Random(4)
    texts = [" ".join("".join(r.choices("abcdefgh", k=r.randrange(1, 9))) for _ in range(n)) for n in (0, 1, 2, 5, 50, 400)]
    alone = np.concatenate([sketch_texts([t]) for t in texts])
    assert (sketch_texts(texts) == alone).all()
    assert (sketch_texts(texts[::-1])[::-1] == alone).all()


def test_shift_keeps_interior_signatures():
    r = random.Random(6)
    text = " ".join("".join(r.choices("abcdefgh", k=r.randrange(1, 9))) for _ in range(800))
    other = " ".join("".join(r.choices("abcdefgh", k=r.randrange(1, 9))) for _ in range(800))
    own = sketch_texts([text])
    for shift in range(1, 9):
        assert likeness(own, sketch_texts(["z" * shift + text]))[0] > 0.9
    assert likeness(own, sketch_texts([text[:3000] + other[3000:]]))[0] > 0.35
    assert likeness(own, sketch_texts([other]))[0] < 0.2
    assert likeness(sketch_texts([""]), sketch_texts([""]))[0] == 1


def test_runs_and_long_texts(make):
    rows = fingerprint(make(["a" * 100_000, "a" * 100_001, "a" * 100_000])).collect()
    got = {r.doc_id: r.fingerprint for r in rows}
    assert got[0] == got[2] != got[1]


@pytest.mark.parametrize("parts", ["2", "16"])
def test_many_rows_of_one_doc_id(make, prose, spark, parts):
    """A third without doc_id, a third of one doc_id; each is dealt over several ranges, in the same order."""
    texts = prose(n=110, seed=13)
    ids = [None if i % 3 == 0 else 50 if i % 3 == 1 else i for i in range(len(texts))]
    want = sorted(brute(list(zip(ids, texts, strict=True))), key=key)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        made = op8(make(texts, ids))
        assert sorted(map(tuple, made.collect()), key=key) == want
        if parts == "16":
            sizes = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
            assert len(sizes) >= 8 and max(sizes) < len(texts) / 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_long_text(make):
    r = random.Random(14)
    long = "".join(r.choices("abcdef \n", k=2_000_000))
    rows = {x.doc_id: x for x in op8(make([long, long, "short"], [3, 2, 1])).collect()}
    assert rows[3].near_next == 1.0 and rows[3].n_chars == 2_000_000 and rows[2].near_next < 0.2 and rows[3].near_edited == 1.0 or rows[3].near_edited > 0.5
