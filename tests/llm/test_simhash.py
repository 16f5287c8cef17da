import random

import pytest
import xxhash

from tessera.llm import simhash
from tessera.llm.components import components
from tessera.llm.simhash import fingerprint, near_components, op4


def plain(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    votes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(v >> k & 1 for v in votes) > len(votes))


def closure(rows, distance=4):
    """rows: (doc_id, fingerprint).  The smallest doc_id reachable of each."""
    rows = list(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if (a ^ b).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, least[find(i)]) for i, (doc, _) in enumerate(rows)]


def test_fingerprint(prose):
    for text in [*prose(seed=5), "A B C", "Éa b", "x" * 50_000]:
        assert fingerprint(text) == plain(text)


def test_op(make, prose):
    texts = prose(seed=6)
    rows = op4(make(texts)).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{plain(t):016x}" for i, t in enumerate(texts)}
    assert dict((r.doc_id, r.component_id) for r in rows) == dict(closure((i, plain(t)) for i, t in enumerate(texts)))


@pytest.mark.parametrize("block, size", [(10**6, 10), (20, 10), (10**6, 1 << 25), (20, 1 << 28), (10**6, 1 << 33)])
def test_links_lose_nothing(spark, block, size, monkeypatch):
    """With the tables of a few fingerprints, and with those of very many."""
    r = random.Random(block)
    monkeypatch.setattr(simhash, "tables", lambda n, of=simhash.tables: of(size))
    prints = []
    for _ in range(60):
        centre = r.getrandbits(64)
        for _ in range(r.choice([1, 2, 12])):
            prints.append(centre)
            for _ in range(r.randrange(6)):
                centre ^= 1 << r.randrange(64)
    dense = r.getrandbits(64)
    prints += [dense ^ 1 << r.randrange(64) ^ 1 << r.randrange(64) ^ 1 << r.randrange(64) for _ in range(250)]
    rows = [(i, p) for i, p in enumerate(prints)]
    df = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in rows], "doc_id long, fp long").repartition(3)
    monkeypatch.setattr(simhash.links, "__defaults__", (block,))
    assert {x.doc_id: x.component_id for x in near_components(df).collect()} == dict(closure(rows))


def test_tables_miss_no_distance():
    """Whatever four bits differ, one table's mask holds at most its radius of them; masks widen with the number."""
    r = random.Random(7)
    widths = []
    for n in (1, 1 << 24, (1 << 24) + 1, 1 << 28, 1 << 31, 1 << 34, 1 << 40):
        made = simhash.tables(n)
        widths.append(min(m.bit_count() for m, _ in made))
        for _ in range(3000):
            differ = sum(1 << b for b in r.sample(range(64), 4))
            assert any((differ & m).bit_count() <= radius for m, radius in made)
    assert widths == sorted(widths) and widths[0] >= 20 and widths[-1] >= 38


def test_null_ids_and_empty(make):
    rows = op4(make(["a b c d e", "a b c d e", None], [None, 3, None])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in rows) == [(-1, -1), (-1, 3), (3, 3)]
    assert op4(make([])).count() == 0


def test_components_of_a_path(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (7, 7)], "a long, b long")
    assert {(r.node, r.root) for r in components(df).collect()} == {(i, 0) for i in range(1, 51)} | {(101, 100)}
