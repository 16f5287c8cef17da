import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import similarity as S


def dp(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_lcs():
    r = random.Random(1)
    for _ in range(1500):
        a, b = ("".join(r.choices("abcé ", k=r.randrange(20))) for _ in range(2))
        assert S.lcs(a, b) == dp(a, b)


@pytest.mark.parametrize(
    "a, b, ratio, by_sort, by_set",
    [("", "", 1, 1, 0), ("abc", "", 0, 0, 0), ("acme corp", "corp acme", 8 / 18, 1, 1), ("a b c", "a b", 0.75, 0.75, 1), ("x y", "z w", 2 / 6, 2 / 6, 2 / 6), ("new york mets", "new york yankees", 22 / 29, 22 / 29, 16 / 21)],
)
def test_ratios(spark, a, b, ratio, by_sort, by_set):
    df = spark.createDataFrame([(a, b)] * 2, "a string, b string")
    row = df.select(S.fuzz_ratio("a", "b").alias("r"), S.fuzz_sort("a", "b").alias("s"), S.fuzz_set("a", "b").alias("t"), S.fuzz_ratio_or_zero("a", "b").alias("z")).first()
    assert row.r == pytest.approx(ratio) and row.t == pytest.approx(by_set)
    assert row.s == pytest.approx(S.ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))) and (by_sort != 1 or row.s == 1)
    assert row.z == (0 if not a and not b else pytest.approx(ratio))


def test_sets(spark):
    df = spark.createDataFrame([("", ""), ("a b b", "b c"), (None, "x")], "a string, b string")
    a, b = S.token_set(F.col("a")), S.token_set(F.col("b"))
    assert [tuple(r) for r in df.select(S.jaccard(a, b, 1.0), S.jaccard(a, b, 0.0)).collect()] == [(1.0, 0.0), (1 / 3, 1 / 3), (0.0, 0.0)]


@pytest.mark.parametrize("low, high, symbols", [(0, 5, "abcé "), (0, 70, "abcdefgh é東ß0"), (50, 200, "abcdefgh é東ß0"), (900, 1300, "abcdefgh "), (40, 60, [chr(x) for x in range(0x4E00, 0x6000)])])
def test_many_pairs_at_once(low, high, symbols):
    """Patterns of one word of bits, of several, of too many, and over an alphabet that is too large for one table."""
    r = random.Random(high)
    make = lambda: "".join(r.choices(symbols, k=r.randrange(low, high)))
    a = [make() for _ in range(150)]
    b = [make() if r.random() < 0.6 else x[: len(x) // 2] + make()[:9] + x[len(x) // 2 :] for x in a]
    assert S.lcs_many(a, b).tolist() == [S.lcs(x, y) for x, y in zip(a, b, strict=True)]
    for many, one, empty in ((S._ratios, S.ratio, 1.0), (S._sorted_ratios, S.sorted_ratio, 1.0), (S._set_ratios, S.set_ratio, 0.0)):
        assert many(a, b, empty) == pytest.approx([one(x, y) if x or y else empty for x, y in zip(a, b, strict=True)])
