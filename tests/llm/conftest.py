import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, version int, fp string, row int, words int"


@pytest.fixture
def make(spark):
    """Documents with columns of clashing names, over several partitions."""

    def build(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", "s", None if t is None else len(t), 7, "x", 1, 2) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    return build


@pytest.fixture
def prose():
    """Random texts over few words, with copies, near copies, shared passages and runs of one word."""

    def build(n=60, seed=1):
        r = random.Random(seed)
        vocabulary = [f"w{i}" for i in range(40)] + ["é", "Ärger", "x|y"]
        passage = " ".join(r.choices(vocabulary, k=30))
        texts = []
        for i in range(n):
            words = r.choices(vocabulary, k=r.choice([0, 1, 3, 19, 20, 21, 45, 120]))
            if i % 4 == 1:
                words[len(words) // 2 : len(words) // 2] = passage.split()
            if i % 7 == 2 and texts:
                words = (r.choice(texts) or "").split()
                if words and r.random() < 0.7:
                    words[r.randrange(len(words))] = "changed"
            if i % 11 == 3:
                words += ["same"] * r.choice([5, 25, 60])
            texts.append(r.choice([" ", "\n", "  ", "\t"]).join(words))
        return texts + [None, "", " \n", texts[5], texts[5], "one", "a\x0bb\x0cc d"]

    return build
