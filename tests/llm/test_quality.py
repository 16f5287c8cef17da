import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from tessera.llm.quality import measure, op6


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def test_base_figures(make, prose):
    r = random.Random(10)
    texts = prose(n=80, seed=11) + ["\n".join(r.choices(["a b", " ", "", "a b ", "x|y#$ é😀", "the the the the"], k=30)) for _ in range(20)]
    texts += ["a b c", "a b c a b c", "a a a a", "a b c d a b c", "😀" * 10_000, " ".join(f"w{i % 9000}" for i in range(20_000))]
    got = {r.doc_id: tuple(r)[1:7] for r in op6(make(texts)).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def sentence(r):
    return " ".join(f"w{r.randrange(10_000)}" for _ in range(12)).capitalize() + "."


def test_verdicts(make):
    r = random.Random(1)
    clean = "\n".join(sentence(r) for _ in range(8))
    menu = "\n".join(" | ".join(f"p{r.randrange(10_000)}" for _ in range(12)) for _ in range(9))
    noise = "\n".join(" ".join(f"w{r.randrange(10_000)}&&&" for _ in range(12)) for _ in range(9))
    legal = clean + "\nAll rights reserved.\nLicensed under CC BY-NC 4.0."
    texts = [clean, menu, noise, legal, clean + "\n" + "\n".join(menu.split("\n")[:2]), clean.replace("\n", " "), None, " ".join(f"w{i}" for i in range(60))]
    got = {x.doc_id: x for x in measure(make(texts)).collect()}
    assert [got[i].kept for i in range(8)] == [True, False, False, True, True, True, False, True]
    assert got[3].cleaned_text == clean
    assert got[0].version == 7 and got[0].words == 2


def test_defined_cases(make):
    assert op6(make([])).count() == 0
    assert [(r.n_words, r.base_failed, r.kept) for r in op6(make([None, None, " "], [None, None, 1])).collect()] == [(0, True, False)] * 3


def plain_kept(text):
    """The whole verdict, line by line."""
    n, *_, failed = brute(text)
    phrases = r"all rights reserved|licensed under|alle rechte vorbehalten|tous droits réservés|todos los derechos reservados|uses cookies"
    furniture = r"log ?in|subscribe|read more|anmelden|cliquez ici|leer más"
    whole = lambda x, p: re.search(rf"(?i)(^|[^\w])({p})($|[^\w])", x)
    left = 0
    for line in (text or "").split("\n"):
        words = re.findall(r"[^\x20\x09-\x0D]+", line)
        if not words:
            continue
        parts, bars = line.split(" "), len(re.findall("[|»›•·]", line))
        bad = len(re.findall(r"[#*$%&<>~^\\{}]", line)) * 10 >= len(line) or len(parts) < 4 and not re.search("[.!?…,;:。！？]", line)
        bad = bad or bars >= 3 and 2 * bars >= len(parts) - bars or len(line) <= 200 and whole(line, phrases) or len(parts) <= 8 and whole(line, furniture)
        left += 0 if bad else len(words)
    return not failed and left >= 0.5 * n


def test_phrases_are_whole_words(make):
    r = random.Random(3)
    clean = "\n".join(sentence(r) for _ in range(8))
    lines = ["The catalog in the hall was new.", "A dialog in act three.", "They subscribed to it.", "We log in to the system every day and then subscribe to what is there.", "Log in.", "Please read more.", "Alle Rechte vorbehalten.", "TOUS DROITS RÉSERVÉS", "Todos los derechos reservados.", "Cliquez ici, merci.", "Bitte anmelden.", "xlicensed underx."]
    rows = {x.doc_id: x for x in measure(make([clean + "\n" + line for line in lines])).collect()}
    assert [rows[i].cleaned_text != clean for i in range(len(lines))] == [True, True, True, True, False, False, False, False, False, False, False, True]
    texts = [x * k + "\n" + "\n".join(r.choices(lines, k=r.randrange(30))) for x in (clean, "", sentence(r)) for k in (1, 2) for _ in range(8)]
    assert {x.doc_id: x.kept for x in op6(make(texts)).collect()} == {i: plain_kept(t) for i, t in enumerate(texts)}


def test_filters_cost_no_more_and_columns_stay(make):
    r = random.Random(4)
    texts = ["\n".join(sentence(r) for _ in range(20)) for _ in range(50)] + [None]
    names = ("w", "l", "h", "s", "p", "k", "t", "n", "row", "_w", "_l", "_h", "_s", "_p", "_k")
    docs = make(texts).withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names}).withColumn("kept", F.lit(5))
    rows = measure(docs).collect()
    assert all(x[n] == f"{n}{x.doc_id}" for x in rows for n in names) and {x.kept for x in rows} == {True, False}
    op6(make(texts)).collect()
    began = time.time()
    op6(make(texts)).collect()
    plain = time.time() - began
    began = time.time()
    assert op6(make(texts)).where("kept and n_dup_lines = 0").count() == 50
    assert time.time() - began < 5 * plain + 5
