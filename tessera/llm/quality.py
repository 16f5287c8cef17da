"""Quality rules, line by line first, then by document; DataFrame functions alone.

Base figures describe the whole text (`measure`).  Cleaning then judges each
line that holds a word: punctuation (no sentence mark and under `SHORT` words,
or a tenth of it symbols), navigation (three separators or more, one for every
two words), boilerplate (legal phrases in lines of up to `PHRASE_LINE` code
points, site furniture in lines of up to `FURNITURE_LINE` words; whole words
only).  Lines that fail are removed; a document that loses more than `LOSS` of
its words so, or fails the base rule, is rejected.

Everything is an expression over one row: no shuffle, no Python.  Repeats of
three-word windows are found by sorting the 64-bit hashes of a text's windows,
so a long text takes n log n.

Defined cases.  Null or empty text: no words, so rejected by the base rule.
Null doc_id and repeated rows: a row out for each row in.  Empty table: empty
result.  `measure` keeps all other columns, whatever their names; names it adds
replace those of equal name.  A filter on the result is not pushed into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORT, LOSS, PHRASE_LINE, FURNITURE_LINE, LEAST_WORDS = 4, 0.5, 200, 8, 50
#: Phrases of legal notes and of site furniture, in English, German, French and Spanish.
PHRASES = (
    "all rights reserved|terms of (use|service)|privacy policy|cookie policy|uses cookies|enable javascript|licensed under|released under|lorem ipsum|"
    "alle rechte vorbehalten|nutzungsbedingungen|datenschutzerklärung|cookie-richtlinie|verwendet cookies|javascript aktivieren|"
    "tous droits réservés|conditions (générales )?d['’]utilisation|politique de confidentialité|utilise des cookies|activer javascript|"
    "todos los derechos reservados|(términos|condiciones) de uso|política de privacidad|utiliza cookies|habilitar javascript"
)
FURNITURE = (
    "sign (up|in)|log ?in|subscribe|click here|read more|anmelden|registrieren|abonnieren|hier klicken|weiterlesen|"
    "s['’]inscrire|se connecter|s['’]abonner|cliquez ici|lire la suite|regístrate|iniciar sesión|suscríbete|haz clic aquí|leer más"
)
_SPACES = "\t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _SPACES, " " * len(_SPACES)), " ", -1), "")


def _whole(phrases: str) -> str:
    """Phrases that are no part of a longer word, in letters of either case."""
    return rf"(?iu)(^|[^\p{{L}}\p{{N}}])({phrases})($|[^\p{{L}}\p{{N}}])"


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def line_fails(line: Column) -> Column:
    """Of a line that holds a word."""
    symbols = _count(line, "#*$%&<>~^\\{}") * 10 >= F.length(line)
    n = F.size(F.split(line, " "))
    bare = (n < SHORT) & ~line.rlike("[.!?…,;:。！？]")
    bars = _count(line, "|»›•·")
    menu = (bars >= 3) & (2 * bars >= n - bars)
    phrase = (F.length(line) <= PHRASE_LINE) & line.rlike(_whole(PHRASES)) | (n <= FURNITURE_LINE) & line.rlike(_whole(FURNITURE))
    return symbols | bare | menu | phrase


def measure(docs: DataFrame, figures: tuple[str, ...] | None = None) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, cleaned_text, base_failed, kept; or those of
    them that are named."""
    d = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce("text", F.lit("")).alias("t"))
    d = d.withColumns({"w": words(F.col("t")), "l": F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    d = d.withColumn("h", F.expr("case when size(w) > 3 then transform(slice(w, 1, size(w) - 2), (x, i) -> xxhash64(x, get(w, i + 1), get(w, i + 2))) else array() end"))
    d = d.withColumn("s", F.expr("case when size(array_distinct(h)) < size(h) then sort_array(transform(h, (x, i) -> struct(x as h, i as i))) else cast(array() as array<struct<h: bigint, i: int>>) end"))
    d = d.withColumn("p", F.expr("sort_array(transform(filter(s, (x, i) -> coalesce(x.h = get(s, i - 1).h, false) or coalesce(x.h = get(s, i + 1).h, false)), x -> x.i))"))
    d = d.withColumn("k", F.filter("l", lambda x: ~line_fails(x)))
    n = F.size("w").cast("long")
    d = d.withColumns({"n": n, "repeat": F.expr("aggregate(transform(p, (x, i) -> least(3, coalesce(get(p, i + 1) - x, 3))), 0L, (a, x) -> a + x)"), "cleaned": F.array_join("k", "\n")})
    left = F.when(F.size("k") == F.size("l"), F.col("n")).otherwise(F.size(words(F.col("cleaned"))))
    failed = (F.col("n") < LEAST_WORDS) | (100 * F.col("repeat") > 50 * F.col("n"))
    made = {
        "n_words": F.col("n"),
        "word_chars": F.length(F.translate("t", _SPACES + " ", "")).cast("long"),
        "n_symbols": _count(F.col("t"), "#*$%&|<>").cast("long"),
        "n_dup_lines": (F.size("l") - F.size(F.array_distinct("l"))).cast("long"),
        "n_repeat_words": F.col("repeat"),
        "cleaned_text": F.col("cleaned"),
        "base_failed": failed,
        "kept": ~failed & (left >= (1 - LOSS) * F.col("n")),
    }
    made = {name: c for name, c in made.items() if figures is None or name in figures}
    # all figures pass through a generator: the optimizer would push a filter on one of them below every step, and
    # write each step out as often as it is used
    d = d.select("row", F.inline_outer(F.array(F.struct(*[c.alias(name) for name, c in made.items()]))))
    return d.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in made], *made)


def accepted(docs: DataFrame) -> DataFrame:
    """The documents that are kept, as they are."""
    judged = measure(docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text")), ("kept",))
    return judged.where("kept").select("row.*")


def op6(docs: DataFrame) -> DataFrame:
    return measure(docs.select("doc_id", "text")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
