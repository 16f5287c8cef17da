"""Secret scans by patterns and sliding-window entropy; DataFrame functions alone.

Base kinds (assign, access, hex) are leftmost non-overlapping matches of fixed
patterns; a match's place comes from the lengths of what a split leaves between
matches.  The entropy kind looks at candidate strings of `WINDOW` characters or
more, outside base spans: a window slides over each, Shannon's entropy within a
character class is kept by the change that the arriving and the leaving
character make to their counts, and a string whose best window reaches the
class's threshold is a secret, unless an allow-list pattern fits it.  The text
class looks at the whole string, the hex class at each run of `WINDOW` hex
digits or more in it (that no allow-list pattern fits), so that a prefix hides
no hex secret.  Base spans always stay.

Everything is an expression over one row: no shuffle, no Python.  Work is linear
in a text but for sorts and running sums (n log n in the number of matches):
running sums go by doubling, pieces of a text are cut out of four bytes a
character, and no step copies what an earlier one has gathered.

Defined cases.  Null text: as empty, no spans.  Very long texts, candidates of
any length and any number of matches: as others.  Null doc_id and repeated rows:
a row out for each row in.  Empty table: empty result.  `scan` keeps all other
columns, whatever their names; the column it adds replaces one of equal name.  A
filter on the result is not pushed into the scan.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of their names in results, with pattern and the group and length that a match needs.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = {"assign": (ASSIGN, 2, 6), "access": ("AKIA[A-Z0-9]+", 0, 20), "hex": ("[0-9a-f]{24,}", 0, 24)}
#: A text without any of these has no match of the kind; looked for first, as it is cheaper.
HINTS = {"assign": ("passw", "secret", "token", "key"), "access": ("AKIA",)}
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Class: its characters, and the bits a character that its windows must reach.
CLASSES = {"hex": ("0123456789abcdefABCDEF", 3.0), "text": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.7)}
#: Candidates that are no secrets: numbers, joined words, placeholders, runs.
ALLOWED = (r"^[0-9_=/+-]+$", r"^[A-Za-z_=/+-]+$", r"(?i)example|sample|dummy|placeholder|changeme", r"0123456789|abcdefgh", r"(.)\1{5}")
_SPAN = "struct<start: bigint, rank: int, until: bigint>"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """body with `name` bound to value, which is made once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _running(values: str, combine: str) -> str:
    """The running combination of an array, by doubling: each pass takes in what stands 1, 2, 4, ... places before.
    combine: of x and {y}, an associative one."""
    step = f"transform(acc, (x, i) -> if(i >= shiftleft(1, k), {combine.format(y='get(acc, i - shiftleft(1, k))')}, x))"
    return _let("v", values, f"aggregate(sequence(0, cast(ceil(log2(size(v) + 1)) as int)), v, (acc, k) -> {step})")


def _matches(text: str, pattern: str, group: int, least: int, rank: int, keep: bool = False) -> str:
    """Places (and, with `keep`, strings) of the matches whose group has `least` characters."""
    p = _quoted(pattern)
    fields = "'start', e - length(get(m.found, k)), 'rank', {}, 'until', e".format(rank) + ", 'found', get(m.found, k)" * keep
    ends = _running("transform(m.found, (f, k) -> cast(length(get(m.gaps, k)) + length(f) as bigint))", "x + {y}")
    places = f"transform({ends}, (e, k) -> if(length(get(m.inner, k)) >= {least}, named_struct({fields}), null))"
    tables = f"named_struct('gaps', split({text}, {p}, -1), 'found', regexp_extract_all({text}, {p}, 0), 'inner', regexp_extract_all({text}, {p}, {group}))"
    return _let("m", tables, f"filter({places}, s -> s is not null)")


def _none(keep: bool = False) -> str:
    return f"cast(array() as array<{_SPAN[:-1] + ', found: string>' if keep else _SPAN}>)"


def _cut(begin: str, end: str) -> str:
    """A piece of the text whose code points stand in `wide`, four bytes each."""
    return f"decode(substring(wide, cast({begin} as int) * 4 + 1, cast({end} - {begin} as int) * 4), 'UTF-32')"


def _blocks(spans: str) -> str:
    """Spans in order -> what they cover, as (start, until) in order, those that overlap as one."""
    first = "filter(sequence(0, size(b) - 1), i -> coalesce(get(b, i).start >= get(reach, i - 1), true))"
    block = "named_struct('start', get(b, i).start, 'until', get(reach, coalesce(get(firsts, j + 1), size(b)) - 1))"
    found = _let("reach", _running("transform(b, x -> x.until)", "greatest(x, {y})"), _let("firsts", first, f"transform(firsts, (i, j) -> {block})"))
    return _let("b", spans, f"if(size(b) = 0, cast(array() as array<struct<start: bigint, until: bigint>>), {found})")


def _replaced(blocks: str, text: str, by: str) -> str:
    """The text with each block (an x) replaced by the string `by`."""
    pieces = f"transform(c, (x, j) -> concat({_cut('coalesce(get(c, j - 1).until, 0)', 'x.start')}, {by}))"
    rest = _cut("get(c, size(c) - 1).until", f"length({text})")
    return _let("c", blocks, f"if(size(c) = 0, {text}, {_let('wide', f"encode({text}, 'UTF-32')", f"concat(array_join({pieces}, ''), {rest})")})")


def _term(n: int) -> float:
    return n * log2(n) if n else 0.0


def _entropy(candidate: str) -> str:
    """The best window's entropy of a string, in bits a character.  acc.s is the sum of n log2 n over the counts n of
    the window's characters; one that arrives as the n-th of its kind, or leaves as such, changes it by `part`."""
    part = f"get(array({', '.join(repr(_term(n) - _term(n - 1)) + 'D' for n in range(1, WINDOW + 1))}), {{}} - 1)"
    equal = "size(filter(slice(ch, greatest(1, {}), least({}, {})), y -> y = get(ch, {})))"
    arrives = part.format(equal.format(f"i - {WINDOW - 2}", WINDOW, "i + 1", "i"))
    leaves = part.format(equal.format(f"i - {WINDOW - 1}", WINDOW, WINDOW, f"i - {WINDOW}"))
    change = f"({arrives} - if(i >= {WINDOW}, {leaves}, 0D))"
    step = _let("now", f"acc.s + {change}", f"named_struct('s', now, 'least', if(i >= {WINDOW - 1}, least(acc.least, now), acc.least))")
    best = f"acc -> log2({WINDOW}) - acc.least / {WINDOW}"
    return _let("ch", f"split({candidate}, '')", f"aggregate(sequence(0, length({candidate}) - 1), named_struct('s', 0D, 'least', 1000D), (acc, i) -> {step}, {best})")


def scan(docs: DataFrame) -> DataFrame:
    """Adds spans: array<struct<start, rank, until>> in order; the rank tells the kind: assign, access, hex, entropy."""
    d = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce("text", F.lit("")).alias("t"))
    d = d.withColumn("low", F.lower("t"))
    found = []
    for rank, (kind, (pattern, group, least)) in enumerate(KINDS.items()):
        fits = F.expr(f"t rlike {_quoted(pattern)}")
        hint = None
        for x in HINTS.get(kind, ()):
            has = F.contains("low" if x == x.lower() else "t", F.lit(x))
            hint = has if hint is None else hint | has
        found.append(F.when(fits if hint is None else hint & fits, F.expr(_matches("t", pattern, group, least, rank))).otherwise(F.expr(_none())))
    d = d.withColumn("base", F.sort_array(F.concat(*found)))
    # what base spans cover becomes blanks, so that candidates are strings beside them
    some = f"t rlike {_quoted(CANDIDATE)}"
    d = d.withColumn("rest", F.expr(f"if({some}, {_replaced(_blocks('base'), 't', "repeat(' ', cast(x.until - x.start as int))")}, '')"))
    allowed = " or ".join(f"s rlike {_quoted(a)}" for a in ALLOWED)
    hexes = f"s rlike {_quoted('^[0-9a-fA-F]+$')}"
    runs = f"regexp_extract_all(s, {_quoted(f'[0-9a-fA-F]{{{WINDOW},}}')}, 0)"
    hexed = f"exists({runs}, h -> not ({allowed.replace('s rlike', 'h rlike')}) and {_entropy('lower(h)')} >= {CLASSES['hex'][1]}D)"
    loud = f"(not ({allowed}) and ({hexed} or not {hexes} and {_entropy('s')} >= {CLASSES['text'][1]}D))"
    more = f"if(rest rlike {_quoted(CANDIDATE)}, {_matches('rest', CANDIDATE, 0, WINDOW, len(KINDS), True)}, {_none(True)})"
    d = d.withColumn("more", F.expr(f"transform(filter({more}, x -> {_let('s', 'x.found', loud)}), x -> named_struct('start', x.start, 'rank', x.rank, 'until', x.until))"))
    # the result passes through a generator: the optimizer would push a plain filter below every step of it, and
    # write each step out as often as it is used
    made = F.inline_outer(F.array(F.struct(F.sort_array(F.concat("base", "more")).alias("spans"))))
    d = d.select("row", made)
    return d.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "spans"], "spans")


def joined(spans: str) -> Column:
    names = "array(" + ", ".join(f"'{k}'" for k in [*KINDS, "entropy"]) + ")"
    return F.expr(f"array_join(transform({spans}, x -> concat(get({names}, x.rank), ':', x.start, ':', x.until)), ',')")


def redact(docs: DataFrame, mark: str = "[REDACTED]") -> DataFrame:
    """Documents with what the spans of their text cover replaced by `mark`, once for spans that overlap; n_chars
    follows where it is there.  Other columns stay as they are, whatever their names."""
    d = scan(docs.select(F.struct(*docs.columns).alias("row"), F.col("text")))
    own = {c: F.col(f"row.`{c}`") for c in docs.columns}
    hit = F.size("spans") > 0
    own["text"] = F.when(hit, F.expr(_replaced(_blocks("spans"), "text", _quoted(mark)))).otherwise(own["text"])
    if "n_chars" in own:
        own["n_chars"] = F.when(hit, F.length(own["text"]).cast(docs.schema["n_chars"].dataType)).otherwise(own["n_chars"])
    return d.select(*[c.alias(name) for name, c in own.items()])


def op2(docs: DataFrame) -> DataFrame:
    d = scan(docs.select("doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(spans, x -> x.rank = {rank})) as bigint)").alias(f"n_{kind}") for rank, kind in enumerate([*KINDS, "entropy"])]
    base = f"filter(spans, x -> x.rank < {len(KINDS)})"
    return d.select("doc_id", *counts[:3], F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"), counts[3])
