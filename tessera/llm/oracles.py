"""Queries of this subpackage as DuckDB SQL, written from their definitions; doc_id tells documents apart.

Fingerprints, tokens and models have no SQL form.
"""

from __future__ import annotations

from tessera.llm import quality, secrets, substring_dedup, url_filters

WORD = r"[^\x20\x09-\x0D]+"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


#: All windows by their words; each that is not the first of its kind covers its words.
OP1_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
s AS (SELECT doc_id, p AS s, concat_ws(' ', {", ".join(f"lead(word, {k}) OVER o" for k in range(substring_dedup.LENGTH))}) AS content,
    lead(p, {substring_dedup.LENGTH - 1}) OVER o AS whole FROM each WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
f AS (SELECT doc_id, s, row_number() OVER (PARTITION BY content ORDER BY doc_id, s) AS k FROM s WHERE whole IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, s + unnest(generate_series(0, {substring_dedup.LENGTH - 1})) AS p FROM f WHERE k > 1),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS words FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


#: The contract's kinds, written out: rank, name, pattern, group, least characters of it.
_BASE = (
    (0, "assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    (1, "access", "AKIA[A-Z0-9]+", 0, 20),
    (2, "hex", "[0-9a-f]+", 0, 24),
)


def _found(source: str, rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Matches of a pattern in the column t of a source, with their places."""
    p = _text(pattern)
    return f"""SELECT doc_id, {rank} AS rank, {_text(kind)} AS kind, f[k] AS found,
            list_sum(list_transform(g[:k], lambda x: length(x))) + coalesce(list_sum(list_transform(f[: k - 1], lambda x: length(x))), 0) AS start
        FROM (SELECT doc_id, f, g, i, unnest(generate_series(1, len(f))) AS k FROM
            (SELECT doc_id, regexp_extract_all(t, {p}) AS f, regexp_extract_all(t, {p}, {group}) AS i, string_split_regex(t, {p}) AS g FROM {source}))
        WHERE length(i[k]) >= {least}"""


def _op2() -> str:
    """Candidates lose the characters that base spans cover; what is left of them in one piece is judged."""
    allow = [a for a in secrets.ALLOWED if "\\1" not in a]
    allowed = lambda x: "(" + " OR ".join(f"regexp_matches({x}, {_text(a)})" for a in allow) + f" OR len(list_filter(generate_series(1, length({x}) - 5), lambda i: substr({x}, i, 6) = repeat(substr({x}, i, 1), 6))) > 0)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (SELECT *, start + length(found) AS until FROM ({" UNION ALL ".join(_found("d", *b) for b in _BASE)})),
m AS (SELECT doc_id, start AS run, found FROM ({_found("d", 3, "entropy", "[A-Za-z0-9+/_=-]{20,}", 0, 20)})),
ch AS (SELECT doc_id, run, run + i - 1 AS pos, found[i] AS x FROM (SELECT *, unnest(generate_series(1, length(found))) AS i FROM m)),
bare AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, run ORDER BY pos) AS part FROM ch
    WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = ch.doc_id AND b.start <= ch.pos AND ch.pos < b.until)),
c AS (SELECT doc_id, min(pos) AS start, string_agg(x, '' ORDER BY pos) AS s FROM bare GROUP BY doc_id, run, part HAVING count(*) >= 20),
ok AS (SELECT * FROM c WHERE NOT {allowed("s")}),
h AS (SELECT doc_id, start, unnest(regexp_extract_all(s, '[0-9a-fA-F]{{20,}}')) AS s FROM ok),
judged AS (SELECT row_number() OVER () AS id, * FROM (
    SELECT doc_id, start, s, 3.7 AS least FROM ok WHERE NOT regexp_full_match(s, '[0-9a-fA-F]+') UNION ALL SELECT doc_id, start, lower(s), 3.0 FROM h WHERE NOT {allowed("s")})),
win AS (SELECT id, s, unnest(generate_series(1, length(s) - 19)) AS i FROM judged),
x AS (SELECT id, i, substr(s, i + unnest(generate_series(0, 19)), 1) AS x FROM win),
n AS (SELECT id, i, x, count(*) AS n FROM x GROUP BY ALL),
e AS (SELECT id, i, -sum(n / 20.0 * log2(n / 20.0)) AS bits FROM n GROUP BY ALL),
loud AS (SELECT DISTINCT doc_id, start FROM judged JOIN (SELECT id, max(bits) AS bits FROM e GROUP BY id) USING (id) WHERE bits >= least - 1e-9),
spans AS (SELECT doc_id, rank, kind, start, until FROM base UNION ALL SELECT doc_id, 3, 'entropy', start, start + length(s) FROM c SEMI JOIN loud USING (doc_id, start)),
o AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (kind = 'entropy') AS n_entropy,
    string_agg(concat(kind, ':', start, ':', until), ',' ORDER BY start, rank) FILTER (kind <> 'entropy') AS base, string_agg(concat(kind, ':', start, ':', until), ',' ORDER BY start, rank) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_entropy, 0) AS n_entropy
FROM d LEFT JOIN o USING (doc_id)
"""


OP2_SQL = _op2()


def _count(text: str, characters: str) -> str:
    return f"(length({text}) - length(translate({text}, {_text(characters)}, '')))"


def _op6() -> str:
    whole = r"(?i)(^|[^\p{{L}}\p{{N}}])({})($|[^\p{{L}}\p{{N}}])"
    fails = f"""({_count("x", "#*$%&<>~^" + chr(92) + "{}")} * 10 >= length(x)
        OR len(string_split(x, ' ')) < 4 AND NOT regexp_matches(x, '[.!?…,;:。！？]')
        OR {_count("x", "|»›•·")} >= 3 AND 3 * {_count("x", "|»›•·")} >= len(string_split(x, ' '))
        OR length(x) <= 200 AND regexp_matches(x, {_text(whole.format(quality.PHRASES))})
        OR len(string_split(x, ' ')) <= 8 AND regexp_matches(x, {_text(whole.format(quality.FURNITURE))}))"""
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM documents),
each AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS s FROM d),
s AS (SELECT doc_id, s, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM each WINDOW o AS (PARTITION BY doc_id ORDER BY s)),
c AS (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, x, y, z) AS n FROM s WHERE z IS NOT NULL),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, s + unnest([0, 1, 2]) AS p FROM c WHERE n > 1) GROUP BY doc_id),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, {_count("t", "#*$%&|<>")}::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(regexp_extract_all(array_to_string(list_filter(l, lambda x: NOT {fails}), chr(10)), '{WORD}')) AS n_left FROM d LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND n_left >= 0.5 * n_words AS kept
FROM b
"""


OP6_SQL = _op6()


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1_SQL, "op2_secret_scans": OP2_SQL, "op5_url_filters": url_filters.OP5_SQL, "op6_quality_rules": OP6_SQL}
