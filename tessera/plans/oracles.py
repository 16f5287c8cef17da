"""The queries of queries.py as DuckDB SQL, written from the definitions of the operators."""

from __future__ import annotations

from tessera.functions import text as N
from tessera.operators.evaluate import GRID, RANKS
from tessera.plans.queries import CFG, PER_POS, SEED, THRESHOLD, VAL


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _norm(x: str) -> str:
    folded = f"replace(lower(strip_accents(coalesce({x}, ''))), 'ß', 'ss')"
    return f"trim(regexp_replace(replace(replace({folded}, '&', ' and '), '+', ' plus '), '[^\\p{{L}}\\p{{N}}\\p{{M}}]+', ' ', 'g'))"


def _tokens(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda x: x <> '')"


def _expand(words: str, table: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items())
    return f"list_transform({words}, lambda x: CASE x {whens} ELSE x END)"


def _numbers(x: str) -> str:
    found = f"list_distinct(list_transform(regexp_extract_all({x}, '[0-9]+'), lambda x: regexp_replace(x, '^0+(.)', '\\1')))"
    return f"array_to_string(list_transform(list_sort(list_transform({found}, lambda x: {{'n': len(x), 'x': x}})), lambda s: s.x), ',')"


def _after(words: str, leads: list[str], pattern: str) -> str:
    return f"coalesce(list_filter(list_transform({words}, lambda x, i: CASE WHEN list_contains({_list(leads)}, x) AND regexp_full_match({words}[i + 1], '{pattern}') THEN {words}[i + 1] END), lambda x: x IS NOT NULL)[1], '')"


def _normalised(source: str) -> str:
    """A select that adds the derived columns to a table with name and address."""
    return f"""
  SELECT *, array_to_string(n, ' ') AS name_tok, {_numbers('name_norm')} AS name_num, len(name_norm) AS name_nchar,
         CASE WHEN len(own) = 0 THEN '' ELSE array_to_string(list_slice(n, list_min(own), list_max(own)), ' ') END AS name_ss,
         {_numbers('addr_norm')} AS addr_num, len(addr_norm) AS addr_nchar,
         coalesce(regexp_replace(list_filter(list_slice(raw_a, 1, 3), lambda x: regexp_full_match(x, '[0-9]+'))[1], '^0+(.)', '\\1'), '') AS street_num,
         {_after('a', N.UNIT_WORDS, '[0-9]+')} AS unit_num, {_after('a', N.BUILDING_WORDS, '[A-Za-z0-9]+')} AS bldg_num,
         coalesce(list_filter(a, lambda x: regexp_full_match(x, '[0-9]{{4,6}}'))[1], '') AS postal
  FROM (SELECT *, array_to_string(a, ' ') AS addr_norm,
               list_filter(list_transform(n, lambda x, i: CASE WHEN list_contains({_list(N.LEGAL)}, x) THEN NULL ELSE i END), lambda x: x IS NOT NULL) AS own
        FROM (SELECT *, {_expand(_tokens('name_norm'), N.NAME_WORDS)} AS n, {_expand('raw_a', N.ADDRESS_WORDS)} AS a
              FROM (SELECT *, {_norm('name')} AS name_norm, {_tokens(_norm('address'))} AS raw_a FROM {source})))"""


RAW = r"""
raw AS (
  SELECT doc_id AS entity_id, 1 + doc_id % 3 AS source_no, lang AS country, array_to_string(list_slice(w, 1, 8), ' ') AS name, array_to_string(list_slice(w, 9, 24), ' ') AS address
  FROM (SELECT *, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents))"""
CUSTOMER = """
addresses AS (
  SELECT c_custkey, c_name AS name, lpad(c_custkey::VARCHAR, 5, '0') || ' ' || c_mktsegment || ' Rd, Apt ' || c_nationkey || ' Bldg ' || c_nationkey || 'b' AS address FROM customer)"""
C = f"WITH {CUSTOMER}, c AS ({_normalised('addresses')})"


def _postings(column: str) -> str:
    return f"SELECT country, {column} AS key, tid FROM t WHERE {column} <> '' QUALIFY row_number() OVER (PARTITION BY country, {column} ORDER BY tid) <= {CFG.max_cluster}"


def _jaccard(a: str, b: str, empty: str) -> str:
    return f"CASE WHEN len(list_distinct(list_concat({a}, {b}))) = 0 THEN {empty} ELSE len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) END"


def _set(x: str, separator: str = " ") -> str:
    return f"list_distinct(list_filter(string_split({x}, '{separator}'), lambda x: x <> ''))"


def _scaled(at: int, n: str = "count(*)") -> str:
    """A cut-off of the reference's size, in proportion to the number of targets (half to even)."""
    return f"round_even({at} * ({n} / 272474.0), 0)::BIGINT"


F05 = "CASE WHEN n_true = 0 THEN (n_pred = 0)::INT::DOUBLE WHEN n_pred = 0 OR tp = 0 THEN 0 ELSE 1.25 * (tp / n_pred) * (tp / n_true) / (0.25 * (tp / n_pred) + tp / n_true) END"
TFIDF_TEXT = "list_filter(string_split_regex(trim(name_tok || ' ' || addr_norm), '\\s+'), lambda x: x <> '')"
FLAGS = ("e_name", "e_ss", "rare", "addr", "tfidf")


def _found(name: str, method: str, shared: str = "0", rank: str = "NULL", score: str = "NULL") -> str:
    flags = ", ".join(f"{m == method} AS {m}" for m in FLAGS)
    return f"SELECT sid, tid, {flags}, {shared} AS n_rare_shared, {rank} AS tfidf_rank, {score} AS tfidf_score FROM {name}"


MERGED = "SELECT sid, tid, " + ", ".join(f"bool_or({m}) AS {m}" for m in FLAGS) + ", min(tfidf_rank) AS tfidf_rank, min(tfidf_score) AS tfidf_score, max(n_rare_shared) AS n_rare_shared"
BASE = f"""WITH {RAW},
e AS ({_normalised('raw')}),
q AS (SELECT entity_id AS sid, * FROM e WHERE source_no = 1), t AS (SELECT entity_id AS tid, * FROM e WHERE source_no > 1),
truth AS (
  SELECT DISTINCT a.doc_id AS sid, b.doc_id AS tid FROM documents a JOIN documents b ON a.lang = b.lang AND a.text = b.text WHERE a.doc_id % 3 = 0 AND b.doc_id % 3 > 0),
cut AS (SELECT greatest({CFG.rare_max_df}, {_scaled(10)}) AS rare_max_df, greatest({CFG.addr_max_df}, {_scaled(50)}) AS addr_max_df, greatest({CFG.max_df}, {_scaled(1500)}) AS max_df FROM t),
p_name AS ({_postings('name_norm')}), p_ss AS ({_postings('name_ss')}),
p_addr AS (
  SELECT country, street_num AS key, tid FROM (SELECT *, count(*) OVER (PARTITION BY country, street_num) AS df FROM t WHERE street_num <> '' AND len(street_num) <= 6)
  WHERE df <= (SELECT addr_max_df FROM cut) QUALIFY row_number() OVER (PARTITION BY country, street_num ORDER BY tid) <= {CFG.max_cluster}),
t_words AS (SELECT * FROM (SELECT country, tid, unnest(string_split(name_tok, ' ')) AS key FROM t) WHERE key <> ''),
rare_df AS (SELECT country, key, count(*) AS df FROM t_words GROUP BY ALL HAVING count(*) BETWEEN 2 AND (SELECT rare_max_df FROM cut)),
p_rare AS (SELECT DISTINCT country, key, tid, df FROM t_words JOIN rare_df USING (country, key)),
b_name AS (SELECT sid, tid FROM q JOIN p_name p ON q.country = p.country AND q.name_norm = p.key),
b_ss AS (SELECT sid, tid FROM q JOIN p_ss p ON q.country = p.country AND q.name_ss = p.key),
b_addr AS (SELECT sid, tid FROM q JOIN p_addr p ON q.country = p.country AND q.street_num = p.key AND len(street_num) <= 6),
q_rare AS (
  SELECT sid, country, key FROM (SELECT sid, country, unnest(string_split(name_tok, ' ')) AS key FROM q) JOIN rare_df USING (country, key)
  QUALIFY row_number() OVER (PARTITION BY sid ORDER BY df, key) <= {CFG.rare_tokens}),
b_rare AS (SELECT sid, tid, count(*) AS n_rare_shared FROM q_rare JOIN p_rare USING (country, key) GROUP BY ALL),
joined AS ({MERGED} FROM ({_found('b_name', 'e_name')} UNION ALL {_found('b_ss', 'e_ss')} UNION ALL {_found('b_addr', 'addr')} UNION ALL {_found('b_rare', 'rare', 'n_rare_shared')}) GROUP BY sid, tid),
tf_t AS (SELECT country, tid, token, count(*) AS tf FROM (SELECT country, tid, unnest({TFIDF_TEXT}) AS token FROM t) GROUP BY ALL),
tf_q AS (SELECT country, sid, token, count(*) AS tf FROM (SELECT country, sid, unnest({TFIDF_TEXT}) AS token FROM q) GROUP BY ALL),
vocab AS (
  SELECT v.country, token, df, cf, ln((1 + n)::DOUBLE / (1 + df)) + 1 AS idf
  FROM (SELECT country, token, count(*) AS df, sum(tf) AS cf FROM tf_t GROUP BY ALL) v JOIN (SELECT country, count(*) AS n FROM t GROUP BY ALL) USING (country)
  WHERE df >= {CFG.min_df} AND cf BETWEEN {CFG.min_df} AND (SELECT max_df FROM cut)),
w_t AS (SELECT country, tid, token, w / sqrt(sum(w * w) OVER (PARTITION BY country, tid)) AS w FROM (SELECT country, tid, token, (1 + ln(tf)) * idf AS w FROM tf_t JOIN vocab USING (country, token))),
w_q AS (SELECT country, sid, token, w / sqrt(sum(w * w) OVER (PARTITION BY country, sid)) AS w FROM (SELECT country, sid, token, (1 + ln(tf)) * idf AS w FROM tf_q JOIN vocab USING (country, token))),
topk AS (
  SELECT sid, tid, tfidf_score, row_number() OVER (PARTITION BY sid ORDER BY tfidf_score DESC, tid) AS tfidf_rank
  FROM (SELECT sid, tid, round(sum(w_q.w * w_t.w), 6) AS tfidf_score FROM w_q JOIN w_t USING (country, token) GROUP BY ALL) WHERE tfidf_score > 0
  QUALIFY tfidf_rank <= {CFG.k}),
cand AS ({MERGED} FROM (SELECT * FROM joined UNION ALL BY NAME {_found('topk', 'tfidf', '0', 'tfidf_rank', 'tfidf_score')}) GROUP BY sid, tid),
hits AS (SELECT truth.*, cand.* EXCLUDE (sid, tid), cand.sid IS NOT NULL AS hit FROM truth LEFT JOIN cand USING (sid, tid)),
fold AS (SELECT entity_id, ('0x' || left(md5(entity_id::VARCHAR), 8))::BIGINT % 10000 AS bucket FROM raw WHERE source_no = 1),
val AS (SELECT entity_id AS sid FROM fold WHERE bucket < {round(VAL * 10000)}),
neg AS (
  SELECT cand.sid, cand.tid FROM cand JOIN (SELECT sid, count(*) AS n_pos FROM truth GROUP BY ALL) USING (sid) ANTI JOIN truth ON cand.sid = truth.sid AND cand.tid = truth.tid
  QUALIFY row_number() OVER (PARTITION BY cand.sid ORDER BY (cand.sid * 2654435761 + cand.tid * 40503 + {SEED}) % 1000000007, cand.tid) <= n_pos * {PER_POS}),
pairs AS (SELECT cand.*, q.* EXCLUDE (sid), {', '.join(f't.{c} AS t_{c}' for c in 'name_norm name_ss name_tok name_num name_nchar addr_norm addr_num addr_nchar street_num unit_num postal'.split())} FROM cand JOIN q ON cand.sid = q.sid JOIN t ON cand.tid = t.tid),
setf AS (
  SELECT *, {_jaccard(_set('name_tok'), _set('t_name_tok'), '1.0')} AS n_jaccard, len(list_intersect({_set('name_tok')}, {_set('t_name_tok')})) AS n_common_tokens,
         {_jaccard(_set('addr_norm'), _set('t_addr_norm'), '0.0')} AS a_jaccard, {_jaccard(_set('name_num', ','), _set('t_name_num', ','), '1.0')} AS n_num_jaccard,
         {_jaccard(_set('addr_num', ','), _set('t_addr_num', ','), '0.0')} AS a_num_jaccard FROM pairs),
scored AS (SELECT sid, tid, round(0.5 * n_jaccard + 0.5 * coalesce(tfidf_score, 0), 7) AS score FROM setf),
matched AS (SELECT sid, tid FROM scored WHERE score >= {THRESHOLD}),
grid(threshold) AS (VALUES {', '.join(f'({x}::DOUBLE)' for x in GRID)}),
sweep AS (
  SELECT threshold, round(avg({F05}), 6) AS macro_f05, round(avg(n_pred), 6) AS avg_preds
  FROM (SELECT threshold, val.sid, count(s.tid)::DOUBLE AS n_pred, count(tr.tid)::DOUBLE AS tp, (SELECT count(*) FROM truth x WHERE x.sid = val.sid)::DOUBLE AS n_true
        FROM grid CROSS JOIN val LEFT JOIN scored s ON s.sid = val.sid AND s.score >= threshold LEFT JOIN truth tr ON tr.sid = s.sid AND tr.tid = s.tid GROUP BY ALL)
  GROUP BY threshold),
"""


def _entities(name: str, predicted: str) -> str:
    return f"""{name} AS (
  SELECT *, {F05} AS f05 FROM (
    SELECT q.sid, (SELECT count(*) FROM {predicted} m WHERE m.sid = q.sid)::DOUBLE AS n_pred, (SELECT count(*) FROM truth x WHERE x.sid = q.sid)::DOUBLE AS n_true,
           (SELECT count(*) FROM truth x JOIN {predicted} m USING (sid, tid) WHERE x.sid = q.sid)::DOUBLE AS tp FROM q))"""


BASE += _entities("by_cand", "cand") + ",\n" + _entities("by_match", "matched")
MICRO = """SELECT tp, fp, fn, round(p, 6) AS pair_precision, round(r, 6) AS pair_recall, round(CASE WHEN p + r = 0 THEN 0 ELSE 1.25 * p * r / (0.25 * p + r) END, 6) AS pair_f05
  FROM (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r
        FROM (SELECT coalesce(sum(tp), 0)::BIGINT AS tp, coalesce(sum(n_pred - tp), 0)::BIGINT AS fp, coalesce(sum(n_true - tp), 0)::BIGINT AS fn FROM by_match WHERE n_true > 0))"""


def _lists(found: str) -> str:
    return f"SELECT q.sid, coalesce(string_agg(DISTINCT f.tid::VARCHAR, ',' ORDER BY f.tid::VARCHAR), '') AS matched_entity_ids, count(DISTINCT f.tid) AS n_ids FROM q LEFT JOIN {found} f USING (sid) GROUP BY q.sid"


def _agree(short: str, name: str) -> str:
    both = f"{name} <> '' AND t_{name} <> ''"
    return f"({both} AND {name} = t_{name})::BIGINT AS a_{short}_match, ({both} AND {name} <> t_{name})::BIGINT AS a_{short}_conflict"


SCALAR = f"""SELECT sid, tid, (name_norm = t_name_norm)::BIGINT AS n_exact, (name_ss = t_name_ss)::BIGINT AS n_exact_ss,
  round(abs(name_nchar - t_name_nchar) / greatest(name_nchar, t_name_nchar, 1), 6) AS n_len_diff, round(least(name_nchar, t_name_nchar) / greatest(name_nchar, t_name_nchar, 1), 6) AS n_nchar_ratio,
  {_agree('street', 'street_num')}, {_agree('unit', 'unit_num')}, {_agree('postal', 'postal')},
  (addr_norm = '' OR t_addr_norm = '')::BIGINT AS a_missing_either, (addr_norm = '' AND t_addr_norm = '')::BIGINT AS a_missing_both,
  (name_norm = t_name_norm AND street_num <> '' AND street_num = t_street_num)::BIGINT AS x_exact_name_street,
  (n_rare_shared > 0 AND street_num <> '' AND street_num = t_street_num)::BIGINT AS x_rare_street,
  round(CASE WHEN tfidf_rank > 0 THEN ({CFG.k} + 1 - tfidf_rank) / {CFG.k + 1} ELSE 0 END, 6) AS r_tfidf_rank_norm, round(coalesce(tfidf_score, 0), 6) AS r_tfidf_score,
  (e_name::BIGINT + e_ss::BIGINT + rare::BIGINT + addr::BIGINT + tfidf::BIGINT) AS r_n_methods, n_rare_shared::BIGINT AS n_rare_shared,
  name_nchar::BIGINT AS q_name_nchar, t_name_nchar::BIGINT AS t_name_nchar, addr_nchar::BIGINT AS q_addr_nchar, t_addr_nchar::BIGINT AS t_addr_nchar FROM pairs"""
_CAND = "sid, tid, e_name::BIGINT AS e_name, e_ss::BIGINT AS e_ss, rare::BIGINT AS rare, addr::BIGINT AS addr"
_LEFT = "greatest({}, 1)"



def _left_out() -> str:
    sizes = {
        "name_cluster": ("SELECT country, name_norm AS key FROM t WHERE name_norm <> ''", f"greatest(df - {CFG.max_cluster}, 0)"),
        "ss_cluster": ("SELECT country, name_ss AS key FROM t WHERE name_ss <> ''", f"greatest(df - {CFG.max_cluster}, 0)"),
        "street_too_long": ("SELECT tid AS country, street_num AS key FROM t WHERE len(street_num) > 6", "df"),
        "street_frequent": ("SELECT country, street_num AS key FROM t WHERE street_num <> '' AND len(street_num) <= 6", "CASE WHEN df > (SELECT addr_max_df FROM cut) THEN df ELSE 0 END"),
        "token_single": ("SELECT country, key FROM t_words", "CASE WHEN df < 2 THEN df ELSE 0 END"),
        "token_frequent": ("SELECT country, key FROM t_words", "CASE WHEN df > (SELECT rare_max_df FROM cut) THEN df ELSE 0 END"),
    }
    return " UNION ALL ".join(f"SELECT '{rule}' AS rule, count(*) AS keys, coalesce(sum(over), 0)::BIGINT AS postings FROM (SELECT {over} AS over FROM (SELECT country, key, count(*) AS df FROM ({rows}) GROUP BY ALL)) WHERE over > 0" for rule, (rows, over) in sizes.items())


def _faults() -> str:
    """The faults are told by the last digits of the ids, rule by rule."""
    lists = f", l AS ({_lists('cand')})"
    own = "SELECT sid % 10 AS d, sid, n_ids FROM l"
    counts = {
        "missing_query": "count(*) FILTER (d = 4)",
        "unknown_query": "count(*) FILTER (d = 6)",
        "repeated_query": "count(*) FILTER (d = 5)",
        "repeated_id": "count(*) FILTER (d = 2 AND n_ids > 0) + count(*) FILTER (d = 3) + coalesce(sum(n_ids) FILTER (d = 5), 0)",
        "unknown_id": "count(*) FILTER (d = 1) + 2 * count(*) FILTER (d = 3)",
        "match_not_candidate": "count(*) FILTER (d = 1) + 2 * count(*) FILTER (d = 3) + coalesce(sum(n_ids) FILTER (d = 6), 0)",
    }
    return f"{lists} " + " UNION ALL ".join(f"SELECT '{rule}' AS rule, ({n})::BIGINT AS violations FROM ({own})" for rule, n in counts.items())


def _first(rows: str, n: int) -> str:
    return f"SELECT * FROM ({rows}) ORDER BY md5(entity_id || '-{SEED}'), entity_id LIMIT {n}"


#: The development split: queries with a link, without, with two or more; what they link to, and more of each source.
DEV = f""", known AS (SELECT entity_id, source_no, country, (SELECT count(*) FROM truth WHERE truth.sid = entity_id) AS links FROM raw WHERE source_no = 1),
chosen AS (SELECT DISTINCT entity_id, source_no, country FROM (SELECT * FROM ({_first("SELECT * FROM known WHERE links > 0", 20)})
  UNION ALL SELECT * FROM ({_first("SELECT * FROM known WHERE links = 0", 10)}) UNION ALL SELECT * FROM ({_first("SELECT * FROM known WHERE links >= 2", 5)}))),
linked AS (SELECT entity_id, source_no, country FROM raw WHERE source_no > 1 AND entity_id IN (SELECT tid FROM truth JOIN chosen ON sid = chosen.entity_id)),
rest AS (SELECT entity_id, source_no, country FROM raw WHERE source_no > 1 AND entity_id NOT IN (SELECT entity_id FROM linked)),
others AS (SELECT * FROM linked UNION ALL SELECT * FROM ({_first("SELECT * FROM rest WHERE source_no = 2", 15)}) UNION ALL SELECT * FROM ({_first("SELECT * FROM rest WHERE source_no = 3", 15)}))"""
SELECTS = {
    "norm_name": "SELECT entity_id, name_norm, name_nchar::BIGINT AS name_nchar FROM e",
    "norm_name_suffix_stripped": "SELECT entity_id, name_ss FROM e",
    "norm_name_tokens": "SELECT entity_id, name_tok, name_num FROM e",
    "norm_address": "SELECT entity_id, addr_norm, addr_num, addr_nchar::BIGINT AS addr_nchar, (addr_norm <> '')::BIGINT AS has_addr FROM e",
    "entity_ids": "SELECT entity_id, row_number() OVER (ORDER BY entity_id) - 1 AS id FROM raw WHERE source_no = 1",
    "target_union": "SELECT entity_id AS tid, source_no, country, name FROM raw WHERE source_no > 1",
    "ground_truth_pairs": "SELECT sid, tid FROM truth",
    "stats_name": "SELECT country, key, tid FROM p_name",
    "stats_ss": "SELECT country, key, tid FROM p_ss",
    "stats_rare_token": "SELECT country, key, tid, df FROM p_rare",
    "block_exact_name": "SELECT sid, tid FROM b_name",
    "block_suffix": "SELECT sid, tid FROM b_ss",
    "block_rare": "SELECT sid, tid, n_rare_shared FROM b_rare",
    "candidate_merge": f"SELECT {_CAND}, n_rare_shared::BIGINT AS n_rare_shared FROM joined",
    "tfidf_vocab": "SELECT country, token, df, cf::BIGINT AS cf, round(idf, 6) AS idf FROM vocab",
    "tfidf_weights": "SELECT country, tid, token, round(w, 6) AS w FROM w_t",
    "tfidf_topk": "SELECT sid, tid, tfidf_score, tfidf_rank FROM topk",
    "candidates_all": f"SELECT {_CAND}, tfidf::BIGINT AS tfidf, tfidf_rank::BIGINT AS tfidf_rank, tfidf_score, n_rare_shared::BIGINT AS n_rare_shared FROM cand",
    "recall_report": """SELECT n_true::BIGINT AS truth_pairs, hit::BIGINT AS retrieved_pairs, round(hit / greatest(n_true, 1), 4) AS pair_recall, round(one / greatest(linked, 1), 4) AS coverage_one,
      round(every / greatest(linked, 1), 4) AS coverage_all, round(n_true / greatest(linked, 1), 3) AS mean_truth, round(preds / greatest(n, 1), 2) AS candidates_per_query, (hit / greatest(n_true, 1) >= 0.97)::BIGINT AS gate_pass
      FROM (SELECT count(*) AS n, sum(n_true) AS n_true, sum(tp) AS hit, sum(n_pred) AS preds, count(*) FILTER (n_true > 0) AS linked, count(*) FILTER (n_true > 0 AND tp > 0) AS one, count(*) FILTER (n_true > 0 AND tp = n_true) AS every FROM by_cand)""",
    "recall_by_method": " UNION ALL ".join(f"SELECT '{m}' AS method, count(*) FILTER ({m}) AS hits, round(count(*) FILTER ({m}) / count(*), 4) AS recall FROM hits HAVING count(*) > 0" for m in FLAGS),
    "recall_by_rank": " UNION ALL ".join(f"SELECT {k}::BIGINT AS k, count(*) FILTER (tfidf_rank <= {k}) AS hits, round(count(*) FILTER (tfidf_rank <= {k}) / count(*), 4) AS recall FROM hits HAVING count(*) > 0" for k in RANKS),
    "fold_assign": f"SELECT entity_id, bucket, (bucket < {round(VAL * 10000)})::BIGINT AS is_val FROM fold",
    "fold_summary": f"SELECT count(*) AS n, count(*) FILTER (bucket < {round(VAL * 10000)}) AS n_val, round(count(*) FILTER (bucket < {round(VAL * 10000)}) / count(*), 4) AS fraction FROM fold",
    "train_positives": "SELECT sid, tid, " + ", ".join(f"coalesce({m}, false)::BIGINT AS {m}" for m in FLAGS) + ", coalesce(tfidf_rank, 0)::BIGINT AS tfidf_rank, coalesce(tfidf_score, 0) AS tfidf_score, coalesce(n_rare_shared, 0)::BIGINT AS n_rare_shared FROM hits",
    "train_negatives": "SELECT sid, tid FROM neg",
    "train_pairs": "SELECT sid, tid, label, (sid IN (SELECT sid FROM val))::BIGINT AS is_val FROM (SELECT sid, tid, 1::BIGINT AS label FROM truth UNION ALL SELECT sid, tid, 0 FROM neg)",
    "features_scalar": SCALAR,
    "features_set": "SELECT sid, tid, round(n_jaccard, 6) AS n_jaccard, n_common_tokens::BIGINT AS n_common_tokens, round(a_jaccard, 6) AS a_jaccard, round(n_num_jaccard, 6) AS n_num_jaccard, round(a_num_jaccard, 6) AS a_num_jaccard FROM setf",
    "feature_cross": "SELECT sid, tid, (name_norm = t_name_norm AND a_num_jaccard > 0)::BIGINT AS x_exact_name_addr FROM setf",
    "rule_score": "SELECT sid, tid, score FROM scored",
    "threshold_sweep": "SELECT * FROM sweep",
    "best_threshold": "SELECT * FROM sweep ORDER BY macro_f05 DESC, threshold DESC LIMIT 1",
    "match_lists": _lists("matched"),
    "candidate_lists": _lists("cand"),
    "macro_f05": "SELECT round(avg(f05), 6) AS macro_f05 FROM by_match",
    "pair_metrics": MICRO,
    "submission_score": f"SELECT * FROM (SELECT round(avg(f05), 6) AS macro_f05, count(*) AS n_s1, count(*) FILTER (n_true = 0) AS singletons, count(*) FILTER (n_true = 0 AND n_pred = 0) AS singletons_empty FROM by_match), ({MICRO})",
    "validate_output": "SELECT unnest(['missing_query', 'unknown_query', 'repeated_query', 'repeated_id', 'unknown_id', 'match_not_candidate']) AS rule, 0::BIGINT AS violations",
    "truth_from_lists": "SELECT a.entity_id AS sid, b.entity_id AS tid FROM raw a JOIN raw b ON b.entity_id IN (a.entity_id + 1, a.entity_id + 2) WHERE a.source_no = 1 AND b.source_no > 1",
    "tfidf_kept_index": "SELECT sid, tid, tfidf_score, tfidf_rank FROM topk",
    "cut_postings": _left_out(),
    "validate_faults": _faults(),
    "match_lines": f"SELECT sid::VARCHAR AS source1_entity_id, matched_entity_ids FROM ({_lists('matched')})",
    "entity_lines": "SELECT entity_id::VARCHAR AS entity_id, name AS business_name, address AS business_address, country FROM raw",
    "dev_split": DEV + " SELECT entity_id, source_no, country FROM chosen UNION ALL SELECT entity_id, source_no, country FROM others",
    "dev_split_report": DEV + """, n AS (SELECT entity_id, count(truth.tid) AS n FROM chosen LEFT JOIN truth ON truth.sid = entity_id GROUP BY ALL)
      SELECT 'country' AS what, country AS key, count(*) AS n FROM chosen GROUP BY country UNION ALL SELECT 'n_matches', n::VARCHAR, count(*) FROM n GROUP BY n
      UNION ALL SELECT 'rows', 'source1', count(*) FROM chosen UNION ALL SELECT 'rows', 'source2', count(*) FROM others WHERE source_no = 2
      UNION ALL SELECT 'rows', 'source3', count(*) FROM others WHERE source_no = 3 UNION ALL SELECT 'links', 'all', coalesce(sum(n), 0)::BIGINT FROM n""",
    "dev_sample": f"SELECT entity_id, country FROM raw WHERE source_no = 1 ORDER BY md5(entity_id || '-{SEED}'), entity_id LIMIT 50",
}


#: The address is all that follows the name.
WHOLE = BASE.replace("list_slice(w, 9, 24)", "list_slice(w, 9, len(w))")
WHOLE_SELECTS = {
    "norm_whole": "SELECT entity_id, name_norm, addr_norm, addr_num, addr_nchar::BIGINT AS addr_nchar FROM e",
    "tfidf_vocab_whole": SELECTS["tfidf_vocab"],
    "tfidf_topk_whole": SELECTS["tfidf_topk"],
}


def oracle_sql() -> dict[str, str]:
    found = {name: f"{BASE}\n{select}" for name, select in SELECTS.items()}
    found |= {name: f"{WHOLE}\n{select}" for name, select in WHOLE_SELECTS.items()}
    found["addr_meta"] = C + " SELECT c_custkey, addr_norm, unit_num, bldg_num, postal FROM c"
    found["street_number"] = C + " SELECT c_custkey, street_num FROM c"
    found["number_sets"] = f"SELECT id, {_numbers(_norm('text'))} AS numbers FROM (SELECT 'p' || page_id AS id, url AS text FROM pages UNION ALL SELECT 'c' || c_custkey, c_name FROM customer)"
    streets = """WITH c AS (SELECT c_custkey AS tid, 'x' AS country, trunc(abs(c_acctbal))::BIGINT::VARCHAR AS key FROM customer),
      s AS (SELECT s_suppkey AS sid, 'x' AS country, trunc(abs(s_acctbal))::BIGINT::VARCHAR AS key FROM supplier),
      """
    streets += f"""p AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY country, key) AS df FROM c) WHERE df <= greatest({CFG.addr_max_df}, (SELECT {_scaled(50)} FROM c))
      QUALIFY row_number() OVER (PARTITION BY country, key ORDER BY tid) <= {CFG.max_cluster})"""
    found["stats_addr"] = streets + " SELECT country, key, df, tid FROM p"
    found["block_address"] = streets + " SELECT sid, tid FROM s JOIN p USING (country, key)"
    sizes = {"rare_max_df": 10, "addr_max_df": 50, "max_df": 1500}
    cuts = ", ".join(f"greatest({3 if name == 'max_df' else 2}, {_scaled(at, 'n')}) AS {name}" for name, at in sizes.items())
    counts = " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in "customer documents events lineitem orders part".split())
    found["scaled_cutoffs"] = f"SELECT name, n AS targets, {cuts} FROM ({counts})"
    found["name_cluster_profile"] = f"SELECT cluster_size, count(*) AS clusters, max((cluster_size > 30)::BIGINT) AS over_cap FROM (SELECT {_norm('p_name')} AS k, count(*) AS cluster_size FROM part GROUP BY ALL) GROUP BY cluster_size"
    found["country_consistency"] = "SELECT a.lang AS q_lang, b.lang AS t_lang, count(*) AS links FROM documents a JOIN documents b USING (text) WHERE a.doc_id % 3 = 0 AND b.doc_id % 3 > 0 GROUP BY ALL"
    return found
