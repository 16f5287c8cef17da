"""Pair features.  Attributes are joined to merged pairs only; ratios of subsequences come last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import similarity as S

USED = ("name_norm", "name_ss", "name_nchar", "addr_norm", "addr_nchar", "street_num", "unit_num", "postal")
#: Token sets, made once for each entity: columns, separators, likeness of two empty ones (names alike, addresses not).
TOKEN_SETS = {"name_tok": (" ", 1.0), "addr_norm": (" ", 0.0), "name_num": (",", 1.0), "addr_num": (",", 0.0)}
SCALAR = (
    "n_exact n_exact_ss n_len_diff n_nchar_ratio a_street_match a_street_conflict a_unit_match a_unit_conflict a_postal_match a_postal_conflict "
    "a_missing_either a_missing_both x_exact_name_street x_rare_street r_tfidf_rank_norm r_tfidf_score r_n_methods n_rare_shared "
    "q_name_nchar t_name_nchar q_addr_nchar t_addr_nchar"
).split()
SETS = "n_jaccard n_common_tokens a_jaccard n_num_jaccard a_num_jaccard x_exact_name_addr".split()
FUZZY = "n_fuzz_ratio n_fuzz_sort n_fuzz_set a_fuzz_ratio".split()
FEATURES = (*SCALAR, *SETS, *FUZZY)


def attach(candidates: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    def side(rows: DataFrame, of: str, s: str) -> DataFrame:
        sets = [S.token_set(F.col(c), sep).alias(f"{s}_{c}_set") for c, (sep, _) in TOKEN_SETS.items()]
        return rows.select(of, *[F.col(c).alias(f"{s}_{c}") for c in USED], *sets)

    return candidates.join(side(queries, "sid", "q"), "sid").join(side(targets, "tid", "t"), "tid")


def _flag(c: Column) -> Column:
    return c.cast("int")


def _agree(name: str) -> tuple[Column, Column]:
    q, t = F.col(f"q_{name}"), F.col(f"t_{name}")
    both = (q != "") & (t != "")
    return _flag(both & (q == t)), _flag(both & (q != t))


def scalar(d: DataFrame, k: int) -> DataFrame:
    q, t = F.col("q_name_nchar"), F.col("t_name_nchar")
    empty = [F.col(f"{s}_addr_norm") == "" for s in "qt"]
    same_name = F.col("q_name_norm") == F.col("t_name_norm")
    same_street = (F.col("q_street_num") != "") & (F.col("q_street_num") == F.col("t_street_num"))
    made = {
        "n_exact": _flag(same_name),
        "n_exact_ss": _flag(F.col("q_name_ss") == F.col("t_name_ss")),
        "n_len_diff": F.abs(q - t) / F.greatest(q, t, F.lit(1)),
        "n_nchar_ratio": F.least(q, t) / F.greatest(q, t, F.lit(1)),
        "a_missing_either": _flag(empty[0] | empty[1]),
        "a_missing_both": _flag(empty[0] & empty[1]),
        "x_exact_name_street": _flag(same_name & same_street),
        "x_rare_street": _flag((F.col("n_rare_shared") > 0) & same_street),
        "r_tfidf_rank_norm": F.when(F.col("tfidf_rank") > 0, (k + 1 - F.col("tfidf_rank")) / (k + 1)).otherwise(0.0),
        "r_tfidf_score": F.coalesce("tfidf_score", F.lit(0.0)),
        "r_n_methods": F.expr("int(e_name) + int(e_ss) + int(rare) + int(addr) + int(tfidf)"),
    }
    for short, name in (("street", "street_num"), ("unit", "unit_num"), ("postal", "postal")):
        made[f"a_{short}_match"], made[f"a_{short}_conflict"] = _agree(name)
    return d.withColumns(made)


def sets(d: DataFrame) -> DataFrame:
    """Likeness of the token sets; each intersection is made once."""
    pair = {c: (F.col(f"q_{c}_set"), F.col(f"t_{c}_set")) for c in TOKEN_SETS}
    d = d.withColumns({f"_{c}": F.size(F.array_intersect(*p)) for c, p in pair.items()})
    like = {c: S.jaccard(*p, TOKEN_SETS[c][1], F.col(f"_{c}")) for c, p in pair.items()}
    d = d.withColumns({"n_jaccard": like["name_tok"], "n_common_tokens": F.col("_name_tok"), "a_jaccard": like["addr_norm"], "n_num_jaccard": like["name_num"], "a_num_jaccard": like["addr_num"]})
    d = d.drop(*[f"_{c}" for c in pair])
    return d.withColumn("x_exact_name_addr", _flag((F.col("q_name_norm") == F.col("t_name_norm")) & (F.col("a_num_jaccard") > 0)))


def fuzzy(d: DataFrame) -> DataFrame:
    name, addr = (F.col("q_name_norm"), F.col("t_name_norm")), (F.col("q_addr_norm"), F.col("t_addr_norm"))
    return d.withColumns({"n_fuzz_ratio": S.fuzz_ratio(*name), "n_fuzz_sort": S.fuzz_sort(*name), "n_fuzz_set": S.fuzz_set(*name), "a_fuzz_ratio": S.fuzz_ratio_or_zero(*addr)})


def pair_features(candidates: DataFrame, queries: DataFrame, targets: DataFrame, k: int) -> DataFrame:
    return fuzzy(sets(scalar(attach(candidates, queries, targets), k)))


def rule_score(d: DataFrame) -> DataFrame:
    """Half of each, to seven places: half of a score of six places has no tie to round."""
    return d.withColumn("score", F.round(0.5 * F.col("n_jaccard") + 0.5 * F.col("r_tfidf_score"), 7))
