"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are positives; documents of the same folds, whatever
they are, are unlabelled.  Numpy classifiers, linear in the presence of hashed
words and word prefixes, minimise the class-prior-corrected risk

    prior * E_P[loss(f)] + max(0, E_U[loss(-f)] - prior * E_P[loss(-f)])

with the logistic loss; where the second term falls below zero its gradient is
turned round, so that the classifier cannot earn from calling positives
unlabelled.  A word or prefix gives one feature if it occurs and another if it is
dense: twice or more, and one word in `DENSE` or more.  Features are those that
positives hold clearly more often than unlabelled texts do, all that pass the
test.  `MODELS` classifiers, each on another part of the sample, are averaged.
The prior is the share of toxic labels over all learnable labels.

Training takes a hash sample of at most `POSITIVES` and `UNLABELLED` documents,
each up to `LONGEST` bytes long and `SAMPLE_BYTES` on each side (documented
bounds; everything else covers all rows), of which the executors send feature
numbers, not texts.  Equal rows are sampled once.  The model is a table of fixed
size.  Only the sampled ids, at most `POSITIVES`, are broadcast.

Defined cases.  Null or empty text: the score of a text without features.  Very
long texts: scored whole.  Ties in the test of features: each is judged by
itself, so none is cut.  Null
doc_id: counts as not held out, learned from only if a label has it (none).
Rows that repeat: a row out for each row in.  Several labels of one doc_id: toxic
if one is.  No positive or no text to learn from: score 0 everywhere.  Empty
table: empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import _words as W
from tessera.llm._shared import bounded, held_out, uniform

#: Bounds of the sample: documents of each side, bytes of text of each side, bytes of one text.
POSITIVES, UNLABELLED, SAMPLE_BYTES, LONGEST = 3000, 6000, 1 << 25, 1 << 18
MODELS = 3
HASH_BITS, DENSE = 18, 125
BITS = HASH_BITS + 1
PREFIXES = (4, 5, 6, 7)
_OTHER = np.ones(256, bool)
_OTHER[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def features(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different (document, feature) pairs of lower-cased texts, in order.  wanted: hashes to look at, as a mask."""
    words = W.Words(data, offsets, _OTHER)
    doc, codes, size = words.docs(), W._BYTE_CODE[data], words.ends - words.starts
    pairs = []
    for n in (0, *PREFIXES):
        some = size > n
        starts = words.starts[some]
        h = W.span_hashes(codes, starts, starts + n if n else words.ends[some])
        h = (W.mix(h + np.uint64(n)) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
        of = doc[some]
        if wanted is not None:
            of, h = of[wanted[h]], h[wanted[h]]
        pairs.append(of << HASH_BITS | h)
    pairs, count = np.unique(np.concatenate(pairs), return_counts=True)
    dense = pairs[(count >= 2) & (count * DENSE >= np.diff(words.first)[pairs >> HASH_BITS])]
    found = np.sort(np.concatenate((pairs << 1, dense << 1 | 1)))
    return found >> BITS, found & ((1 << BITS) - 1)


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = W.texts_of(batch.column(1))
        for i, j in W.chunks(offsets):
            doc, feature = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            edges = np.searchsorted(doc, np.arange(j - i + 1))
            packed = [feature[a:b].astype("<i4").tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(packed, pa.binary())], names=["positive", "features"])


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[np.ndarray], list[np.ndarray], float]:
    """Features of positives and of unlabelled documents outside the held-out fold, and the class prior."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    stats = known.agg(F.count("*").alias("n"), F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")).first()
    pool = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = pool.count()
    if not n or not stats.toxic:
        return [], [], 0.0
    # at most POSITIVES ids, so that they can be broadcast; a document of many rows is sampled again by row
    positive = known.where(F.col("toxic") == 1).select("doc_id").orderBy(uniform(F.col("doc_id"), F.lit("p")), "doc_id").limit(POSITIVES)
    sides = (pool.join(F.broadcast(positive), "doc_id", "left_semi"), F.lit(2.0), POSITIVES), (pool, F.lit(2 * UNLABELLED / n), UNLABELLED)
    chosen = [bounded(d, "text", share, most, SAMPLE_BYTES, LONGEST).select(F.lit(k == 0).alias("positive"), F.lower("text").alias("text")) for k, (d, share, most) in enumerate(sides)]
    rows = chosen[0].union(chosen[1]).mapInArrow(_distinct, "positive boolean, features binary").collect()  # bounded: the sample
    packed = sorted((r.positive, bytes(r.features)) for r in rows)
    split = [[np.frombuffer(x, "<i4") for p, x in packed if p == side] for side in (True, False)]
    return split[0], split[1], stats.toxic / stats.n


class Rows:
    """A 0/1 matrix by its rows, sparse: row k has ones in cells[first[k]:first[k + 1]]; the last column is all ones."""

    def __init__(self, rows: list[np.ndarray], place: np.ndarray, width: int):
        kept = [place[r] for r in rows]
        kept = [np.append(c[c >= 0], width - 1) for c in kept]
        self.cells, self.width = np.concatenate(kept), width
        self.first = np.concatenate(([0], np.cumsum([len(c) for c in kept])[:-1]))
        self.of = np.repeat(np.arange(len(kept)), [len(c) for c in kept])

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.add.reduceat(w[self.cells], self.first)

    def transposed(self, y: np.ndarray) -> np.ndarray:
        return np.bincount(self.cells, y[self.of], self.width)


def risk(xp: Rows, xu: Rows, w: np.ndarray, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """prior * E_P[loss(f)] and E_U[loss(-f)] - prior * E_P[loss(-f)], with their slopes; logistic loss."""
    fp, fu = xp.times(w), xu.times(w)
    toxic_p, toxic_u = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
    own = prior * np.logaddexp(0, -fp).mean()
    rest = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
    return own, rest, prior * xp.transposed(toxic_p - 1) / len(fp), xu.transposed(toxic_u) / len(fu) - prior * xp.transposed(toxic_p) / len(fp)


def _counts(rows: list[np.ndarray]) -> np.ndarray:
    return np.bincount(np.concatenate(rows), minlength=1 << BITS) if rows else np.zeros(1 << BITS, np.int64)


def chosen_features(positives: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Those that positives hold clearly more often, in order: every feature that passes the test."""
    np_, nu = len(positives), len(unlabelled)
    in_p, in_u = _counts(positives), _counts(unlabelled)
    p, u = (in_p + 0.5) / (np_ + 1), (in_u + 0.5) / (nu + 1)
    both = (in_p + in_u + 1) / (np_ + nu + 2)
    z = (p - u) / np.sqrt(both * (1 - both) * (1 / np_ + 1 / nu))
    return np.flatnonzero((in_p >= 3) & (z > 4) & (p > 3 * u))


def _fit(positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, rounds: int = 300, rate: float = 0.1, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights of all features (zero for most) and the intercept, by Adam on the non-negative risk."""
    weights = np.zeros(1 << BITS, np.float32)
    if not positives or not unlabelled:
        return weights, -10.0
    chosen = chosen_features(positives, unlabelled)
    place = np.full(1 << BITS, -1)
    place[chosen] = np.arange(len(chosen))
    xp, xu = (Rows(x, place, len(chosen) + 1) for x in (positives, unlabelled))
    w = np.zeros(len(chosen) + 1)
    w[-1] = np.log(prior / (1 - prior)) if prior < 1 else 0.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        _, rest, own_slope, rest_slope = risk(xp, xu, w, prior)
        slope = -rest_slope if rest < 0 else own_slope + rest_slope
        slope = slope + decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights[chosen] = w[:-1]
    return weights, float(w[-1])


def train(docs: DataFrame, labels: DataFrame) -> list[tuple[np.ndarray, float]]:
    positives, unlabelled, prior = sample(docs, labels)
    return [_fit([r for i, r in enumerate(positives) if MODELS == 1 or i % MODELS != k], [r for i, r in enumerate(unlabelled) if MODELS == 1 or i % MODELS != k], prior) for k in range(MODELS)]


def score(docs: DataFrame, models: list[tuple[np.ndarray, float]]) -> DataFrame:
    """doc_id and score, the mean of the models' probabilities."""
    used = np.flatnonzero(np.any([w != 0 for w, _ in models], axis=0))
    table = np.array([w[used] for w, _ in models], np.float64).reshape(len(models), -1)
    base = np.array([b for _, b in models])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, wanted = np.full(1 << BITS, -1), np.zeros(1 << HASH_BITS, bool)
        place[used] = np.arange(len(used))
        wanted[used >> 1] = True
        for batch in batches:
            data, offsets = W.texts_of(batch.column(1))
            out = np.zeros(batch.num_rows)
            for i, j in W.chunks(offsets):
                doc, feature = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], wanted)
                at = place[feature]
                d, f = doc[at >= 0], at[at >= 0]
                margin = np.array([np.bincount(d, t[f], j - i) for t in table]) + base[:, None]
                out[i:j] = (1 / (1 + np.exp(-margin))).mean(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=["doc_id", "score"])

    return docs.select("doc_id", F.lower("text").alias("text")).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def op7(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = score(docs, train(docs, labels))
    return rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
