"""Language identification by averaged hashed subword embeddings.

A text is the mean of the embeddings of its byte n-grams (of lower-cased text,
words set off by spaces), hashed into `BUCKETS`; a linear softmax over that mean
gives the language.  Embeddings and softmax are trained together by stochastic
gradient descent in numpy.  A fifth of the sample sets a temperature, so that
the score is a calibrated probability, and the rejection threshold, which all
but `REJECTED` of the right predictions pass.

Training takes a hash sample of at most `SAMPLE` documents for each of the
`LANGUAGES` most frequent values of lang, each up to `LONGEST` bytes long and
`SAMPLE_BYTES` in all (documented bounds), of which the executors send counts of
n-grams, not texts.  Equal rows are sampled once.  The model that predicts is one
table, buckets x languages: embeddings times softmax weights; a text's n-grams
are summed language by language and `_SLICE` bytes at a time.

Defined cases.  Null text, or one without a letter: `und`, score 0.  Very long
texts: predicted whole, in slices.  Equal scores: the first language.  Null lang:
not learned from.  Null doc_id: not held out.  Rows that repeat: a row out for
each row in.  Nothing to learn from: `und` everywhere.  Empty table: empty
result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import _words as W
from tessera.llm._shared import bounded, held_out

#: Bounds of the sample: languages (the most frequent), documents of each, bytes of text in all, bytes of one text.
LANGUAGES, SAMPLE, SAMPLE_BYTES, LONGEST = 256, 1000, 1 << 24, 1 << 18
REJECTED = 0.01
BUCKETS_BITS, GRAMS = 16, (2, 3)
DIMENSIONS, EPOCHS, BATCH, RATE = 16, 6, 16, 4.0
BUCKETS = 1 << BUCKETS_BITS
#: Bytes of text whose n-grams are held at once.
_SLICE = 1 << 19


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # BUCKETS x languages
    bias: np.ndarray
    temperature: float
    threshold: float


def buckets(padded: np.ndarray, k: int) -> np.ndarray:
    """The buckets of all k-grams of bytes (as uint32)."""
    code = padded[: max(0, len(padded) - k + 1)].copy()
    for s in range(1, k):
        code |= padded[s : len(code) + s] << np.uint32(8 * s)
    return (code * np.uint32(0x9E3779B1) + np.uint32(k * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(32 - BUCKETS_BITS)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of each text, and the offsets of texts in them.  Separators count as spaces; a text
    begins and ends with one."""
    n = len(offsets) - 1
    padded = np.full(len(data) + n + 1, 0x20, np.uint32)
    where = np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))
    padded[where] = np.where(W._SEPARATOR[data], 0x20, data)
    # places that a k-gram has too few bytes for hold one over a text's end, of the last space and what follows
    out = [buckets(padded, k) for k in GRAMS]
    starts = offsets[:-1] + np.arange(n)
    sizes = [np.maximum(np.diff(offsets) + 2 - k + 1, 0) for k in GRAMS]
    total = np.add.reduce(sizes)
    at = np.concatenate(([0], np.cumsum(total)))
    found = np.empty(at[-1], np.int64)
    shift = np.zeros(n, np.int64)
    for size, code in zip(sizes, out, strict=True):
        begin = np.cumsum(size) - size
        inside = np.arange(size.sum()) - np.repeat(begin, size)
        found[inside + np.repeat(at[:-1] + shift, size)] = code[inside + np.repeat(starts, size)]
        shift += size
    return found, at


def sums(table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the sum of table rows over its n-grams, and their number; memory is bounded by `_SLICE` and the
    number of texts, not by the longest one.  table: languages x buckets."""
    n = len(offsets) - 1
    out, count = np.zeros((n, len(table))), np.zeros(n)
    for i, j in W.chunks(offsets, _SLICE):
        own = data[offsets[i] : offsets[j]]
        if len(own) <= 2 * _SLICE:
            found, at = grams(own, offsets[i : j + 1] - offsets[i])
            for k, row in enumerate(table):
                out[i:j, k] = np.add.reduceat(row[found], at[:-1], dtype=np.float64)
            count[i:j] = np.diff(at)
            continue
        # one long text: n-grams that start in a slice reach into the next
        width = max(GRAMS)
        for a in range(0, len(own) + 2, _SLICE):
            piece = np.full(min(_SLICE + width - 1, len(own) + 2 - a), 0x20, np.uint8)
            low, high = max(a, 1), min(a + len(piece), len(own) + 1)
            piece[low - a : high - a] = np.where(W._SEPARATOR[own[low - 1 : high - 1]], 0x20, own[low - 1 : high - 1])
            for g in GRAMS:
                found = buckets(piece.astype(np.uint32), g)[:_SLICE]
                out[i] += [row[found].sum(dtype=np.float64) for row in table]
                count[i] += len(found)
    return out, count


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = W.texts_of(batch.column(1))
        for i, j in W.chunks(offsets):
            found, at = grams(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            packed = []
            for a, b in zip(at[:-1], at[1:], strict=True):
                bucket, count = np.unique(found[a:b], return_counts=True)
                packed.append(np.stack([bucket, count]).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(packed, pa.binary())], names=["lang", "counts"])


def sample(docs: DataFrame) -> list[tuple[str, np.ndarray]]:
    pool = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    pool = pool.select("lang", "text")
    sizes = pool.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return []
    share = F.coalesce(*[F.when(F.col("lang") == r.lang, 2 * SAMPLE / r["count"]) for r in sizes])
    chosen = bounded(pool, "text", share, SAMPLE, SAMPLE_BYTES, LONGEST, "lang")
    rows = chosen.select("lang", F.lower("text").alias("text")).mapInArrow(_sampled, "lang string, counts binary").collect()  # bounded: the sample
    return [(lang, np.frombuffer(x, "<i4").reshape(2, -1)) for lang, x in sorted((r.lang, bytes(r.counts)) for r in rows)]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray]], seed: int = 7) -> Model | None:
    languages = sorted({x for x, _ in rows})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    target = np.array([languages.index(x) for x, _ in rows])
    count = max(1, len(rows) // 5) if len(rows) > 1 else 0
    check, learn = order[:count], order[count:]
    embedding = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    weights, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))

    def means(which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        parts = [rows[i][1] for i in which]
        bucket, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(float)
        owner = np.repeat(np.arange(len(parts)), [p.shape[1] for p in parts])
        n /= np.bincount(owner, n, len(parts))[owner]
        first = np.cumsum([0] + [p.shape[1] for p in parts[:-1]])
        return np.add.reduceat(embedding[bucket] * n[:, None], first), bucket, n, owner

    steps, done = EPOCHS * -(-len(learn) // BATCH), 0
    for _ in range(EPOCHS):
        rng.shuffle(learn)
        for k in range(0, len(learn), BATCH):
            which = learn[k : k + BATCH]
            x, bucket, n, owner = means(which)
            slope = _softmax(x @ weights + bias)
            slope[np.arange(len(which)), target[which]] -= 1
            slope /= len(which)
            rate = RATE * (1 - done / steps)
            done += 1
            back = slope @ weights.T
            weights -= rate * (x.T @ slope)
            bias -= rate * slope.sum(0)
            np.add.at(embedding, bucket, -rate * back[owner] * n[:, None])
    temperature, threshold = 1.0, 0.0
    if count:
        z = means(check)[0] @ weights + bias
        right = np.arange(count), target[check]
        loss = {t: -np.log(_softmax(z / t)[right] + 1e-12).mean() for t in np.geomspace(0.05, 20, 60)}
        temperature = float(min(loss, key=loss.get))
        p = _softmax(z / temperature)
        if (ok := p.argmax(1) == target[check]).any():
            threshold = float(np.quantile(p.max(1)[ok], REJECTED))
    return Model(languages, (embedding @ weights).astype(np.float32), bias, temperature, threshold)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score and rejected (the score is below the model's threshold)."""

    table = np.ascontiguousarray(model.table.T) if model else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.texts_of(batch.column(1))
            letters = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            best, top = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            if model and batch.num_rows:
                total, count = sums(table, data, offsets)
                p = _softmax((total / count[:, None] + model.bias) / model.temperature)
                best, top = p.argmax(1), p.max(1)
            known = letters & (model is not None)
            names = [*(model.languages if model else []), "und"]
            lang = pa.array(names).take(pa.array(np.where(known, best, len(names) - 1)))
            top = np.where(known, top, 0.0)
            low = ~known | (top < (model.threshold if model else 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), lang, pa.array(top), pa.array(low)], names=["doc_id", "lang_pred", "score", "rejected"])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("doc_id", F.lower("text").alias("text"), letters.alias("letters")).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double, rejected boolean")


def op10(docs: DataFrame) -> DataFrame:
    rows = predict(docs, fit(sample(docs)))
    return rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
