"""Document fingerprints by locally consistent parsing.

A text's bytes are cut into phrases, these into phrases of phrases, and so on.
At each level runs of one symbol become one symbol; deterministic coin tossing
(twice or more: the lowest bit in which a symbol differs from the one before,
and that bit) gives small labels of which neighbours differ; a phrase starts at
each local maximum.  Where a phrase starts depends on a few neighbours only, and
its name is a hash of its content, so equal substrings get equal interior names
at every level, wherever they stand.

Parsing goes on until a text is one phrase.  The fingerprint is a weighted
one-permutation MinHash of the names of all levels, each weighted by the bytes it
covers, and `FADE` times less from one level to the next, as large phrases
survive few edits: `BINS` numbers of 32 bits in hex, zero where a bin is empty.
Likeness is the share of bins that agree, of those that either fills (two empty
texts: 1).

`op8` compares each document with an edit of itself that takes text from the
next document.  Texts are dealt into ranges of doc_id and sorted there, so that
the next document is the next row; the first document of a range also goes, as a
guest, to the end of the range before.  That is one shuffle of the texts.  A
doc_id that many rows share, null among them, gets several ranges, cut by the
hash of the text.  The driver sees a few rows for each range; the first documents
of the ranges, one each, are joined as a small table.

Defined cases.  Null text: as empty.  Very long texts: whole, in memory of one
task.  Null doc_id: after all others.  Equal doc_ids: by the hash of the text.  A
single document is its own next.  Empty table: empty result.  Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import _words as W
from tessera.llm._shared import parts

BINS, FADE = 64, 2
_RUN = np.uint64(0xC2B2AE3D27D4EB4F)


def _toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 2k + bit k of each symbol, k the lowest bit in which it differs from the one before."""
    d = np.empty_like(x)
    d[1:] = x[1:] ^ x[:-1]
    d[:1] = 1
    d[first] = 1
    k = np.bitwise_count(~d & (d - x.dtype.type(1))).astype(np.uint8)
    return 2 * k + ((x >> k.astype(x.dtype)) & x.dtype.type(1)).astype(np.uint8)


def parse(symbols: np.ndarray, names: np.ndarray, weights: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One level: names, weights and offsets of the phrases of the texts names[offsets[d]:offsets[d + 1]].
    symbols: what names stand for, differing where they differ."""
    n = len(names)
    start = np.zeros(n + 1, bool)
    start[offsets] = True
    fresh = start[:-1].copy()
    fresh[1:] |= symbols[1:] != symbols[:-1]
    at = np.flatnonzero(fresh)
    size = np.diff(np.append(at, n))
    symbols, runs = symbols[at], names[at]
    many = size > 1
    runs[many] = W.mix(runs[many] + size[many].astype(np.uint64) * _RUN)
    weights = np.add.reduceat(weights, at) if n else weights
    offsets = np.searchsorted(at, offsets)
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    labels = symbols
    for _ in range(2 if symbols.dtype == np.uint8 else 3):
        labels = _toss(labels, first)
    peak = np.zeros(len(labels), bool)
    if len(labels) > 2:
        peak[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] >= labels[2:])
    peak[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = False  # what follows it is another text
    peak[first] = True
    cut = np.flatnonzero(peak)
    ends = np.append(cut[1:], len(labels))[: len(cut)]
    made = W.span_hashes(runs, cut, ends)
    return made, (np.add.reduceat(weights, cut) if len(cut) else weights), np.searchsorted(cut, offsets)


def sketches(data: np.ndarray, offsets: np.ndarray, bins: int = BINS) -> np.ndarray:
    """A row of `bins` 32-bit numbers for each text data[offsets[d]:offsets[d + 1]]."""
    texts = len(offsets) - 1
    best = np.full(texts * bins, np.iinfo(np.uint64).max, np.uint64)
    symbols, names, weights, doc = data, W._BYTE_CODE[data], np.ones(len(data), np.float32), np.arange(texts)
    scale = np.float32(1)
    while len(names):
        names, weights, offsets = parse(symbols, names, weights, offsets)
        symbols = names
        h = W.mix(names + _RUN)
        draw = -np.log(((h >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) / np.float32(1 << 24)) / (weights * scale)
        rank = draw.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | (names >> np.uint64(32)) | np.uint64(1)
        np.minimum.at(best, np.repeat(doc, np.diff(offsets)) * bins + (h % np.uint64(bins)).astype(np.int64), rank)
        # texts of one phrase are done
        size = np.diff(offsets)
        more = size > 1
        held = np.repeat(more, size)
        names, weights, symbols = names[held], weights[held], symbols[held]
        doc, offsets = doc[more], np.concatenate(([0], np.cumsum(size[more])))
        scale /= np.float32(FADE)
    found = best.astype(np.uint32)
    found[best == np.iinfo(np.uint64).max] = 0
    return found.reshape(texts, bins)


def sketch_texts(texts: list[str]) -> np.ndarray:
    data, offsets = W.texts_of(pa.array(texts, pa.large_string()))
    out = [sketches(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in W.chunks(offsets)]
    return np.concatenate(out) if out else np.empty((0, BINS), np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    filled = ((a > 0) | (b > 0)).sum(1)
    return np.where(filled == 0, 1.0, ((a == b) & (a > 0)).sum(1) / np.maximum(filled, 1))


def as_hex(rows: np.ndarray) -> list[str]:
    return [r.astype(">u4").tobytes().hex() for r in rows]


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = sketch_texts([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(as_hex(rows), pa.string())], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, fingerprint string")


_NAMES = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def _beside_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, guest) come in order; each is compared with the row after it."""
    ids, texts, guests, prints = [], [], [], np.empty((0, BINS), np.uint32)
    for whole in batches:
        for i in range(0, whole.num_rows, 500):
            batch = whole.slice(i, 500)
            new = [t or "" for t in batch.column(1).to_pylist()]
            ids, texts, guests = ids + batch.column(0).to_pylist(), texts + new, guests + batch.column(2).to_pylist()
            prints = np.concatenate((prints, sketch_texts(new)))
            rows = [k for k in range(len(ids) - 1) if not guests[k]]
            edited = []
            for k in rows:
                n = len(texts[k])
                edited.append(texts[k][: n - n // 3] + texts[k + 1][: n // 3])
            own, after, changed = prints[rows], prints[[k + 1 for k in rows]], sketch_texts(edited)
            columns = [
                pa.array([ids[k] for k in rows], batch.column(0).type),
                pa.array([len(texts[k]) for k in rows], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array(as_hex(own), pa.string()),
                pa.array(as_hex(changed), pa.string()),
                pa.array(likeness(own, changed), pa.float64()),
                pa.array(likeness(own, after), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=list(_NAMES))
            ids, texts, guests, prints = ids[-1:], texts[-1:], guests[-1:], prints[-1:]


def _ranges(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray, int]:
    """About n ranges of (doc_id descending, nulls last, hash ascending), as cuts: a row belongs to range k if k cuts
    are at or before it.  A cut is (doc_id, hash); hash None stands before all hashes.  Returns ids, hashes and the
    number of cuts before the documents without doc_id."""
    quantiles = F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], 100 * n)
    known, total, found = docs.agg(F.count("doc_id"), F.count("*"), quantiles).first()
    ids, count = np.unique(np.array(found or [], np.int64), return_counts=True)
    cuts: list[tuple[int, int]] = []
    least = -(1 << 63)
    for i, c in zip(ids[::-1].tolist(), count[::-1].tolist(), strict=True):
        # a doc_id that is several quantiles holds so many n-ths of the rows
        slices = c + 1 if c > 1 else 1
        cuts += [(i, least + (1 << 64) * k // slices) for k in range(slices)]
    nulls = max(1, round(n * (total - known) / max(1, total)))
    return np.array([c[0] for c in cuts], np.int64), np.array([c[1] for c in cuts] + [least + (1 << 64) * k // nulls for k in range(nulls)], np.int64), len(cuts)


def beside_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edit, with their likeness, and that to the next document."""
    n, kind = parts(docs.sparkSession), dict(docs.dtypes)["doc_id"]
    docs = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    ids, hashes, known = _ranges(docs, n)
    first = np.flatnonzero(np.diff(ids, prepend=ids[:1] + 1)) if len(ids) else ids
    last = np.append(first[1:], len(ids))

    @F.pandas_udf("int")
    def range_of(doc_id: pd.Series, h: pd.Series, null: pd.Series) -> pd.Series:
        x, at = doc_id.to_numpy(np.int64), h.to_numpy(np.int64)
        block = len(first) - np.searchsorted(ids[first][::-1], x, "right")  # blocks of larger ids before
        out = np.append(first, len(ids))[block]
        own = np.flatnonzero((block < len(first)) & (ids[first][np.minimum(block, max(0, len(first) - 1))] == x)) if len(first) else []
        for b in np.unique(block[own]) if len(own) else []:
            rows = own[block[own] == b]
            out[rows] = first[b] + np.searchsorted(hashes[first[b] : last[b]], at[rows], "right")
        gone = null.to_numpy(bool)
        out[gone] = known + np.searchsorted(hashes[known:], at[gone], "right")
        return pd.Series(out, dtype="int32")

    docs = docs.withColumn("range", range_of(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "h", F.col("doc_id").isNull()))
    # the first of each range: the largest doc_id, if any, and of that the least hash
    order = F.struct(F.col("doc_id").isNull().alias("no"), (-F.col("doc_id").cast("decimal(20,0)")).alias("id"), F.col("h"))
    heads = sorted(map(tuple, docs.groupBy("range").agg(F.min(order).alias("o")).select("range", F.col("o.id").cast("string"), "o.h").collect()))  # a row for each range
    spread = docs.withColumn("guest", F.lit(False))
    if heads:
        to = [(heads[k - 1][0], None if heads[k][1] is None else -int(heads[k][1]), heads[k][2]) for k in range(len(heads))]
        small = F.broadcast(docs.sparkSession.createDataFrame(to, "to int, id long, head long"))  # a row for each range
        guests = docs.join(small, F.col("doc_id").cast("long").eqNullSafe(F.col("id")) & (F.col("h") == F.col("head")))
        guests = guests.groupBy("to").agg(F.first("doc_id").alias("doc_id"), F.min("text").alias("text"), F.first("h").alias("h"))
        spread = spread.union(guests.select(F.col("doc_id"), "text", "h", F.col("to"), F.lit(True)))
    spread = spread.repartitionById(len(hashes) + 1, F.col("range")).sortWithinPartitions("range", "guest", F.col("doc_id").desc_nulls_last(), "h", "text")
    return spread.select("doc_id", "text", "guest").mapInArrow(_beside_next, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op8(docs: DataFrame) -> DataFrame:
    return beside_next(docs)
