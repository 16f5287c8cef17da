"""Packing of token sequences by non-negative least squares.

Documents are tokenised once and cut into full windows and one shorter piece.
The histogram of piece lengths (at most `WINDOW` numbers) is all that the driver
sees.  On it, combinations of up to three lengths that fill a window exactly are
enumerated, and singles that are a power of two, which need no padding; their
repeat counts are the non-negative least-squares solution against the histogram
(accelerated projected gradients), rounded and held to what is there.  Lengths
that are left are packed greedily, the largest first with the largest that
still fit.  The plan says which sequence and offset the k-th piece of a length
gets; pieces learn their k from counts by (length, salt) and a rank within, so
that no length, however frequent, meets in one task.  The plan's size depends on
the window alone.

Defined cases.  Null text: as empty, so the closing id alone.  Very long texts:
cut into windows by the task that reads them, a text at a time.  Lengths that are
equally frequent: in order.  Null doc_id and repeated rows: each row is packed.  Strings of special tokens are ordinary text.
Empty table: empty result.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import _bpe
from tessera.llm._shared import parts, settled

VOCABULARY = "byte_bpe_50k.json"
WINDOW, CLOSING = 1024, 0


def pieces(docs: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: full windows of each document, and the rest."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe.load(path)
        close = np.array([CLOSING], "<u4").tobytes()
        for batch in batches:
            row, start, length, crc, total = [], [], [], [], []
            for k, text in enumerate(batch.column(1)):
                ids = bpe.encode(text.as_py() or "") + close
                n = len(ids) // 4
                for s in range(0, n, window):
                    piece = ids[4 * s : 4 * (s + window)]
                    row.append(k)
                    start.append(s)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).take(pa.array(row, pa.int64())), **{k: pa.array(v, pa.int64()) for k, v in (("start", start), ("length", length), ("ids_crc32", crc), ("doc_tokens", total))}})

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, start long, length long, ids_crc32 long, doc_tokens long")


def combinations(have: np.ndarray, window: int) -> np.ndarray:
    """Rows of three lengths (0: none) that fill the window, or one power of two; only lengths that occur."""
    there = have > 0
    there[0] = False
    lengths = np.flatnonzero(there)
    powers = [x for x in lengths if x & (x - 1) == 0]
    rows = [np.array([[x, 0, 0] for x in powers], np.int64).reshape(-1, 3)]
    low = lengths[2 * lengths <= window]
    low = low[there[window - low] & (low < window)]
    rows.append(np.stack([low, window - low, np.zeros_like(low)], 1))
    for a in lengths[3 * lengths <= window]:
        b = lengths[(lengths >= a) & (2 * lengths <= window - a)]
        b = b[there[window - a - b]]
        rows.append(np.stack([np.full_like(b, a), b, window - a - b], 1))
    return np.concatenate(rows)


def nnls(rows: np.ndarray, have: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeat counts x >= 0 with the least squared distance of the lengths used from the histogram."""
    target, size = have.astype(float), len(have)

    def used(x: np.ndarray) -> np.ndarray:
        out = np.bincount(rows.ravel(), np.repeat(x, 3), size)
        out[0] = 0
        return out

    v = np.ones(len(rows))
    step = 1.0
    for _ in range(20):
        v = used(v)[rows].sum(1)
        step = float(np.linalg.norm(v))
        v /= step
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(rounds):
        slope = (used(y) - target)[rows].sum(1)
        new = np.maximum(0, y - slope / (1.05 * step))
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        x, y = new, new + (before - 1) / t * (new - x)
    return x


def plan(have: np.ndarray, window: int = WINDOW) -> list[tuple[list[tuple[int, int]], int]]:
    """have[l]: pieces of length l.  Returns recipes ([(length, copies in a sequence)], sequences) that use each
    piece once."""
    left, out = have.astype(np.int64).copy(), []
    left[0] = 0
    rows = combinations(left, window)
    if len(rows):
        x = nnls(rows, left)
        for k in np.argsort(-x, kind="stable"):
            lengths, copies = np.unique(rows[k][rows[k] > 0], return_counts=True)
            n = min(int(x[k] + 0.5), int((left[lengths] // copies).min()))
            if n:
                left[lengths] -= n * copies
                out.append((list(zip(lengths.tolist(), copies.tolist(), strict=True)), n))
            elif x[k] < 0.5:
                break
    while (rest := np.flatnonzero(left)).size:
        recipe, room = [(int(rest[-1]), 1)], window - int(rest[-1])
        left[rest[-1]] -= 1
        while room and (rest := np.flatnonzero(left[: room + 1])).size:
            length = int(rest[-1])
            copies = min(room // length, int(left[length]))
            left[length] -= copies
            room -= copies * length
            recipe = [*recipe[:-1], (length, recipe[-1][1] + copies)] if recipe[-1][0] == length else [*recipe, (length, copies)]
        more = min(int(left[length]) // copies for length, copies in recipe)
        for length, copies in recipe:
            left[length] -= more * copies
        out.append((recipe, 1 + more))
    return out


def slots(recipes: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """Sorted rows (length << 40 | first rank, first sequence, offset): ranks from there on fill one place of
    consecutive sequences."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for recipe, n in recipes:
        offset = 0
        for length, copies in recipe:
            for _ in range(copies):
                rows.append((length << 40 | taken.get(length, 0), sequence, offset))
                taken[length] = taken.get(length, 0) + n
                offset += length
        sequence += n
    found = np.array(rows, np.int64).reshape(-1, 3)
    return found[np.argsort(found[:, 0])]


def _place(table: np.ndarray, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("length").to_numpy() << 40 | batch.column("rank").to_numpy()
            at = np.searchsorted(table[:, 0], key, "right") - 1
            made = {"sequence_id": pa.array(table[at, 1] + key - table[at, 0], pa.int64()), "offset": pa.array(table[at, 2], pa.int64())}
            yield pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c) for c in columns], names=columns)

    return run


def pack(docs: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = settled(pieces(docs, window, path))
    salt = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(parts(docs.sparkSession)))
    cut = cut.withColumn("salt", salt)
    counts = cut.groupBy("length", "salt").count()
    have = np.zeros(window + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect():  # at most `window` rows
        have[r.length] = r.n
    table = slots(plan(have, window))
    before = F.coalesce(F.sum("count").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("length", "salt", before.alias("before"))
    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")) - 1
    ranked = cut.withColumn("own", rank).join(counts, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("own"))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    kinds = dict(cut.dtypes)
    return ranked.select(*columns, "rank").mapInArrow(_place(table, [*columns, "sequence_id", "offset"]), ", ".join(f"{c} {kinds[c]}" for c in columns) + ", sequence_id long, offset long")


def op9(docs: DataFrame) -> DataFrame:
    return pack(docs)
