"""Substring dedup by level-wise doubling.

A window is `length` consecutive words of one document.  Every word covered by a
window whose word sequence also starts earlier (a smaller doc_id, or the same
document and an earlier start) is removed; windows are judged on the input.

Level length/2: windows of half the length are compared first.  Of the half
windows inside each full window only those with the least hash are taken; equal
full windows take equal halves at equal places, so no repeat is missed while one
half window in six is shuffled.  Halves that occur once rule out every full
window whose least half they are.  Level length: the windows that are left are
extended to the full length and compared again, by 80 bits of hash; what repeats
there is removed.  The doubling ends at `length`: a longer repeat is a run of
repeats of that length, so longer levels change no removed word.
(`repeat_levels` goes on doubling until no candidate survives, for reports.)

Hot windows: each batch of documents sends one row for a window, whatever number
of copies it holds, and settles the other copies by itself.  Full windows are
dealt by their own hashes, never by a phrase that many share, into buckets of
about `BUCKET` windows, packed by batch (14 bytes a window).  Texts are shuffled
once, by doc_id; both joins with them share that exchange.

Defined cases.  Null or empty text: no words, empty kept text.  Null doc_id: no
order is defined, so the document takes part in no comparison and loses nothing.
A row repeated with equal doc_id and text: the copies are one document.  Rows of
equal doc_id with other texts: each loses what starts earlier in the other, by
start.  Empty table: empty result.  Other columns are ignored by
`removed_words`, and kept as they are by `substring_dedup`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import _words as W
from tessera.llm._shared import parts, settled

LENGTH = 20
#: Candidate windows that are compared at once.
BUCKET = 1_000_000


def _least_halves(words: W.Words, codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the full windows, the least half hash in each, and the places (word, hash index) of such halves."""
    half = length // 2
    halves = W.windows(codes, half)
    wide = length - half + 1
    least = W.sliding(halves, wide)
    docs = words.docs()
    starts = np.flatnonzero(np.arange(len(least)) + length <= words.first[1:][docs[: len(least)]]) if len(least) else np.empty(0, np.int64)
    floor = np.zeros(len(halves) + wide - 1, np.uint64)
    floor[starts + wide - 1] = least[starts]
    places = np.flatnonzero(W.sliding(floor, wide, np.maximum)[: len(halves)] == halves) if len(starts) else np.empty(0, np.int64)
    return starts, least[starts], places


def _runs(*keys: np.ndarray) -> np.ndarray:
    """True where a row's keys differ from the row before."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _halves(length: int):
    """Level length/2: a row for each half window of a batch with its number of places (one document stands for
    all), and rows with n = 0 for the other documents of the batch that share it, which need no counting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.texts_of(batch.column("text"))
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for i, j in W.chunks(offsets):
                words = W.Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                codes = words.hashes()
                _, _, places = _least_halves(words, codes, length)
                found.append((W.windows(codes, length // 2)[places], i + words.docs()[places]))
            if not found:
                continue
            half, row = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((row, half))
            half, row = half[order], row[order]
            first = _runs(half)
            count = np.diff(np.append(np.flatnonzero(first), len(half)))
            n = np.zeros(len(half), np.int32)
            n[first] = np.minimum(count, 2)
            take = _runs(half, row)
            row = pa.array(row[take])
            yield pa.RecordBatch.from_arrays([pa.array(half.view(np.int64)[take]), batch.column("doc_id").take(row), batch.column("version").take(row), pa.array(n[take])], names=["half", "doc_id", "version", "n"])

    return run


def _packed(full: np.ndarray, check: np.ndarray, doc: np.ndarray, version: np.ndarray, start: np.ndarray) -> bytes:
    """Windows in order of document and start."""
    step = np.diff(doc, prepend=doc[:1]).view(np.uint64)
    kinds = [np.min_scalar_type(int(x.max())) for x in (step, start)]
    versions = version.tobytes() if version.any() else b""
    head = np.array([len(full), doc[0], kinds[0].itemsize, kinds[1].itemsize, len(versions)], np.int64)
    return b"".join([head.tobytes(), full.tobytes(), check.tobytes(), step.astype(kinds[0]).tobytes(), start.astype(kinds[1]).tobytes(), versions])


def _unpacked(blob: bytes) -> tuple[np.ndarray, ...]:
    n, doc, a, b, versions = np.frombuffer(blob, np.int64, 5).tolist()
    out, at = [], 40
    for kind in (np.uint64, np.uint16, f"u{a}", f"u{b}"):
        out.append(np.frombuffer(blob, kind, n, at))
        at += out[-1].nbytes
    version = np.frombuffer(blob, np.int64, n, at) if versions else np.zeros(n, np.int64)
    return out[0], out[1], doc + np.cumsum(out[2].astype(np.uint64)).view(np.int64), version, out[3].astype(np.int64)


def _by_bucket(bucket: np.ndarray, kind: int, columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    """A row for each bucket, with its share of the columns (those of _packed), in order of document and start."""
    order = np.lexsort((columns[4], columns[3], columns[2], bucket))
    bucket, columns = bucket[order], tuple(c[order] for c in columns)
    edges = np.append(np.flatnonzero(_runs(bucket)), len(bucket))
    blobs = [_packed(*(c[a:b] for c in columns)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[edges[:-1]], pa.int32()), pa.array([kind] * len(blobs), pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "kind", "packed"])


def _joined(doc: np.ndarray, version: np.ndarray, start: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of starts, those that touch as one, in order of document."""
    by = np.lexsort((start, version, doc))
    doc, version, start, until = doc[by], version[by], start[by], until[by]
    new = _runs(doc, version)
    new[1:] |= start[1:] > until[:-1] + 1
    at = np.flatnonzero(new)
    return doc[at], version[at], start[at], until[np.append(at[1:], len(new))[: len(at)] - 1]


def _marks(bits: int, doc: np.ndarray, version: np.ndarray, start: np.ndarray, until: np.ndarray) -> pa.RecordBatch:
    """Runs to remove, packed for the bucket of their document."""
    doc, version, start, until = _joined(doc, version, start, until)
    bucket = (W.mix(doc.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
    return _by_bucket(bucket, 1, (until.astype(np.uint64), np.zeros(len(doc), np.uint16), doc, version, start))


_ROW = "bucket int, kind int, packed binary"


def _first_or_later(full: np.ndarray, check: np.ndarray, doc: np.ndarray, version: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """The windows in order of content and place, and whether each has the first place of its content.  (A row of
    equal doc_id and another text can share it.)"""
    order = np.lexsort((version, start, doc, check, full))
    full, check, doc, version, start = (x[order] for x in (full, check, doc, version, start))
    fresh = _runs(full, check)
    lead = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(full) else np.empty(0, np.int64)
    return full, check, doc, version, start, (doc == doc[lead]) & (start == start[lead])


def _full(length: int, bits: int):
    """Level length: for the documents of a batch, the first of each candidate window, packed for one of 2**bits
    buckets, and the runs of later ones, which are repeats whatever other batches hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("doc_id", "version"))
            data, offsets = W.texts_of(batch.column("text"))
            lists = batch.column("halves")
            sizes = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
            known = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            found = []
            for i, j in W.chunks(offsets):
                words = W.Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                codes = words.hashes()
                starts, least, _ = _least_halves(words, codes, length)
                again = np.isin(least, known[sizes[i] : sizes[j]])
                starts, least = starts[again], least[again]
                doc = words.docs()[starts]
                found.append((W.windows(codes, length)[starts], least.astype(np.uint16), i + doc, starts - words.first[doc]))
            if not found:
                continue
            full, check, row, start = (np.concatenate(x) for x in zip(*found, strict=True))
            full, check, doc, version, start, first = _first_or_later(full, check, ids[row], versions[row], start)
            yield _marks(bits, doc[~first], version[~first], start[~first], start[~first])
            first &= _runs(full, check, version)
            bucket = (full[first] >> np.uint64(64 - bits)).astype(np.int64)
            yield _by_bucket(bucket, 0, tuple(c[first] for c in (full, check, doc, version, start)))

    return run


def _buckets(batches: Iterator[pa.RecordBatch], kind: int) -> Iterator[tuple[list[bytes], pa.RecordBatch]]:
    """For rows in order of their bucket: the packed columns of the given kind of each bucket, and other rows."""
    now, held, none = None, [], None
    for batch in batches:
        other = pc.not_equal(batch.column("kind"), kind)
        none = batch.slice(0, 0)
        if pc.any(other).as_py():
            yield [], batch.filter(other)
        for bucket, k, packed in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "packed")), strict=True):
            if k != kind:
                continue
            if bucket != now and held:
                yield held, none
                held = []
            now = bucket
            held.append(packed)
    if held:
        yield held, none


def _compared(bits: int):
    """Rows in order of their bucket: its windows are compared, and what is a repeat is marked; marks pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for held, others in _buckets(batches, 0):
            if others.num_rows:
                yield others
            if held:
                *_, doc, version, start, first = _first_or_later(*(np.concatenate(x) for x in zip(*map(_unpacked, held), strict=True)))
                found.append((doc[~first], version[~first], start[~first]))
                size += len(found[-1][0])
            if size > BUCKET:
                doc, version, start = (np.concatenate(x) for x in zip(*found, strict=True))
                yield _marks(bits, doc, version, start, start)
                found, size = [], 0
        if size:
            doc, version, start = (np.concatenate(x) for x in zip(*found, strict=True))
            yield _marks(bits, doc, version, start, start)

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their bucket: the runs of each of its documents, as first << 32 | last."""
    for held, _ in _buckets(batches, 1):
        until, _, doc, version, start = (np.concatenate(x) for x in zip(*map(_unpacked, held), strict=True))
        doc, version, start, until = _joined(doc, version, start, until.astype(np.int64))
        of = np.flatnonzero(_runs(doc, version))
        runs = pa.ListArray.from_arrays(pa.array(np.append(of, len(doc)).astype(np.int32)), pa.array(start << 32 | until, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(doc[of], pa.int64()), pa.array(version[of], pa.int64()), runs], names=["doc_id", "version", "runs"])


def _texts(docs: DataFrame, rest: bool = False) -> DataFrame:
    """What both joins read, in one form, so that they share an exchange.  version tells texts of equal doc_id apart,
    where there are such.  rest: all columns, as one."""
    again = not docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()
    version = F.xxhash64("text") if again else F.lit(0).cast("long")
    every = [F.struct(*docs.columns).alias("rest")] if rest else []
    return docs.select("doc_id", version.alias("version"), "text", *every)


def removed_words(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Runs of window starts to remove: doc_id, version (of the text), runs: an array of first << 32 | last."""
    return _removed(_texts(docs), length)


def _removed(docs: DataFrame, length: int) -> DataFrame:
    key = ["doc_id", "version"]
    kinds = "doc_id long, version long"
    known = docs.where("doc_id is not null")
    halves = known.select(*key, "text").mapInArrow(_halves(length), f"half long, {kinds}, n int")
    counted = F.sum("n").over(Window.partitionBy(F.when(F.col("n") == 0, F.xxhash64("half", "doc_id")).otherwise(F.col("half"))))
    halves = settled(halves.withColumn("seen", counted).where("n = 0 or seen >= 2").groupBy(*key).agg(F.collect_list("half").alias("halves")))
    windows = (halves.agg(F.sum(F.size("halves"))).first()[0] or 0) * length // 2
    n = parts(docs.sparkSession)
    bits = max(1, (max(windows // BUCKET, 4 * n) - 1).bit_length())
    rows = known.join(halves.hint("shuffle_hash"), key).mapInArrow(_full(length, bits), _ROW)
    rows = rows.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_compared(bits), _ROW)
    rows = rows.repartition(n, "bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(_gathered, f"{kinds}, runs array<long>")


def _with_runs(docs: DataFrame, length: int, rest: bool) -> DataFrame:
    """doc_id, version, text (, rest), runs of each document."""
    rows = _texts(docs, rest)
    gone = _removed(rows, length)
    found = rows.where("doc_id is not null").join(gone.hint("shuffle_hash"), ["doc_id", "version"], "left").select(*rows.columns, "runs")
    return found.union(rows.where("doc_id is null").withColumn("runs", F.lit(None).cast("array<bigint>")))


def kept_words(text: str | None, runs: list[int] | None, length: int) -> tuple[int, list[bytes]]:
    """The number of words of a text, and those that no removed window covers."""
    words = (text or "").encode().split()
    if not runs:
        return len(words), words
    edge = np.zeros(len(words) + 1, np.int64)
    spans = np.array(runs, np.int64)
    np.add.at(edge, spans >> 32, 1)
    np.add.at(edge, (spans & 0xFFFFFFFF) + length, -1)
    return len(words), list(compress(words, np.cumsum(edge)[:-1] == 0))


def _keep(length: int, columns: list[str]):
    """Adds n_words, n_removed and the kept words, joined by one space, to each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept, digests = [], [], [], []
            for text, runs in zip(batch.column("text"), batch.column("runs"), strict=True):
                n, words = kept_words(text.as_py(), runs.as_py(), length)
                total.append(n)
                gone.append(n - len(words))
                joined = b" ".join(words)
                digests.append(hashlib.sha256(joined).hexdigest())
                kept.append(joined.decode() if "kept_text" in columns else None)
            made = {"n_words": pa.array(total, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "kept_sha256": pa.array(digests, pa.string()), "kept_text": pa.array(kept, pa.string())}
            yield pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c) for c in columns], names=columns)

    return run


def substring_dedup(docs: DataFrame, length: int = LENGTH, text: bool = True) -> DataFrame:
    """One row for each document: doc_id, n_words, n_removed, kept_sha256 and, with `text`, text and kept_text."""
    rows = _with_runs(docs, length, False)
    made = {"n_words": "long", "n_removed": "long", "kept_sha256": "string"} | ({"text": "string", "kept_text": "string"} if text else {})
    return rows.mapInArrow(_keep(length, ["doc_id", *made]), f"doc_id {dict(docs.dtypes)['doc_id']}, " + ", ".join(f"{k} {v}" for k, v in made.items()))


def rewritten(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs with the removed words taken out of `text` (n_chars follows where it is there).  Texts that lose nothing
    stay as they are, the others are their kept words joined by one space; texts that lose everything go."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, runs in zip(batch.column("text"), batch.column("runs"), strict=True):
                n, words = kept_words(text.as_py(), runs.as_py(), length)
                texts.append(None if n == len(words) else b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(texts, pa.string())], names=["rest", "now"])

    rows = _with_runs(docs, length, True)
    rows = rows.mapInArrow(cut, f"rest {rows.schema['rest'].dataType.simpleString()}, now string").where("now is null or now <> ''")
    own = {c: F.col(f"rest.`{c}`") for c in docs.columns}
    own["text"] = F.coalesce("now", own["text"])
    if "n_chars" in own:
        own["n_chars"] = F.coalesce(F.length("now").cast(docs.schema["n_chars"].dataType), own["n_chars"])
    return rows.select(*[c.alias(name) for name, c in own.items()])


def repeat_levels(docs: DataFrame, length: int = LENGTH) -> list[tuple[int, int]]:
    """(window length, windows that repeat) for length, 2 * length, ... until none repeats; a report."""
    levels: list[tuple[int, int]] = []
    while not levels or levels[-1][1]:
        at = length << len(levels)
        levels.append((at, removed_words(docs, at).select(F.explode("runs").alias("r")).agg(F.coalesce(F.sum(F.expr("(r & 4294967295L) - shiftright(r, 32) + 1")), F.lit(0))).first()[0]))
    return levels


def op1(docs: DataFrame) -> DataFrame:
    return substring_dedup(docs, text=False)
