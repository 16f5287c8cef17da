"""Byte-level BPE encoding and decoding, by overlapping chunk encoding.

A text of more than a chunk is cut into overlapping chunks, each a row that goes
to any task.  There it is pre-tokenised by itself; its right seam is the first
boundary, inside what it shares with the next chunk, that both have (the start
of the next is cut once more for that), and its pre-tokens up to there are
encoded by the ranks of a vocabulary file.  The chunks of a text then meet in
order: what a chunk has before its left seam is dropped, so that the pieces
follow one another.  They stream by; no task holds a long text, and its ids are
gathered only where a row of all of them is asked for.  Decoding concatenates the
raw bytes of the ids.  A text of one chunk has no seam and stays in its task.

Defined cases.  Null text: as empty, no ids.  Very long texts: by chunks; a
stretch of `_bpe.REACH` code points without an end of letters or digits, which
may be one pre-token, is not cut.  Null doc_id and repeated rows: a row out for
each row in.  Strings of special tokens are ordinary text.  Empty table: empty
result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm import _bpe
from tessera.llm._shared import parts

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
_ROWS = 128
_KEY = ["doc_id", "hash", "part"]


def _table(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) for k, t in kinds.items()], names=list(kinds))


def _cut(chunk: int, overlap: int):
    """Chunks of each text.  part tells equal rows of different tasks apart, so that they need not meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for batch in batches:
            kinds = {"doc_id": batch.column(0).type, "hash": pa.int64(), "part": pa.int32(), "k": pa.int32(), "start": pa.int64(), "lead": pa.int32(), "after": pa.int32(), "text": pa.string()}
            rows: list[tuple] = []
            for doc_id, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = text.as_py()
                edges = _bpe.cuts(text, chunk, overlap)
                for k, (start, end) in enumerate(edges):
                    lead = edges[k - 1][1] - start if k else 0
                    after = edges[k + 1][0] - start if k + 1 < len(edges) else -1
                    rows.append((doc_id, h, part, k, start, lead, after, text[start:end]))
                    if len(rows) == _ROWS:
                        yield _table(dict(zip(kinds, map(list, zip(*rows, strict=True)), strict=True)), kinds)
                        rows = []
            if rows:
                yield _table(dict(zip(kinds, map(list, zip(*rows, strict=True)), strict=True)), kinds)

    return run


def _coded(path: str):
    """Encodes each chunk by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe.load(path)
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS):
                some = batch.slice(i, _ROWS)
                made = [bpe.chunk(t.as_py(), *x) for t, *x in zip(some.column("text"), some.column("lead").to_pylist(), some.column("after").to_pylist(), strict=True)]
                start = np.array(some.column("start").to_pylist(), np.int64)
                ids = [np.frombuffer(m[0], "<u4").astype(bpe.width).tobytes() for m in made]
                heads = [np.array([m[2], m[3]], "<u4").tobytes() for m in made]
                columns = {"ids": pa.array(ids, pa.binary()), "seam": pa.array(start + [m[1] for m in made], pa.int64()), "start": some.column("start"), "heads": pa.array(heads, pa.binary())}
                yield pa.RecordBatch.from_pydict({c: some.column(c) for c in (*_KEY, "k")} | columns)

    return run


def _stitched(batches: Iterator[pa.RecordBatch], width: np.dtype) -> Iterator[tuple[object, bytes | None, int]]:
    """For chunks in order of key and k: (doc_id, ids of a piece, 0) for each, then (doc_id, None, copies of the row)."""
    now, last, seam, copies = None, -1, 0, 0
    for batch in batches:
        columns = [batch.column(c) for c in (*_KEY, "k", "seam", "start", "heads", "ids")]
        for row in zip(*columns, strict=True):
            *key, k, end, start = (x.as_py() for x in row[:6])
            if key != now:
                if copies:
                    yield now[0], None, copies
                now, last, seam, copies = key, -1, 0, 0
            copies += k == 0
            if k == last:
                continue  # of an equal row
            places, before = np.frombuffer(row[6].as_py(), "<u4").reshape(2, -1)
            drop = int(before[places.tolist().index(seam - start)])
            yield key[0], np.frombuffer(row[7].as_py(), width)[drop:].astype("<u4").tobytes(), 0
            last, seam = k, end
    if copies:
        yield now[0], None, copies


def _long_or_short(docs: DataFrame, chunk: int, overlap: int, path: str, whole: Callable, gather: Callable, row: str) -> DataFrame:
    """whole: rows of texts of one chunk -> result; gather: chunks in order -> result."""
    kind = dict(docs.dtypes)["doc_id"]
    more = F.coalesce(F.length("text"), F.lit(0)) > chunk + overlap
    short = docs.where(~more).select("doc_id", "text").mapInArrow(whole, row)
    cut = docs.where(more).select("doc_id", F.xxhash64("text").alias("hash"), "text")
    cut = cut.mapInArrow(_cut(chunk, overlap), f"doc_id {kind}, hash long, part int, k int, start long, lead int, after int, text string")
    n = parts(docs.sparkSession)
    coded = cut.repartition(n, *_KEY, "k").mapInArrow(_coded(path), f"doc_id {kind}, hash long, part int, k int, ids binary, seam long, start long, heads binary")
    return short.union(coded.repartition(n, *_KEY).sortWithinPartitions(*_KEY, "k").mapInArrow(gather, row))


def _each(texts: pa.Array, bpe: _bpe.Bpe) -> list[bytes]:
    return [bpe.encode(t.as_py() or "") for t in texts]


def _ids_column(encoded: list[bytes]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in encoded]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(encoded), "<i4"), pa.int32()))


def encode(docs: DataFrame, path: str | None = None, chunk: int = _bpe.CHUNK, overlap: int = _bpe.OVERLAP) -> DataFrame:
    """doc_id, ids array<int>."""
    path = path or public_tokenizers.path(VOCABULARY)
    given = docs.schema["doc_id"].dataType
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe.load(path)
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS):
                some = batch.slice(i, _ROWS)
                yield pa.RecordBatch.from_arrays([some.column(0), _ids_column(_each(some.column(1), bpe))], names=["doc_id", "ids"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        for doc_id, ids, copies in _stitched(batches, _bpe.load(path).width):
            if ids is not None:
                held.append(ids)
                continue
            one = b"".join(held)
            held = []
            for _ in range(copies):
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], to_arrow_type(given)), _ids_column([one])], names=["doc_id", "ids"])

    return _long_or_short(docs, chunk, overlap, path, whole, gather, f"doc_id {dict(docs.dtypes)['doc_id']}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the decoded bytes of rows (doc_id, ids)."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe.load(path)
        for batch in batches:
            got = [bpe.decode(np.array(x.as_py() or [], "<u4").tobytes()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.binary())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, decoded binary")


class _Digest:
    """Of ids that come in pieces, and of the bytes that they decode to."""

    def __init__(self, bpe: _bpe.Bpe):
        self.bpe, self.n, self.ids, self.decoded = bpe, 0, hashlib.sha256(), hashlib.sha256()

    def add(self, ids: bytes) -> None:
        some = np.frombuffer(ids, "<u4").tolist()
        if some:
            self.ids.update((("," if self.n else "") + ",".join(map(self.bpe.digits.__getitem__, some))).encode())
            self.decoded.update(self.bpe.decode(ids))
            self.n += len(some)

    def row(self) -> tuple[int, str, str]:
        return self.n, self.ids.hexdigest(), self.decoded.hexdigest()


def digests(docs: DataFrame, path: str | None = None, chunk: int = _bpe.CHUNK, overlap: int = _bpe.OVERLAP) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (of the ids, decoded again); pieces are digested as they come."""
    path = path or public_tokenizers.path(VOCABULARY)
    given = docs.schema["doc_id"].dataType
    names = ("n_tokens", "ids_sha256", "decoded_sha256")

    def made(doc_ids: pa.Array, rows: list[tuple[int, str, str]]) -> pa.RecordBatch:
        columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))]
        return pa.RecordBatch.from_arrays([doc_ids, *columns], names=["doc_id", *names])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe.load(path)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                digest = _Digest(bpe)
                digest.add(bpe.encode(text.as_py() or ""))
                rows.append(digest.row())
            yield made(batch.column(0), rows)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe.load(path)
        digest, ids, rows = _Digest(bpe), [], []
        for doc_id, piece, copies in _stitched(batches, bpe.width):
            if piece is not None:
                digest.add(piece)
                continue
            ids += [doc_id] * copies
            rows += [digest.row()] * copies
            digest = _Digest(bpe)
            if len(rows) >= 1000:
                yield made(pa.array(ids, to_arrow_type(given)), rows)
                ids, rows = [], []
        if rows:
            yield made(pa.array(ids, to_arrow_type(given)), rows)

    return _long_or_short(docs, chunk, overlap, path, whole, gather, f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3(docs: DataFrame) -> DataFrame:
    return digests(docs)
