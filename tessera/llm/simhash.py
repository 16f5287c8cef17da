"""SimHash near-dedup by multi-index hashing.

Fingerprint: texts are lower-cased (A-Z) and cut into words; every shingle of
`words` words votes with the 64 bits of its XXH64; a bit is set if set in over
half of the votes.  Fewer words than that: the whole sequence is the one
shingle; none: fingerprint zero, linked like any other.

Search: a fingerprint is cut into segments, and each table is looked up by the
bits of one segment or of several together.  Up to 2**24 different fingerprints
there are three segments of 22, 21 and 21 bits: if two fingerprints differ in 4
bits at most, then they differ in at most one bit of the first or of the second,
or in none of the third.  So the Hamming balls of radius 1, 1 and 0 around the
segments are enumerated, each pair once (a ball holds the values with one bit
cleared: of two that differ in one bit, one has it set), the tables are looked
up, and complete distances verify each match.  More fingerprints would crowd
tables of 2**22 places, so `tables` takes wider keys for them: of m segments, m - 4
at least are the same in both, so that a table for each choice of m - 4 segments,
with balls of radius 0, misses none.  m follows from their number: a key has as
many bits as the number has, so that a bucket of strangers stays small at any
size.  All sizes give the same links.  Only different fingerprints are searched;
equal ones are grouped before, with map-side combining, so that no group of exact
copies is ever expanded.

A bucket is searched by growing its components: what a member reaches is not
compared with it again, so a dense group of g near copies gives g - 1 links, not
g * g / 2.  Buckets with more than `BLOCK` fingerprints are split into pairs of
blocks, which go to different tasks.  Links are joined into components by star
contraction (components.py); neither links nor fingerprints reach the driver.

Defined cases.  Null text: as empty.  Very long texts: whole, a text at a time.  Null doc_id: counts for no component_id
(null if a component has no other).  Rows that repeat: one group.  Empty table:
empty result.  Other columns are ignored by `fingerprints`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._shared import parts, settled
from tessera.llm.components import components

WORDS, SEED, DISTANCE = 4, 42, 4
#: Fingerprints of a bucket that are compared in one task.
BLOCK = 100_000
#: Up to so many fingerprints of a bucket are compared by shifts, more by growing; the links join the same ones.
_SMALL = 64
_BITS = 64


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    digest = xxhash.xxh64_intdigest
    n = len(tokens) - words + 1
    votes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[words - 1 :].tolist(), strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        ones += np.unpackbits(votes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            some = batch.slice(i, 512)
            found = np.fromiter((fingerprint(t.as_py()) for t in some.column(1)), np.uint64, some.num_rows)
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the 64 bits as a signed long."""
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, f"doc_id {dict(docs.dtypes)['doc_id']}, fp long")


def _segments(m: int) -> list[int]:
    """Masks of m segments of about equal width, the lower ones first."""
    edges = [-(-_BITS * k // m) for k in range(m + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]


def tables(n: int, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """(mask, radius) of the tables for n fingerprints: two that differ in `distance` bits at most differ in at most
    `radius` bits of at least one mask."""
    if n <= 1 << 24:
        m = (distance + 2) // 2
        # the radii plus one sum up to distance + 1: an odd rest makes the last one 0
        radii = [1] * m
        radii[-1] -= 2 * m - distance - 1
        return list(zip(_segments(m), radii, strict=True))
    m = distance + 2
    while m < 16 and _BITS * (m - distance) / m < n.bit_length():
        m += 1
    return [(sum(some), 0) for some in combinations(_segments(m), m - distance)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def probes(prints: DataFrame, masks: list[tuple[int, int]]) -> DataFrame:
    """(key, fp): the table places that a fingerprint is stored under and looks up."""
    kinds = []
    for k, (mask, radius) in enumerate(masks):
        value = F.col("fp").bitwiseAND(F.lit(_signed(mask)))
        kinds.append(F.array(F.xxhash64(F.lit(k), value)))
        if radius:
            bits = F.array(*[F.lit(_signed(1 << b)) for b in range(_BITS) if mask >> b & 1])
            set_ = F.filter(bits, lambda bit: value.bitwiseAND(bit) != 0)
            kinds.append(F.transform(set_, lambda bit: F.xxhash64(F.lit(k), value.bitwiseXOR(bit))))
    return prints.select("fp", F.explode(F.concat(*kinds)).alias("key"))


def _grown(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join every two members within DISTANCE through members of this bucket."""
    rest, a, b = members, [], []
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            near = np.bitwise_count(rest ^ x) <= DISTANCE
            if near.any():
                hit = rest[near]
                a.append(np.full(len(hit), x))
                b.append(hit)
                front.extend(hit)
                rest = rest[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (members[:0], members[:0])


def _bucket_links(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    size = np.diff(edge)
    small = np.repeat(size <= _SMALL, size)
    run, value = np.repeat(np.arange(len(size)), size)[small], prints[small]
    a, b = [prints[:0]], [prints[:0]]
    for step in range(1, _SMALL):
        same = run[step:] == run[:-step]
        if not same.any():
            break
        near = same & (np.bitwise_count(value[step:] ^ value[:-step]) <= DISTANCE)
        a.append(value[:-step][near])
        b.append(value[step:][near])
    for k in np.flatnonzero(size > _SMALL):
        x, y = _grown(prints[edge[k] : edge[k + 1]])
        a.append(x)
        b.append(y)
    return np.concatenate(a), np.concatenate(b)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; a bucket may run over several batches."""
    key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)

    def made(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        a, b = _bucket_links(keys, prints)
        low, high = np.minimum(a, b), np.maximum(a, b)
        order = np.lexsort((high, low))
        low, high = low[order], high[order]
        new = (np.diff(low, prepend=~low[:1]) != 0) | (np.diff(high, prepend=~high[:1]) != 0)
        return pa.RecordBatch.from_arrays([pa.array(x[new].view(np.int64)) for x in (low, high)], names=["a", "b"])

    for batch in batches:
        key = np.concatenate((key, batch.column(0).to_numpy()))
        fp = np.concatenate((fp, batch.column(1).to_numpy().view(np.uint64)))
        if len(key):
            done = int(np.searchsorted(key, key[-1]))
            if done:
                yield made(key[:done], fp[:done])
                key, fp = key[done:], fp[done:]
    if len(key):
        yield made(key, fp)


def links(prints: DataFrame, masks: list[tuple[int, int]], block: int = BLOCK) -> DataFrame:
    """(a, b): links between different fingerprints, enough of them to give the components of all links.
    prints: fp, each once."""
    rows = probes(prints, masks)
    hot = settled(rows.groupBy("key").count().where(F.col("count") > block))
    if not hot.isEmpty():
        n = F.coalesce(F.ceil(F.col("count") / block), F.lit(1)).cast("long")
        own = F.pmod(F.xxhash64("fp"), n)
        other = F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
        rows = rows.join(hot, "key", "left").select("key", "fp", n.alias("n"), own.alias("own"), other.alias("other"))
        pair = F.least("own", "other") * F.col("n") + F.greatest("own", "other")
        rows = rows.select(F.when(F.col("n") > 1, F.xxhash64("key", pair)).otherwise(F.col("key")).alias("key"), "fp")
    n = parts(prints.sparkSession)
    rows = rows.select("key", "fp").repartition(n, "key").sortWithinPartitions("key")
    return rows.mapInArrow(_links, "a long, b long")


def near_components(prints: DataFrame) -> DataFrame:
    """doc_id, fp, component_id of rows (doc_id, fp)."""
    each = settled(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    tree = components(links(each.select("fp"), tables(each.count())))
    roots = each.join(tree, each.fp == tree.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    named = settled(roots.groupBy("root").agg(F.min("least").alias("component_id")))  # so that AQE can split a hot root
    named = roots.join(named, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def simhash_dedup(docs: DataFrame) -> DataFrame:
    return near_components(settled(fingerprints(docs)))


def op4(docs: DataFrame) -> DataFrame:
    return simhash_dedup(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
