"""Near-dedup as stages need it: SimHash by multi-index hashing over five-word shingles, then exact Jaccard similarity.

A text is its set of shingles of `WORDS` words (lower-cased A-Z; fewer words:
the whole sequence is the one shingle; none: the empty set).  Two texts are
linked if |A & B| / |A | B| is `SHARE` or more, counted on the whole sets of
64-bit hashes; components of links are the groups.

Pairs come from SimHash fingerprints: each bit is the majority of one bit of a
hash over all shingles.  Texts of similarity 0.8 differ in about 15 % of the bits,
so a fingerprint has more than 64: `layout` gives the number and the width of its
segments, wider ones for more texts, so that a bucket of strangers stays small.
Each segment is a table.  A text is entered under its segment and under those
that differ in any of its `FLIPS` least certain bits, the ones with the closest
votes; so two texts meet if all bits that differ are uncertain in one or the
other.  In a bucket those whose other `SKETCH` bits differ in `APART` at most stay
together; the others met by chance.  This choice of pairs is the only loss
(README has its size); what it finds is compared exactly.

Equal sets are one node.  First each node of a bucket is compared with
the bucket's least, its lead, so that a group of g near copies costs g comparisons, not
g * g / 2.  Buckets of one lead overlap, so they are one from then on: a node is there once
for each lead it met, not for each bucket.  In those, members that cannot be similar to any
of another component go (`_maybe`, a bound that loses none), and the others are
searched by growing them, with sets at hand, whatever their number.  A node has
at most as many leads as places, so rows follow the number of texts, also in a group of any size.
Only texts that share a bucket are read again for their sets.

Defined cases.  Null text: as empty.  Very long texts: whole sets, a text at a
time.  Null doc_id: counts for no component_id.  Rows that repeat: one group.
Empty table: empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._shared import parts, settled
from tessera.llm.components import components

WORDS, SEED = 5, 42
#: Similarity of links as a fraction, so that it is compared in whole numbers.
SHARE = (4, 5)
#: Least certain bits of a segment that are tried both ways.
FLIPS = 3
#: Bits beside the segments, two longs, and how many of them may differ: strangers differ in 64 on average, texts of
#: similarity 0.8 in 19.
SKETCH, APART = 128, 36
#: Minhashes by which pairs of a mixed bucket are told apart, and the share of equal ones below which they are not
#: counted exactly; five standard errors below 0.8.
MINHASHES, MAYBE = 280, 0.68
_r = np.random.default_rng(SEED)
_XOR, _ODD = (_r.integers(0, 1 << 64, MINHASHES, np.uint64) | np.uint64(1) for _ in range(2))
_CHUNK = 1024
#: Cells of a set's parities, in words of 64; two sets differ in as many shingles at least as in parities.
_CELLS = 32
#: Up to so many rows of a bucket are compared by shifts, more by growing; the groups are the same.
_SMALL = 64


def layout(n: int) -> tuple[int, int]:
    """(segments, width) for n texts."""
    width = max(20, n.bit_length() + 2)
    return 18 + 3 * (width - 20), width


def shingles(text: str | None) -> np.ndarray:
    """The hashes of a text's shingles, sorted, each once."""
    tokens = (text or "").encode().lower().split()
    n = max(1, len(tokens) - WORDS + 1) if tokens else 0
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(b" ".join(tokens[i : i + WORDS]), SEED) for i in range(n)), np.uint64, n))


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    least = np.full((len(sets), MINHASHES), np.iinfo(np.uint64).max, np.uint64)
    for row, own in zip(least, sets, strict=True):
        for i in range(0, len(own), _CHUNK):
            np.minimum(row, ((own[i : i + _CHUNK, None] ^ _XOR) * _ODD).min(axis=0), out=row)
    return least


def parities(own: np.ndarray) -> np.ndarray:
    """For each cell, whether an odd number of hashes falls into it, as words."""
    odd = np.bincount((own >> np.uint64(64 - (64 * _CELLS - 1).bit_length())).astype(np.int64), minlength=64 * _CELLS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def votes(own: np.ndarray, bits: int) -> np.ndarray:
    """For each bit of a fingerprint, twice the shingles that set it, less all shingles."""
    words = np.arange(1, -(-bits // 64) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    ones = np.zeros(len(words) * 64, np.int64)
    for i in range(0, len(own), 255):  # what fits a byte
        x = own[i : i + 255, None] + words
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        ones += np.add.reduce(np.unpackbits(x.view(np.uint8), axis=1), axis=0, dtype=np.uint8)
    return (2 * ones - len(own))[:bits]


def fingerprints(sets: list[np.ndarray], segments: int, width: int) -> np.ndarray:
    """A row for each set: the sketch, each segment, and for each segment a mask of its least certain bits."""
    found = np.array([votes(s, SKETCH + segments * width) for s in sets]).reshape(len(sets), -1)
    sketch = (found[:, :SKETCH].reshape(-1, 2, 64) > 0) @ (np.uint64(1) << np.arange(64, dtype=np.uint64))
    own = found[:, SKETCH:].reshape(-1, segments, width)
    weight = np.int64(1) << np.arange(width)
    # ties by place, so that equal sets have equal masks
    unsure = np.argsort(np.abs(own), axis=2, kind="stable")[:, :, :FLIPS]
    return np.concatenate((sketch.view(np.int64), (own > 0) @ weight, weight[unsure].sum(axis=2)), axis=1)


def places(prints: np.ndarray) -> np.ndarray:
    """The buckets of each fingerprint: (texts, places)."""
    segments = prints.shape[1] // 2 - 1
    value, mask, parts = prints[:, 2 : 2 + segments, None], prints[:, 2 + segments :].copy(), []
    for _ in range(FLIPS):
        parts.append(mask & -mask)
        mask &= mask - 1
    flips = np.stack([sum((p for k, p in enumerate(parts) if some >> k & 1), np.zeros_like(mask)) for some in range(1 << FLIPS)], axis=2)
    return ((value ^ flips) | (np.arange(segments)[:, None] << 48)).reshape(len(prints), -1)


def _node(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes(), SEED)


def _lists(values: np.ndarray, lengths: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), pa.array(values.view(np.int64)))


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _printed(segments: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                sets = [shingles(t.as_py()) for t in some.column(2)]
                found = fingerprints(sets, segments, width)
                prints = _lists(found.reshape(-1), [found.shape[1]] * len(sets))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), _signed([_node(s) for s in sets]), pa.array([len(s) for s in sets], pa.int64()), prints], names=["doc_id", "version", "node", "n", "print"])

    return run


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, print) as (key, node, low, high), a row for each place."""
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            some = batch.slice(i, 512)
            prints = some.column(1).flatten().to_numpy().reshape(some.num_rows, -1)
            keys = places(prints)
            own = [np.repeat(x, keys.shape[1]) for x in (some.column(0).to_numpy(), prints[:, 0], prints[:, 1])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys.reshape(-1), *own)], names=["key", "node", "low", "high"])


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=1) > APART


def _close(keys: np.ndarray, sketch: np.ndarray) -> list[list[int]]:
    """The groups of rows of one key that close sketches join, two rows or more each."""
    edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    size = np.diff(edge)
    few = np.flatnonzero(np.repeat((size > 1) & (size <= _SMALL), size))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for step in range(1, _SMALL):
        same = keys[few[step:]] == keys[few[:-step]]
        if not same.any():
            break
        near = np.flatnonzero(same)
        near = near[~_far(sketch[few[near]], sketch[few[near + step]])]
        for x, y in zip(few[near].tolist(), few[near + step].tolist(), strict=True):
            low, high = sorted((find(x), find(y)))
            root[high] = low
    groups: dict[int, list[int]] = {}
    for x in list(root):
        groups.setdefault(find(x), []).append(x)
    out = list(groups.values())
    for k in np.flatnonzero(size > _SMALL):
        rest = np.arange(edge[k], edge[k + 1])
        while len(rest):
            group, front, rest = [rest[0]], [rest[0]], rest[1:]
            while front and len(rest):
                hit = ~_far(sketch[rest], sketch[front.pop()])
                front += rest[hit].tolist()
                group += rest[hit].tolist()
                rest = rest[~hit]
            if len(group) > 1:
                out.append(group)
    return out


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, node, low, high), sorted by key, as (lead, node): the least of the nodes that met, and each of them."""
    held, known = [np.empty(0, np.int64)] * 4, set()

    def made(key: np.ndarray, node: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
        nodes, leads = [], []
        for group in _close(key, np.stack((low, high), axis=1).view(np.uint64)):
            own = np.sort(node[group])
            name = xxhash.xxh64_intdigest(own.tobytes(), SEED)
            if name not in known:
                if len(known) >= 1 << 20:
                    known.clear()
                known.add(name)
                nodes += own.tolist()
                leads += [int(own[0])] * len(own)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (leads, nodes)], names=["lead", "node"])

    for batch in batches:
        held = [np.concatenate((x, batch.column(k).to_numpy())) for k, x in enumerate(held)]
        if len(held[0]):
            done = int(np.searchsorted(held[0], held[0][-1]))
            if done:
                yield made(*[x[:done] for x in held])
                held = [x[done:] for x in held]
    if len(held[0]):
        yield made(*held)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            some = batch.slice(i, 64)
            sets = [shingles(t.as_py()) for t in some.column(1)]
            odd = _lists(np.concatenate([parities(s) for s in sets]), [_CELLS] * len(sets))
            yield pa.RecordBatch.from_arrays([some.column(0), _lists(np.concatenate(sets), [len(s) for s in sets]), odd], names=["node", "own", "odd"])


def _alive(lead: np.ndarray, root: np.ndarray, size: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """Which rows may be similar to a row of the same lead and another root: the symmetric difference of their sets is
    not too large by parities or by size.  Rows come sorted by lead."""
    up, down = SHARE
    alive = np.zeros(len(lead), bool)

    def look(x: np.ndarray, y: np.ndarray) -> None:
        some = (root[x] != root[y]) & (down * np.minimum(size[x], size[y]) >= up * np.maximum(size[x], size[y]))
        x, y = x[some], y[some]
        apart = np.bitwise_count(odd[x] ^ odd[y]).sum(axis=1, dtype=np.int64)
        some = (up + down) * apart <= (down - up) * (size[x] + size[y])
        alive[x[some]] = alive[y[some]] = True

    edge = np.flatnonzero(np.concatenate(([True], lead[1:] != lead[:-1], [True])))
    count = np.diff(edge)
    few = np.flatnonzero(np.repeat((count > 1) & (count <= _SMALL), count))
    for step in range(1, _SMALL):
        near = few[:-step][lead[few[step:]] == lead[few[:-step]]]
        if not len(near):
            break
        for i in range(0, len(near), 1 << 14):
            look(near[i : i + (1 << 14)], near[i : i + (1 << 14)] + step)
    for k in np.flatnonzero(count > _SMALL):
        at = slice(edge[k], edge[k + 1])
        _, own, often = np.unique(root[at], return_inverse=True, return_counts=True)
        # of two roots one is not the most frequent, so a large component is not compared with itself
        less = own != often.argmax()
        rest = edge[k] + np.concatenate((np.flatnonzero(less), np.flatnonzero(~less)))
        for n, x in enumerate(rest[: less.sum()], 1):
            look(np.full(len(rest) - n, x), rest[n:])
    return alive


def _maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lead, node, root, n, odd), sorted by lead, as (lead, node, root): those that `_alive` keeps."""
    held = [*[np.empty(0, np.int64)] * 4, np.empty((0, _CELLS), np.int64)]

    def made(lead: np.ndarray, node: np.ndarray, root: np.ndarray, n: np.ndarray, odd: np.ndarray) -> pa.RecordBatch:
        stay = _alive(lead, root, n, odd.view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(x[stay]) for x in (lead, node, root)], names=["lead", "node", "root"])

    for batch in batches:
        new = [batch.column(k).to_numpy() for k in range(4)] + [batch.column(4).flatten().to_numpy().reshape(-1, _CELLS)]
        held = [np.concatenate(x) for x in zip(held, new, strict=True)]
        if len(held[0]):
            done = int(np.searchsorted(held[0], held[0][-1]))
            if done:
                yield made(*[x[:done] for x in held])
                held = [x[done:] for x in held]
    if len(held[0]):
        yield made(*held)


def _grown(nodes: list[int], roots: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join all similar members of a bucket whose roots differ; what is reached is not compared again."""
    size, least = np.array([len(s) for s in sets]), minhashes(sets).astype(np.uint8)
    rest, out, (up, down) = np.arange(len(nodes)), [], SHARE
    while len(rest):
        own = roots[rest] == roots[rest[0]]
        front, rest = rest[own].tolist(), rest[~own]
        while front and len(rest):
            x = front.pop()
            maybe = rest[down * np.minimum(size[rest], size[x]) >= up * np.maximum(size[rest], size[x])]
            maybe = maybe[(least[maybe] == least[x]).sum(axis=1) >= MAYBE * MINHASHES]
            hits = [y for y in maybe.tolist() if (up + down) * len(np.intersect1d(sets[x], sets[y], True)) >= up * (size[x] + size[y])]
            if hits:
                out += [(nodes[x], nodes[y]) for y in hits]
                moved = np.isin(roots[rest], roots[hits])
                front += rest[moved].tolist()
                rest = rest[~moved]
    return out


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lead, node, root, own) come sorted by lead; a bucket may run over several batches."""
    last, nodes, roots, sets = None, [], [], []

    def made() -> pa.RecordBatch:
        found = _grown(nodes, np.array(roots), sets)
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    for batch in batches:
        for i in range(batch.num_rows):
            key = batch.column(0)[i].as_py()
            if key != last and nodes:
                yield made()
                nodes, roots, sets = [], [], []
            last = key
            nodes.append(batch.column(1)[i].as_py())
            roots.append(batch.column(2)[i].as_py())
            sets.append(batch.column(3)[i].values.to_numpy().view(np.uint64))
    if nodes:
        yield made()


#: Tells texts of one doc_id apart.
def version() -> F.Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    up, down = SHARE
    of = {x: sets.select(F.col("node").alias(x), F.col("own").alias(f"{x}_own")) for x in "ab"}
    both = pairs.join(of["a"], "a").join(of["b"], "b").withColumn("same", F.size(F.array_intersect("a_own", "b_own")))
    return both.where(f"{up + down} * same >= {up} * (size(a_own) + size(b_own))").select("a", "b")


def near_links(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """(a, b): links between different nodes, enough of them to give the components of all links."""
    each = prints.groupBy("node").agg(F.min(F.struct("doc_id", "version")).alias("one"), F.first("n").alias("n"), F.first("print").alias("print"))
    rows = each.where("n > 0").select("node", "print").mapInArrow(_placed, "key long, node long, low long, high long")
    rows = rows.repartition(parts(docs.sparkSession), "key").sortWithinPartitions("key")
    shared = settled(rows.mapInArrow(_met, "lead long, node long").distinct())
    first = shared.where("lead <> node").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    # all that share a bucket are read again, as the second step compares any of them
    wanted = shared.select("node").distinct().join(each.select("node", "one"), "node").select("node", "one.doc_id", "one.version")
    texts = docs.select("doc_id", "text").withColumn("version", version()).join(wanted, ["doc_id", "version"]).dropDuplicates(["node"])
    sets = settled(texts.select("node", "text").mapInArrow(_sets, "node long, own array<long>, odd array<long>"))
    found = settled(_alike(first, sets))
    of = sets.select("node", F.size("own").cast("long").alias("n"), "odd").join(components(found), "node", "left")
    of = of.select("node", F.coalesce("root", "node").alias("root"), "n", "odd")
    rows = shared.join(of, "node").select("lead", "node", "root", "n", "odd")
    rows = rows.repartition(parts(docs.sparkSession), "lead").sortWithinPartitions("lead")
    rows = rows.mapInArrow(_maybe, "lead long, node long, root long").join(sets.select("node", "own"), "node").select("lead", "node", "root", "own")
    rows = rows.repartition(parts(docs.sparkSession), "lead").sortWithinPartitions("lead")
    return found.union(rows.mapInArrow(_bucket_links, "a long, b long"))


def near_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, version (the hash of the text), root (one of each component), component_id, its least doc_id."""
    kind = dict(docs.dtypes)["doc_id"]
    run = _printed(*layout(docs.count()))
    prints = settled(docs.select("doc_id", version().alias("version"), "text").mapInArrow(run, f"doc_id {kind}, version long, node long, n long, print array<long>"))
    tree = components(near_links(docs, prints))
    roots = prints.select("doc_id", "version", "node").join(tree, "node", "left").select("doc_id", "version", F.coalesce("root", "node").alias("root"))
    named = settled(roots.groupBy("root").agg(F.min("doc_id").alias("component_id")))  # so that AQE can split a hot root
    return roots.join(named, "root").select("doc_id", "version", "root", "component_id")
