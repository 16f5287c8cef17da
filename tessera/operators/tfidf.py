"""Sparse TF-IDF retrieval inside each country.

Vocabulary, idf and norms are joins and aggregates over (country, token); they
come from the targets alone.  Scores are rounded before they are ranked, and ties
go to the smaller tid, so that the order of additions never shows.

`topk` reads every text once.  A slice of rows is turned into postings, a row for
each token of the slice; where the rows of a token meet, its frequencies are
known, so it is dropped or weighed there, and what is left goes on as pieces of
vectors.

The products are made block by block.  As a join on the token they would be one
row for each token that a query and a target share, shuffled before any could be
dropped, and a frequent token's key would hold all its queries times all its
targets.  Instead the targets of a country are dealt into blocks and its queries
into chunks; each meeting of a block and a chunk is a group of pieces of vectors,
sorted, in which the block becomes posting lists and the queries stream by.  A
group gives up its K best for each query, so that K rows a query and block are
all that is ranked again.  No result is lost: the K best of all are among the K
best of each block.  A target is shuffled once for each chunk and a query once
for each block, so there are no more of them than memory and cores ask for,
however many shuffle partitions there are.

Rows of one id in one country count as one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.blocking import BlockConfig, pairs

#: Targets of a block and queries of a chunk at most; cells of the score table, and
#: products, that a worker holds at once.
BLOCK, CHUNK, CELLS = 50_000, 1_000_000, 1 << 22
#: Pairs that are worth a group of their own.
PAIRS = 1 << 24
#: Rows that are turned into postings together.
SLICE = 4096
#: Bytes of postings that are weighed together.
HELD = 1 << 25


def term_counts(rows: DataFrame, of: str) -> DataFrame:
    text = F.trim(F.concat("name_tok", F.lit(" "), "addr_tok"))
    words = rows.select("country", of, F.explode(F.split(text, r"\s+")).alias("token")).where(F.col("token") != "")
    return words.groupBy("country", of, "token").agg(F.count("*").alias("tf"))


def vocabulary(targets: DataFrame, cfg: BlockConfig) -> DataFrame:
    """country, token, df, cf, idf of the tokens in the frequency window."""
    n = targets.groupBy("country").agg(F.count("*").alias("n"))
    seen = term_counts(targets, "tid").groupBy("country", "token").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
    kept = seen.where((F.col("df") >= cfg.min_df) & F.col("cf").between(cfg.min_df, cfg.max_df))
    return kept.join(n, "country").select("country", "token", "df", "cf", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def weights(rows: DataFrame, of: str, vocab: DataFrame) -> DataFrame:
    """Unit vectors: country, id, token, w."""
    w = term_counts(rows, of).join(vocab.select("country", "token", "idf"), ["country", "token"]).withColumn("w", (1 + F.log("tf")) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("country", of)))
    return w.select("country", of, "token", (F.col("w") / norm).alias("w"))


def topk(queries: DataFrame, targets: DataFrame, cfg: BlockConfig) -> DataFrame:
    """sid, tid, tfidf_score, tfidf_rank of the K nearest targets of each query."""
    n = targets.groupBy("country").agg(F.count("*").alias("n"))
    texts = [rows.select("country", F.lit(kind).alias("kind"), F.col(of).alias("id"), F.concat("name_tok", F.lit(" "), "addr_tok").alias("text")) for kind, (rows, of) in enumerate(((targets, "tid"), (queries, "sid")))]
    texts = texts[0].union(texts[1]).where("country is not null")
    own = dict(texts.dtypes)["id"]
    seen = texts.mapInArrow(_postings, f"country string, token string, kind int, ids array<{own}>, tfs array<int>")
    # the fewer partitions there are, the longer are the pieces
    tasks = 2 * queries.sparkSession.sparkContext.defaultParallelism
    tasks = min(_parts(queries), max(tasks, (targets.count() + queries.count()) // BLOCK))
    seen = seen.repartition(tasks, "country", "token").join(F.broadcast(n), "country").sortWithinPartitions("country", "token")
    pieces = seen.mapInArrow(_weighed(cfg), f"country string, kind int, id {own}, tokens string, w array<double>")
    return _best(pieces, queries, n.withColumnRenamed("n", "t"), cfg, dict(targets.dtypes)["tid"])


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (country, kind, id, text) as (country, token, kind, ids, tfs), for each slice of rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            some = pa.Table.from_batches([batch.slice(at, SLICE)])
            groups = some.select(["country", "kind"]).group_by(["country", "kind"]).aggregate([]).to_pylist()
            for g in groups:
                rows = some.filter(pc.and_(pc.equal(some["country"], g["country"]), pc.equal(some["kind"], g["kind"]))).combine_chunks()
                ids, text = rows["id"].combine_chunks(), rows["text"].combine_chunks().cast(pa.large_string())
                words = pc.ascii_split_whitespace(text)
                row, words = pc.list_parent_indices(words), pc.list_flatten(words)
                real = pc.not_equal(words, "")
                row, words = row.filter(real).to_numpy().astype(np.int64), words.filter(real).dictionary_encode()
                if not len(row):
                    continue
                pair, tf = np.unique(words.indices.to_numpy().astype(np.int64) * len(ids) + row, return_counts=True)
                code, row = np.divmod(pair, len(ids))
                edge = pa.array(np.searchsorted(code, np.arange(len(words.dictionary) + 1)), pa.int32())
                n = len(words.dictionary)
                lists = [pa.ListArray.from_arrays(edge, x) for x in (ids.take(pa.array(row)), pa.array(tf, pa.int32()))]
                yield pa.RecordBatch.from_arrays([pa.repeat(g["country"], n), words.dictionary.cast(pa.string()), pa.array(np.full(n, g["kind"], np.int32)), *lists], names=["country", "token", "kind", "ids", "tfs"])


def _flat(rows: pa.Table, of: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, and the row of each."""
    lists = rows[of].combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return pc.list_flatten(lists).to_numpy(zero_copy_only=False), pc.list_parent_indices(lists).to_numpy().astype(np.int64)


def _coded(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    coded = column.combine_chunks()
    coded = (coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _packed(country: np.ndarray, countries: pa.Array, kind: np.ndarray, ids: np.ndarray, token: np.ndarray, tokens: pa.Array, w: np.ndarray) -> pa.RecordBatch:
    """Pieces of vectors: the tokens of one id as one row."""
    order = np.lexsort((ids, kind, country))
    country, kind, ids, token, w = (x[order] for x in (country, kind, ids, token, w))
    new = np.ones(len(ids), bool)
    new[1:] = (np.diff(ids) != 0) | (np.diff(kind) != 0) | (np.diff(country) != 0)
    first = np.flatnonzero(new)
    edge = pa.array(np.append(first, len(ids)), pa.int32())
    joined = pc.binary_join(pa.ListArray.from_arrays(edge, tokens.take(pa.array(token))), " ")
    columns = [countries.take(pa.array(country[first])), pa.array(kind[first].astype(np.int32)), pa.array(ids[first]), joined, pa.ListArray.from_arrays(edge, pa.array(w))]
    return pa.RecordBatch.from_arrays(columns, names=["country", "kind", "id", "tokens", "w"])


def _weighed(cfg: BlockConfig):
    """Rows (country, token, kind, ids, tfs, n), those of a token together, as pieces of vectors that are not of unit
    length yet: the tokens in the frequency window."""

    def made(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        (country, countries), (token, tokens) = _coded(rows["country"]), _coded(rows["token"])
        kind, total = rows["kind"].to_numpy().astype(np.int64), rows["n"].to_numpy()
        key = country * len(tokens) + token
        (tf, at), ids = _flat(rows, "tfs"), _flat(rows, "ids")[0]
        keys, key = np.unique(key, return_inverse=True)
        cf = np.bincount(key[at], np.where(kind[at] == 0, tf, 0), len(keys))
        left = ((cf >= cfg.min_df) & (cf <= cfg.max_df))[key[at]]
        at, tf, ids = at[left], tf[left], ids[left]
        if not len(at):
            return
        # rows of one id count as one text
        order = np.lexsort((ids, kind[at], key[at]))
        at, tf, ids = at[order], tf[order], ids[order]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(ids) != 0) | (np.diff(kind[at]) != 0) | (np.diff(key[at]) != 0)
        first = np.flatnonzero(new)
        tf, at, ids = np.add.reduceat(tf.astype(np.int64), first), at[first], ids[first]
        df = np.bincount(key[at], kind[at] == 0, len(keys))
        left = df[key[at]] >= cfg.min_df
        tf, at, ids = tf[left], at[left], ids[left]
        if len(at):
            w = (1 + np.log(tf)) * (np.log((1 + total[at]) / (1 + df[key[at]])) + 1)
            yield _packed(country[at], countries, kind[at], ids, token[at], tokens, w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held, size = [*held, batch], size + batch.nbytes
            if size < HELD:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            # the last token may go on in the next batch
            same = pc.and_(pc.equal(rows["country"], rows["country"][-1].as_py()), pc.equal(rows["token"], rows["token"][-1].as_py())).to_numpy()
            cut, size = int(np.argmax(same)), 0
            if cut:
                yield from made(rows.slice(0, cut))
                held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            yield from made(pa.Table.from_batches(held).combine_chunks())

    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (country, kind, id, token, w) as pieces of vectors."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if rows.num_rows:
            yield _packed(*_coded(rows["country"]), rows["kind"].to_numpy(), rows["id"].to_numpy(), *_coded(rows["token"]), rows["w"].to_numpy())


def _reached(score: np.ndarray, k: int) -> np.ndarray:
    """Of each row, a bound that its k best cells reach, as do all that are equal to them once they are rounded: the
    k-th of the maxima of parts of the row."""
    bound, parts = np.full(len(score), 1e-9), 8 * k
    if score.shape[1] > 2 * parts:
        most = np.maximum.reduceat(score, np.arange(parts) * score.shape[1] // parts, axis=1)
        bound = np.maximum(bound, np.partition(most, parts - k, axis=1)[:, parts - k] - 2e-6)
    return bound


class _Postings:
    """The targets of a block by token."""

    def __init__(self, tid: np.ndarray, token: pa.Array, w: np.ndarray):
        coded = token.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(code, kind="stable")
        self.tokens = coded.dictionary
        self.tids, at = np.unique(tid, return_inverse=True)
        w = w / np.sqrt(np.bincount(at, w * w))[at]
        self.at, self.w = at[order], w[order]
        self.first = np.searchsorted(code[order], np.arange(len(self.tokens) + 1))

    def best(self, sid: np.ndarray, token: pa.Array, qw: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(sid, tid, score) of the k best targets of each query; rows of one query stand together."""
        whole = np.cumsum(np.diff(sid, prepend=sid[:1]) != 0)
        qw = qw / np.sqrt(np.bincount(whole, qw * qw))[whole]
        code = pc.index_in(token, value_set=self.tokens).fill_null(-1).to_numpy(zero_copy_only=False)
        known = code >= 0
        sid, code, qw = sid[known], code[known], qw[known]
        edge = np.append(np.flatnonzero(np.diff(sid, prepend=sid[:1] - 1)), len(sid))
        width = len(self.tids)
        size = self.first[code + 1] - self.first[code]
        # queries that go together: so many cells and products at most, one query at least
        made = np.append(0, np.cumsum(size))[edge]
        i = 0
        while i < len(edge) - 1:
            j = min(i + max(1, CELLS // width), max(i + 1, int(np.searchsorted(made, made[i] + CELLS, "right")) - 1), len(edge) - 1)
            a, b = edge[i], edge[j]
            own, n = np.searchsorted(edge, np.arange(a, b), "right") - 1 - i, size[a:b]
            post = np.arange(n.sum()) + np.repeat(self.first[code[a:b]] - (np.cumsum(n) - n), n)
            cell = np.repeat(own * width, n)
            cell += self.at[post]
            score = np.bincount(cell, np.repeat(qw[a:b], n) * self.w[post], (j - i) * width).reshape(j - i, width)
            query, at = np.nonzero(score >= _reached(score, k)[:, None])
            score, tid = np.round(score[query, at], 6), self.tids[at]
            query, tid, score = query[score > 0], tid[score > 0], score[score > 0]
            order = np.lexsort((tid, -score, query))
            query, tid, score = query[order], tid[order], score[order]
            rank = np.arange(len(query)) - np.searchsorted(query, query)
            yield sid[edge[i + query]][rank < k], tid[rank < k], score[rank < k]
            i = j


def _products(k: int):
    """Rows (country, block, chunk, kind, id, tokens, w) in this order, targets (kind 0) before queries (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, index, late = None, [], None, None

        def columns(rows: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, np.ndarray]:
            w, row = _flat(pa.Table.from_batches([rows]), "w")
            return rows.column("id").to_numpy()[row], pc.list_flatten(pc.split_pattern(rows.column("tokens"), " ")), w

        def found(rows: pa.Table | pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for sid, tid, score in index.best(*columns(rows), k):
                yield pa.RecordBatch.from_arrays([pa.array(sid), pa.array(tid), pa.array(score)], names=["sid", "tid", "tfidf_score"])

        for batch in batches:
            keys = [batch.column(c).dictionary_encode().indices.to_numpy(zero_copy_only=False) for c in ("country", "block", "chunk", "kind")]
            new = np.logical_or.reduce([np.diff(x, prepend=x[:1]) != 0 for x in keys])
            edge = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                if a == b:
                    continue
                rows = batch.slice(a, b - a)
                group, kind = [rows.column(c)[0].as_py() for c in ("country", "block", "chunk")], rows.column("kind")[0].as_py()
                if group != now:
                    if late is not None:
                        yield from found(late)
                    now, held, index, late = group, [], None, None
                if kind == 0:
                    held.append(rows)
                elif held:
                    if index is None:
                        index, held = _Postings(*columns(pa.Table.from_batches(held).combine_chunks().to_batches()[0])), [None]
                    if late is not None:
                        rows = pa.Table.from_batches([late, rows]).combine_chunks().to_batches()[0]
                    # the last query may go on in the next batch
                    sid = rows.column("id").to_numpy()
                    cut = int(np.searchsorted(sid, sid[-1]))
                    if cut:
                        yield from found(rows.slice(0, cut))
                    late = rows.slice(cut)
        if late is not None:
            yield from found(late)

    return run


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def nearest(queries: DataFrame, vocab: DataFrame, targets: DataFrame, cfg: BlockConfig) -> DataFrame:
    """topk from a vocabulary and the weights of the targets, as kept from an earlier run."""
    q = weights(queries, "sid", vocab)
    rows = [d.select("country", F.lit(kind).alias("kind"), F.col(of).alias("id"), "token", "w") for kind, (d, of) in enumerate(((targets, "tid"), (q, "sid")))]
    rows = rows[0].union(rows[1])
    pieces = rows.mapInArrow(_pieces, f"country string, kind int, id {dict(rows.dtypes)['id']}, tokens string, w array<double>")
    t = targets.groupBy("country").agg(F.approx_count_distinct("tid").alias("t"))
    return _best(pieces, queries, t, cfg, dict(targets.dtypes)["tid"])


def _best(pieces: DataFrame, queries: DataFrame, size: DataFrame, cfg: BlockConfig, tid: str) -> DataFrame:
    """The K nearest by pieces of vectors.  size: t, the number of targets of each country, roughly."""
    size = size.join(queries.groupBy("country").agg(F.count("*").alias("q")), "country")
    size = size.crossJoin(F.broadcast(size.agg(F.sum(F.col("q").cast("double") * F.col("t")).alias("all"))))  # one row
    # groups in proportion to the pairs, for all cores twice; the sides of a group so that copies are few
    tasks = 2 * queries.sparkSession.sparkContext.defaultParallelism
    most = F.col("q").cast("double") * F.col("t")
    size = size.withColumn("groups", F.ceil(F.least(tasks * most / F.col("all"), most / PAIRS)))
    size = size.withColumn("chunks", F.greatest(F.ceil(F.col("q") / CHUNK), F.least("groups", F.round(F.sqrt(F.col("groups") * F.col("q") / F.col("t"))))).cast("int"))
    size = size.select("country", "chunks", F.greatest(F.ceil(F.col("t") / BLOCK), F.ceil(F.col("groups") / F.col("chunks"))).cast("int").alias("blocks"))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    target = F.col("kind") == 0
    rows = pieces.join(F.broadcast(size), "country").withColumn("block", F.explode(F.when(target, F.array(own("blocks"))).otherwise(every("blocks"))))
    rows = rows.withColumn("chunk", F.explode(F.when(target, every("chunks")).otherwise(F.array(own("chunks")))))
    group = ["country", "block", "chunk"]
    rows = rows.select(*group, "kind", "id", "tokens", "w").repartition(_parts(queries), *group).sortWithinPartitions(*group, "kind", "id")
    scores = rows.mapInArrow(_products(cfg.k), f"sid {dict(queries.dtypes)['sid']}, tid {tid}, tfidf_score double")
    rank = Window.partitionBy("sid").orderBy(F.col("tfidf_score").desc(), "tid")
    return scores.withColumn("tfidf_rank", F.row_number().over(rank)).where(F.col("tfidf_rank") <= cfg.k)


def tfidf_block(queries: DataFrame, targets: DataFrame, cfg: BlockConfig) -> DataFrame:
    return pairs(topk(queries, targets, cfg), "tfidf")
