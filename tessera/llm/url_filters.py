"""URL filters as a sort-merge range join.

A host's labels are reversed, so that `www.example.net` becomes the key
`net.example.www.`; a rule for a host and its subdomains is then the interval of
keys that start with the rule's key.  Such intervals are nested or apart.  Urls
(by key and path) and rules (by key) are cut into ranges, sorted, and swept once:
a stack holds the rules whose interval is open, innermost on top, and the first
from the top whose path starts the url's path decides.  A url that no rule fits
gets the default verdict.

Ranges: cut at quantiles of a hash sample of the keys (`SAMPLE` a range; it
steers the balance only).  A rule goes to each range that its interval meets.
Keys that are cut more than once, as a frequent url's, are dealt over all ranges
that they bound, so that no key is in one task.

Defined cases.  Null url or one without `://`: host and path are empty.  Very
long urls: whole.  Null
page_id and repeated rows: a row out for each row in.  Rules that repeat: as one;
of equal host and path, block wins.  Null in a rule's host or path: as empty.
Empty tables: an empty result, or the default for each url.  Other columns are
ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm._shared import parts

SAMPLE = 20
LAST = "\U0010ffff"
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROW = "page_id {}, host string, path string, key string, action string, range int, kind int"


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_key(name: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(name, r"\.", -1)), "."), F.lit("."))


def _ranges(bounds: list[str], rules: bool):
    """Deals rows to ranges: a url to one, a rule to all that its interval meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_pylist()
            rows, where = [], []
            if rules:
                for k, key in enumerate(keys):
                    for r in range(bisect_left(bounds, key), bisect_right(bounds, key + LAST) + 1):
                        rows.append(k)
                        where.append(r)
            else:
                for k, (key, page) in enumerate(zip(keys, batch.column("page_id").to_pylist(), strict=True)):
                    low, high = bisect_left(bounds, key), bisect_right(bounds, key)
                    rows.append(k)
                    where.append(low if low == high else low + zlib.crc32(str(page).encode()) % (high - low + 1))
            take = pa.array(rows, pa.int64())
            columns = {n: batch.column(n).take(take) for n in ("page_id", "host", "path", "key", "action")}
            yield pa.RecordBatch.from_pydict(columns | {"range": pa.array(where, pa.int32()), "kind": pa.array([int(not rules)] * len(rows), pa.int32())})

    return run


def _sweep(default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rules: list[tuple[str, str, str, str]] = []
        now = None
        for batch in batches:
            take, rule, verdict = [], [], []
            columns = (batch.column(n).to_pylist() for n in ("range", "kind", "key", "host", "path", "action"))
            for k, (part, kind, key, name, start, action) in enumerate(zip(*columns, strict=True)):
                if part != now:
                    open_rules, now = [], part
                while open_rules and not key.startswith(open_rules[-1][0]):
                    open_rules.pop()
                if kind == 0:
                    open_rules.append((key, start, name + start, action))
                    continue
                fit = next((r for r in reversed(open_rules) if start.startswith(r[1])), None)
                take.append(k)
                rule.append(fit and fit[2])
                verdict.append(fit[3] if fit else default)
            some = batch.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([some.column(n) for n in ("page_id", "host", "path")] + [pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    return run


def url_filter(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """pages: page_id, url.  rules: host, path, action (allow or block).  Adds host, path, rule and verdict."""
    n = parts(pages.sparkSession)
    kind = dict(pages.dtypes)["page_id"]
    row = _ROW.format(kind)
    urls = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), F.lit(None).cast("string").alias("action"))
    urls = urls.withColumn("key", F.concat(reversed_key(F.col("host")), "path"))
    sample = [r.key for r in urls.select("key", F.xxhash64("page_id", "key").alias("h")).orderBy("h").limit(SAMPLE * n).collect()]
    sample.sort()
    bounds = [sample[len(sample) * k // n] for k in range(1, n)] if sample else []
    rules = rules.select(F.lit(None).cast(kind).alias("page_id"), F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "action").distinct()
    rules = rules.withColumn("key", reversed_key(F.col("host")))
    dealt = urls.mapInArrow(_ranges(bounds, False), row).union(rules.mapInArrow(_ranges(bounds, True), row))
    order = ["range", "key", "kind", F.length("path"), "path", "action"]
    dealt = dealt.repartition(n, "range").sortWithinPartitions(*order)
    return dealt.mapInArrow(_sweep(default), f"page_id {kind}, host string, path string, rule string, verdict string")


def op5(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return url_filter(pages, spark.createDataFrame(list(RULES), "host string, path string, action string"))


#: The same by plain SQL, from the definition of a rule.
OP5_SQL = r"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
r(rhost, rpath, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (
  SELECT page_id, host, path, rhost || rpath AS rule, action,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost) DESC NULLS LAST, length(rpath) DESC NULLS LAST) AS k
  FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM f WHERE k = 1
"""
