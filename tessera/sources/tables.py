"""Sources and sinks: tab-separated and Parquet tables, ground truth, match lists, stage manifests and reports."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTITY = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])


def _tsv(spark: SparkSession, path: str):
    return spark.read.options(sep="\t", header=True, quote='"', escape='"', multiLine=True, mode="FAILFAST")


def scan_source(spark: SparkSession, path: str) -> DataFrame:
    """An entity table: Parquet with all its columns, or tab-separated text cut to the four that matter."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    header = _tsv(spark, path).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return _tsv(spark, path).schema(schema).csv(path).select(*ENTITY.names)


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path).schema(TRUTH).csv(path).withColumn("matched_entity_ids", F.coalesce("matched_entity_ids", F.lit("")))


def ids_of(lists: Column | str) -> Column:
    """A comma-joined list as an array without empty ids."""
    return F.array_remove(F.split(F.coalesce(F.col(lists) if isinstance(lists, str) else lists, F.lit("")), ","), "")


def read_matches(spark: SparkSession, path: str, column: str = "matched_entity_ids") -> DataFrame:
    """source1_entity_id and the array of ids of a written match list; of lines with one id, the last counts."""
    df = _tsv(spark, path).csv(path)
    if df.columns != ["source1_entity_id", column]:
        raise ValueError(f"{path}: unexpected header {df.columns}")
    lines = df.where("source1_entity_id is not null").select("source1_entity_id", ids_of(column).alias("ids"), F.monotonically_increasing_id().alias("line"))
    return lines.groupBy("source1_entity_id").agg(F.max_by("ids", "line").alias("ids"))


def read_match_lines(spark: SparkSession, path: str, column: str = "matched_entity_ids") -> DataFrame:
    """All lines of a match list as they are: sid, matched_entity_ids."""
    df = _tsv(spark, path).csv(path)
    if df.columns != ["source1_entity_id", column]:
        raise ValueError(f"{path}: unexpected header {df.columns}")
    return df.select(F.col("source1_entity_id").alias("sid"), F.coalesce(column, F.lit("")).alias("matched_entity_ids"))


def write_matches(lists: DataFrame, path: str, column: str = "matched_entity_ids") -> None:
    """source1_entity_id and ids, one line each in order of the id; range-sorted, so files follow one another."""
    rows = lists.select("source1_entity_id", F.array_join("ids", ",").alias(column)).orderBy("source1_entity_id")
    rows.write.options(sep="\t", header=True, emptyValue="", quote='"', escape='"').mode("overwrite").csv(path)


def staged(spark: SparkSession, path: str, build: Callable[[], DataFrame], **about: object) -> DataFrame:
    """A stage's table: read again if it was written to the end, else built, written and noted in a manifest."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        build().write.mode("overwrite").parquet(path)
        note = json.dumps({"rows": spark.read.parquet(path).count(), "finished_at": time.time(), **about})
        spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.manifest")
    return spark.read.parquet(path)


def manifest(spark: SparkSession, path: str) -> dict | None:
    note = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.manifest")
    if not note.getFileSystem(spark._jsc.hadoopConfiguration()).exists(note):
        return None
    return json.loads(spark.read.text(f"{path}.manifest").first()[0])


def traced(spark: SparkSession, path: str, build: Callable[[], DataFrame], **about: object) -> DataFrame:
    """As `staged`, but built again where its settings, or the tables it came from, are no longer those of its
    manifest.  about: what the table depends on, as JSON values."""
    note = manifest(spark, path)
    if note is None or any(note.get(k) != v for k, v in about.items()):
        drop(spark, path)
    return staged(spark, path, build, **about)


def sharded(spark: SparkSession, path: str, shards: int, build: Callable[[int], DataFrame], **about: object) -> DataFrame:
    """A stage in parts, each with a marker of its own: a run that is lost goes on at the first part that is missing.
    A part that was made with other settings, or of other tables, is built again."""
    note = manifest(spark, path)
    parts = [f"{path}/shard-{k:05d}" for k in range(shards)]
    if note is None or note.get("shards") != shards or any(note.get(k) != v for k, v in about.items()):
        if note is not None and note.get("shards") != shards:
            drop(spark, path)
        rows = 0
        for k, part in enumerate(parts):
            traced(spark, part, lambda k=k: build(k), shards=shards, **about)
            rows += manifest(spark, part)["rows"]
        note = json.dumps({"rows": rows, "shards": shards, "finished_at": time.time(), **about})
        spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.manifest")
    return spark.read.parquet(*parts)


def same_pairs(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables have the same (sid, tid), each as often."""
    both = a.select("sid", "tid", F.lit(1).alias("n")).union(b.select("sid", "tid", F.lit(-1)))
    return both.groupBy("sid", "tid").agg(F.sum("n").alias("n")).where("n <> 0").isEmpty()


def drop(spark: SparkSession, path: str) -> None:
    """Removes a stage's table, its manifest first, so that a half-removed one counts as not there."""
    for p in (f"{path}.manifest", path):
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_report(spark: SparkSession, path: str) -> list[dict]:
    """A report of few rows."""
    return [json.loads(r.value) for r in spark.read.text(path).collect()]


def require_same_k(spark: SparkSession, features: str, k: int) -> None:
    """Features made with another K than the model's are refused; a table without a manifest is tolerated."""
    note = manifest(spark, features)
    if note is not None and note.get("tfidf_k") not in (None, k):
        raise ValueError(f"features were made with K = {note['tfidf_k']}, the model wants {k}")


def write_report(df: DataFrame, path: str) -> None:
    """A table of few rows as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
