"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder: the one the cluster names.  Where none is named, a session of one process (local[...],
    as in tests) gets a temporary one; any other is refused, as executors would not see each other's files."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        given = spark.conf.get("spark.checkpoint.dir", None)
        if not given and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc._jsc.sc().getCheckpointDir().get()


def settled(df: DataFrame) -> DataFrame:
    """`df`, computed once and written to the shared folder, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """The fold no label is learned from: crc32(doc_id as text) mod 5 = 0."""
    return F.crc32(doc_id.cast("string")) % 5 == F.lit(0)


def uniform(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the values alone, so that a sample is the same on every run."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / F.lit(float(1 << 40))


def bounded(rows: DataFrame, text: str, share: Column, most: int, size: int, longest: int, by: str | None = None) -> DataFrame:
    """A sample to learn from: different rows in the order of their hash, `most` of each group and `size` bytes of
    text at most, of texts of up to `longest` bytes.  share: of the rows that are looked at, enough to give as many.
    What reaches the driver is a hash and a length for each sampled row.  by: names the group; few, as counted before."""
    group = F.col(by) if by else F.lit("")
    some = rows.withColumn("_h", F.xxhash64(*rows.columns)).withColumn("_o", F.pmod("_h", F.lit(1 << 40)))
    some = some.where((F.col("_o") / F.lit(float(1 << 40)) < share) & (F.octet_length(text) <= longest))
    narrow = some.select(group.alias("g"), "_o", F.octet_length(text).alias("n")).distinct()
    first = Window.partitionBy("g").orderBy("_o", "n")
    least = narrow.withColumn("k", F.row_number().over(first)).where(F.col("k") <= most).collect()
    cuts, total = {}, 0
    for r in sorted(least, key=lambda r: (r.k, r.g)):
        total += r.n
        if total > size:
            break
        cuts[r.g] = r["_o"]
    cut = F.coalesce(*[F.when(group == g, F.lit(o)) for g, o in cuts.items()], F.lit(-1))
    return some.where(F.col("_o") <= cut).dropDuplicates(["_h"]).drop("_h", "_o")
