"""A corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the next stage's docs.  All but the last return the columns of
documents, also columns that documents do not have of themselves, whatever their
names.  An empty table gives an empty table at every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import near, packing, quality, secrets, substring_dedup
from tessera.llm._shared import remove, shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject; the others keep their text.

    Null and empty texts have no words, so they go.  Null doc_id and repeated rows: each row is judged by itself.
    Nulls in other columns do not matter.  A text of any length is judged whole."""
    return quality.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of five-word shingle similarity 0.8 or more: that of the smallest doc_id.

    Rows of one doc_id with texts of several components: one for each component that the doc_id leads; of several in
    one component, and of rows that repeat, the least by hash of the text, then text, then other columns (nulls
    first), so that the choice does not depend on the layout.  Texts without words, null ones among them, are alike.
    Documents without doc_id stay, as nothing tells which of them comes first.  A text of any length is compared
    whole."""
    stay = near.near_dedup(docs.where("doc_id is not null")).where("doc_id = component_id")
    stay = stay.groupBy("doc_id", "root").agg(F.min("version").alias("version")).select("doc_id", "version")
    order = ["text", *[c for c in docs.columns if c not in ("doc_id", "text")]]
    own = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", near.version().alias("version")).join(stay, ["doc_id", "version"])
    first = Window.partitionBy("doc_id", "version").orderBy(*[f"_row.`{c}`" for c in order])
    kept = own.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("_row.*")
    return kept.union(docs.where("doc_id is null"))


def substring_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes each word covered by 20 words that start earlier elsewhere; a document with nothing left goes.

    Null and empty texts lose nothing and stay as they are, as do documents without doc_id, which take no part.  Rows
    that repeat count as one document.  Of rows of one doc_id with other texts, each loses what starts earlier in the
    other."""
    return substring_dedup.rewritten(docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces the secrets in each text; n_chars follows.

    A row out for each row in, whatever its doc_id and however often it is there.  Null texts stay null.  A text of
    any length, with a secret of any length or any number of them, is redacted in time linear in it."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences: a row for each piece of a document.

    Null and empty texts are the closing id alone.  Null doc_id and rows that repeat: each row is packed.  A text of
    any length is cut into windows.  Pieces of equal length are ranked by all their columns, so that ties do not
    change the sequences."""
    return packing.pack(docs)


STAGES = [("quality rules", quality_rules), ("near dedup", near_dedup), ("substring dedup", substring_removal), ("secret scans", secret_redaction), ("packing", pack)]

#: SQL expresses neither shingle similarity over hashes nor tokens; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read again; what a stage has read is removed
    once its own table is there."""
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        if k:
            remove(spark, f"{base}/{k - 1}")
    return docs
