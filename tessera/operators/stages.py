"""Cutting points of long plans."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: the one the cluster names.  Where none is named, a session of one process (local[...],
    as in tests) gets a temporary one; any other is refused, as executors would not see each other's files."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        given = spark.conf.get("spark.checkpoint.dir", None)
        if not given and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="stages-"))
    return sc._jsc.sc().getCheckpointDir().get()


def stage(df: DataFrame) -> DataFrame:
    """`df`, computed once and kept in the checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
