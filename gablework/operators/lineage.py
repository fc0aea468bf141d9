"""Cutting of lineage by reliable checkpoints in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; a temporary one only for a local session that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return named or tempfile.mkdtemp(prefix="spark-")


def kept(df: DataFrame) -> DataFrame:
    """df, computed once and written to the checkpoint folder."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint()
