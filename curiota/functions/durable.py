"""Cutting lineage through the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and read from there.

    The folder is ``spark.checkpoint.dir``; only in local mode, where none is
    set, it is one of this machine.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None:
            if spark.sparkContext.master.split("[")[0] != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            where = tempfile.mkdtemp(prefix="curiota-checkpoint-")
        spark.sparkContext.setCheckpointDir(where)
    return df.checkpoint()
