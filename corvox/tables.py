"""Rows that are fixed for good in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def held(df: DataFrame) -> DataFrame:
    """The rows of df, computed once and written by checkpoint() to the folder in spark.checkpoint.dir: whoever reads
    them again gets the same rows in the same partitions, and a lost executor loses none. Where the setting is absent
    a folder is made if all of Spark runs on this machine; on a cluster that is an error."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        path = sc.getConf().get("spark.checkpoint.dir")
        if not path and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint()
