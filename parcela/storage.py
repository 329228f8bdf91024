"""The folder that all executors share, and tables written to it."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Where the setting is absent the context's checkpoint folder is taken. If there is none, a
    temporary one is made, but only where everything runs in one process (``local``, as in tests):
    elsewhere executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not found and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(found or tempfile.mkdtemp(prefix="parcela-"))
    return found or sc._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/parcela/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
