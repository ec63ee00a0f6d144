"""Tables in the folder that all executors share, which cut the lineage of iterative operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder, or on the local disk where none is set and all runs on this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = f"file://{tempfile.mkdtemp(prefix='sieveline-')}"
    return f"{root.rstrip('/')}/records-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read again: a lost executor costs a re-read."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
