"""Deduplicated landing of responses: a stream over a folder, the first row of each hash kept.

State is bounded by a watermark on arrival time; duplicates that come later are left to the batch step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """JSON rows as they land, with `arrived`."""
    return spark.readStream.schema(schema).json(folder).withColumn("arrived", F.current_timestamp())


def deduplicated(rows: DataFrame, *, cols: tuple[str, ...] = ("instruction", "input", "output"), late: str = "1 day") -> DataFrame:
    key = F.sha2(F.concat(*[F.coalesce(F.col(c), F.lit("")) for c in cols]), 256)
    return rows.withWatermark("arrived", late).withColumn("row_hash", key).dropDuplicatesWithinWatermark(["row_hash"])


def land(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what is there and stops."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
