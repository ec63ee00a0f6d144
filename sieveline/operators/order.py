"""Order as data: ranks over whole tables without sorting them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffled_key(seed: int | str, key: Column) -> Column:
    """Hex digest that orders rows at random, the same in any engine and at any partitioning."""
    return F.sha2(F.concat(F.lit(f"{seed}-"), key.cast("string")), 256)


def global_rank(df: DataFrame, order: list[Column], bucket: Column, name: str = "rank") -> DataFrame:
    """df with the 1-based rank of each row in the whole table.

    bucket must be non-decreasing along the order and of few values (thousands): rows are ranked
    within their bucket, and the sizes of the buckets before are added. Only the sizes meet in one task.
    """
    df = df.withColumn("_bucket", bucket)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy("_bucket").agg(F.count("*").alias("_n")).select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy("_bucket").orderBy(*order)))
    out = ranked.join(F.broadcast(sizes), "_bucket")
    return out.withColumn(name, F.col("_rank") + F.col("_before")).drop("_bucket", "_rank", "_before")


def rank_by_hash(df: DataFrame, key: str, seed: int | str = 42, name: str = "rank") -> DataFrame:
    """Rank in the random order of shuffled_key; ties, of equal keys only, are broken by the key."""
    df = df.withColumn("_h", shuffled_key(seed, F.col(key)))
    return global_rank(df, [F.col("_h"), F.col(key)], F.substring("_h", 1, 3), name).drop("_h")


def rank_by_number(df: DataFrame, key: str, *more: str, buckets: int = 4096, name: str = "rank") -> DataFrame:
    """Rank by a numeric key (never null), then `more`. Its range is cut into equal buckets."""
    ends = df.agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
    at = F.floor((F.col(key) - F.col("_lo")) * buckets / (F.col("_hi") - F.col("_lo") + 1))
    return global_rank(df.join(F.broadcast(ends)), [F.col(key), *map(F.col, more)], at, name).drop("_lo", "_hi")


def rank_within(df: DataFrame, keys: list[str], order: str, buckets: int = 4096, name: str = "rank") -> DataFrame:
    """df with the 1-based rank of each row among those of its keys, by a numeric column (never null).

    Keys may hold most rows: ranges of the order are ranked for themselves, and the sizes of a key's ranges before are added.
    """
    ends = df.agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"))
    df = df.join(F.broadcast(ends)).withColumn("_bucket", F.floor((F.col(order) - F.col("_lo")) * buckets / (F.col("_hi") - F.col("_lo") + 1))).drop("_lo", "_hi")
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    sizes = df.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n")).select(*keys, "_bucket", (F.sum("_n").over(before) - F.col("_n")).alias("_before"))
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(order)))
    return ranked.join(sizes, [*keys, "_bucket"]).withColumn(name, F.col("_rank") + F.col("_before")).drop("_bucket", "_rank", "_before")


def first_rows(df: DataFrame, key: str, n: int, seed: int | str = 42) -> DataFrame:
    """n rows in random order: a top-n of each task, then of all."""
    return df.withColumn("_h", shuffled_key(seed, F.col(key))).orderBy("_h", key).limit(n).drop("_h")


def keep_first(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key. Each task keeps one row for a key before the shuffle, so hot keys do no harm."""
    names = df.columns
    best = df.select(key.alias("_key"), F.struct(*names).alias("_row"), F.col(order).alias("_o")).groupBy("_key").agg(F.min_by("_row", "_o").alias("_row"))
    return best.select("_row.*")


def top_k(df: DataFrame, partition: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each partition; Spark's group limit prunes each task's rows before the shuffle."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*partition).orderBy(*order))).where(F.col("_rn") <= k).drop("_rn")
