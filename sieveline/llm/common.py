"""What the operators of this subpackage share: scratch tables, keys, native helpers."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType, StructType

#: Six ASCII white-space characters: space, tab, line feed, vertical tab, form feed, return.
ASCII_SPACE = r"[\x20\x09-\x0D]+"
#: Stands for a null id in internal keys; results show the null again.
NULL_ID = -(2**63)
#: Most bytes of values that a table may have to be broadcast; its hash table takes about three times as many.
BROADCAST_BYTES = 48 << 20
IDLE = 3.0


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it in spark.checkpoint.dir.

    Only where the session names none and all executors are on this machine (as in tests) a local
    one is set; on a cluster a session without the setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        context = spark.sparkContext
        there = context._jsc.sc().getCheckpointDir()
        if there.isEmpty():
            if not context.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="sieveline-"))
            there = context._jsc.sc().getCheckpointDir()
        named = there.get()
    return named.rstrip("/")


def stored(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """df written as Parquet to the shared folder and read again; with `by` in a folder for each value of that column.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def dropped(*tables: DataFrame) -> None:
    """Deletes the files of stored tables that no later plan reads."""
    for df in tables:
        path = getattr(df, "_stored_at", None)
        if path:
            files, where = _files(df.sparkSession, path)
            files.delete(where, True)


def _width(kind: DataType, value: Column) -> Column:
    """Bytes of a value of this type, about."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, ArrayType):
        one = kind.elementType
        if isinstance(one, (StringType, BinaryType)):
            return F.coalesce(F.aggregate(value, F.lit(0), lambda n, x: n + F.coalesce(F.octet_length(x), F.lit(0)) + 16), F.lit(0)) + 16
        return F.coalesce(F.size(value), F.lit(0)) * (8 * len(one.fields) + 8 if isinstance(one, StructType) else 16) + 16
    if isinstance(kind, StructType):
        return sum((_width(f.dataType, value[f.name]) for f in kind.fields), F.lit(8))
    return F.lit(8)


def value_bytes(df: DataFrame) -> int:
    """Bytes of all values of df, about."""
    width = sum((_width(f.dataType, F.col(f"`{f.name}`")) for f in df.schema.fields), F.lit(8))
    return df.agg(F.sum(width.cast("long"))).first()[0] or 0


def broadcast_if(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if its values take no more than `most` bytes; else as it is, for a shuffle join.

    df should be a stored table, or little more than one, as its bytes are summed first. A stored
    table whose files alone take more isn't read for it.
    """
    path = getattr(df, "_stored_at", None)
    if path:
        files, where = _files(df.sparkSession, path)
        if files.getContentSummary(where).getLength() > most:
            return df
    return F.broadcast(df) if value_bytes(df) <= most else df


def slim(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, which gives what its task took back to the system at the end: workers stay for later stages."""

    @wraps(run)
    def slimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return slimmed


class Cache(dict):
    """What a worker knows by key, in two halves of at most `most` entries: keys in use come over from
    the older one. Tasks that follow each other share it; it is emptied `IDLE` seconds after the last."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old, self.timer = most, {}, None

    def keep(self, key, value) -> None:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def begin(self) -> None:
        if self.timer:
            self.timer.cancel()

    def end(self) -> None:
        self.timer = threading.Timer(IDLE, self._forget)
        self.timer.daemon = True
        self.timer.start()

    def _forget(self) -> None:
        self.clear()
        self.old = {}
        release()


def release() -> None:
    """Gives free memory of this process back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once for a row, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else kept. Pure ASCII texts take the quick built-in."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def space_words(text: Column) -> Column:
    """Runs without ASCII white space; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), ASCII_SPACE), "")


def row_key(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Adds _id (never null) and _th (hash of the text).

    Rows that repeat both have the same results, so the pair is a sound key even if ids repeat.
    """
    return df.withColumns({"_id": F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)), "_th": F.xxhash64(F.col(text_col))})
