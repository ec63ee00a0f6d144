"""Writers: JSON Lines, reports, review sheets, staged replacement, backups and archives.

Files are moved through the file system of their path, so any store that Spark writes will do.
"""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REVIEW = ["sample_id", "claim_preview", "model_verdict", "reviewer_verdict", "reviewer_explanation", "quality_score", "notes"]
STAMP = "%Y%m%d_%H%M%S"


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def jsonl(df: DataFrame, path: str, *, keep_nulls: bool = True) -> None:
    """One JSON object a line, in UTF-8."""
    df.write.mode("overwrite").option("ignoreNullFields", not keep_nulls).json(path)


def training_only(df: DataFrame, path: str) -> None:
    """JSON lines of the three training columns."""
    jsonl(df.select("instruction", "input", "output"), path)


def intermediate(df: DataFrame, path: str, kind: str = "text") -> None:
    """Text (first column), json (one array in one file) or jsonl; anything else is an error."""
    if kind == "jsonl":
        jsonl(df, path)
    elif kind == "json":
        json_array(df).write.mode("overwrite").option("lineSep", " ").text(path)
    elif kind == "text":
        df.select(F.col(df.columns[0]).cast("string")).coalesce(1).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unknown kind {kind}")


def json_array(df: DataFrame) -> DataFrame:
    """The lines of one JSON array of all rows, in one partition; no line holds more than a row."""
    one = lambda sign: df.sparkSession.range(0, 1, 1, 1).select(F.lit(sign).alias("value"))
    comma = F.when(F.monotonically_increasing_id() == 0, "").otherwise(",")
    rows = df.select(F.to_json(F.struct(*df.columns)).alias("j")).coalesce(1).select(F.concat(comma, "j").alias("value"))
    return one("[").unionAll(rows).unionAll(one("]")).coalesce(1)


def single(lines: DataFrame, path: str) -> None:
    """The lines of a one-column frame, in order, as one text file at the path itself."""
    staged = f"{path}_parts"
    lines.coalesce(1).write.mode("overwrite").text(staged)
    fs, part = _fs(lines.sparkSession, f"{staged}/part-*")
    target = _path(lines.sparkSession, path)
    fs.delete(target, True)
    for x in fs.globStatus(part):
        if not fs.rename(x.getPath(), target):
            raise OSError(f"can't rename {staged}")
    fs.delete(_path(lines.sparkSession, staged), True)


def bytes_file(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file of these bytes."""
    fs, where = _fs(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def json_report(row: DataFrame, path: str) -> None:
    """A one-row frame as one JSON object."""
    row.select(F.to_json(F.struct(*row.columns), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def chunks_manifest(chunks: DataFrame, batches: DataFrame, *, limit: int) -> DataFrame:
    """One row: config, the chunks and batches of each language, and totals."""
    c = chunks.groupBy("language").agg(F.array_sort(F.collect_list(F.struct("chunk_id", "token_count"))).alias("chunks"), F.count("*").alias("n_chunks"), F.sum("token_count").alias("tokens"))
    b = batches.groupBy("language").agg(F.array_sort(F.collect_list(F.struct("batch_id", "chunk_ids", "total_tokens"))).alias("batches"), F.count("*").alias("n_batches"))
    per = c.join(b, "language", "left")
    return per.agg(F.lit(limit).alias("limit"), F.array_sort(F.collect_list(F.struct("language", "n_chunks", "n_batches", "tokens", "chunks", "batches"))).alias("languages"), F.sum("n_chunks").alias("total_chunks"))


def csv_review(sample: DataFrame, path: str) -> None:
    """The review sheet: seven columns, those for the reviewer empty."""
    blank = [c for c in REVIEW if c not in sample.columns]
    sample.withColumns({c: F.lit("") for c in blank}).select(*REVIEW).coalesce(1).write.mode("overwrite").csv(path, header=True, quoteAll=True)


def raw_responses(df: DataFrame, path: str, by: str = "batch_id") -> None:
    """Response envelopes as JSON, in a folder for each batch."""
    df.write.mode("append").partitionBy(by).json(path)


def publish(df: DataFrame, path: str, *, keep: int = 2) -> int:
    """Writes JSON lines as a new version in a folder of its own below the path and makes it current if there
    are rows, which it returns. Read the path through `readers.published`.

    Current is what the small file CURRENT names. Its new content is written beside it and renamed over it,
    which file systems do at once, so readers find the old version or the new one, whole; a job that fails leaves
    the old one. Of older versions `keep` less one stay, for readers that have begun.
    """
    spark, version = df.sparkSession, f"v-{time.time_ns():020d}-{uuid.uuid4().hex}"
    root = path.rstrip("/")
    fs, there = _fs(spark, f"{root}/{version}")
    try:
        jsonl(df, f"{root}/{version}")
        n = spark.read.text(f"{root}/{version}").count()
    except BaseException:
        fs.delete(there, True)
        raise
    if not n:
        fs.delete(there, True)
        return 0
    bytes_file(spark, f"{root}/.{version}", version.encode())
    jvm, conf = spark.sparkContext._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, root).toUri(), conf).rename(_path(spark, f"{root}/.{version}"), _path(spark, f"{root}/CURRENT"), options)
    versions = sorted(str(x.getPath()) for x in fs.globStatus(_path(spark, f"{root}/v-*")) or [])
    for old in [v for v in versions if not v.endswith(version)][: max(0, len(versions) - keep)]:
        fs.delete(_path(spark, old), True)
    return n


def candidate_swap(df: DataFrame, path: str, *, dry_run: bool = False) -> int:
    """The rows of df; unless there are none or it is a dry run they become the current version at the path."""
    return df.count() if dry_run else publish(df, path)


def backup(spark: SparkSession, paths: list[str], root: str) -> str:
    """Copies of the paths that are there, in a folder named by the time."""
    out = f"{root}/{time.strftime(STAMP)}"
    util, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil, spark._jsparkSession.sessionState().newHadoopConf()
    for p in paths:
        fs, where = _fs(spark, p)
        if fs.exists(where):
            target = _path(spark, f"{out}/{where.getName()}")
            util.copy(fs, where, target.getFileSystem(conf), target, False, conf)
    return out


def restore_latest(spark: SparkSession, root: str, name: str, path: str) -> str | None:
    """The named part of the latest backup (by its folder's name) copied over the path; None without one."""
    fs, where = _fs(spark, f"{root}/*/{name}")
    found = sorted(str(x.getPath()) for x in fs.globStatus(where) or [])
    if not found:
        return None
    util, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil, spark._jsparkSession.sessionState().newHadoopConf()
    target_fs, target = _fs(spark, path)
    staged = _path(spark, f"{path.rstrip('/')}_restored")
    target_fs.delete(staged, True)
    util.copy(fs, _path(spark, found[-1]), target_fs, staged, False, conf)
    # only when the copy is whole; what was there is put aside and comes back if the copy can't take its place
    aside, there = _path(spark, f"{path.rstrip('/')}_before"), target_fs.exists(target)
    target_fs.delete(aside, True)
    if there and not target_fs.rename(target, aside):
        raise OSError(f"can't rename {target}")
    if not target_fs.rename(staged, target):
        if there:
            target_fs.rename(aside, target)
        raise OSError(f"can't rename {staged}")
    target_fs.delete(aside, True)
    return found[-1]


def listing(spark: SparkSession, patterns: list[str]) -> DataFrame:
    """path, name, mtime (ms), size of the files that match; a listing of names, kept on the driver as file moves are."""
    rows = []
    for p in patterns:
        fs, where = _fs(spark, p)
        rows += [(str(x.getPath()), x.getPath().getName(), x.getModificationTime(), x.getLen()) for x in fs.globStatus(where) or [] if x.isFile()]
    return spark.createDataFrame(rows, "path string, name string, mtime long, size long")


def oldest_beyond(files: DataFrame, *, above: int = 100, keep: int = 50) -> DataFrame:
    """If there are more than `above` files, all but the newest `keep`."""
    newest = files.orderBy(F.desc("mtime"), F.desc("path")).limit(keep).select("path")
    n = files.agg(F.count("*").alias("_n"))
    return files.join(newest, "path", "left_anti").join(F.broadcast(n)).where(F.col("_n") > above).drop("_n")


def archive(files: DataFrame, folder: str) -> list[str]:
    """Moves the files, which a manifest in the folder lists; their new paths."""
    spark = files.sparkSession
    out = f"{folder}/{time.strftime(STAMP)}"
    moved = []
    for row in files.orderBy("path").toLocalIterator():
        fs, where = _fs(spark, row["path"])
        fs.mkdirs(_path(spark, out))
        target, k = f"{out}/{where.getName()}", 0
        while fs.exists(_path(spark, target)):  # another file of this name
            k += 1
            target = f"{out}/{k}_{where.getName()}"
        if fs.rename(where, _path(spark, target)):
            moved.append(target)
    if moved:
        json_report(spark.createDataFrame([(moved,)], "files array<string>"), f"{out}/manifest")
    return moved


def purge(spark: SparkSession, folder: str, *, days: int = 30, referenced: set[str] = frozenset(), essential: set[str] = frozenset(), now: datetime | None = None) -> list[str]:
    """Deletes archives whose name tells a time more than `days` ago, unless referenced or
    holding a file of an essential name; names that tell none stay."""
    fs, where = _fs(spark, f"{folder}/*")
    cut, gone = (now or datetime.now()) - timedelta(days=days), []
    for x in fs.globStatus(where) or []:
        name = x.getPath().getName()
        try:
            old = datetime.strptime(name, STAMP) < cut
        except ValueError:
            continue
        held = {y.getPath().getName() for y in fs.listStatus(x.getPath())} if old and essential else set()
        if old and name not in referenced and held.isdisjoint(essential):
            fs.delete(x.getPath(), True)
            gone.append(name)
    return gone


def cleanup(spark: SparkSession, patterns: list[str]) -> int:
    """Deletes everything that matches; how many that was."""
    n = 0
    for p in patterns:
        fs, where = _fs(spark, p)
        for x in fs.globStatus(where) or []:
            n += bool(fs.delete(x.getPath(), True))
    return n


def yaml_config(spark: SparkSession, values: dict, path: str) -> None:
    """A flat or nested mapping as YAML lines."""

    def lines(x: dict, depth: int = 0) -> list[str]:
        out = []
        for k, v in x.items():
            if isinstance(v, dict):
                out += [f"{'  ' * depth}{k}:", *lines(v, depth + 1)]
            elif isinstance(v, list):
                out += [f"{'  ' * depth}{k}:", *[f"{'  ' * depth}  - {i}" for i in v]]
            else:
                out.append(f"{'  ' * depth}{k}: {str(v).lower() if isinstance(v, bool) else v}")
        return out

    spark.createDataFrame([(line,) for line in lines(values)], "value string").coalesce(1).write.mode("overwrite").text(path)
