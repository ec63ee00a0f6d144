"""Readers of JSON Lines, JSON arrays, texts, word-processor files, web pages and corrections.

Paths are given to Spark's readers, so they may lie in any store that Spark reads. Line order is
kept as `line` (1-based, blank lines counted) where records need it.
"""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T
from ..operators.scratch import stored

RECORD = "instruction string, input string, output string, meta struct<language: string, seed_id: string, type: string, source: string, suspected_fabrication: boolean, chunk_id: bigint>"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or any file of a pattern, is there."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(where)
    return found is not None and len(found) > 0


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    return next((p for p in paths if exists(spark, p)), None)


def jsonl(spark: SparkSession, path: str, schema: str | StructType = RECORD, *, strict: bool = True) -> DataFrame:
    """Rows of JSON lines; blank lines go. A malformed line is an error if strict, else it goes too."""
    if strict:
        return spark.read.schema(schema).json(path, mode="FAILFAST")
    lines = spark.read.text(path).where(F.trim("value") != "")
    ok = F.try_parse_json("value").isNotNull() & F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    return lines.where(ok).select(F.from_json("value", ddl).alias("r")).select("r.*")


def jsonl_or_nothing(spark: SparkSession, path: str, schema: str | StructType = RECORD) -> tuple[DataFrame | None, str]:
    """(rows, '') or (None, message) if any line is bad or the file is missing."""
    if not exists(spark, path):
        return None, f"{path} is missing"
    bad = jsonl_audited(spark, path).where("problem is not null").orderBy("line").limit(1).collect()
    return (None, f"line {bad[0]['line']}: {bad[0]['problem']}") if bad else (jsonl(spark, path, schema), "")


#: Splits of whose first lines the numbers are broadcast; beyond it they are joined by a shuffle.
FEW_SPLITS = 100_000


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, line (from 1 in each file), raw of all lines of text files, which may have any size.

    Splits of a file are read by many tasks: a first pass counts each split's lines, whose sums give the number of its first line.
    """
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("raw"))
    splits = text.groupBy("path", "_at").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("path").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    splits = stored(splits.select("path", "_at", "_first", before.alias("_before")))
    if splits.count() <= FEW_SPLITS:
        splits = F.broadcast(splits)
    return text.join(splits, ["path", "_at"]).select("path", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line"), "raw")


def jsonl_audited(spark: SparkSession, path: str) -> DataFrame:
    """path, line, raw, problem (null, or `Invalid JSON`) of each line that isn't blank."""
    rows = numbered_lines(spark, path).where(F.trim("raw") != "")
    return rows.withColumn("problem", F.when(F.try_parse_json("raw").isNull(), "Invalid JSON"))


def published(spark: SparkSession, path: str) -> str:
    """The folder of the version that is current at a path that `writers.publish` writes to."""
    return f"{path.rstrip('/')}/{spark.read.text(f'{path.rstrip('/')}/CURRENT').first()[0]}"


def json_or_jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """JSON lines if the path ends in .jsonl, else one JSON array."""
    return spark.read.schema(schema).json(path, multiLine=not path.endswith(".jsonl"))


def json_dir(spark: SparkSession, folder: str, schema: str | StructType, pattern: str = "synthetic_by_seed_*.json") -> DataFrame:
    """Rows of all arrays in matching files, with `file`; files that don't parse go."""
    return spark.read.schema(schema).json(folder, multiLine=True, pathGlobFilter=pattern, mode="DROPMALFORMED").withColumn("file", F.input_file_name())


def optional_json(spark: SparkSession, paths: dict[str, str], schema: str | StructType) -> dict[str, DataFrame]:
    """The arrays of those files that are there, by name."""
    return {name: spark.read.schema(schema).json(p, multiLine=True) for name, p in paths.items() if exists(spark, p)}


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """path and text of whole files; an error if there is none."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def corpus(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path and text of those files that are there; no rows if none is."""
    there = [p for p in paths if exists(spark, p)]
    return text_files(spark, there) if there else spark.createDataFrame([], "path string, text string")


_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_paragraphs(content: bytes) -> list[str]:
    """Stripped paragraphs of a word-processor file that aren't empty."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    breaks = {f"{_WORD}tab": "\t", f"{_WORD}br": "\n", f"{_WORD}cr": "\n"}
    texts = ("".join(t.text or "" if t.tag == f"{_WORD}t" else breaks.get(t.tag, "") for t in p.iter()) for p in root.iter(f"{_WORD}p"))
    return [s for t in texts if (s := t.strip())]


def docx(spark: SparkSession, path: str, *, separator: str = "\n\n", strict: bool = True) -> DataFrame:
    """path and text of word-processor files. A file that can't be read is an error if strict, else an empty text."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for content in pdf["content"]:
                try:
                    out.append(separator.join(docx_paragraphs(bytes(content))))
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
                    if strict:
                        raise
                    out.append("")
            yield pd.DataFrame({"path": pdf["path"], "text": out})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, "path string, text string")


def docx_pair(spark: SparkSession, arabic: str, english: str, *, separator: str = "\n") -> DataFrame:
    """name (ar, en, combined) and text; combined is both, with a blank line between."""
    a, e = (docx(spark, p, separator=separator, strict=False).agg(F.max("text").alias(n)) for p, n in ((arabic, "ar"), (english, "en")))
    both = a.join(e).select("ar", "en", F.concat_ws("\n\n", "ar", "en").alias("combined"))
    return both.selectExpr("stack(3, 'ar', ar, 'en', en, 'combined', combined) as (name, text)")


def load_document(spark: SparkSession, path: str) -> DataFrame:
    """A word-processor file by its extension, any other as text."""
    return docx(spark, path) if posixpath.splitext(path)[1].lower() == ".docx" else text_files(spark, path)


def pages_text(pages: DataFrame, *, html_col: str = "html") -> DataFrame:
    """Pages with the column text. Fetching is outside the engine: pages come as a table."""
    return pages.withColumn("text", T.html_text(F.coalesce(F.col(html_col), F.lit(""))))


def corrections_csv(spark: SparkSession, path: str, *, key: str = "seed_id") -> DataFrame:
    """Corrections with a verdict, the last of each key, with `ordinal`."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"').withColumn("ordinal", F.monotonically_increasing_id())
    rows = rows.where(F.coalesce(F.trim("reviewer_verdict"), F.lit("")) != "")
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), "ordinal").alias("r")).select("r.*")


def count_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row n: lines that aren't blank; a missing file has none."""
    if not exists(spark, path):
        return spark.range(1).select(F.lit(0).cast("bigint").alias("n"))
    return spark.read.text(path).where(F.trim("value") != "").agg(F.count("*").alias("n"))
