"""Registered queries that pass through files: readers, writers, archives and their reports."""

from __future__ import annotations

import io
import zipfile
from datetime import datetime
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import data as D
from ..operators.scratch import scratch
from ..sources import readers, writers
from . import reports
from .catalog import query
from .fixtures import strip_sql, table

LABELS = "doc_id bigint, quality bigint, toxic bigint"
_LABELS = "SELECT doc_id, CAST(quality AS BIGINT) AS quality, CAST(toxic AS BIGINT) AS toxic FROM labels"


def _labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").select(*[F.col(c).cast("bigint").alias(c) for c in ("doc_id", "quality", "toxic")])


def _items(spark: SparkSession, d: str, most: int | None = None) -> DataFrame:
    """Benchmark texts on one line each, in order."""
    rows = table(spark, d, "benchmark").select("item_id", T.strip(F.regexp_replace("text", r"[\r\n]+", " ")).alias("value"))
    return (rows.where(F.col("item_id") < most) if most else rows).orderBy("item_id").select("value")


_LINE = strip_sql("regexp_replace(text, '[\\r\\n]+', ' ', 'g')")


def _joined(sep: str, where: str = "true") -> str:
    return f"(SELECT string_agg(line, {sep} ORDER BY item_id) FROM (SELECT item_id, {_LINE} AS line FROM benchmark WHERE {where}))"


@query(f"SELECT *, 'lines' AS kind FROM ({_LABELS}) UNION ALL SELECT *, 'array' FROM ({_LABELS})")
def src_json_or_jsonl(spark, d):
    path = scratch(spark)
    writers.jsonl(_labels(spark, d), f"{path}/a.jsonl")
    writers.single(writers.json_array(_labels(spark, d)), f"{path}/b.json")
    read = lambda name, kind: readers.json_or_jsonl(spark, f"{path}/{name}", LABELS).withColumn("kind", F.lit(kind))
    return read("a.jsonl", "lines").unionByName(read("b.json", "array"))


@query(f"SELECT *, 'synthetic_by_seed_' || quality || '.json' AS file FROM ({_LABELS})")
def src_json_dir(spark, d):
    """Two arrays that match, one that doesn't, and a file that doesn't parse."""
    path = scratch(spark)
    for k in (0, 1):
        writers.single(writers.json_array(_labels(spark, d).where(F.col("quality") == k)), f"{path}/synthetic_by_seed_{k}.json")
    writers.single(writers.json_array(_labels(spark, d)), f"{path}/other.json")
    writers.bytes_file(spark, f"{path}/synthetic_by_seed_bad.json", b"{broken")
    return readers.json_dir(spark, path, LABELS).withColumn("file", F.substring_index("file", "/", -1))


@query(f"SELECT *, 'qa_ar' AS name FROM ({_LABELS}) WHERE quality = 0 UNION ALL SELECT *, 'qa_en' FROM ({_LABELS}) WHERE quality = 1")
def src_qa_json(spark, d):
    path = scratch(spark)
    for k, name in enumerate(("qa_ar", "qa_en")):
        writers.single(writers.json_array(_labels(spark, d).where(F.col("quality") == k)), f"{path}/{name}.json")
    found = readers.optional_json(spark, {n: f"{path}/{n}.json" for n in ("qa_ar", "qa_en", "qa_missing")}, LABELS)
    out = None
    for name, rows in found.items():
        rows = rows.withColumn("name", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(f"SELECT 'items.txt' AS name, {_joined('chr(10)')} || chr(10) AS text")
def src_text(spark, d):
    path = scratch(spark)
    writers.single(_items(spark, d), f"{path}/items.txt")
    return _named(readers.load_document(spark, f"{path}/items.txt"))


def _corpus(names: list[str]):
    def run(spark, d):
        path = scratch(spark)
        for k, name in enumerate(names[:2]):
            writers.single(_items(spark, d, 5 * (k + 1)), f"{path}/{name}")
        return _named(readers.corpus(spark, [f"{path}/{n}" for n in names]))

    return run


_FIVE, _TEN = (f"{_joined('chr(10)', f'item_id < {n}')} || chr(10)" for n in (5, 10))
query(f"SELECT 'ar.txt' AS name, {_FIVE} AS text UNION ALL SELECT 'en.txt', {_TEN}", "src_corpus_files")(_corpus(["ar.txt", "en.txt", "missing.txt"]))
query(f"SELECT 'combined.txt' AS name, {_FIVE} AS text", "src_corpus_single")(_corpus(["combined.txt"]))


def _docx(paragraphs: list[str]) -> bytes:
    """The least word-processor file that holds these paragraphs and an empty one."""
    body = "".join(f"<w:p><w:r><w:t>{escape(p)}</w:t></w:r></w:p>" for p in ["", *paragraphs])
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def _documents(spark, d) -> str:
    """A folder with two word-processor files of five and ten items, and one that can't be read."""
    path = scratch(spark)
    for n, name in ((5, "ar"), (10, "en")):
        writers.bytes_file(spark, f"{path}/{name}.docx", _docx([r["value"] for r in _items(spark, d, n).collect()]))
    writers.bytes_file(spark, f"{path}/bad.docx", b"no archive")
    return path


def _named(files: DataFrame) -> DataFrame:
    return files.select(F.substring_index("path", "/", -1).alias("name"), "text")


@query(f"SELECT 'ar.docx' AS name, {_joined('chr(10) || chr(10)', 'item_id < 5')} AS text UNION ALL SELECT 'en.docx', {_joined('chr(10) || chr(10)', 'item_id < 10')}")
def src_docx_para2(spark, d):
    path = _documents(spark, d)
    return _named(readers.docx(spark, f"{path}/[ae][rn].docx"))


@query(f"SELECT 'ar.docx' AS name, {_joined('chr(10)', 'item_id < 5')} AS text UNION ALL SELECT 'en.docx', {_joined('chr(10)', 'item_id < 10')} UNION ALL SELECT 'bad.docx', ''")
def src_docx_para1(spark, d):
    return _named(readers.docx(spark, f"{_documents(spark, d)}/*.docx", separator="\n", strict=False))


_AR, _EN = (_joined("chr(10)", f"item_id < {n}") for n in (5, 10))


@query(f"SELECT 'ar' AS name, {_AR} AS text UNION ALL SELECT 'en', {_EN} UNION ALL SELECT 'combined', {_AR} || chr(10) || chr(10) || {_EN}")
def src_docx_pair(spark, d):
    path = _documents(spark, d)
    return readers.docx_pair(spark, f"{path}/ar.docx", f"{path}/en.docx")


@query("SELECT CAST(doc_id AS VARCHAR) AS seed_id, 'True' AS reviewer_verdict, 'a \"note\", ' || doc_id AS reviewer_notes FROM labels WHERE quality = 1")
def src_csv_corrections(spark, d):
    """Rows without a verdict go; a key given again counts by its last row."""
    path = scratch(spark)
    notes = F.concat(F.lit('a "note", '), F.col("doc_id").cast("string")).alias("reviewer_notes")
    verdicts = lambda good: table(spark, d, "labels").select(F.col("doc_id").alias("seed_id"), F.when(F.col("quality") == 1, good).alias("reviewer_verdict"), notes)
    verdicts("False").unionByName(verdicts("True")).coalesce(1).write.csv(path, header=True, quoteAll=True, escape='"')
    return readers.corrections_csv(spark, path).select("seed_id", "reviewer_verdict", "reviewer_notes")


@query(_LABELS)
def src_first_existing(spark, d):
    """The rows of the first of three paths that is there; the third has fewer."""
    path, rows = scratch(spark), _labels(spark, d)
    writers.jsonl(rows, f"{path}/second")
    writers.jsonl(rows.where("toxic = 1"), f"{path}/third")
    return readers.jsonl(spark, readers.first_existing(spark, [f"{path}/{n}" for n in ("first", "second", "third")]), LABELS)


@query(f"SELECT kind, doc_id, quality, toxic FROM ({_LABELS}), (VALUES ('json'), ('jsonl')) t(kind) UNION ALL SELECT 'text', doc_id, NULL, NULL FROM labels")
def snk_intermediate(spark, d):
    path, rows = scratch(spark), _labels(spark, d)
    for kind in ("json", "jsonl", "text"):
        writers.intermediate(rows, f"{path}/{kind}", kind)
    out = spark.read.text(f"{path}/text").select(F.lit("text").alias("kind"), F.col("value").cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("quality"), F.lit(None).cast("bigint").alias("toxic"))
    for kind in ("json", "jsonl"):
        out = out.unionByName(spark.read.schema(LABELS).json(f"{path}/{kind}", multiLine=kind == "json").withColumn("kind", F.lit(kind)))
    return out


@query("SELECT count(*) AS n, CAST(sum(quality) AS BIGINT) AS good, NULL AS nothing FROM labels")
def snk_json_report(spark, d):
    path = scratch(spark)
    row = _labels(spark, d).agg(F.count("*").alias("n"), F.sum("quality").alias("good"), F.lit(None).cast("int").alias("nothing"))
    writers.json_report(row, path)
    return spark.read.schema("n bigint, good bigint, nothing int").json(path)


def _backed_up(spark, d) -> tuple[str, str]:
    path = scratch(spark)
    writers.jsonl(_labels(spark, d), f"{path}/data")
    return path, writers.backup(spark, [f"{path}/data", f"{path}/raw"], f"{path}/backups")


@query(_LABELS)
def snk_backup(spark, d):
    _, copy = _backed_up(spark, d)
    return readers.jsonl(spark, f"{copy}/data", LABELS)


@query(_LABELS)
def snk_restore_latest(spark, d):
    """What was lost after the backup is there again."""
    path, _ = _backed_up(spark, d)
    writers.jsonl(_labels(spark, d).where("false"), f"{path}/data")
    writers.restore_latest(spark, f"{path}/backups", "data", f"{path}/data")
    return readers.jsonl(spark, f"{path}/data", LABELS)


@query("SELECT CASE WHEN toxic = 1 THEN 'archived' ELSE 'stays' END AS kind, doc_id FROM labels WHERE toxic IN (0, 1)")
def snk_archive_patterns(spark, d):
    """Files that match are moved with their rows, those of the same name from two folders too; others stay."""
    path, rows = scratch(spark), _labels(spark, d)
    for part in (0, 1):
        for name in ("x", "y"):
            writers.single(rows.where(f"toxic = {part} and (doc_id % 2 = 0) = {name == 'x'}".lower()).select(F.to_json(F.struct("doc_id")).alias("value")), f"{path}/{name}/{'raw' if part else 'kept'}.json")
    moved = writers.archive(writers.listing(spark, [f"{path}/*/raw*.json"]), f"{path}/archive")
    of = lambda where, kind: readers.jsonl(spark, where, "doc_id bigint").select(F.lit(kind).alias("kind"), "doc_id")
    return of(moved, "archived").unionByName(of(f"{path}/[xy]/*.json", "stays"))


@query(
    """SELECT name, count(*) AS n FROM (
  SELECT CASE WHEN quality = 0 THEN '20250102_000000' WHEN toxic = 1 THEN '20250103_000000' WHEN doc_id % 2 = 0 THEN '20250101_000000' ELSE '20250601_000000' END AS name FROM labels)
WHERE name <> '20250101_000000' GROUP BY 1"""
)
def snk_archive_old(spark, d):
    """Of archives older than 30 days those go that nothing refers to and that hold nothing essential; what the others hold."""
    path = scratch(spark)
    stamp = F.when(F.col("quality") == 0, "20250102_000000").when(F.col("toxic") == 1, "20250103_000000").when(F.col("doc_id") % 2 == 0, "20250101_000000").otherwise("20250601_000000")
    rows = _labels(spark, d).withColumn("stamp", stamp)
    names = [r["stamp"] for r in rows.select("stamp").distinct().collect()]  # four at most
    for name in names:
        held = rows.where(F.col("stamp") == name).select(F.to_json(F.struct("doc_id")).alias("value"))
        writers.single(held, f"{path}/{name}/{'keep' if name.startswith('20250103') else 'a'}.json")
    gone = writers.purge(spark, path, referenced={"20250102_000000"}, essential={"keep.json"}, now=datetime(2025, 6, 15))
    left = spark.read.text([f"{path}/{n}" for n in names if n not in gone]) if len(gone) < len(names) else spark.range(0).select(F.lit("").alias("value"))
    return left.groupBy(F.regexp_extract(F.input_file_name(), "([0-9]{8}_[0-9]{6})/[^/]*$", 1).alias("name")).agg(F.count("*").alias("n"))


@query("SELECT CAST(doc_id AS VARCHAR) || '.json' AS name FROM labels WHERE (SELECT count(*) FROM labels) > 100 ORDER BY toxic DESC, doc_id DESC OFFSET 50")
def snk_archive_oldest(spark, d):
    """All but the newest 50, of a listing with times, if there are more than 100."""
    files = table(spark, d, "labels").select(F.concat(F.col("doc_id").cast("string"), F.lit(".json")).alias("name"), F.format_string("%020d", "doc_id").alias("path"), F.col("toxic").alias("mtime"))
    return writers.oldest_beyond(files).select("name")


@query("SELECT CAST(2 AS BIGINT) AS deleted, count(*) AS n_left FROM labels")
def snk_cleanup(spark, d):
    """Deleted folders and files, and the rows of what stays."""
    path, rows = scratch(spark), _labels(spark, d)
    for name in ("cache/part", "x.tmp", "kept"):
        writers.jsonl(rows, f"{path}/{name}")
    n = writers.cleanup(spark, [f"{path}/cache", f"{path}/*.tmp"])
    return spark.read.text(f"{path}/*").agg(F.lit(n).cast("bigint").alias("deleted"), F.count("*").alias("n_left"))


@query(
    """WITH n AS (SELECT count(*) AS rows, count(*) FILTER (toxic = 1) AS toxic, count(*) FILTER (quality = 1) AS good FROM labels)
SELECT 'rows: ' || rows AS line FROM n UNION ALL SELECT 'labels:' UNION ALL SELECT '  good: ' || good FROM n UNION ALL SELECT '  any_toxic: ' || CASE WHEN toxic > 0 THEN 'true' ELSE 'false' END FROM n
UNION ALL SELECT 'languages:' UNION ALL SELECT DISTINCT '  - ' || lang FROM documents WHERE lang IS NOT NULL"""
)
def snk_yaml(spark, d):
    path = scratch(spark)
    n = _labels(spark, d).agg(F.count("*").alias("rows"), F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("quality") == 1).alias("good")).first()
    languages = [r["lang"] for r in table(spark, d, "documents").select("lang").where("lang is not null").distinct().orderBy("lang").collect()]
    writers.yaml_config(spark, {"rows": n["rows"], "labels": {"good": n["good"], "any_toxic": n["toxic"] > 0}, "languages": languages}, path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("SELECT 'toxic: ' || CASE WHEN (SELECT count(*) FROM labels WHERE toxic = 1) > 0 THEN 'found' ELSE 'not found' END || chr(10) || 'unlabelled: ' || CASE WHEN (SELECT count(*) FROM labels WHERE quality IS NULL) > 0 THEN 'found' ELSE 'not found' END AS text")
def rep_validation_overall(spark, d):
    """Which of the files are there; those without rows aren't written."""
    path, rows = scratch(spark), _labels(spark, d)
    for name, part in (("toxic", rows.where("toxic = 1")), ("unlabelled", rows.where("quality is null"))):
        if not part.isEmpty():
            writers.jsonl(part, f"{path}/{name}")
    return spark.range(1).select(F.lit(reports.overall({n: readers.exists(spark, f"{path}/{n}") for n in ("toxic", "unlabelled")})).alias("text"))


@query("SELECT 'labels there: ' || CASE WHEN (SELECT count(*) FROM labels) > 0 THEN 'PASS' ELSE 'FAIL' END || chr(10) || 'no toxic rows: ' || CASE WHEN (SELECT count(*) FROM labels WHERE toxic = 1) = 0 THEN 'PASS' ELSE 'FAIL' END || chr(10) || ((SELECT count(*) > 0 FROM labels)::INT + (SELECT count(*) = 0 FROM labels WHERE toxic = 1)::INT) || ' of 2 steps passed' AS text")
def rep_steps(spark, d):
    rows = table(spark, d, "labels")
    text = reports.steps([("labels there", not rows.isEmpty()), ("no toxic rows", rows.where("toxic = 1").isEmpty())])
    return spark.range(1).select(F.lit(text).alias("text"))


@query("SELECT doc_id % 5 AS key, count(*) AS calls, CAST(count(*) FILTER (toxic = 1) AS BIGINT) AS failures, count(*) FILTER (toxic = 1) >= 3 AS blocked FROM labels GROUP BY 1")
def agg_key_usage(spark, d):
    return D.key_usage(table(spark, d, "labels").select((F.col("doc_id") % 5).alias("key"), (F.col("toxic") == 1).alias("failed")))
