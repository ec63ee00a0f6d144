"""Record tables derived from the driver's tables, in DataFrame and SQL form, for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.records import JUDGE_EN
from ..operators.order import rank_by_number

WS = r"[ \t\n\r\x0B\f]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with labels as judged records."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    line = F.substring_index("text", "\n", 1)
    rows = rows.select(
        F.col("doc_id").alias("ordinal"), F.when(F.col("quality") == 1, "correct").otherwise("incorrect").alias("kind"), line.alias("claim"), F.col("text").alias("context"), line.alias("explanation"),
        F.coalesce("source", F.lit("UNKNOWN")).alias("reference"), F.col("lang").alias("language"), (F.col("toxic") == 1).alias("suspected"), "doc_id",
    )
    verdict = F.when(F.col("kind") == "correct", "True").otherwise("False")
    return rows.withColumns(
        {
            "instruction": F.concat(F.lit(JUDGE_EN[0]), "context", F.lit(JUDGE_EN[1]), "claim"),
            "input": F.concat(F.lit("Claim: "), "claim", F.lit("\nContext: "), "context"),
            "output": F.concat(F.lit("VERDICT: "), verdict, F.lit("\nExplanation: "), "explanation", F.lit("\nReference: "), "reference"),
        }
    )


_J0, _J1 = ("'" + t.replace("\n", "' || chr(10) || '") + "'" for t in JUDGE_EN)
JUDGED = f"""judged0 AS (
  SELECT doc_id AS ordinal, doc_id, CASE WHEN quality = 1 THEN 'correct' ELSE 'incorrect' END AS kind, split_part(text, chr(10), 1) AS claim, text AS context, split_part(text, chr(10), 1) AS explanation,
    coalesce(source, 'UNKNOWN') AS reference, lang AS language, toxic = 1 AS suspected
  FROM documents JOIN labels USING (doc_id)),
judged AS (
  SELECT *, {_J0} || context || {_J1} || claim AS instruction, 'Claim: ' || claim || chr(10) || 'Context: ' || context AS input,
    'VERDICT: ' || CASE WHEN kind = 'correct' THEN 'True' ELSE 'False' END || chr(10) || 'Explanation: ' || explanation || chr(10) || 'Reference: ' || reference AS output
  FROM judged0)"""


def qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive user and assistant turns as pairs; two conversations are the two languages of a chunk."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").withColumns({"next_role": F.lead("role").over(w), "answer": F.lead("text").over(w)}).where("role = 'user' and next_role = 'assistant'")
    return rows.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ordinal"), F.col("text").alias("question"), "answer", F.floor(F.col("conv_id") / 2).alias("chunk_id"), F.when(F.col("conv_id") % 2 == 0, "ar").otherwise("en").alias("language")
    )


QA = """turns AS (SELECT *, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer FROM conversations),
qa AS (
  SELECT conv_id * 1000 + turn AS ordinal, text AS question, answer, CAST(floor(conv_id / 2) AS BIGINT) AS chunk_id, CASE WHEN conv_id % 2 = 0 THEN 'ar' ELSE 'en' END AS language
  FROM turns WHERE role = 'user' AND next_role = 'assistant')"""


def chunks(spark: SparkSession, sf_dir: str, lang: str) -> DataFrame:
    """Documents of a language with a dense chunk_id from 0."""
    docs = table(spark, sf_dir, "documents").where(F.col("lang") == lang).select("doc_id", "text", F.col("lang").alias("language"))
    return rank_by_number(docs, "doc_id", name="r").select((F.col("r") - 1).alias("chunk_id"), "text", "language", "doc_id")


def _chunks_sql(lang: str) -> str:
    return f"chunks_{lang} AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS chunk_id, text, lang AS language, doc_id FROM documents WHERE lang = '{lang}')"


CHUNKS = f"{_chunks_sql('en')}, {_chunks_sql('de')}"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def words_sql(x: str) -> str:
    return rf"CAST(len(regexp_extract_all({x}, '[^ \t\n\r\x0B\f]+')) AS BIGINT)"


def paragraphs_sql(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, chr(10)), lambda p: {strip_sql('p')}), lambda p: p <> '')"
