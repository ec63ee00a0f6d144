"""Reports: one-row aggregates, formatted at the edge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..operators import data as D


def counts(rows: DataFrame, *, letters: str | None = None) -> DataFrame:
    """One row: total, true, false, arabic, english by the loose verdict and the letters of the instruction."""
    arabic = C.has_letters(F.col("instruction"), letters) if letters else C.has_letters(F.col("instruction"))
    true = C.verdict_loose(F.col("output"))
    return rows.agg(F.count("*").alias("total"), F.count_if(true).alias("true"), F.count_if(~true).alias("false"), F.count_if(arabic).alias("arabic"), F.count_if(~arabic).alias("english"))


def generation(rows: DataFrame, *, target: int = 3000) -> DataFrame:
    """Counts, percentages and targets of a generated set: rows with language, output, reference."""
    return D.targets(rows, target=target, arabic=F.col("language") == "ar", true=C.verdict_exact(F.col("output")), unknown=F.col("reference") == "UNKNOWN")


def rebalance(rows: DataFrame, *, letters: str | None = None) -> DataFrame:
    """Counts with safe percentages, balance ratios and two grades."""
    pct = lambda c: F.coalesce(F.try_divide(F.col(c) * 100.0, F.col("total")), F.lit(0.0))
    row = counts(rows, letters=letters)
    row = row.withColumns({f"{c}_percentage": F.round(pct(c), 6) for c in ("true", "false", "arabic", "english")})
    row = row.withColumns({"balance_ratio": F.round(D.ratio_fixed(F.col("true"), F.col("false")), 6), "language_balance": F.round(D.ratio_fixed(F.col("arabic"), F.col("english")), 6)})
    return row.withColumns({"verdict_grade": C.balance_grade(F.col("balance_ratio"), 0.9, 0.8), "language_grade": C.balance_grade(F.col("language_balance"), 0.8, 0.6)})


def audit(rows: DataFrame, actions: list[str], *, letters: str | None = None) -> DataFrame:
    """Counts, ratio and the actions taken."""
    row = counts(rows, letters=letters).withColumn("balance_ratio", F.round(D.ratio_fixed(F.col("true"), F.col("false")), 6))
    return row.withColumn("actions", F.array(*[F.lit(a) for a in actions]).cast("array<string>"))


def validation(rows: DataFrame, issues: DataFrame, *, letters: str | None = None, shown: int = 20) -> DataFrame:
    """Counts, grade, the first issues and a status. issues: ordinal, issues array."""
    row = counts(rows, letters=letters)
    row = row.withColumn("balance_ratio", F.when((F.col("true") > 0) & (F.col("false") > 0), D.ratio_fixed(F.col("true"), F.col("false"))).when(F.col("total") > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    row = row.withColumn("balance_grade", C.balance_grade(F.col("balance_ratio"), 0.8, 0.6))
    return row.join(F.broadcast(D.issue_summary(issues, shown=shown))).withColumn("status", C.issue_grade(F.col("n_issues")))


def overall(found: dict[str, bool]) -> str:
    """A line for each file: found or not."""
    return "\n".join(f"{name}: {'found' if ok else 'not found'}" for name, ok in found.items())


def steps(results: list[tuple[str, bool]]) -> str:
    """Pass or fail of each step, and how many passed."""
    lines = [f"{name}: {'PASS' if ok else 'FAIL'}" for name, ok in results]
    return "\n".join([*lines, f"{sum(ok for _, ok in results)} of {len(results)} steps passed"])


def snapshot(sample: DataFrame, *, dataset: str, commit: str = "unknown") -> DataFrame:
    """One row on where a review sample comes from."""
    return sample.agg(F.count("*").alias("sample_size"), F.count_if(C.verdict_exact(F.col("output"))).alias("true")).withColumns({"dataset": F.lit(dataset), "commit": F.lit(commit)})


def file_stats(rows: DataFrame) -> DataFrame:
    """Rows, KB of JSON lines, verdicts and languages."""
    line = F.octet_length(F.to_json(F.struct("instruction", "input", "output"))) + 1
    return rows.agg(F.count("*").alias("n_rows"), F.round(F.sum(line) / 1024, 6).alias("kb"), F.count_if(C.verdict_lower(F.col("output"))).alias("true"), F.count_if(C.has_letters(F.col("instruction"))).alias("arabic"))


def markdown(row: DataFrame, title: str) -> DataFrame:
    """A one-row frame as a text: a heading and a line for each column."""
    parts = [F.concat(F.lit(f"- {c}: "), F.coalesce(F.col(c).cast("string"), F.lit("none"))) for c in row.columns]
    return row.select(F.concat_ws("\n", F.lit(f"# {title}"), F.lit(""), *parts).alias("text"))
