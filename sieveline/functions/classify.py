"""Verdict, language, scenario and heading classes, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ARABIC_LETTERS, SPACE, strip

#: Scenario words in order of preference (fixed values).
SCENARIOS = ["contract", "investment", "profit", "loss", "riba", "gharar", "murabaha", "musharaka", "mudaraba", "ijara", "salam", "istisna"]
#: Words that negate a claim (fixed values).
NEGATIONS = ["not", "never", "cannot", "incorrect", "wrong", "false", "لا", "ليس", "غير"]


def verdict_loose(output: Column) -> Column:
    """True if the lower-cased output has `verdict: true`, or `correct` anywhere, `incorrect` included."""
    low = F.lower(output)
    return low.contains("verdict: true") | low.contains("correct")


def verdict_lower(output: Column) -> Column:
    return F.lower(output).contains("verdict: true")


def verdict_exact(output: Column) -> Column:
    return output.contains("VERDICT: True")


def verdict_3way(output: Column) -> Column:
    return F.when(output.contains("VERDICT: True"), "True").when(output.contains("VERDICT: False"), "False").otherwise("Unknown")


def verdict_type(kind: Column) -> Column:
    return F.when(kind == "correct", "True").otherwise("False")


def has_letters(text: Column, letters: str = ARABIC_LETTERS) -> Column:
    """Whether any of the letters is in the text."""
    return text.rlike(f"[{letters}]")


def lang_any(text: Column, letters: str = ARABIC_LETTERS, found: str = "ar", other: str = "en") -> Column:
    return F.when(has_letters(text, letters), found).otherwise(other)


def lang_ratio(text: Column, letters: str = "؀-ۿ", share: float = 0.3, found: str = "ar", other: str = "en") -> Column:
    """found if more than the share of the characters are in the class."""
    n = F.regexp_count(text, F.lit(f"[{letters}]"))
    return F.when(n > F.lit(share).cast("double") * F.char_length(text), found).otherwise(other)


def scenario(text: Column, words: list[str] | None = None) -> Column:
    """The first word of the list that the lower-cased text contains, else `general`."""
    low = F.lower(text)
    return F.coalesce(*[F.when(low.contains(w), F.lit(w)) for w in words or SCENARIOS], F.lit("general"))


def negated(claim: Column, words: list[str] | None = None) -> Column:
    """Whether any negation word is a substring of the lower-cased claim."""
    low = F.lower(claim)
    return F.exists(F.array(*[F.lit(w) for w in words or NEGATIONS]), lambda w: low.contains(w))


def is_upper(text: Column) -> Column:
    return (F.upper(text) == text) & (F.lower(text) != text)


def heading_unit(paragraph: Column) -> Column:
    """One line of fewer than 200 characters: upper-case, with a digit among its first ten, or ending in a colon."""
    short = ~paragraph.contains("\n") & (F.char_length(paragraph) < 200)
    return short & (is_upper(paragraph) | F.substring(paragraph, 1, 10).rlike("[0-9]") | paragraph.endswith(":"))


def heading_chunk(text: Column) -> Column:
    """Struct (position, original) of the first heading among the first five lines; null if there is none."""
    lines = F.split(text, "\n")
    several = F.size(lines) > 1

    def is_heading(x: Column) -> Column:
        line = x["original"]
        n = F.char_length(line)
        kinds = is_upper(line) | line.rlike(rf"^[0-9]+[.)]{SPACE}+") | line.rlike(rf"^[IVX]+[.)]{SPACE}+") | line.endswith(":") | ((x["position"] == 0) & several)
        return (n < 200) & (n > 5) & kinds

    numbered = F.transform(F.slice(lines, 1, 5), lambda x, i: F.struct(i.alias("position"), strip(x).alias("original")))
    return F.get(F.filter(numbered, is_heading), F.lit(0))


def suspected(reference: Column, verdict: Column) -> Column:
    """The reference is UNKNOWN, or a True verdict has none."""
    return (F.coalesce(reference, F.lit("")) == "UNKNOWN") | ((verdict == "True") & (F.coalesce(reference, F.lit("")) == ""))


def balance_grade(ratio: Column, good: float, fair: float, names: tuple[str, str, str] = ("GOOD", "FAIR", "POOR")) -> Column:
    return F.when(ratio >= good, names[0]).when(ratio >= fair, names[1]).otherwise(names[2])


def issue_grade(n: Column) -> Column:
    return F.when(n == 0, "PASS").when(n <= 5, "WARN").otherwise("FAIL")
