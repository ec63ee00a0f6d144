"""Cleaning, counting and splitting of texts, as column expressions.

Character classes are spelled out where `\\s` and `\\d` would differ between engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of the cleaning rules.
SPACE = r"[ \t\n\r\x0B\f]"
ARABIC_MARKS = "؟؛،"
#: 28 base Arabic letters; hamza forms, ta marbuta and presentation forms are not among them (fixed value).
ARABIC_LETTERS = "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"
#: Line patterns of boilerplate, removed in this order (fixed values).
BOILERPLATE = [
    r"^.*?Table of Contents.*?(?=\n\n|\n[A-Z])",
    r"^.*?Contents.*?(?=\n\n|\n[A-Z])",
    r"Page \d+.*?\n",
    r"^\d+\s*$",
    r"^.*?Header.*?\n",
    r"^.*?Footer.*?\n",
    r"^\s*\d+\s*\n",
    r"Copyright.*?\n",
    r"All rights reserved.*?\n",
]


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def word_count(c: Column) -> Column:
    """Number of runs without white space."""
    return F.regexp_count(c, F.lit(r"[^ \t\n\r\x0B\f]+")).cast("bigint")


def tokens_floor(c: Column) -> Column:
    """Estimate of tokens: three quarters of the words, rounded down."""
    return F.floor(word_count(c) * F.lit(0.75).cast("double")).cast("bigint")


def tokens_scaled(c: Column) -> Column:
    """Estimate of tokens: 1.3 for each word, not rounded."""
    return word_count(c) * F.lit(1.3).cast("double")


def strip_boilerplate(c: Column) -> Column:
    """Contents, page numbers, headers, footers and notices removed, ignoring case, line by line."""
    for pattern in BOILERPLATE:
        c = F.regexp_replace(c, f"(?im){pattern}", "")
    return c


def punctuation_arabic(c: Column) -> Column:
    """No space before an Arabic mark and a space after it."""
    c = F.regexp_replace(c, rf"{SPACE}+([{ARABIC_MARKS}])", "$1")
    return F.regexp_replace(c, rf"([{ARABIC_MARKS}])(?!{SPACE})", "$1 ")


def punctuation_english(c: Column) -> Column:
    """No space before a mark and a space after it, at the end of the text too; so 3.14 becomes 3. 14."""
    c = F.regexp_replace(c, rf"{SPACE}+([.!?;,:])", "$1")
    c = F.regexp_replace(c, rf"([.!?])(?!{SPACE})", "$1 ")
    return F.regexp_replace(c, rf"([,;:])(?!{SPACE})", "$1 ")


def clean_whitespace(c: Column) -> Column:
    """Single spaces, lines without white space at their ends, at most one blank line between lines."""
    c = F.regexp_replace(c, " +", " ")
    c = F.regexp_replace(c, "\n{3,}", "\n\n")
    c = F.array_join(F.transform(F.split(c, "\n"), strip), "\n")
    return strip(F.regexp_replace(c, rf"\n{SPACE}*\n", "\n\n"))


def preprocess(c: Column, language: str) -> Column:
    """Boilerplate, then punctuation of the language (`arabic` or other), then white space."""
    c = strip_boilerplate(c)
    return clean_whitespace(punctuation_arabic(c) if language == "arabic" else punctuation_english(c))


def spacing_arabic(c: Column) -> Column:
    """No space before an Arabic mark, and one where white space follows it."""
    c = F.regexp_replace(c, rf"{SPACE}+([{ARABIC_MARKS}])", "$1")
    return F.regexp_replace(c, rf"([{ARABIC_MARKS}]){SPACE}+", "$1 ")


def clean_extracted(c: Column) -> Column:
    """Text of a page in one line, without page numbers.

    White space is collapsed first, so rules that need line ends can't match and aren't kept.
    """
    c = F.regexp_replace(c, f"{SPACE}+", " ")
    c = F.regexp_replace(c, r"(?i)Page [0-9]+", "")
    c = F.regexp_replace(c, rf"^{SPACE}*[0-9]+{SPACE}*$", "")
    return strip(spacing_arabic(c))


def html_text(c: Column) -> Column:
    """Text of a page: style and script elements, comments and tags go, common references are decoded."""
    c = F.regexp_replace(c, r"(?is)<(style|script)\b[^>]*>.*?</\1\s*>", "")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", "")
    c = F.regexp_replace(c, r"<[!/a-zA-Z][^>]*>", "")
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(sign))
    return clean_extracted(c)


def paragraphs(c: Column, separator: str = "\n\n") -> Column:
    """Array of stripped parts that aren't empty."""
    return F.filter(F.transform(F.split(c, separator), strip), lambda x: x != "")


def sentences(c: Column, pattern: str = "[.!?]+") -> Column:
    return F.filter(F.transform(F.split(c, pattern), strip), lambda x: x != "")


def overlap_tail(c: Column, n: int) -> Column:
    """The last n sentences, joined again; empty if there are fewer."""
    s = sentences(c)
    return F.when(F.size(s) >= n, F.concat(F.array_join(F.slice(s, -n, n), ". "), F.lit("."))).otherwise(F.lit(""))


def normal_heading(c: Column) -> Column:
    """A heading without digits and marks, in lower case with single spaces."""
    c = F.regexp_replace(c, r"(?U)[\d\.\)\-:]+", "")
    c = F.regexp_replace(c, r"(?U)[^\w\s]", " ")
    return F.trim(F.lower(F.regexp_replace(c, r"(?U)\s+", " ")))


def progress(current: Column, total: Column) -> Column:
    """`12.5%`; `0%` of nothing. One decimal of the number's exact value, a tie to the even one, as C's printf rounds.

    The part behind the point is cut in two, so that ten times each half is exact; Java's format and `bround` round the shortest
    decimals that stand for the number, which may lie on a tie where the number itself doesn't.
    """
    value = current.cast("double") / total * 100
    size, half = F.abs(value), F.lit(0.5).cast("double")
    whole = F.floor(size)
    part = size - whole
    high = F.floor(part * 2**26) / F.lit(float(2**26))
    tenths = F.floor(high * 10)
    over, short = (part - high) * 10, half - (high * 10 - tenths)
    tenths = tenths + F.when((over > short) | ((over == short) & (tenths % 2 == 1)), 1).otherwise(0)
    sign = F.when(value < 0, "-").otherwise("")
    text = F.concat(sign, F.format_string("%d.%d%%", whole + F.floor(tenths / 10), tenths % 10))
    # beyond 2 ** 53 nothing is behind the point
    return F.when(total == 0, F.lit("0%")).when(size < float(2**53), text).when(size.isNotNull(), F.format_string("%.1f%%", value))


def hash16(*parts: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the joined parts."""
    return F.substring(F.sha2(F.concat(*parts), 256), 1, 16)


def archive_time(c: Column) -> Column:
    """Time in a name like 20250131_235959; null if it is none."""
    return F.try_to_timestamp(c, F.lit("yyyyMMdd_HHmmss"))


def document_id(url: Column) -> Column:
    """The id in an exported document's address; an error if there is none."""
    found = F.regexp_extract(url, r"/document/d/([a-zA-Z0-9-_]+)", 1)
    return F.when(found != "", found).otherwise(F.raise_error(F.concat(F.lit("no document id in "), F.coalesce(url, F.lit("null")))).cast("string"))


def batch_size(n_seeds: Column, prompt_tokens: Column, *, limit: int = 240_000, reserve: int = 1000, most: int = 50) -> Column:
    """Seeds in a request: what fits the limit, one at least, `most` at most."""
    fits = F.floor((F.lit(limit - reserve)) / F.greatest(prompt_tokens, F.lit(1)))
    return F.when(n_seeds == 0, F.lit(0)).otherwise(F.least(F.lit(most), F.greatest(F.lit(1), F.least(n_seeds, fits)))).cast("bigint")
