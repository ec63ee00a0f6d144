"""Filter interaction audit: what each filter removes, repeats and costs in every order of application.

Documents become a few cells: for each part the number of documents with the same set of failed
filters (a bit mask), and how many of them are labelled good or toxic. The cells are unpivoted
against the steps of all orders. A running bit-or over a cell's steps in an order tells which of
its filters came earlier, so each row knows whether the step removes its documents, finds them gone,
or passes them; conditional sums by part, order and step give the counts, and a window over all
orders of a filter gives its total removals (Shapley values times the number of orders).

Texts are read once, without a shuffle of texts: repeats are found through digests of 256 bits.
The smallest id of each digest is an aggregate with partial results, and documents meet it (and
their labels) by their own id, so thousands of copies of a text are never gathered.

Defined results: null and empty texts are equal, have no words and hold no sign; a null part counts
as the empty string; a document without id repeats no other and is none that others repeat; rows
that repeat an id and its text don't repeat each other; of labels that repeat an id any may make
the document good or toxic; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, space_words, stored

LETTERS = "ABCDE"


def text_failures(text: Column) -> Column:
    """Bits 0 to 3 for the conditions A to D that need nothing but the text."""
    bit = lambda failed, k: F.when(failed, F.lit(1 << k)).otherwise(F.lit(0))
    of_words = let(
        space_words(text),
        lambda w: bit(F.size(w) < 200, 0) + bit(100 * F.size(F.array_distinct(w)) < 50 * F.size(w), 1),
    )
    capitals = 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.char_length(text)
    return of_words + bit(capitals, 2) + bit(text.rlike(r"[#$%&*|]"), 3)


def masks(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Of each document its part, mask of failed filters, and whether labels call it good and toxic.

    The text's digest and bits are stored, so that they are made once.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    facts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("_digest"), text_failures(text).alias("_bits"))
    facts = stored(facts, "audit-facts")
    first = facts.where("_id is not null").groupBy("_digest").agg(F.min("_id").alias("_id")).withColumn("_first", F.lit(True))
    flags = labels.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    repeats = F.when(F.col("_id").isNotNull() & F.col("_first").isNull(), F.lit(1 << 4)).otherwise(F.lit(0))
    joined = facts.join(first, ["_id", "_digest"], "left").join(flags, "_id", "left")
    no = F.lit(False)
    return joined.select("part", (F.col("_bits") + repeats).alias("mask"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def cells(masked: DataFrame) -> DataFrame:
    """Documents by part and mask: n, n_good, n_toxic."""
    return masked.groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("good").alias("n_good"), F.count_if("toxic").alias("n_toxic"))


def audit(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Counts of each part, order of the filters (named by letters, bit k for the k-th) and step.

    Orders are all permutations, so letters should be few; cells are at most 2 ** len(letters) for a part.
    """
    orders = F.array(*[F.lit("".join(p)) for p in permutations(letters)])
    steps = F.sequence(F.lit(1), F.lit(len(letters)))
    unpivoted = cells.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(steps))
    unpivoted = unpivoted.withColumn("_filter", F.col("filter_order").substr(F.col("step"), F.lit(1)))
    bit = F.create_map(*[F.lit(x) for k, letter in enumerate(letters) for x in (letter, 1 << k)])[F.col("_filter")]
    run = Window.partitionBy("part", "mask", "filter_order").orderBy("step")
    fails = unpivoted.withColumn("_bit", bit).withColumn("_fails", F.col("mask").bitwiseAND(F.col("_bit")))
    known = fails.withColumns(
        {
            "_earlier": F.coalesce(F.bit_or("_fails").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_so_far": F.bit_or("_fails").over(run.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    total = lambda when, n: F.coalesce(F.sum(F.when(when, F.col(n))), F.lit(0)).cast("long")
    gone, here = F.col("_earlier") != 0, (F.col("_fails") != 0) & (F.col("_earlier") == 0)
    counts = known.groupBy("part", "filter_order", "step", "_filter").agg(
        total(F.col("_so_far") == 0, "n").alias("kept"),
        total(here, "n").alias("removed"),
        total((F.col("_fails") != 0) & gone, "n").alias("redundant"),
        total((F.col("_fails") != 0) & (F.col("mask") == F.col("_bit")), "n").alias("unique_fails"),
        total(here, "n_good").alias("good_lost"),
        total(here, "n_toxic").alias("toxic_lost"),
    )
    return counts.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "_filter"))).drop("_filter")
