"""Benchmark decontamination: a positional inverted index of training tokens.

Native: DataFrame expressions only. `build_index` stores postings (document, position, term) of
the training tokens; asked for the terms of given test items, it stores the postings of these
terms only, all of them. Each task writes its own segments, ordered by term, without a shuffle.

`phrase_matches` works on windows of `window` consecutive item words. For each window the two
terms with the fewest postings are its anchors. Their postings, less the anchor's offset, give
(document, item, offset) triples; a triple survives if one of its windows has both anchors. The
survivors' remaining terms are then intersected with the postings at the same offset, and runs
of matching positions at least one window long are exact matches. Work is in proportion to the
postings of the rarest terms, never to pairs of documents and items.

`proximity_matches` finds the documents in which all terms of an item lie within `slop` words of
an occurrence of its rarest term.

Defined results: null or empty texts have no words, and items without words match nothing; an
item shorter than a window is one window; repeated rows and repeated ids are judged by their own
text; null item ids count as hits but are not listed; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, broadcast_if, row_key, stored

#: Anything but digits, a-z and non-ASCII, in a text that ascii_lower has treated.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10


def alnum_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def item_words(items: DataFrame, *, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Stored table of items with words: _item (unique), item_id, p, term, n."""
    rows = items.select(F.col(id_col).alias("item_id"), alnum_words(F.col(text_col)).alias("_w")).where(F.size("_w") > 0)
    rows = stored(rows, "items").withColumn("_item", F.monotonically_increasing_id())
    return stored(rows.select("_item", "item_id", F.size("_w").alias("n"), F.posexplode("_w").alias("p", "term")), "item-words")


def build_index(docs: DataFrame, terms: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored postings _id, _th, pos, term of docs; with `terms` (column term) of these terms only."""
    keyed = row_key(docs.select(id_col, text_col), id_col, text_col)
    rows = keyed.select("_id", "_th", F.posexplode(alnum_words(F.col(text_col))).alias("pos", "term"))
    if terms is not None:
        rows = rows.join(broadcast_if(terms), "term")
        rows = rows.drop("term").sortWithinPartitions("term_id") if "term_id" in terms.columns else rows
    return stored(rows, "postings")


def _anchors(words: DataFrame, counts: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(_item, pairs: the anchor positions of each of its windows) and (_item, p, term_id: all anchors)."""
    known = words.join(broadcast_if(counts), "term_id", "left").fillna(0, ["postings"])
    items = known.groupBy("_item").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("p", "postings", "term_id"))).alias("w"))
    picks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("n") - window, F.lit(0))),
        lambda s: F.slice(F.sort_array(F.transform(F.slice(F.col("w"), s + 1, window), lambda x: F.struct(x["postings"].alias("c"), x["p"].alias("p")))), 1, 2),
    )
    # a window one of whose terms has no posting occurs nowhere
    pairs = F.array_distinct(F.transform(F.filter(picks, lambda x: x[0]["c"] > 0), lambda x: F.transform(x, lambda y: y["p"])))
    items = stored(items.select("_item", "w", pairs.alias("pairs")).where(F.size("pairs") > 0), "anchors")
    used = items.select("_item", "pairs", "w", F.explode(F.array_distinct(F.flatten("pairs"))).alias("p"))
    return items.select("_item", "pairs"), used.select("_item", "p", F.get(F.col("w"), F.col("p"))["term_id"].alias("term_id"))


def phrase_matches(index: DataFrame, words: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """Matched positions: _id, _th, _item, pos, each within an occurrence of an item's window.

    index: postings with term_id; words: item words with term_id.
    """
    counts = stored(index.groupBy("term_id").agg(F.count("*").alias("postings")), "posting-counts")
    pairs, anchors = _anchors(words, counts, window)
    found = index.join(broadcast_if(stored(anchors, "anchor-terms")), "term_id").select("_id", "_th", "_item", (F.col("pos") - F.col("p")).alias("off"), "p")
    met = found.groupBy("_id", "_th", "_item", "off").agg(F.collect_set("p").alias("ps"))
    met = met.join(broadcast_if(pairs), "_item").where(F.exists("pairs", lambda x: F.size(F.array_except(x, F.col("ps"))) == 0))
    met = stored(met.select("_id", "_th", "_item", "off"), "survivors")
    hit_docs = stored(met.select("_id", "_th").distinct(), "survivor-docs")
    wanted = met.join(broadcast_if(words.select("_item", "p", "n", "term_id")), "_item").withColumn("pos", F.col("p") + F.col("off"))
    there = index.join(broadcast_if(hit_docs), ["_id", "_th"], "left_semi").select("_id", "_th", "pos", "term_id").distinct()
    same = wanted.join(there, ["_id", "_th", "pos", "term_id"])
    by = Window.partitionBy("_id", "_th", "_item", "off")
    runs = same.withColumn("_run", F.col("p") - F.row_number().over(by.orderBy("p")))
    runs = runs.withColumn("_len", F.count("*").over(Window.partitionBy("_id", "_th", "_item", "off", "_run")))
    return runs.where(F.col("_len") >= F.least(F.col("n"), F.lit(window))).select("_id", "_th", "_item", "pos")


def proximity_matches(docs: DataFrame, items: DataFrame, *, slop: int, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Distinct (id_col, item_id, pos): occurrences of an item's rarest term with all its other terms within slop words."""
    words, terms = _with_term_ids(item_words(items, id_col=item_id_col, text_col=item_text_col))
    index = build_index(docs, terms, id_col=id_col, text_col=text_col)
    counts = stored(index.groupBy("term_id").agg(F.count("*").alias("postings")), "posting-counts")
    need = words.select("_item", "item_id", "term_id").distinct().join(broadcast_if(counts), "term_id", "left").fillna(0, ["postings"])
    per = need.groupBy("_item").agg(F.count("*").alias("kinds"), F.min(F.struct("postings", "term_id"))["term_id"].alias("rare"))
    need = stored(need.join(per, "_item"), "proximity-terms")
    rare = index.join(broadcast_if(need.where("term_id = rare").select("term_id", "_item", "item_id", "kinds")), "term_id").select("_id", "_th", "_item", "item_id", "kinds", F.col("pos").alias("at"))
    # the other postings are looked up by blocks of slop + 1 words, so each is compared with its neighbourhood only
    width = slop + 1
    around = rare.withColumn("_b", F.explode(F.array(*[F.floor(F.col("at") / width) + k for k in (-1, 0, 1)])))
    others = index.join(broadcast_if(need.select("term_id", "_item")), "term_id").withColumn("_b", F.floor(F.col("pos") / width))
    near = around.join(others, ["_id", "_th", "_item", "_b"]).where(F.abs(F.col("pos") - F.col("at")) <= slop)
    whole = near.groupBy("_id", "_th", "_item", "item_id", "at").agg(F.size(F.collect_set("term_id")).alias("_k"), F.max("kinds").alias("kinds")).where("_k = kinds")
    return whole.select(F.col("_id").alias(id_col), "item_id", F.col("at").alias("pos")).distinct()


def _with_term_ids(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    terms = stored(stored(words.select("term").distinct(), "term-list").withColumn("term_id", F.monotonically_increasing_id()), "terms")
    return stored(words.join(broadcast_if(terms), "term").drop("term"), "item-terms"), terms


def decontaminate(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Every row of docs with n_words, n_hit and hit_items (distinct item ids) added."""
    words, terms = _with_term_ids(item_words(items, id_col=item_id_col, text_col=item_text_col))
    index = build_index(docs, terms, id_col=id_col, text_col=text_col)
    hits = phrase_matches(index, words, window=window)
    ids = broadcast_if(words.select("_item", "item_id").distinct())
    per = hits.groupBy("_id", "_th").agg(F.size(F.collect_set("pos")).cast("long").alias("n_hit"), F.collect_set("_item").alias("_items"))
    named = per.select("_id", "_th", F.explode("_items").alias("_item")).join(ids, "_item").groupBy("_id", "_th").agg(F.collect_set("item_id").alias("hit_items"))
    per = stored(per.drop("_items").join(named, ["_id", "_th"]), "hits")
    out = row_key(docs, id_col, text_col).join(broadcast_if(per), ["_id", "_th"], "left").withColumn("n_words", F.size(alnum_words(F.col(text_col))).cast("long"))
    return out.drop("_id", "_th").withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "hit_items": F.coalesce("hit_items", F.array().cast(per.schema["hit_items"].dataType))})
