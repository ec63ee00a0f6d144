"""Greedy packing of paragraphs, sentences and chunks under word or token budgets.

Packing restarts with each document, so it is one ordered fold for a row, and rows are independent.
Batches of chunks run over whole groups; these are packed in ranges (`budgets`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.classify import heading_unit
from . import budgets
from .scratch import stored


def _groups(items: Column, limit: int, *, base: int = 0, closes=None) -> Column:
    """Groups first, last (positions from 0) and n of consecutive items with a cost n, in one pass.

    An item that would exceed the limit begins the next group, and so does one behind a group that
    closes(item, n). A group costs `base` besides its items. Only a new group copies what was found before.
    """
    shut = closes or (lambda x, n: F.lit(False))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("at"), F.lit(True).alias("shut"), F.array().cast("array<struct<first: int, last: int, n: bigint>>").alias("done"), F.lit(0).alias("first"))

    def ended(acc: Column) -> Column:
        group = F.struct(acc["first"].alias("first"), (acc["at"] - 1).alias("last"), acc["n"].alias("n"))
        return F.concat(acc["done"], F.array(group))

    def step(acc: Column, x: Column) -> Column:
        new = acc["shut"] | (acc["n"] + x["n"] > limit)
        n = F.when(new, F.lit(base) + x["n"]).otherwise(acc["n"] + x["n"]).cast("bigint")
        done = F.when(new & (acc["at"] > 0), ended(acc)).otherwise(acc["done"])
        return F.struct(n.alias("n"), (acc["at"] + 1).alias("at"), F.coalesce(shut(x, n), F.lit(False)).alias("shut"), done.alias("done"), F.when(new, acc["at"]).otherwise(acc["first"]).alias("first"))

    return F.aggregate(items, zero, step, lambda acc: F.when(acc["at"] == 0, acc["done"]).otherwise(ended(acc)))


def _texts(items: Column, group: Column) -> Column:
    return F.transform(F.slice(items, group["first"] + 1, group["last"] - group["first"] + 1), lambda x: x["text"])


def chunk_words(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", size: int = 1500, separator: str = "\n\n") -> DataFrame:
    """Chunks id, text, word_count, language of each document: paragraphs up to `size` words; one alone may exceed it."""
    items = F.transform(T.paragraphs(F.col(text_col), separator), lambda p: F.struct(p.alias("text"), T.word_count(p).alias("n")))
    docs = docs.select(id_col, F.col(lang_col).alias("language"), items.alias("_items"))
    groups = F.transform(_groups(F.col("_items"), size), lambda g: F.struct(F.array_join(_texts(F.col("_items"), g), separator).alias("text"), g["n"].alias("n")))
    rows = docs.select(id_col, "language", F.posexplode(groups).alias("id", "c"))
    return rows.select(id_col, "id", "c.text", F.col("c.n").alias("word_count"), "language")


def paragraph_units(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", separator: str = "\n\n") -> DataFrame:
    """Units index, text, token_count, is_heading, language of each document."""
    rows = docs.select(id_col, F.col(lang_col).alias("language"), F.posexplode(T.paragraphs(F.col(text_col), separator)).alias("index", "text"))
    return rows.select(id_col, "index", "text", T.tokens_floor(F.col("text")).alias("token_count"), heading_unit(F.col("text")).alias("is_heading"), "language")


def chunk_tokens(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", size: int = 15_000, overlap: int = 2, separator: str = "\n\n") -> DataFrame:
    """Token chunks: greedy up to `size`, closed behind a heading once over half full, begun with the last
    `overlap` sentences of the chunk before, its own overlap included."""
    units = F.transform(T.paragraphs(F.col(text_col), separator), lambda p: F.struct(p.alias("text"), T.tokens_floor(p).alias("n"), heading_unit(p).alias("heading")))
    docs = docs.select(id_col, F.col(lang_col).alias("language"), units.alias("_items"))
    groups = _groups(F.col("_items"), size, closes=lambda x, n: x["heading"] & (n > size * 0.5))
    docs = docs.withColumn("_packed", F.transform(groups, lambda g: F.struct(F.array_join(_texts(F.col("_items"), g), separator).alias("text"), g["n"].alias("n"), g["first"].alias("first"), g["last"].alias("last"))))
    empty = F.array().cast("array<string>")
    if overlap:
        # an overlap ends with a point, so the sentences of a chunk are those of its overlap and its own: each chunk is split once
        ends = lambda c: F.slice(F.reverse(T.sentences(c)), 1, overlap)
        behind = T.strip(F.lit(separator)) != ""  # else the separator adds nothing to the first sentence
        own = F.transform("_packed", lambda x: F.struct(ends(x["text"]).alias("alone"), F.when(behind, ends(F.concat(F.lit(separator), x["text"]))).alias("later")))
        docs = docs.withColumn("_own", own)

        def step(acc: Column, x: Column) -> Column:
            mine = F.when(F.size(acc["s"]) == 0, x["alone"]).otherwise(F.coalesce(x["later"], x["alone"]))
            s = F.slice(F.concat(mine, acc["s"]), 1, overlap)  # the last sentence first
            return F.struct(F.concat(acc["done"], F.array(acc["s"])).alias("done"), F.when(F.size(s) == overlap, s).otherwise(empty).alias("s"))

        none = F.struct(F.array().cast("array<array<string>>").alias("done"), empty.alias("s"))
        before = F.aggregate("_own", none, step, lambda acc: acc["done"])
    else:
        before = F.transform("_packed", lambda x: empty)
    rows = docs.select(id_col, "language", F.posexplode(F.zip_with("_packed", before, lambda c, s: F.struct(c.alias("c"), s.alias("s")))).alias("chunk_id", "x"))
    rows = rows.select(id_col, "chunk_id", "language", "x.c", F.when(F.size("x.s") > 0, F.concat(F.array_join(F.reverse("x.s"), ". "), F.lit("."))).otherwise("").alias("tail"))
    text = F.when(F.col("tail") == "", F.col("c.text")).otherwise(F.concat("tail", F.lit(separator), "c.text"))
    n = F.col("c.n") + F.when(F.col("tail") == "", F.lit(0)).otherwise(T.tokens_floor(F.col("tail")))
    return rows.select(
        id_col, "chunk_id", text.alias("text"), n.cast("bigint").alias("token_count"), "language", F.col("c.first").alias("start_paragraph_index"), F.col("c.last").alias("end_paragraph_index"), (F.col("c.last") - F.col("c.first") + 1).alias("paragraph_count")
    )


def chunk_sentences(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 1000, overlap: int = 100) -> DataFrame:
    """Chunks of sentences (split at points) up to `size` estimated tokens, each begun with the two last
    sentences of the one before, if it has two. start_sentence and overlap_tokens are the estimates that parameters give.

    Words are counted once for each sentence; the fold adds counts and keeps places, and texts are joined at the end.
    """
    parts = F.filter(F.transform(F.split(F.col(text_col), r"\."), T.strip), lambda x: x != "")
    docs = docs.select(id_col, parts.alias("_s")).select(id_col, "_s", F.transform("_s", T.word_count).alias("_w"))
    words = lambda i: F.coalesce(F.get("_w", i), F.lit(0).cast("bigint"))
    span = lambda first, last, n: F.struct(first.alias("first"), last.alias("last"), n.alias("n"))

    def fold(acc: Column, w: Column) -> Column:
        at, now = acc["at"], acc["now"]
        full = (now["n"] + w) * F.lit(1.3).cast("double") > size
        two = now["last"] > now["first"]
        begun = span(F.when(two, at - 2).otherwise(at), at, F.when(two, words(at - 2) + words(at - 1)).otherwise(F.lit(0).cast("bigint")) + w)
        grown = span(now["first"], at, now["n"] + w)
        first = at == 0
        return F.struct(F.when(full & ~first, F.concat(acc["done"], F.array(now))).otherwise(acc["done"]).alias("done"), F.when(full & ~first, begun).otherwise(grown).alias("now"), (at + 1).alias("at"))

    none = F.struct(F.array().cast("array<struct<first: int, last: int, n: bigint>>").alias("done"), span(F.lit(0), F.lit(0), F.lit(0).cast("bigint")).alias("now"), F.lit(0).alias("at"))
    ended = lambda acc: F.when(acc["at"] == 0, acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["now"])))
    chunks = F.transform(F.aggregate("_w", none, fold, ended), lambda c: F.struct(F.array_join(F.slice("_s", c["first"] + 1, c["last"] - c["first"] + 1), ". ").alias("text"), c["n"].alias("n")))
    rows = docs.select(id_col, F.posexplode(chunks).alias("id", "c"))
    return rows.select(
        id_col, "id", F.col("c.text").alias("text"), (F.col("c.n") * F.lit(1.3).cast("double")).alias("token_count"), (F.col("id") * (size // 100)).alias("start_sentence"), F.when(F.col("id") > 0, overlap).otherwise(0).alias("overlap_tokens")
    )


def pack_batches(chunks: DataFrame, *, group: str, order: str, tokens: str = "token_count", limit: int = 240_000, prompt_tokens: int = 0, output_tokens: int = 512) -> DataFrame:
    """Batches batch_id, chunk_ids, prompt_tokens, expected_output_tokens, total_tokens of each group's chunks in order.

    Groups of up to `budgets.RANGE` chunks are folded in a row each; larger ones are packed in ranges, by many tasks.
    """
    rows = chunks.select(group, F.col(order).cast("bigint").alias("id"), (F.col(tokens).cast("bigint") + output_tokens).alias("n"))
    sizes = rows.groupBy(F.col(group).alias("_of")).agg(F.count("*").alias("_size"))
    large = stored(sizes.where(F.col("_size") > budgets.RANGE).select("_of"))
    same = F.col(group).eqNullSafe(F.col("_of"))
    lists = rows.join(large, same, "left_anti").groupBy(group).agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("_items"))
    folded = F.transform(_groups(F.col("_items"), limit, base=prompt_tokens), lambda g: F.struct(F.transform(F.slice("_items", g["first"] + 1, g["last"] - g["first"] + 1), lambda x: x["id"]).alias("ids"), g["n"].alias("n")))
    batches = lists.select(group, F.posexplode(folded).alias("batch_id", "b")).select(group, "batch_id", F.col("b.ids").alias("chunk_ids"), F.col("b.n").alias("total_tokens"))
    if large.limit(1).count():
        packed = budgets.batch_ids(rows.join(large, same, "left_semi"), group=group, order="id", cost="n", limit=limit - prompt_tokens)
        wide = packed.groupBy(group, F.col("batch_id").cast("int").alias("batch_id")).agg(F.array_sort(F.collect_list("id")).alias("chunk_ids"), (F.sum("n") + prompt_tokens).alias("total_tokens"))
        batches = batches.unionByName(wide)
    output = (F.size("chunk_ids") * output_tokens).cast("bigint")
    return batches.select(group, "batch_id", "chunk_ids", (F.col("total_tokens") - output).alias("prompt_tokens"), output.alias("expected_output_tokens"), "total_tokens")


def make_seeds(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", separator: str = "\n\n", least_paragraph: int = 50, least_claim: int = 30, claims: int = 2, letters: str = "؀-ۿ", found: str = "ar", other: str = "en") -> DataFrame:
    """Seeds pos, k, claim, context, language: the first sentences of each long enough paragraph."""
    from ..functions.classify import lang_ratio

    rows = docs.select(id_col, F.posexplode(T.paragraphs(F.col(text_col), separator)).alias("pos", "p")).where(F.char_length("p") >= least_paragraph)
    good = F.slice(F.filter(T.sentences(F.col("p")), lambda s: F.char_length(s) > least_claim), 1, claims)
    rows = rows.select(id_col, "pos", "p", F.posexplode(good).alias("k", "claim"))
    return rows.select(id_col, "pos", "k", "claim", F.substring("p", 1, 1000).alias("context"), lang_ratio(F.col("p"), letters, found=found, other=other).alias("language"))
