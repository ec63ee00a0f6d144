"""Alignment of chunks and question-answer pairs, by key, position, heading or embedding.

Chunk tables have chunk_id and text; alignments are ar_chunk_id, en_chunk_id (-1 for none), confidence, method.
Heading and semantic alignment are greedy one to one: lefts in order take their best unused right. Candidates
are scored in blocks. Headings are settled in turns of a bounded number of lefts, vectors in rounds (`matching`); neither gathers a document pair (`group`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.classify import heading_chunk
from ..functions.text import normal_heading
from .matching import match
from .order import rank_by_number, rank_within
from .scratch import stored
from .similarity import Texts, best_ratios, indel, like, seq_ratios

MATCHED = "ar_chunk_id long, en_chunk_id long, confidence double, method string"


def chunk_zip(left: DataFrame, right: DataFrame, *, key: str = "chunk_id", order: str = "ordinal") -> DataFrame:
    """The k-th left row of each key with the k-th right one. Columns get the suffixes _ar and _en."""
    w = Window.partitionBy(key).orderBy(order)
    mark = lambda df, s: df.withColumn("_k", F.row_number().over(w)).select(key, "_k", *[F.col(c).alias(f"{c}_{s}") for c in df.columns if c != key])
    return mark(left, "ar").join(mark(right, "en"), [key, "_k"]).drop("_k")


def positional(left: DataFrame, right: DataFrame, *, order: str) -> DataFrame:
    """The k-th row of all on the left with the k-th of all on the right. Suffixes as above, and pair (from 1)."""
    mark = lambda df, s: rank_by_number(df, order, name="pair").select("pair", *[F.col(c).alias(f"{c}_{s}") for c in df.columns])
    return mark(left, "ar").join(mark(right, "en"), "pair")


def headings(chunks: DataFrame, *, id_col: str = "chunk_id", text_col: str = "text") -> DataFrame:
    """chunk_id, position, original, normalized of each chunk with a heading."""
    rows = chunks.select(id_col, heading_chunk(F.col(text_col)).alias("h")).where("h is not null")
    return rows.select(id_col, "h.position", "h.original", normal_heading(F.col("h.original")).alias("normalized"))


@F.pandas_udf(DoubleType())
def seq_ratio_column(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the characters in matching blocks over both lengths; null as empty."""
    a, b, out = a.fillna("").to_list(), b.fillna("").to_list(), []
    for at in range(0, len(a), 512):
        x, y = Texts(a[at : at + 512]), Texts(b[at : at + 512])
        rows = np.arange(len(x.n))
        out.append(seq_ratios(x, y, rows, rows))
    return pd.Series(np.concatenate(out) if out else np.empty(0))


def indel_ratio(a: str, b: str) -> float:
    """100 times twice the longest common subsequence over both lengths; 100 of two empty strings."""
    return float(indel(a, Texts([b]))[0])


@F.pandas_udf(DoubleType())
def indel_ratio_column(a: pd.Series, b: pd.Series) -> pd.Series:
    """100 times twice the longest common subsequence over both lengths; null as empty. Strings that share a left one are taken at once."""
    a, b = a.fillna(""), b.fillna("")
    out = np.empty(len(a))
    for text, rows in b.reset_index(drop=True).groupby(a.to_numpy(), sort=False):
        for at in range(0, len(rows), 512):
            some = rows.iloc[at : at + 512]
            out[some.index] = indel(text, Texts(some))
    return pd.Series(out)


#: Strings in a block of the left and of the right side that are compared for being alike.
LIKE_LEFT, LIKE_RIGHT = 2048, 4096


def _bands(threshold: float):
    """Functions of a string column: its band of lengths, and the bands of all strings whose length allows a ratio of the threshold. The empty one is alone."""
    step = max(math.log((2 - threshold) / threshold), 0.01)
    at = lambda c, by: F.when(F.char_length(c) == 0, F.lit(-(10**6))).otherwise(F.floor(F.log(F.char_length(c).cast("double")) / F.lit(step) + F.lit(by)).cast("int"))
    around = lambda c: F.when(F.char_length(c) == 0, F.array(at(c, 0.0))).otherwise(F.sequence(at(c, -1 - 1e-9), at(c, 1 + 1e-9)))
    return lambda c: at(c, 0.0), around


def like_pairs(left: DataFrame, right: DataFrame, a: str, b: str, threshold: float) -> DataFrame:
    """Pairs of the distinct strings a of left and b of right whose common subsequence is at least threshold (above 0, at most 1)
    times half of both lengths.

    Strings are dealt to bands of lengths that allow the threshold, and blocks of neighbouring bands meet. In a task counts of
    characters and of neighbouring ones exclude most pairs before the subsequence is worked out. What is shuffled are blocks, never pairs.
    """
    band, bands = _bands(threshold)
    x = stored(left.select(F.col(a).alias("_s")).where("_s is not null").distinct().withColumn("_band", band("_s")))
    y = stored(right.select(F.col(b).alias("_s")).where("_s is not null").distinct().withColumn("_band", F.explode(bands("_s"))))
    # a row for each band, of which there are few
    sizes = lambda df, size: df.groupBy("_band").agg(F.ceil(F.count("*") / size).alias("_of"))
    n, m = stored(sizes(x, LIKE_LEFT)), stored(sizes(y, LIKE_RIGHT))

    def blocked(df: DataFrame, of: DataFrame, name: str) -> DataFrame:
        return df.join(F.broadcast(of), "_band").groupBy("_band", F.pmod(F.xxhash64("_s"), F.col("_of")).alias("_k")).agg(F.collect_list("_s").alias(name))

    met = n.join(m.withColumnRenamed("_of", "_to"), "_band").agg(F.sum(F.col("_of") * F.col("_to"))).first()[0] or 0
    each = blocked(x, n, "_a").drop("_k").join(F.broadcast(m), "_band").withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_of") - 1))).drop("_of")
    pairs = each.join(blocked(y, m, "_b"), ["_band", "_k"]).select("_a", "_b").repartition(min(max(met, 8), 10_000))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                p, q = batch["_a"][r].values, batch["_b"][r].values
                i, j = like(Texts(p.to_pylist()), Texts(q.to_pylist()), threshold)
                yield pa.RecordBatch.from_arrays([p.take(pa.array(i)), q.take(pa.array(j))], [a, b])

    return pairs.mapInArrow(near, f"`{a}` string, `{b}` string")


#: Texts in a block of the left and of the right side that meet in one step of a task.
LEFT_BLOCK, RIGHT_BLOCK = 64, 1024
#: Lefts of a group that are settled in one turn: within these bounds an eighth of the rights, or so many that whole lists have about PAIRS entries.
#: With few distinct rights they are up to MANY, as their lists are short.
TURN, MANY, PAIRS = (1024, 16_384), 131_072, 1 << 21


def _group(df: DataFrame, group: str | None) -> Column:
    return F.coalesce(F.concat(F.lit("g"), F.col(group).cast("string")), F.lit("")) if group else F.lit("")


def _scored(left: DataFrame, right: DataFrame, on: list[str], threshold: float, most: int | None) -> DataFrame:
    """on, ha, hb, score of distinct texts with a sequence ratio above the threshold; with `most` only those as good
    as a left's `most`-th best. Blocks of texts meet whose lengths allow the threshold; pairs are formed inside tasks only."""
    band, bands = _bands(threshold)
    rights = max(right.count(), 1)
    # few rights meet more lefts at a time
    n, m = max(1, -(-left.count() // min(max(LEFT_BLOCK, LEFT_BLOCK * RIGHT_BLOCK // rights), 1024))), -(-rights // RIGHT_BLOCK)
    salts = min(m, 64)
    block = lambda c, k: F.pmod(F.xxhash64(c), F.lit(k))
    x = left.groupBy(*on, band("ha").alias("_band"), block("ha", n).alias("_x")).agg(F.collect_list("ha").alias("_a"))
    x = x.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    y = right.groupBy(*on, bands("hb").alias("_bands"), block("hb", m).alias("_y")).agg(F.collect_list("hb").alias("_b"))
    y = y.select(*on, F.explode("_bands").alias("_band"), F.pmod("_y", F.lit(salts)).alias("_salt"), "_b")
    pairs = x.join(y, [*on, "_band", "_salt"]).select(*on, "_a", "_b").repartition(min(max(n * m, 8), 10_000))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                x, y = batch["_a"][r].values, batch["_b"][r].values
                i, j, s = best_ratios(Texts(x.to_pylist()), Texts(y.to_pylist()), threshold, most)
                same = [batch[c].take(pa.array(np.full(len(i), r))) for c in on]
                yield pa.RecordBatch.from_arrays([*same, x.take(pa.array(i)), y.take(pa.array(j)), pa.array(s, pa.float64())], [*on, "ha", "hb", "score"])

    kinds = "".join(f"{c} {left.schema[c].dataType.simpleString()}, " for c in on)
    found = pairs.mapInArrow(score, f"{kinds}ha string, hb string, score double")
    if most is None:
        return found
    best = Window.partitionBy(*on, "ha").orderBy(F.desc("score"))
    return found.withColumn("_r", F.rank().over(best)).where(F.col("_r") <= most).drop("_r")


SETTLED = "_grp string, kind int, a long, b long, score double"


def _settle(table: pa.Table) -> pa.Table:
    """What a group's lefts take one after the other, as far as their lists tell: rows of kind 0 with a left, the right and the score, and
    one of kind 1 with the number of lefts that were settled and whether (1) a list that isn't whole ended.

    Rows of the table: kind 0, a left a of text b; kind 1, a free right a of text b; kind 2, a left's text a, a right's text b,
    their score and whether (1) that list goes on behind what is given. Rights of one text are taken in order, so the smallest of each text competes.
    """
    kind, a, b, score, on = (table[c].to_numpy() for c in ("kind", "a", "b", "score", "more"))
    lefts, rights, lists = (np.flatnonzero(kind == k) for k in range(3))
    lefts = lefts[np.argsort(a[lefts])]
    rights = rights[np.lexsort((a[rights], b[rights]))]
    texts, starts = np.unique(b[rights], return_index=True)
    head, end = dict(zip(texts.tolist(), starts.tolist())), dict(zip(texts.tolist(), [*starts[1:].tolist(), len(rights)]))
    ids = a[rights].tolist()
    lists = lists[np.lexsort((-score[lists], a[lists]))]
    of, at = np.unique(a[lists], return_index=True)
    span = {t: [i, j] for t, i, j in zip(of.tolist(), at.tolist(), [*at[1:].tolist(), len(lists)])}
    to, worth, goes_on = b[lists].tolist(), score[lists].tolist(), on[lists]
    out, settled, cut = [], 0, 0
    for left, text in zip(a[lefts].tolist(), b[lefts].tolist()):
        here, got = span.get(text), None
        while here and here[0] < here[1]:
            stop = here[0] + 1
            while stop < here[1] and worth[stop] == worth[here[0]]:
                stop += 1
            free = [(ids[head[t]], t) for t in to[here[0] : stop] if head[t] < end[t]]
            if free:
                got = min(free)
                out.append((left, got[0], worth[here[0]]))
                head[got[1]] += 1
                break
            here[0] = stop
        if here and got is None and goes_on[here[1] - 1]:
            cut = 1
            break
        settled += 1
    rows = [(0, *r) for r in out] + [(1, settled, cut, 0.0)]
    columns = [pa.array([table["_grp"][0].as_py()] * len(rows)), *(pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.float64())))]
    return pa.Table.from_arrays(columns, ["_grp", "kind", "a", "b", "score"])


def heading_fuzzy(left: DataFrame, right: DataFrame, *, threshold: float = 0.3, group: str | None = None, first: int | None = None) -> DataFrame:
    """Alignment by the ratio of normalised headings, above the threshold: lefts in order of chunk_id take their
    best unused right, ties to the smallest. Equal pairs of headings are scored once.

    In each turn the next lefts of every group are scored against the headings of the rights that are left, and
    each list keeps its best headings, as many (with ties) as give PAIRS entries in all, or `first`. One task
    settles these lefts of a group in order; a turn ends early where a list that isn't whole is used up, and where that is early the next ones have fewer
    lefts and longer lists.
    The fewer rights are left, the more lefts come in a turn.
    So tasks hold a bounded part of a group, which may be null or hold all rows.
    """
    on = ["_grp"]

    def mark(df: DataFrame, h: str) -> DataFrame:
        rows = headings(df.withColumn("_g", F.struct(_group(df, group).alias("_grp"), F.col("chunk_id").cast("long").alias("chunk_id"))), id_col="_g")
        return rows.select("_g._grp", F.col("_g.chunk_id").alias("_id"), F.col("normalized").alias(h))

    spark, zero, none = left.sparkSession, F.lit(0).cast("long"), F.lit(None).cast("double")
    # ranking reads its rows several times
    rights = stored(rank_within(stored(mark(right, "hb")), [*on, "hb"], "_id", name="_r"))
    lefts = stored(rank_within(stored(mark(left, "ha")), on, "_id", name="_r"))
    ends, taken = spark.createDataFrame([], "_grp string, n long"), spark.createDataFrame([], "_grp string, hb string, n long")
    next_ = lambda df, done, keys, turn: df.join(done, keys, "left").where((F.col("_r") > F.coalesce("n", zero)) & (F.col("_r") <= F.coalesce("n", zero) + turn)).drop("n")
    matched, least, longest = [], first, TURN[1]
    while True:
        # a text's rights are taken in order, so those behind the number that was taken are free
        left_over = rights.join(taken, [*on, "hb"], "left").where(F.col("_r") > F.coalesce("n", zero))
        texts = left_over.groupBy(*on, "hb").agg(F.count("*").alias("n")).groupBy(*on).agg(F.count("*").alias("texts"), F.sum("n").alias("n"))
        most, n = texts.agg(F.max("texts"), F.max("n")).first()
        if not most:
            break
        turn = min(max(PAIRS // most, min(n // 8, longest), TURN[0]), MANY)
        first = min(turn, max(PAIRS // turn, 1) if least is None else least)
        free = stored(next_(rights, taken, [*on, "hb"], turn).withColumn("t", F.min("_id").over(Window.partitionBy(*on, "hb"))))
        texts = free.select(*on, "hb", "t").distinct()
        window = stored(next_(lefts, ends, on, turn).join(free.select(*on).distinct(), on, "left_semi").withColumn("t", F.min("_id").over(Window.partitionBy(*on, "ha"))))
        if window.isEmpty():
            break
        scores = stored(_scored(window.select(*on, "ha").distinct(), texts.select(*on, "hb"), on, threshold, first))
        per = Window.partitionBy(*on, "a")
        lists = scores.join(window.select(*on, "ha", F.col("t").alias("a")).distinct(), [*on, "ha"]).join(texts.withColumnRenamed("t", "b"), [*on, "hb"])
        lists = lists.withColumn("more", (F.count("*").over(per) >= first).cast("long")).withColumn("_r", F.row_number().over(per.orderBy(F.desc("score"), "b"))).where(F.col("_r") <= turn)
        rows = lists.select(*on, F.lit(2).alias("kind"), "a", "b", "score", "more")
        for kind, df in enumerate((window, free)):
            rows = rows.unionByName(df.select(*on, F.lit(kind).alias("kind"), F.col("_id").alias("a"), F.col("t").alias("b"), none.alias("score"), zero.alias("more")))
        # of the rights only those whose text is on a list
        listed = lists.select(*on, F.col("b").alias("b")).distinct().withColumn("kind", F.lit(1))
        rows = rows.where("kind <> 1").unionByName(rows.where("kind = 1").join(listed, [*on, "kind", "b"], "left_semi"))
        got = stored(rows.groupBy(*on).applyInArrow(_settle, SETTLED))
        matched.append(got.where("kind = 0").select(F.col("a").alias("ar_chunk_id"), F.col("b").alias("en_chunk_id"), F.col("score").alias("confidence"), F.lit("heading").alias("method")))
        used = got.where("kind = 0").select(*on, F.col("b").alias("_id")).join(free, [*on, "_id"]).groupBy(*on, "hb").agg(F.count("*").alias("n"))
        taken = stored(taken.unionByName(used).groupBy(*on, "hb").agg(F.sum("n").alias("n")))
        ends = stored(ends.unionByName(got.where("kind = 1").select(*on, F.col("a").alias("n"))).groupBy(*on).agg(F.sum("n").alias("n")))
        if first < turn and not got.where("kind = 1 and b = 1").where(F.col("a") < turn // 4).isEmpty():
            longest = turn // 4
            least = None if least is None else 4 * first
    return reduce(DataFrame.unionByName, matched) if matched else spark.createDataFrame([], MATCHED)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; null for a zero vector."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


#: Rows in a block of vectors, most pivots, stripes of a large group's side, least vectors and most bytes of a stripe.
VECTORS, PIVOTS, STRIPES, STRIPE, STRIPE_BYTES = 1024, 64, 16, 256, 1 << 25


def _clustered(df: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """df (_grp, i, e, n) with the vectors' dimension d, nearest pivot k and angle to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch["e"].value_lengths().to_numpy()
            for d in np.unique(size):
                rows = batch.filter(pa.array(size == d))
                u = rows["e"].flatten().to_numpy().reshape(len(rows), d) / rows["n"].to_numpy()[:, None]
                cosines = u @ pivots[int(d)].T if int(d) in pivots else np.full((len(u), 1), -1.0)
                k = cosines.argmax(1)
                angle = np.arccos(np.clip(cosines[np.arange(len(u)), k], -1, 1))
                yield pa.RecordBatch.from_arrays([*(rows[c] for c in ("_grp", "i", "e", "n")), pa.array(np.full(len(u), d, np.int32)), pa.array(k.astype(np.int32)), pa.array(angle)], ["_grp", "i", "e", "n", "d", "k", "angle"])

    return stored(df.mapInArrow(run, f"_grp string, i {df.schema['i'].dataType.simpleString()}, e array<double>, n double, d int, k int, angle double"))


def _products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Scalar products of the columns a[:, i] and b[:, j], summed in order of components."""
    out = np.zeros(len(i))
    for x, y in zip(a, b, strict=True):
        out += x[i] * y[j]
    return out


def near_vectors(a: DataFrame, b: DataFrame, threshold: float, *, pivots: int | None = None, rows: int = VECTORS) -> tuple[DataFrame, float]:
    """Pairs (a, b: the ids, and their score) of the same _grp and dimension whose cosine exceeds the threshold, and the share of pairs of
    one group and dimension that need not be compared. a and b: _grp, i, e, n (the vector and its length, above 0).

    Both sides of a group are dealt to stripes, and each stripe of one meets each of the other in a task: a vector is shuffled
    once for each stripe of the other side, of which there are STRIPES, however many vectors there are (until a stripe would exceed STRIPE_BYTES).
    Vectors are clustered by their nearest pivot. In a task two clusters meet only if the angle between their pivots, less
    both radii, allows the threshold (triangle inequality); blocks of `rows` vectors take one matrix product each.
    Vectors that lie in all directions alike, as at random in many dimensions, leave nothing to skip.
    """
    pivots, sample = pivots or min(PIVOTS, 1 + b.count() // 64), {}
    for r in b.orderBy(F.xxhash64("i"), "i").limit(pivots).collect():
        sample.setdefault(len(r["e"]), []).append(np.array(r["e"], float) / r["n"])
    sample = {d: np.array(v) for d, v in sample.items()}
    x, y = _clustered(a, sample), _clustered(b, sample)
    key = ["_grp", "d"]
    sizes = lambda df, s: df.groupBy(*key, F.col("k").alias(f"k{s}")).agg(F.count("*").alias(f"n{s}"), F.max("angle").alias(f"r{s}"))
    apart = [(d, i, j, float(v)) for d, p in sample.items() for (i, j), v in np.ndenumerate(np.arccos(np.clip(p @ p.T, -1, 1)))]
    between = a.sparkSession.createDataFrame(apart, "d int, ka int, kb int, apart double")  # at most pivots ** 2 rows
    met = sizes(x, "a").join(sizes(y, "b"), key).join(F.broadcast(between), ["d", "ka", "kb"], "left")
    allowed = F.coalesce(F.col("apart"), F.lit(0.0)) - F.col("ra") - F.col("rb") <= math.acos(max(-1.0, min(1.0, threshold))) + 1e-9
    total, kept = met.agg(F.sum(F.col("na") * F.col("nb")), F.coalesce(F.sum(F.when(allowed, F.col("na") * F.col("nb"))), F.lit(0))).first()

    def of(df: DataFrame, s: str) -> DataFrame:
        n = F.count("*")
        fewest = F.ceil(n * F.col("d") * 8 / STRIPE_BYTES)
        return df.groupBy(*key).agg(F.greatest(F.least(F.lit(STRIPES), F.ceil(n / STRIPE)), fewest).alias(f"_n{s}"))

    stripes = stored(of(x, "a").join(of(y, "b"), key))
    cells = stripes.agg(F.sum(F.col("_na") * F.col("_nb"))).first()[0] or 0

    def dealt(df: DataFrame, s: str, other: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"_n{other}") - 1)).alias(f"_{other}")
        return df.join(stripes, key).select(*key, F.pmod(F.xxhash64("i"), F.col(f"_n{s}")).alias(f"_{s}"), every, F.lit(s).alias("side"), "i", "e", "n", "k", "angle")

    limit, axes = math.acos(max(-1.0, min(1.0, threshold))) + 1e-9, {d: np.arccos(np.clip(p @ p.T, -1, 1)) for d, p in sample.items()}

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        d = table["d"][0].as_py()
        sides = []
        for s in "ab":
            t = table.filter(pc.equal(table["side"], s)).sort_by("k").combine_chunks()
            if not len(t):
                return
            e, n, k, angle = t["e"].combine_chunks().flatten().to_numpy().reshape(len(t), d), *(t[c].to_numpy() for c in ("n", "k", "angle"))
            clusters, first = np.unique(k, return_index=True)
            spans = [(c, i, j, angle[i:j].max()) for c, i, j in zip(clusters.tolist(), first.tolist(), [*first.tolist()[1:], len(k)], strict=True)]
            sides.append((t["i"].combine_chunks(), np.ascontiguousarray(e.T), n, e / n[:, None], spans))
        del table
        (ia, ea, na, ua, left), (ib, eb, nb, ub, right) = sides
        for ka, i0, i1, ra in left:
            meets = [np.arange(j0, j1) for kb, j0, j1, rb in right if d not in axes or not axes[d][ka, kb] - ra - rb > limit]
            meets = np.concatenate(meets) if meets else np.empty(0, np.int64)
            for p in range(i0, i1, rows):
                for q in range(0, len(meets), 2 * rows):
                    cols = meets[q : q + 2 * rows]
                    i, j = np.nonzero(~(ua[p : min(p + rows, i1)] @ ub[cols].T <= threshold - 1e-9))
                    for at in range(0, len(i), 1 << 16):
                        r, c = p + i[at : at + (1 << 16)], cols[j[at : at + (1 << 16)]]
                        score = _products(ea, eb, r, c) / (na[r] * nb[c])
                        found = ~(score <= threshold)
                        yield pa.RecordBatch.from_arrays([ia.take(pa.array(r[found])), ib.take(pa.array(c[found])), pa.array(score[found])], ["a", "b", "score"])

    kind = lambda df: df.schema["i"].dataType.simpleString()
    at = [*key, "_a", "_b"]
    both = dealt(x, "a", "b").select(*at, "side", "i", "e", "n", "k", "angle").unionByName(dealt(y, "b", "a"))
    found = both.repartition(min(max(cells, 8), 10_000), *at).groupBy(*at).applyInArrow(near, f"a {kind(a)}, b {kind(b)}, score double")
    return found, 1 - kept / total if total else 0.0


def semantic(left: DataFrame, right: DataFrame, *, embedding: str = "embedding", threshold: float = 0.5, group: str | None = None) -> DataFrame:
    """Alignment by the cosine of embeddings, above the threshold: lefts in order of chunk_id take their best unused right."""
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))

    def mark(df: DataFrame) -> DataFrame:
        grp = _group(df, group)
        rows = df.select(grp.alias("_grp"), F.struct(grp.alias("_grp"), F.col("chunk_id").cast("long").alias("chunk_id")).alias("i"), F.col(embedding).cast("array<double>").alias("e"))
        return stored(rows.withColumn("n", norm("e")).where("n > 0"))

    a, b = mark(left), mark(right)
    scored, _ = near_vectors(a, b, threshold)
    got = match(a.select(F.col("i").alias("a")), scored)
    return got.select(F.col("a.chunk_id").alias("ar_chunk_id"), F.col("b.chunk_id").alias("en_chunk_id"), F.col("score").alias("confidence"), F.lit("semantic").alias("method"))


def _rest(chunks: DataFrame, matched: DataFrame, side: str) -> DataFrame:
    return chunks.join(matched.select(F.col(f"{side}_chunk_id").alias("chunk_id")), "chunk_id", "left_anti")


def position_rest(left: DataFrame, right: DataFrame, matched: DataFrame) -> DataFrame:
    """What is unaligned on both sides, in order, zipped; confidence falls with the distance of relative positions to 0.1."""
    totals = left.agg(F.count("*").alias("na")).join(right.agg(F.count("*").alias("ne")))
    pairs = positional(_rest(left, matched, "ar").select("chunk_id"), _rest(right, matched, "en").select("chunk_id"), order="chunk_id").join(F.broadcast(totals))
    apart = F.abs(F.col("chunk_id_ar") / F.col("na") - F.col("chunk_id_en") / F.col("ne"))
    return pairs.select(F.col("chunk_id_ar").cast("long").alias("ar_chunk_id"), F.col("chunk_id_en").cast("long").alias("en_chunk_id"), F.greatest(F.lit(0.1).cast("double"), 1 - 2 * apart).alias("confidence"), F.lit("position").alias("method"))


def unmatched(left: DataFrame, right: DataFrame, matched: DataFrame) -> DataFrame:
    """Rows of either side without a match, with -1 on the other and no confidence."""
    none, zero, how = F.lit(-1).cast("long"), F.lit(0.0), F.lit("unmatched")
    a = _rest(left, matched, "ar").select(F.col("chunk_id").cast("long").alias("ar_chunk_id"), none.alias("en_chunk_id"), zero.alias("confidence"), how.alias("method"))
    b = _rest(right, matched, "en").select(none.alias("ar_chunk_id"), F.col("chunk_id").cast("long").alias("en_chunk_id"), zero.alias("confidence"), how.alias("method"))
    return a.unionByName(b)


def align_chunks(left: DataFrame, right: DataFrame, *, stages: tuple[str, ...] = ("heading", "position", "semantic"), embedding: str | None = None, cut=lambda df: df) -> DataFrame:
    """All stages, each on what is left, then the unmatched. In the default order position uses up the shorter
    side, so semantic finds nothing; `cut` may store the alignments between stages."""
    matched = None
    for stage in stages:
        keep = lambda df, side: df if matched is None else _rest(df, matched, side)
        if stage == "position":
            base = matched if matched is not None else left.sparkSession.createDataFrame([], MATCHED)
            got = position_rest(left, right, base)
        elif stage == "heading":
            got = heading_fuzzy(keep(left, "ar"), keep(right, "en"))
        elif embedding is None:
            continue
        else:
            got = semantic(keep(left, "ar"), keep(right, "en"), embedding=embedding)
        matched = cut(got if matched is None else matched.unionByName(got))
    return matched.unionByName(unmatched(left, right, matched))


def align_lookup(left: DataFrame, right: DataFrame, matched: DataFrame) -> DataFrame:
    """Alignments with both texts; unmatched ones go."""
    a = left.select(F.col("chunk_id").cast("long").alias("ar_chunk_id"), F.col("text").alias("text_ar"))
    b = right.select(F.col("chunk_id").cast("long").alias("en_chunk_id"), F.col("text").alias("text_en"))
    return matched.join(a, "ar_chunk_id").join(b, "en_chunk_id")

