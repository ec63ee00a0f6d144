"""Mixing sources to target weights: exact block quotas, dealt to output shards by a splitting tree.

Sources have weights; their targets share a multiple of all words, and stop at a multiple of
their own words, the excess being shared by the others until none is above. Documents of a source
are put in random order (a digest of seed and id), which gives each the range of words it takes on
the source's axis. A source's target is a number of whole passes over the axis and the words up to
a point of one more, so a mix takes exactly the target's words, and cuts one document of a source at most.

The axis is cut into blocks; a document belongs to the block of its first word. The blocks that the
passes draw are a source's quota. A tree over the output shards splits the quotas of all sources: each node hands
a share of its draws to its left half, with as many of each source as a multivariate hypergeometric draw
says, and the rest to the right; leaves have exact counts that add up to the quotas. A source's leaves take
disjoint ranges of a pseudo-random permutation of its draws, so every drawn block lies in one shard.
Documents meet their block's shards by key, and `shards` shuffles each shard for itself.

Sources meet in one task only as rows of the tree's nodes; documents of a source are ranked in 4096
ranges of the digest, so one that holds most rows spreads over all tasks. Texts are not shuffled unless carried.

Defined results: a null or empty text has no words and is never drawn; null sources are one source,
behind all others; a source without words has the target 0; rows that repeat a document are
documents of their own (equal ones are ordered by text); an empty table gives no rows; columns not named in
`carry` are ignored. Reruns, whatever the partitioning, give the same mix.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..operators.order import global_rank
from .common import broadcast_if, dropped, space_words, stored

WEIGHTS = (5, 2, 1)
#: Levels of the tree that one task works out for a node.
LEVELS = 6
#: Most draws in a tree, for which hypergeometric draws are exact; blocks grow beyond it.
DRAWS = 1 << 28


def targets(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """sizes (_src, source_size) with target: the sources' shares of share[0] / share[1] of all words.

    Weights repeat along the order of _src. Levels are compared in whole numbers; each round is one
    aggregate over the sources and stops at least one more. The result is a stored table.
    """
    ranged = stored(sizes.repartitionByRange(16, "_src").withColumn("_range", F.spark_partition_id()), "mix-sizes")
    ranked = global_rank(ranged, [F.col("_src")], F.col("_range"), "_place").drop("_range")
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_place") - 1) % len(weights) + 1).cast("int"))
    rows = stored(ranked.select("_src", "source_size", w.cast("long").alias("_w"), (F.col("source_size") * most).alias("_cap")), "mix-weights")
    dropped(ranged)
    up, down = share
    exact = lambda n: F.lit(Decimal(n)).cast("decimal(38,0)")
    words, weight = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_w"), F.lit(0))).first()
    stopped, open_ = 0, weight
    while True:
        above = F.col("_w") * exact(up * words - down * stopped) > F.col("_cap") * exact(down * open_) if open_ else F.lit(True)
        now = rows.agg(F.coalesce(F.sum(F.when(above, F.col("_cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("_w"))), F.lit(0))).first()
        if tuple(now) == (stopped, open_):
            break
        stopped, open_ = now
    level = F.col("_w") * F.lit(float(up * words - down * stopped)) / F.lit(float(max(1, down * open_)))
    return stored(rows.select("_src", "source_size", F.when(above, F.col("_cap").cast("double")).otherwise(level).alias("target")), "mix-targets")


def split(quotas: np.ndarray, low: int, high: int, shards: int, draws: int, seed: int, levels: int) -> list[tuple[int, int, np.ndarray]]:
    """Nodes (from, to, quotas) below a node after as many levels, or leaves. The first `k` of all shards draw floor(k * draws / shards)."""
    if high - low == 1 or not levels:
        return [(low, high, quotas)]
    mid = (low + high) // 2
    left = mid * draws // shards - low * draws // shards
    mine = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(quotas, left, method="marginals")
    return [*split(mine, low, mid, shards, draws, seed, levels - 1), *split(quotas - mine, mid, high, shards, draws, seed, levels - 1)]


def tree(quotas: DataFrame, shards: int, draws: int, seed: int) -> DataFrame:
    """Draws _n of each source (_src) in each _shard, from the quotas _n of the sources."""
    nodes = quotas.select("_src", "_n", F.lit(0).cast("long").alias("_low"), F.lit(shards).cast("long").alias("_high"))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_src")
        found = split(pdf["_n"].to_numpy(np.int64), int(pdf["_low"].iloc[0]), int(pdf["_high"].iloc[0]), shards, draws, seed, LEVELS)
        rows = [pd.DataFrame({"_src": pdf["_src"].to_numpy(), "_n": n, "_low": low, "_high": high})[n > 0] for low, high, n in found]
        return pd.concat(rows)

    depth = max(1, -(-max(1, (shards - 1).bit_length()) // LEVELS))
    for _ in range(depth):
        nodes = nodes.groupBy("_low", "_high").applyInPandas(grow, nodes.schema)
    return nodes.select("_src", "_n", F.col("_low").alias("_shard"))


def permuted(at: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The place of each `at` in a pseudo-random permutation of 0 to n - 1: a Feistel network, applied until it falls below n."""
    bits = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    n, key, x = n.astype(np.uint64), key.astype(np.uint64), at.astype(np.uint64)

    def mixed(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))

    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> bits[todo], x[todo] & mask[todo]
        for turn in range(1, 5):
            left, right = right, left ^ (mixed(right + key[todo] + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)) & mask[todo])
        x[todo] = (left << bits[todo]) | right
        todo = todo[x[todo] >= n[todo]]
    return x.astype(np.int64)


@F.pandas_udf(LongType())
def _permuted(at: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(permuted(at.to_numpy(np.int64), n.to_numpy(np.int64), key.to_numpy(np.int64)))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: tuple[str, ...] = ("doc_id",),
    weights: tuple[int, ...] = WEIGHTS,
    share: tuple[int, int] = (3, 2),
    most: int = 2,
    block_words: int = 1 << 12,
    shard_words: int = 1 << 22,
    seed: int = 17,
) -> DataFrame:
    """A row for each document: `carry`, size (words), source_size, target, pieces and taken (their words).

    A piece (pass, shard, length) is a copy of the document, or of its first `length` words.
    """
    text = F.col(text_col)
    size = F.size(space_words(text)).cast("long")
    source = F.col(source_col).cast("string")
    facts = docs.select(
        F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(carry)]).alias("_carry"),
        F.when(source.isNull(), F.lit("2")).otherwise(F.concat(F.lit("1"), source)).alias("_src"),
        size.alias("size"),
        F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("_h"),
        F.xxhash64(text).alias("_th"),
    )
    facts = stored(facts.withColumn("_b", F.substring("_h", 1, 3)), "mix-facts")
    sums = stored(facts.groupBy("_src", "_b").agg(F.sum("size").alias("_words")), "mix-ranges")
    sources = targets(sums.groupBy("_src").agg(F.sum("_words").alias("source_size")), weights=weights, share=share, most=most)

    # whole passes over the axis, then words of one more; blocks of the axis and of all draws
    words = sources.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    block = max(block_words, -(-int(words) // DRAWS))
    shards = max(1, -(-int(words) // shard_words))
    take, whole = F.floor(F.col("target") + 0.5).cast("long"), F.greatest(F.col("source_size"), F.lit(1))
    plan = sources.withColumns({"_full": F.floor(take / whole), "_rest": take % whole, "_blocks": F.ceil(F.col("source_size") / block)})
    plan = stored(plan.withColumn("_n", F.col("_full") * F.col("_blocks") + F.ceil(F.col("_rest") / block)), "mix-plan")
    draws = plan.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]

    leaves = tree(plan.where("_n > 0").select("_src", "_n"), shards, draws, seed)
    before = F.sum("_n").over(Window.partitionBy("_src").orderBy("_shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    leaves = leaves.withColumn("_from", before).withColumn("_at", F.explode(F.sequence(F.col("_from"), F.col("_from") + F.col("_n") - 1))).drop("_n", "_from")
    drawn = leaves.join(broadcast_if(plan.select("_src", "_n", "_blocks")), "_src")
    drawn = drawn.withColumn("_draw", _permuted("_at", "_n", F.xxhash64(F.lit(seed), "_src")))
    drawn = drawn.withColumns({"_pass": F.floor(F.col("_draw") / F.col("_blocks")), "_block": F.col("_draw") % F.col("_blocks")})
    drawn = stored(drawn.groupBy("_src", "_block").agg(F.array_sort(F.collect_list(F.struct(F.col("_pass").alias("pass"), F.col("_shard").alias("shard")))).alias("_draws")), "mix-draws")

    # each document's first word on its source's axis
    running = Window.rowsBetween(Window.unboundedPreceding, 0)
    starts = sums.withColumn("_before", F.sum("_words").over(running.partitionBy("_src").orderBy("_b")) - F.col("_words")).select("_src", "_b", "_before")
    order = running.partitionBy("_src", "_b").orderBy("_h", "size", "_th")
    axis = facts.withColumn("_in", F.sum("size").over(order) - F.col("size")).join(broadcast_if(stored(starts, "mix-starts")), ["_src", "_b"])
    axis = axis.withColumn("_o", F.col("_in") + F.col("_before")).join(broadcast_if(plan.drop("_n", "_blocks")), "_src")
    # documents without words are in no block; they are spread so as not to meet
    axis = axis.withColumn("_block", F.when(F.col("size") > 0, F.floor(F.col("_o") / block)).otherwise(-1 - F.pmod(F.xxhash64("_th", "_h"), F.lit(4096))))
    joined = axis.join(broadcast_if(drawn), ["_src", "_block"], "left")
    length = lambda x: F.when(x["pass"] < F.col("_full"), F.col("size")).otherwise(F.least(F.col("size"), F.col("_rest") - F.col("_o")))
    pieces = F.filter(F.transform(F.coalesce("_draws", F.array()), lambda x: F.struct(x["pass"].alias("pass"), x["shard"].alias("shard"), length(x).alias("length"))), lambda x: x["length"] > 0)
    taken = lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda n, x: n + x["length"])
    out = joined.withColumn("pieces", pieces)
    return out.select(*[F.col(f"_carry.k{i}").alias(c) for i, c in enumerate(carry)], "size", "source_size", "target", "pieces", taken(F.col("pieces")).alias("taken"))


def shards(mixed: DataFrame, *, id_col: str = "doc_id", seed: int = 17) -> DataFrame:
    """The mix as shards: shard, position (from 0, in random order within the shard), and the document's columns with
    pass and length. A shard has about `shard_words` words."""
    names = [c for c in mixed.columns if c not in ("pieces", "taken")]
    rows = mixed.select(*names, F.explode("pieces").alias("_p")).select(*names, "_p.*")
    key = F.md5(F.concat_ws("-", F.lit(f"{seed}-local"), F.col("shard"), F.col("pass"), F.col(id_col).cast("string")))
    order = Window.partitionBy("shard").orderBy(key, "pass", id_col, "size", "length")
    return rows.withColumn("position", (F.row_number().over(order) - 1).cast("long"))
