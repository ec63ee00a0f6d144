"""Greedy packing of a long ordered list under a budget, by many tasks.

A batch takes items until one doesn't fit, which begins the next; so what a range of items does depends on
nothing but how much the open batch already holds. Each range of `RANGE` items is made a step function from that
amount to the amount after the range. Functions of `FAN` neighbours are composed to one, level by level,
until one is left for a group; then the amounts are handed down, and each range finds its own breaks.
No task sees more than a range of items, or `FAN` functions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .order import rank_within
from .scratch import stored

RANGE, FAN = 4096, 128
#: More than any batch holds: nothing fits, so the first item begins a batch.
FULL = 1 << 62


class Steps:
    """amount -> amount + total up to bounds[0]; beyond it values[j] up to bounds[j + 1]."""

    def __init__(self, total: int, bounds: np.ndarray, values: np.ndarray):
        last = np.r_[bounds[1:] > bounds[:-1], True]  # of equal bounds the last counts
        bounds, values = bounds[last], values[last]
        new = np.r_[True, values[1:] != values[:-1]]
        self.total, self.bounds, self.values = total, bounds[new], values[new]

    def __call__(self, amount: np.ndarray) -> np.ndarray:
        amount = np.asarray(amount, np.int64)
        at = np.searchsorted(self.bounds, amount, "left") - 1
        return np.where(at < 0, amount + self.total, self.values[np.maximum(at, 0)])

    def then(self, other: Steps) -> Steps:
        early = other.bounds - self.total < self.bounds[0]
        return Steps(self.total + other.total, np.r_[other.bounds[early] - self.total, self.bounds], np.r_[other.values[early], other(self.values)])


def breaks(costs: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums before each item and behind the last; for each item where the batch that it begins ends, and what the last batch behind it holds at the end."""
    n, sums = len(costs), np.r_[0, np.cumsum(costs)]
    ends = np.maximum(np.searchsorted(sums, sums[:-1] + limit, "right") - 1, np.arange(n) + 1)
    held = np.zeros(n, np.int64)
    for k in range(n - 1, -1, -1):
        held[k] = held[ends[k]] if ends[k] < n else sums[n] - sums[k]
    return sums, ends, held


def steps_of(costs: np.ndarray, limit: int) -> Steps:
    sums, _, held = breaks(costs, limit)
    return Steps(int(sums[-1]), (limit - sums[1:])[::-1], held[::-1])


def starts_from(costs: np.ndarray, limit: int, amount: int) -> np.ndarray:
    """Whether each item begins a batch, if the open one holds `amount`."""
    sums, ends, _ = breaks(costs, limit)
    out = np.zeros(len(costs), bool)
    k = int(np.searchsorted(sums[1:], limit - amount, "right"))
    while k < len(costs):
        out[k] = True
        k = int(ends[k])
    return out


def batch_ids(items: DataFrame, *, group: str, order: str, cost: str, limit: int) -> DataFrame:
    """items (group, order: a number, cost: not below 0) with batch_id, from 0 in each group: batches of consecutive
    items that cost `limit` at most, or of one item. Ties of the order are broken at random; null groups are one."""
    key = F.coalesce(F.concat(F.lit("g"), F.col(group).cast("string")), F.lit(""))
    ranked = rank_within(items.withColumn("_grp", key), ["_grp"], order, name="_pos")
    ranked = stored(ranked.withColumn("_rng", F.floor((F.col("_pos") - 1) / RANGE)))
    steps = "_grp string, _rng long, total long, bounds array<long>, cuts array<long>"

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        s = steps_of(rows.sort_values("_pos")[cost].to_numpy(np.int64), limit)
        return pd.DataFrame({"_grp": [rows["_grp"].iloc[0]], "_rng": [rows["_rng"].iloc[0]], "total": [s.total], "bounds": [s.bounds], "cuts": [s.values]})

    def composed(rows: pd.DataFrame) -> pd.DataFrame:
        s = None
        for r in rows.sort_values("_rng").itertuples(index=False):
            mine = Steps(r.total, np.asarray(r.bounds, np.int64), np.asarray(r.cuts, np.int64))
            s = mine if s is None else s.then(mine)
        return pd.DataFrame({"_grp": [rows["_grp"].iloc[0]], "_rng": [rows["_rng"].iloc[0] // FAN], "total": [s.total], "bounds": [s.bounds], "cuts": [s.values]})

    def handed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_rng")
        amount, out = int(rows["amount"].iloc[0]), []
        for r in rows.itertuples(index=False):
            out.append(amount)
            amount = int(Steps(r.total, np.asarray(r.bounds, np.int64), np.asarray(r.cuts, np.int64))(amount))
        return pd.DataFrame({"_grp": rows["_grp"], "_rng": rows["_rng"], "amount": out})

    up = F.floor(F.col("_rng") / FAN).alias("_up")
    levels = [stored(ranked.select("_grp", "_rng", "_pos", cost).groupBy("_grp", "_rng").applyInPandas(one, steps))]
    while levels[-1].where("_rng > 0").limit(1).count():
        levels.append(stored(levels[-1].groupBy("_grp", up).applyInPandas(composed, steps)))
    amounts = levels[-1].select("_grp", "_rng", F.lit(FULL).alias("amount"))
    for level in reversed(levels[:-1]):
        given = amounts.select("_grp", F.col("_rng").alias("_up"), "amount")
        amounts = stored(level.withColumn("_up", F.floor(F.col("_rng") / FAN)).join(given, ["_grp", "_up"]).groupBy("_grp", "_up").applyInPandas(handed, "_grp string, _rng long, amount long"))

    def begun(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_pos")
        starts = starts_from(rows[cost].to_numpy(np.int64), limit, int(rows["amount"].iloc[0]))
        return pd.DataFrame({"_grp": rows["_grp"], "_rng": rows["_rng"], "_pos": rows["_pos"], "_in": np.cumsum(starts)})

    marks = ranked.select("_grp", "_rng", "_pos", cost).join(amounts, ["_grp", "_rng"])
    marks = stored(marks.groupBy("_grp", "_rng").applyInPandas(begun, "_grp string, _rng long, _pos long, _in long"))
    before = Window.partitionBy("_grp").orderBy("_rng").rowsBetween(Window.unboundedPreceding, 0)
    sums = marks.groupBy("_grp", "_rng").agg(F.max("_in").alias("_n")).withColumn("_before", F.sum("_n").over(before) - F.col("_n")).drop("_n")
    ids = marks.join(sums, ["_grp", "_rng"]).select("_grp", "_pos", (F.col("_before") + F.col("_in") - 1).alias("batch_id"))
    return ranked.join(ids, ["_grp", "_pos"]).drop("_grp", "_pos", "_rng")
