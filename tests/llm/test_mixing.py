"""The mix against a plain computation of targets and axes, and the properties of its tree, permutations and shards."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from sieveline.llm import mixing, queries


def words_of(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def brute(rows):
    """rows: doc_id (unique), text, source. doc_id: size, source_size, target, taken."""
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += words_of(t)
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), Fraction(3, 2) * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        for s in above or open_:
            target[s] = Fraction(2 * sizes[s]) if above else level * weight[s]
        left -= sum(target[s] for s in above)
        open_ = open_ - above if above else set()
    out = {}
    for s in names:
        take, at = int(target[s] + Fraction(1, 2)), 0
        for d, t, _ in sorted((r for r in rows if r[2] == s), key=lambda r: hashlib.md5(f"17-{'' if r[0] is None else r[0]}".encode()).hexdigest()):
            n = words_of(t)
            full, rest = divmod(take, sizes[s]) if sizes[s] else (0, 0)
            out[d] = (n, sizes[s], float(target[s]), full * n + max(0, min(n, rest - at)))
            at += n
    return out


def corpus(rng):
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 120))), rng.choice(["hot"] * 6 + ["a", "é", "z", "Z", "", None, "tiny"])) for i in range(400)]
    return [*rows, (400, None, "a"), (401, "", "void"), (402, None, "void"), (403, "x " * 9000, "long"), (404, " a\tb c ", "z"), (None, "one two", "hot")]


def frame(spark, rows, parts):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"size": F.lit("clash"), "_src": F.lit(1), "pieces": F.lit(2)}).repartition(parts)


def test_mix_agrees_with_brute_force_at_any_partitioning(spark):
    rows, columns = corpus(random.Random(6)), ["doc_id", "size", "source_size", "target", "taken"]
    want = brute(rows)
    mixed = mixing.mix(frame(spark, rows, 5), block_words=50, shard_words=1500)
    got = mixed.select(*columns, "pieces").collect()
    assert {r[0]: (r[1], r[2], round(r[3], 6), r[4]) for r in got} == {d: (a, b, round(c, 6), e) for d, (a, b, c, e) in want.items()}
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    again = mixing.mix(frame(spark, rows[::-1], 2), block_words=50, shard_words=1500).select(*columns, "pieces")
    assert sorted(map(str, again.collect())) == sorted(map(str, got))
    # every draw of a document lies in one shard, with all words taken; positions have no gap
    dealt = mixing.shards(mixed).collect()
    by_doc, by_shard = Counter(), defaultdict(list)
    for r in dealt:
        by_doc[r["doc_id"]] += r["length"]
        by_shard[r["shard"]].append(r["position"])
    assert all(by_doc[r["doc_id"]] == r["taken"] for r in got)
    assert all(sorted(p) == list(range(len(p))) for p in by_shard.values())
    assert len({(r["doc_id"], r["pass"]) for r in dealt}) == len(dealt)
    assert len(by_shard) > 5


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, "a b c", "s")] * 4 + [(1, "d e f", "s"), (2, None, None)]
    got = mixing.mix(frame(spark, rows, 3)).select("size", "taken").collect()
    assert sum(r["taken"] for r in got) == 23 and all(r["taken"] <= 2 * r["size"] for r in got)  # 1.5 times 15, rounded
    for none in (frame(spark, rows, 1).limit(0), frame(spark, [(1, None, "a"), (2, "", None)], 1)):
        assert all(r["taken"] == 0 and r["target"] == 0 for r in mixing.mix(none).collect())


def test_tree_splits_quotas_exactly(spark):
    quotas = spark.createDataFrame([(f"s{i:02}", 1 + i * i) for i in range(20)], "_src string, _n long")
    total = sum(1 + i * i for i in range(20))
    rows = mixing.tree(quotas, 150, total, 3).collect()
    per_source, per_shard = Counter(), Counter()
    for r in rows:
        per_source[r["_src"]] += r["_n"]
        per_shard[r["_shard"]] += r["_n"]
    assert per_source == {f"s{i:02}": 1 + i * i for i in range(20)}
    assert [per_shard[k] for k in range(150)] == [(k + 1) * total // 150 - k * total // 150 for k in range(150)]


def test_hypergeometric_split_has_the_right_mean():
    quotas = np.array([600, 300, 100])
    draws = np.array([mixing.split(quotas, 0, 2, 2, 1000, seed, 1)[0][2] for seed in range(300)])
    assert np.abs(draws.mean(0) - quotas / 2).max() < 2
    # variance of a hypergeometric count
    assert abs(draws[:, 0].var() - 500 * 0.6 * 0.4 * 500 / 999) < 15


def test_permutation_is_a_bijection():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        got = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, -9))
        assert sorted(got) == list(range(n))
    assert (mixing.permuted(np.arange(1000), np.full(1000, 1000), np.full(1000, 5)) != np.arange(1000)).mean() > 0.9


def test_query_eleven_agrees_with_sql(same):
    same(queries.QUERIES["op11_mixing"], queries.ORACLES["op11_mixing"])
