"""Ratios of strings against the standard library, greedy alignment against the plain sequence of lefts."""

import difflib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.operators import align as A
from sieveline.operators import matching as M
from sieveline.operators import similarity as S


def strings(rng, n, longest=70, letters="abcdé "):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_ratios_agree_with_the_standard_library():
    rng = random.Random(1)
    a, b = [*strings(rng, 25), "", *strings(rng, 3, 260)], [*strings(rng, 30, 90), "", *strings(rng, 4, 260), "😀é" * 70]
    x, y = S.Texts(a), S.Texts(b)
    i, j = np.divmod(np.arange(len(a) * len(b)), len(b))
    want = [difflib.SequenceMatcher(None, a[p], b[q]).ratio() for p, q in zip(i, j, strict=True)]
    assert S.seq_ratios(x, y, i, j).tolist() == want
    table = np.array(want).reshape(len(a), len(b))
    for most in (None, 1, 4):
        p, q, s = S.best_ratios(x, y, 0.3, most)
        expected = set()
        for k, row in enumerate(table):
            good = sorted(v for v in row if v > 0.3)
            least = good[-most] if most and len(good) >= most else 0.3
            expected |= {(k, m) for m, v in enumerate(row) if v > 0.3 and v >= least}
        assert set(zip(p.tolist(), q.tolist(), strict=True)) == expected
        assert all(v == table[k, m] for k, m, v in zip(p, q, s, strict=True))


def test_blocks_across_words_agree_with_the_standard_library(monkeypatch):
    """Ranges that begin or end at the borders of words of 64 bits, blocks longer than a word, and strings of one letter."""
    rng = random.Random(3)
    a = [*strings(rng, 12, 400, "ab"), *strings(rng, 12, 200), "q" * 64, "q" * 65, "q" * 128, "ab" * 90 + "c" * 70, "x" * 63 + "é" * 70, "\ud800😀" * 40]
    b = [*strings(rng, 12, 199, "ab"), *strings(rng, 12, 199), "q" * 63, "q" * 64, "q" * 199, "c" * 70 + "ab" * 60, "é" * 70 + "x" * 63, "😀\ud800" * 40]
    x, y = S.Texts(a), S.Texts(b)
    i, j = np.divmod(np.arange(len(a) * len(b)), len(b))
    want = np.array([difflib.SequenceMatcher(None, a[p], b[q], autojunk=False).ratio() for p, q in zip(i, j, strict=True)])
    assert S.seq_ratios(x, y, i, j).tolist() == want.tolist()
    monkeypatch.setattr(S, "CELLS", 1 << 10)
    assert S.seq_ratios(x, y, i, j).tolist() == want.tolist()
    least = np.array([rng.random() for _ in i])
    got = S.seq_ratios(x, y, i, j, least)
    assert (got <= want).all() and (got == want)[want >= least].all()


def test_blocks_of_headings_are_scored_fast():
    """A pair of headings takes less than a tenth of the time that the standard library needs."""
    rng = random.Random(4)
    a, b = ([t + "en der" for t in strings(rng, n, 120, "etaoinshrdlu    ")] for n in (32, 512))

    def seconds(run):
        at = time.process_time()
        run()
        return time.process_time() - at

    plain = seconds(lambda: [difflib.SequenceMatcher(None, x, y).ratio() for x in a for y in b[:16]]) / 16
    assert min(seconds(lambda: S.best_ratios(S.Texts(a), S.Texts(b), 0.3, 512)) for _ in range(3)) / 512 < plain / 10


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for k, y in enumerate(b):
            now.append(row[k] + 1 if x == y else max(row[k + 1], now[k]))
        row = now
    return row[-1]


def test_common_subsequences():
    rng = random.Random(2)
    a, b = [*strings(rng, 12), "", "q" * 64, *strings(rng, 3, 200)], [*strings(rng, 12, 150), "", "qq"]
    for t in [*a, "ab" * 300]:
        assert S.common(t, S.Texts(b)).tolist() == [longest_common(t, u) for u in b]


def sequence(lefts, scores):
    """Each left in order takes its best unused right (ties to the smallest); scores: {left: {right: score}}."""
    used, out = set(), []
    for a in sorted(lefts):
        free = [(-s, b) for b, s in scores.get(a, {}).items() if b not in used]
        if free:
            s, b = min(free)
            used.add(b)
            out.append((a, b, -s))
    return out


def test_rounds_agree_with_the_sequence(spark):
    rng = random.Random(1)
    scores = {a: {b: rng.choice([1, 2, 3, rng.random()]) for b in rng.sample(range(40), rng.randint(0, 12))} for a in range(50)}
    frame = spark.createDataFrame([(a, b, float(s)) for a, r in scores.items() for b, s in r.items()], "a long, b long, score double").repartition(3)
    want = sequence(scores, scores)
    got = M.match(spark.range(50).select(F.col("id").alias("a")), frame)
    assert sorted(map(tuple, got.collect())) == [(a, b, float(s)) for a, b, s in want]
    # with lists of two rights only, which are made longer on demand
    short = frame.rdd.map(tuple).groupBy(lambda r: r[0]).flatMap(lambda g: sorted(g[1], key=lambda r: (-r[2], r[1]))[:2]).toDF("a long, b long, score double")
    more = lambda lefts, holders, turn: (frame.join(lefts, "a", "left_semi").join(holders, "b", "left").where("h is null or h > a").select("a", "b", "score"), lefts.limit(0))
    got = M.match(spark.range(50).select(F.col("id").alias("a")), short, more)
    assert sorted(map(tuple, got.collect())) == [(a, b, float(s)) for a, b, s in want]
    assert M.match(spark.range(0).select(F.col("id").alias("a")), frame.limit(0)).count() == 0


def headed(rng, n, words):
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 3))) + ":\nbody") for i in range(n)]


def plain_headings(left, right, threshold=0.3):
    heads = lambda df: {r["chunk_id"]: r["normalized"] for r in A.headings(df).collect()}
    a, b = heads(left), heads(right)
    ratio = {(x, y): difflib.SequenceMatcher(None, x, y).ratio() for x in set(a.values()) for y in set(b.values())}
    return sequence(a, {i: {j: ratio[x, y] for j, y in b.items() if ratio[x, y] > threshold} for i, x in a.items()})


@pytest.mark.parametrize("words", [["intro", "scope", "terms"], ["alpha", "beta", "gamma", "rules", "index", "annex", "zq"]])
def test_headings_agree_with_the_sequence(spark, words):
    """The first words make many equal headings, the second many ties and windows."""
    rng = random.Random(5)
    left, right = (spark.createDataFrame([*headed(rng, n, words), (n, None), (n + 1, "no heading here\nx")], "chunk_id long, text string").repartition(3) for n in (40, 30))
    got = A.heading_fuzzy(left, right, first=3).collect()
    assert sorted((r["ar_chunk_id"], r["en_chunk_id"], r["confidence"]) for r in got) == plain_headings(left, right)


def test_headings_by_group_and_in_windows(spark, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(A, "LEFT_BLOCK", 64)
    monkeypatch.setattr(A, "RIGHT_BLOCK", 16)
    words = ["alpha", "beta", "gamma", "delta", "intro"]
    left, right = (spark.createDataFrame([(i, t, rng.choice(["p", "q", None])) for i, t in headed(rng, n, words)], "chunk_id long, text string, pair string") for n in (300, 12))
    got = sorted((r["ar_chunk_id"], r["en_chunk_id"], r["confidence"]) for r in A.heading_fuzzy(left, right, group="pair", first=2).collect())
    parts = [plain_headings(left.where(w), right.where(w)) for w in ("pair = 'p'", "pair = 'q'", "pair is null")]
    assert got == sorted(x for p in parts for x in p)
    assert A.heading_fuzzy(left.limit(0), right).count() == 0 and A.heading_fuzzy(left, right.limit(0)).count() == 0


def vectors(rng, n, centres, spread):
    return [(i, (centres[rng.integers(len(centres))] + rng.normal(0, spread, centres.shape[1])).astype("float32").tolist()) for i in range(n)]


def test_pivots_skip_pairs_and_lose_none(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 1, (12, 24))
    rows = [vectors(rng, n, centres, 0.08) for n in (300, 250)]
    rows[0] += [(900, [0.0] * 24), (901, None), (902, [1.0, 0.0])]
    rows[1] += [(900, [0.0] * 24), (903, [1.0, 0.1])]
    frame = lambda r: spark.createDataFrame(r, "i long, e array<double>").selectExpr("'' as _grp", "i", "e", "sqrt(aggregate(e, 0D, (s, v) -> s + v * v)) as n").where("n > 0")
    found, skipped = A.near_vectors(frame(rows[0]), frame(rows[1]), 0.5, pivots=40, rows=32)
    got = {(r["a"], r["b"]) for r in found.collect()}
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    want = {(i, j) for i, x in rows[0] if x and any(x) for j, y in rows[1] if any(y) and len(x) == len(y) and unit(x) @ unit(y) > 0.5}
    assert want <= got and all((i, j) in want or abs(unit(dict(rows[0])[i]) @ unit(dict(rows[1])[j]) - 0.5) < 1e-6 for i, j in got)
    assert skipped > 0.5
    pairs = lambda rows, grp: spark.createDataFrame([(i, v, "g" if i % 2 else "h") for i, v in rows], "chunk_id long, embedding array<float>, pair string")
    got = A.semantic(pairs(rows[0], 0), pairs(rows[1], 1), group="pair").collect()
    scores = {}
    for i, x in rows[0]:
        for j, y in rows[1]:
            if x and any(x) and any(y) and len(x) == len(y) and i % 2 == j % 2 and unit(x) @ unit(y) > 0.5:
                scores.setdefault(i, {})[j] = float(unit(x) @ unit(y))
    assert sorted((r["ar_chunk_id"], r["en_chunk_id"]) for r in got) == [(a, b) for a, b, _ in sequence(scores, scores)]
