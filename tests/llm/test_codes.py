"""Vector codes against an exhaustive search with whole numbers."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.llm import queries, vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * x) for x in v], b) for i, v, b in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        codes = [[near(p, c[p])[1] for p in range(parts)] for c in cut]
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, code in zip(cut, codes, strict=True) if code[p] == k]
                if mine:
                    books[p][k] = tuple(sum(x) // len(mine) for x in zip(*mine, strict=True))
    found = [[near(p, c[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, _, b), e in zip(kept, errors, strict=True):
        by_label[b] += e
    out = [(i, [k for _, k in f], e, by_label[b]) for (i, _, b), f, e in zip(kept, found, errors, strict=True)]
    return sorted(out, key=str), books


def coded(frame, **options):
    got, books = vectorcodes.compress(frame, **options)
    rows = vectorcodes.with_label_error(got).select("vec_id", "codes", "error", "label_error").collect()
    return sorted([(r[0], list(r[1]), r[2], r[3]) for r in rows], key=str), [[tuple(map(int, e)) for e in b] for b in books]


@pytest.mark.parametrize("kind", ["normal", "ties"])
def test_codes_agree_with_brute_force(spark, kind):
    rng = random.Random(4)
    draw = (lambda: rng.gauss(0, 0.3)) if kind == "normal" else (lambda: rng.choice([-1, 0, 0, 1]) / 128)
    rows = [(rng.randint(0, 400) if i % 9 else None, [draw() for _ in range(32)], rng.choice([1, 2, None])) for i in range(300)]
    rows += rows[:7] + [(1, None, 1), (2, [0.1] * 31 + [None], 1), (3, [0.1] * 31 + [math.nan], 2), (4, [math.inf] + [0.0] * 31, None)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"part": F.lit("clash"), "_error": F.lit(0)}).repartition(5)
    assert coded(frame) == brute(rows)


def test_fewer_vectors_than_entries_other_lengths_and_none(spark):
    rows = [(i, [float(i + j) for j in range(16)], None) for i in range(5)]
    odd = [(9, [1.0] * 15, 1), (10, [1.0] * 32, 1), (11, [], 1), (12, [1e30] * 16, 1)]
    frame = spark.createDataFrame(rows + odd, SCHEMA)
    assert coded(frame) == brute(rows)
    for empty in (frame.limit(0), frame.where("embedding is null")):
        assert coded(empty)[0] == []


def test_bounds_skip_most_distances_and_lose_none():
    rng = np.random.default_rng(3)
    centres = rng.integers(-300, 300, (64, 4))
    x = centres[rng.integers(0, 64, 5000)] + rng.integers(-9, 10, (5000, 4))
    book = x[:64].copy()
    at, upper, lower, all_of = vectorcodes.nearest_all(x, book)
    for _ in range(4):
        new = np.array([x[at == k].sum(0) // max(1, (at == k).sum()) if (at == k).any() else book[k] for k in range(64)])
        at, upper, lower, worked = vectorcodes.nearest_bounded(x, new, np.sqrt(np.square(new - book).sum(1)), at, upper, lower)
        book = new
        exact = np.square(x[:, None] - book[None]).sum(2)
        assert (at == exact.argmin(1)).all()
        assert (lower.astype(float) ** 2 <= exact).all()
        assert (upper**2 >= exact.min(1)).all()
    assert worked < all_of / 5


def test_query_thirteen_agrees_with_sql(same):
    same(queries.QUERIES["op13_vector_codes"], queries.ORACLES["op13_vector_codes"])
