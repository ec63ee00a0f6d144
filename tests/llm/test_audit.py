"""The filter audit against brute force over whole texts and all orders."""

import random
import re
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from sieveline.llm import filteraudit, queries


def failures(rows):
    """rows: doc_id, text, lang. For each its failed letters."""
    out = []
    for d, t, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = set()
        if len(w) < 200:
            bad.add("A")
        if 100 * len(set(w)) < 50 * len(w):
            bad.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t):
            bad.add("C")
        if re.search(r"[#$%&*|]", t):
            bad.add("D")
        if d is not None and any(e is not None and e < d and (u or "") == t for e, u, _ in rows):
            bad.add("E")
        out.append(bad)
    return out


def brute(rows, labels):
    good, toxic = ({d for d, *v in labels if v[k] == 1 and d is not None} for k in (0, 1))
    bad, out, total = failures(rows), {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        alive = [True] * len(rows)
        for step, letter in enumerate(order, 1):
            for part in {r[2] or "" for r in rows}:
                mine = [i for i, r in enumerate(rows) if (r[2] or "") == part and letter in bad[i]]
                here = [i for i in mine if alive[i]]
                for i in here:
                    alive[i] = False
                total[part, letter] += len(here)
                kept = sum(a for a, r in zip(alive, rows, strict=True) if (r[2] or "") == part)
                out[part, order, step] = [kept, len(here), len(mine) - len(here), sum(bad[i] == {letter} for i in mine), sum(rows[i][0] in good for i in here), sum(rows[i][0] in toxic for i in here)]
    return sorted((*k, *v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def test_audit_agrees_with_brute_force(spark):
    rng = random.Random(8)
    vocabulary = ["one", "Two", "three", "vier", "#five", "SIX", "sept", "ocho", "A", "b|c"]
    rows = [(i, " ".join(rng.choice(vocabulary[: rng.randint(2, 10)]) + str(rng.randint(0, rng.choice([3, 400]))) for _ in range(rng.choice([3, 150, 230, 260]))), rng.choice(["en", "de", None])) for i in range(60)]
    rows += [(100 + i, rows[i % 5][1], "fr") for i in range(20)]
    rows += [(200, None, "en"), (201, "", "de"), (202, " \t ", None), (None, rows[3][1], "en"), (None, rows[3][1], "en"), (203, "z " * 60_000, ""), (7, rows[7][1], "en"), (7, rows[8][1], "en")]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1])) for d, _, _ in rows if d is not None and d % 3 == 0] + [(0, 1, 0), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"part": F.lit("clash"), "mask": F.lit(9)}).repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit("clash"))
    got = filteraudit.audit(filteraudit.cells(filteraudit.masks(docs, marks)))
    assert sorted(map(tuple, got.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect())) == brute(rows, labels)
    assert filteraudit.audit(filteraudit.cells(filteraudit.masks(docs.limit(0), marks))).count() == 0
    assert filteraudit.cells(filteraudit.masks(docs, marks.limit(0))).agg(F.sum("n")).first()[0] == len(rows)


def test_audit_takes_any_few_filters(spark):
    cells = spark.createDataFrame([("x", 0, 5, 1, 0), ("x", 3, 4, 2, 1), ("x", 1, 2, 0, 0)], "part string, mask int, n long, n_good long, n_toxic long")
    got = {(r["filter_order"], r["step"]): tuple(r)[3:] for r in filteraudit.audit(cells, "PQ").collect()}
    assert got == {("PQ", 1): (5, 6, 0, 2, 2, 1, 8), ("PQ", 2): (5, 0, 4, 0, 0, 0, 4), ("QP", 1): (7, 4, 0, 0, 2, 1, 4), ("QP", 2): (5, 2, 4, 2, 0, 0, 8)}


def test_query_twelve_agrees_with_sql(same):
    same(queries.QUERIES["op12_filter_audit"], queries.ORACLES["op12_filter_audit"])
