"""What a review found: exact rounding, long numbers, and work that must not grow with a text's length or a key's rows."""

import random
import re
import time
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sieveline.functions import text as T
from sieveline.operators import align as A
from sieveline.operators import chunking as K
from sieveline.operators import data as D
from sieveline.operators import similarity as S
from sieveline.plans import catalog, model


def test_progress_rounds_exact_values(spark):
    pairs = [(1, 400), (3, 400), (5, 400), (2801, 2000), (29, 2000), (7, 0), (None, 3), (123456, 7), (-1, 400), (-1, 3000), (1999, 2000), *[(i, 2000) for i in range(1, 400, 2)]]
    got = spark.createDataFrame(pairs, "a long, b long").select(T.progress(F.col("a"), F.col("b")).alias("p")).collect()
    assert [r["p"] for r in got] == ["0%" if b == 0 else None if a is None else f"{a / b * 100:.1f}%" for a, b in pairs]


def test_seed_ids_beyond_four_digits(spark, tmp_path):
    """The SQL's lpad keeps four characters of a longer number."""
    turn = lambda t: F.struct(F.lit(t).alias("turn"), F.lit(("user", "assistant")[t]).alias("role"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    spark.range(20_004).select(F.col("id").alias("conv_id"), F.explode(F.array(turn(0), turn(1))).alias("t")).select("conv_id", "t.*").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r["language"], r["aligned_id"]): r["seed_id"] for r in catalog.QUERIES["prj_seed_from_pair"](spark, str(tmp_path)).collect()}
    assert len(got) == 20_004 and got["ar", 7] == "ar_0007" and got["en", 9999] == "en_9999" and got["ar", 10_001] == "ar_1000"


def test_long_references_take_no_longer(spark):
    """Grams of a text of 200,000 characters were folded in quadratic time; no string is near it in length."""
    refs = [("word " * 40_000,), ("the rule of the house",), ("a rule of the horse",), ("",), (None,)]
    corpus = spark.createDataFrame([("The rule of the house is. x",), ("the rules of the house",)], "text string")
    start = time.monotonic()
    got = A.like_pairs(spark.createDataFrame(refs, "a string"), corpus, "a", "text", 0.85).collect()
    assert [tuple(r) for r in got if len(r["a"]) != 21] == [] and ("the rule of the house", "the rules of the house") in map(tuple, got)
    assert time.monotonic() - start < 60


def test_counts_of_characters_exclude_no_like_pair():
    rng = random.Random(3)
    texts = ["", "a", *("".join(rng.choice("abc é😀") for _ in range(rng.randint(1, 400))) for _ in range(40))]
    texts += [t[: len(t) // 3] + t[len(t) // 3 + rng.randint(1, 9) :] for t in texts]
    for threshold in (0.3, 0.7, 0.85, 1.0):
        i, j = S.like(S.Texts(texts), S.Texts(texts), threshold)
        want = {(x, y) for x, t in enumerate(texts) for y, r in enumerate(S.indel(t, S.Texts(texts))) if r >= 100 * threshold}
        assert set(zip(i.tolist(), j.tolist(), strict=True)) >= want


def test_model_gets_slices_and_all_rows(spark):
    batch = pa.RecordBatch.from_pydict({"prompt": ["p"] * 900, "context": ["c" * (10 if i % 300 else 5 << 20) for i in range(900)]})
    sizes = lambda b: np.array([len(x.as_py()) for x in b["context"]])
    parts = list(model._slices(iter([batch, batch.slice(0, 0)]), sizes))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert all(p.num_rows == 1 or (p.num_rows <= model.SLICE and sizes(p).sum() <= model.SLICE_BYTES) for p in parts)
    rows = spark.range(1000).selectExpr("id", "if(id % 7 = 0, null, concat('c', id)) as context", "concat('p', id) as prompt", "array(struct(id as x)) as more")
    got = model.responses(rows, lambda p, c: f"{p} {c}" if p != "p5" else 1 / 0).collect()
    assert sorted((r["id"], r["response"], r["more"][0]["x"], r["error"]) for r in got) == [(i, None if i == 5 else f"p{i} {None if i % 7 == 0 else f'c{i}'}", i, "division by zero" if i == 5 else None) for i in range(1000)]


def test_unknown_references_are_spread_over_tasks(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    rows = spark.range(2000).selectExpr("id", "case when id = 0 then 'the rule' when id = 1 then 'none of it' when id = 2 then null else 'UNKNOWN' end as reference")
    corpus = spark.createDataFrame([("So says the rule.",)], "text string")
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        for check in (D.reference_norm, D.reference_seq):
            got = check(rows, corpus).select("id", "verified", F.spark_partition_id().alias("p")).collect()
            assert {r["id"] for r in got if not r["verified"]} == ({1, 2} if check is D.reference_norm else {1}) and len(got) == 2000
            assert max(Counter(r["p"] for r in got).values()) < 1000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_vectors_meet_in_stripes_with_exact_scores(spark, monkeypatch):
    """Blocks of 1024 vectors were shuffled once for each block of the other side, and near vectors once more for their scores."""
    for name, value in (("STRIPES", 3), ("STRIPE", 4), ("STRIPE_BYTES", 5 * 8 * 8)):
        monkeypatch.setattr(A, name, value)
    rng = np.random.default_rng(4)
    rows = [[(i, rng.normal(0, 1, 8).tolist(), "g" if i % 5 else "h") for i in range(n)] for n in (40, 23)]
    frame = lambda r: spark.createDataFrame(r, "i long, e array<double>, _grp string").selectExpr("_grp", "i", "e", "sqrt(aggregate(e, 0D, (s, v) -> s + v * v)) as n")
    found, _ = A.near_vectors(frame(rows[0]), frame(rows[1]), 0.3, rows=3)

    def cosine(x, y):
        dot = lambda p, q: reduce(lambda s, t: s + t[0] * t[1], zip(p, q, strict=True), 0.0)
        return dot(x, y) / (dot(x, x) ** 0.5 * dot(y, y) ** 0.5)

    want = {(i, j): cosine(x, y) for i, x, g in rows[0] for j, y, h in rows[1] if g == h and cosine(x, y) > 0.3}
    got = found.collect()
    assert {(r["a"], r["b"]): r["score"] for r in got} == want and len(got) == len(want) > 50


def test_overlaps_split_each_chunk_once(spark):
    """A chunk with its overlap was split into sentences anew wherever its tail was named."""
    rng = random.Random(8)
    for separator, overlap in (("\n", 1), ("\n", 3), (" -- ", 2), (" ! x", 2)):
        texts = [separator.join("".join(rng.choice(["a b c", ". ", "word", "! ", " ", "d e f g"]) for _ in range(rng.randint(1, 6))) for _ in range(40)) for _ in range(6)]
        df = spark.createDataFrame([*enumerate(texts), (90, ""), (91, None)], "doc_id long, text string").withColumn("lang", F.lit("en"))
        alone, got = (K.chunk_tokens(df, size=6, overlap=n, separator=separator) for n in (0, overlap))
        assert got._jdf.queryExecution().optimizedPlan().toString().count("[.!?]+") <= 2
        want, last = [], None
        for r in alone.orderBy("doc_id", "chunk_id").collect():
            s = [x for x in (x.strip() for x in re.split(r"[.!?]+", last or "")) if x] if r["chunk_id"] else []
            tail = ". ".join(s[-overlap:]) + "." if len(s) >= overlap else ""
            last = f"{tail}{separator}{r['text']}" if tail else r["text"]
            want.append((r["doc_id"], r["chunk_id"], last, r["token_count"] + int(len(tail.split()) * 0.75)))
        assert [(r["doc_id"], r["chunk_id"], r["text"], r["token_count"]) for r in got.orderBy("doc_id", "chunk_id").collect()] == want and len(want) > 20
