"""Record functions and operators on literal rows, with the quirks that the reference form has."""

import difflib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.functions import classify as C
from sieveline.functions import records as R
from sieveline.functions import text as T
from sieveline.operators import align as A
from sieveline.operators import budgets as B
from sieveline.operators import similarity as S
from sieveline.operators import chunking as K
from sieveline.operators import data as D
from sieveline.operators import order as O
from sieveline.plans import model, reports
from sieveline.sources import readers, writers
from sieveline.streaming import landing


def one(spark, column, *values):
    """The column of each string, as a list."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["y"] for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_verdicts(spark):
    values = ("VERDICT: True", "verdict: true", "VERDICT: incorrect", "VERDICT: False", "")
    assert one(spark, C.verdict_loose, *values) == [True, True, True, False, False]
    assert one(spark, C.verdict_lower, *values) == [True, True, False, False, False]
    assert one(spark, C.verdict_exact, *values) == [True, False, False, False, False]
    assert one(spark, C.verdict_3way, *values) == ["True", "Unknown", "Unknown", "False", "Unknown"]


def test_languages(spark):
    # presentation forms and Arabic-Indic digits aren't base letters
    assert one(spark, C.lang_any, "نص", "text", "ﻻﻼ", "٣", None) == ["ar", "en", "en", "en", "en"]
    assert one(spark, C.lang_ratio, "نص عربي", "a نص in english text") == ["ar", "en"]


def test_punctuation_and_space(spark):
    assert one(spark, T.punctuation_english, "a ,b.c", "3.14", "end.") == ["a, b. c", "3. 14", "end. "]
    assert one(spark, T.punctuation_arabic, "نعم ؟لا") == ["نعم؟ لا"]
    assert one(spark, T.clean_whitespace, "  a   b \n\n\n\n c ", "") == ["a b\n\nc", ""]
    assert one(spark, T.clean_extracted, "a \n Page 12 b") == ["a  b"]


def test_repair(spark):
    got = one(spark, R.repair_output, "plain", "it is incorrect", "VERDICT: True\nbecause", "before VERDICT: False", "VERDICT: True\nExplanation: x\nReference: y")
    assert got == [
        "VERDICT: False\nExplanation: plain\nReference: UNKNOWN",
        "VERDICT: True\nExplanation: it is incorrect\nReference: UNKNOWN",
        "VERDICT: True\nExplanation: because\nReference: UNKNOWN",
        "VERDICT: False\nExplanation: \nReference: UNKNOWN",
        "VERDICT: True\nExplanation: x\nReference: y",
    ]
    assert one(spark, lambda c: R.repair_output(R.repair_output(c)), "plain") == [got[0]]


def test_fences(spark):
    assert one(spark, R.strip_fence, '```json{"a": 1}```', "```abc```", '```json{"a": 12', "plain") == ['{"a": 1}', "abc", '{"a":', "plain"]
    assert one(spark, lambda c: R.strip_fence(c, strict=True), '```json{"a": 12') == ['{"a": 12']


def test_responses(spark):
    good = json.dumps({"verdict": "True", "explanation": "e"})
    got = one(spark, R.parse_response, good, "no json", json.dumps({"verdict": "True"}), None)
    assert got[0] == ("True", "e", "UNKNOWN")
    assert got[1:] == [None, None, None]


def test_references(spark):
    text = "see Section 3 and Standard No. 12, then section 4"
    assert one(spark, R.extract_references, text) == [["AAOIFI Standard 12", "AAOIFI Standard 3", "AAOIFI Standard 4"]]
    assert one(spark, lambda c: R.extract_references(c, True), "وفق المعيار 7") == [["معيار رقم 7"]]
    assert one(spark, R.reference_of, "Reference:  x \nmore", "none") == ["x", "UNKNOWN"]
    assert one(spark, lambda c: R.rewrite_reference(c, F.lit(r"$1\2")), "Reference: a\nReference: b") == ["Reference: $1\\2\nReference: $1\\2"]
    rows = spark.createDataFrame([("UNKNOWN", ""), ("In Here", ""), ("made up", "Section 9"), ("made up", "x"), ("", "y")], "reference string, context string")
    corpus = spark.createDataFrame([("all is in here today",)], "text string")
    got = {(r["reference"], r["context"]) for r in D.fix_references(rows, corpus).collect()}
    assert got == {("UNKNOWN", ""), ("In Here", ""), ("AAOIFI Standard 9", "Section 9"), ("UNKNOWN", "x"), ("", "y")}


def test_negation(spark):
    assert one(spark, lambda c: R.negate_claim(c, F.lit(False)), "It is permissible", "Permissible", "Other Thing") == ["It is not permissible", "Permissible", "It is not correct that other thing"]
    assert one(spark, lambda c: R.negate_claim(c, F.lit(True)), "يجوز البيع") == ["لا يجوز البيع"]


def test_ratios():
    for a, b in (("abcd", "bcde"), ("", ""), ("a", ""), ("kitten sitting", "sitting kitten")):
        assert S.seq_ratios(S.Texts([a]), S.Texts([b]), np.array([0]), np.array([0]))[0] == difflib.SequenceMatcher(None, a, b).ratio()
    assert A.indel_ratio("abcd", "bcde") == 75.0
    assert A.indel_ratio("", "") == 100.0


def test_containment_and_fuzzy_references(spark):
    corpus = spark.createDataFrame([("The first rule of sale. The second rule of hire",)], "text string")
    rows = spark.createDataFrame([(1, "the  first rule"), (2, "the second rules of hire"), (3, "nothing like it"), (4, "UNKNOWN"), (5, None)], "i int, reference string")
    for op in (D.reference_norm, D.reference_seq):
        got = {r["i"]: r["verified"] for r in op(rows, corpus).collect()}
        assert got[2] and got[4] and not got[3]
    assert {r["i"] for r in D.reference_any(rows, corpus).collect()} == set()


def test_greedy_alignment(spark):
    left = spark.createDataFrame([(0, "Alpha rule:\nx"), (1, "Alpha rules:\nx"), (2, "zzz")], "chunk_id long, text string")
    right = spark.createDataFrame([(0, "Beta\nx"), (1, "Alpha rules:\ny")], "chunk_id long, text string")
    got = A.heading_fuzzy(left, right).collect()
    assert [(r["ar_chunk_id"], r["en_chunk_id"]) for r in got][0] == (0, 1)
    assert len({r["en_chunk_id"] for r in got}) == len(got)
    whole = A.align_chunks(left, right).collect()
    assert sorted(r["ar_chunk_id"] for r in whole if r["ar_chunk_id"] >= 0) == [0, 1, 2]


def test_semantic_alignment(spark):
    left = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 0.0])], "chunk_id long, embedding array<float>")
    right = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, 1.0])], "chunk_id long, embedding array<float>")
    assert [(r["ar_chunk_id"], r["en_chunk_id"]) for r in A.semantic(left, right).collect()] == [(0, 7)]


def chunked_by_hand(paragraphs, size, overlap):
    """Token chunks by a plain loop."""
    tokens = lambda t: int(len(t.split()) * 0.75)
    heading = lambda p: "\n" not in p and len(p) < 200 and (p.isupper() or any(c.isdigit() for c in p[:10]) or p.endswith(":"))
    out, i = [], 0
    while i < len(paragraphs):
        part, n, first = [], 0, i
        while i < len(paragraphs):
            if part and n + tokens(paragraphs[i]) > size:
                break
            part.append(paragraphs[i])
            n += tokens(paragraphs[i])
            i += 1
            if heading(part[-1]) and n > size * 0.5:
                break
        text = "\n\n".join(part)
        if out and overlap:
            s = [x.strip() for x in __import__("re").split(r"[.!?]+", out[-1][0]) if x.strip()]
            if len(s) >= overlap:
                tail = ". ".join(s[-overlap:]) + "."
                text, n = tail + "\n\n" + text, n + tokens(tail)
        out.append((text, n, first, i - 1))
    return out


def test_token_chunks(spark):
    paragraphs = [f"Sentence {i} has some words here. And more of them follow! Part {i}" for i in range(9)] + ["HEADING 4:", "tail words"] + ["one two three four"] * 5
    df = spark.createDataFrame([(1, "\n\n".join(paragraphs), "en"), (2, "", "en"), (3, None, None)], "doc_id long, text string, lang string")
    for size, overlap in ((20, 2), (30, 1), (12, 0), (15000, 2)):
        got = K.chunk_tokens(df, size=size, overlap=overlap).where("doc_id = 1").orderBy("chunk_id").collect()
        assert [(r["text"], r["token_count"], r["start_paragraph_index"], r["end_paragraph_index"]) for r in got] == chunked_by_hand(paragraphs, size, overlap)


def test_splits_are_exact(spark):
    for n in (0, 1, 6, 18, 19, 20):
        df = spark.createDataFrame([(i, "x") for i in range(n)], "ordinal long, s string")
        sizes = {r["split"]: r["count"] for r in D.split(df, strata=("s",)).groupBy("split").count().collect()}
        a, b = int(n * 0.8), int(n * 0.9)
        assert sizes == {k: v for k, v in {"train": a, "val": b - a, "test": n - b}.items() if v}
    df = spark.createDataFrame([(i, None if i % 2 else "x") for i in range(36)], "ordinal long, s string")
    sizes = {(r["s"], r["split"]): r["count"] for r in D.split(df, strata=("s",), val_from_train=True).groupBy("s", "split").count().collect()}
    assert sizes == {(s, k): v for s in (None, "x") for k, v in (("train", 14), ("val", 1), ("test", 3))}


@pytest.mark.parametrize(("total", "true", "left"), [(300, 232, 79), (79, 70, 22), (22, 19, 6), (6, 6, 1), (1, 1, 0)])
def test_rebalance_counts(spark, total, true, left):
    """Sizes of repeated runs on a set of one scenario: the pool, then 15 % of it."""
    rows = spark.createDataFrame([(i, "plain", "", f"VERDICT: {i < true}\nExplanation: e\nReference: UNKNOWN") for i in range(total)], "ordinal long, instruction string, input string, output string")
    corpus = spark.createDataFrame([("a text",)], "text string")
    assert D.rebalance(rows, corpus).count() == left


def test_dedup_keeps_first(spark):
    df = spark.createDataFrame([(1, " A ", "en"), (0, "a", "en"), (2, "", "en"), (3, None, "en"), (4, "a", "ar")], "ordinal long, question string, language string")
    assert {r["ordinal"] for r in D.dedup_question(df).collect()} == {0, 4}
    assert {r["ordinal"] for r in D.dedup_input(df, col="question").collect()} == {0, 2}


def test_ranks(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    assert O.rank_by_number(df, "k").where("rank <> k + 1").count() == 0
    ranks = [r["rank"] for r in O.rank_by_hash(df, "k").select("rank").collect()]
    assert sorted(ranks) == list(range(1, 1001))


def test_reviews(spark):
    df = spark.createDataFrame([(i, i < 3) for i in range(100)], "ordinal long, suspected boolean")
    got = D.review_uncertain(df).collect()
    assert len(got) == 20 and sum(r["suspected"] for r in got) == 3
    assert D.review_simple(df).count() == 5
    assert D.review_simple(df.limit(19)).count() == 19
    assert D.review_simple(df.limit(0)).count() == 0


def test_json_lines(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"instruction": "i", "input": "", "output": "o"}\n\n{broken\n{"instruction": "j", "output": null}\n', encoding="utf-8")
    assert readers.jsonl(spark, str(path), strict=False).count() == 2
    audited = readers.jsonl_audited(spark, str(path)).orderBy("line").collect()
    assert [(r["line"], r["problem"]) for r in audited] == [(1, None), (3, "Invalid JSON"), (4, None)]
    rows, message = readers.jsonl_or_nothing(spark, str(path))
    assert rows is None and "line 3" in message
    with pytest.raises(Exception):  # noqa: B017
        readers.jsonl(spark, str(path)).collect()
    assert readers.count_lines(spark, str(path)).first()["n"] == 3
    assert readers.count_lines(spark, str(tmp_path / "none")).first()["n"] == 0
    raw = readers.jsonl_audited(spark, str(path)).where("line = 4")
    assert raw.select(R.missing_fields(F.col("raw")).alias("m")).first()["m"] == ["input"]


def sentence_chunks(text, size):
    """By growing texts, as they are read."""
    out, now = [], None
    for s in filter(None, (x.strip(" \t\n\r\x0b\f") for x in (text or "").split("."))):
        grown = s if now is None else f"{now}. {s}"
        if now is not None and len(grown.split()) * 1.3 > size:
            out.append(now)
            grown = ". ".join([*now.split(". ")[-2:], s]) if "." in now else s
        now = grown
    return out if now is None else [*out, now]


def test_sentence_chunks(spark):
    rng = random.Random(15)
    texts = [". ".join(" ".join("w" * rng.randint(1, 4) for _ in range(rng.choice([1, 2, 7, 30]))) for _ in range(rng.randint(0, 40))) for _ in range(30)] + [None, "", "..", "a.b..c. "]
    texts.append("one two. " * 30_000)
    got = K.chunk_sentences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), size=30).collect()
    for i, t in enumerate(texts):
        mine = sorted((r["id"], r["text"], r["token_count"]) for r in got if r["doc_id"] == i)
        assert [m[1] for m in mine] == sentence_chunks(t, 30)
        assert all(n == pytest.approx(1.3 * len(x.split())) for _, x, n in mine)


def test_unreferenced_files(spark):
    """Against a plain search of many reports, by path and by name; an unreadable report keeps all."""
    rng = random.Random(13)
    paths = [f"{rng.choice(['raw', 'out', 'a b'])}/{rng.choice(['x', 'y 1', 'z'])}{i % 40}.json" for i in range(120)] + ["", None]
    texts = [" ".join(rng.choice([p for p in paths if p]) + rng.choice(["", ",", " kept"]) for _ in range(rng.randint(0, 3))) for _ in range(25)] + ["see x7.json!"]
    files = spark.createDataFrame(list(enumerate(paths)), "i int, path string")
    reports = spark.createDataFrame([(t,) for t in texts], "text string")
    plain = lambda key: {i for i, p in enumerate(paths) if p is None or not any(key(p) in t for t in texts)}
    assert {r["i"] for r in D.anti_referenced(files, reports).collect()} == plain(lambda p: p)
    assert {r["i"] for r in D.anti_referenced(files, reports, by_name=True).collect()} == plain(lambda p: p.rsplit("/", 1)[-1])
    assert {r["i"] for r in D.anti_referenced(files, reports, keep_on_error=True).collect()} == plain(lambda p: p)
    broken = reports.unionByName(spark.createDataFrame([(None,)], "text string"))
    assert D.anti_referenced(files, broken, keep_on_error=True).count() == 0
    assert {r["i"] for r in D.anti_referenced(files, broken).collect()} == plain(lambda p: p)


def test_line_numbers_of_split_files(spark, tmp_path):
    """A file of many splits and some small ones: line numbers are those of the files, blank lines counted."""
    rng = random.Random(12)
    want = set()
    for name, n in (("a", 3000), ("b", 1), ("c", 40)):
        lines = [rng.choice(['{"k": 1}', "", "{cut", '{"t": "' + "é" * rng.randint(0, 90) + '"}']) for _ in range(n)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
        want |= {(name, k, x) for k, x in enumerate(lines, 1)}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = readers.numbered_lines(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 5
        assert {(r["path"].rsplit("/", 1)[1][0], r["line"], r["raw"]) for r in rows.collect()} == want
        bad = readers.jsonl_audited(spark, str(tmp_path)).where("problem is not null").collect()
        assert {(r["path"].rsplit("/", 1)[1][0], r["line"]) for r in bad} == {(f, k) for f, k, x in want if x == "{cut"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_publishing_is_all_or_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/rows"
    rows = lambda: sorted(r["i"] for r in spark.read.schema("i long").json(readers.published(spark, path)).collect())
    assert writers.publish(spark.range(3).withColumnRenamed("id", "i"), path) == 3
    with pytest.raises(Exception):  # noqa: B017
        writers.publish(spark.range(0, 90, 1, 4).select(F.when(F.col("id") == 70, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("i")), path)
    assert rows() == [0, 1, 2]
    old = spark.read.schema("i long").json(readers.published(spark, path))
    assert writers.publish(spark.range(5, 7).withColumnRenamed("id", "i"), path) == 2
    assert rows() == [5, 6]
    assert old.count() == 3  # a reader that has begun
    assert writers.candidate_swap(spark.range(0).withColumnRenamed("id", "i"), path) == 0 and rows() == [5, 6]
    for k in range(3):
        writers.publish(spark.range(k + 1).withColumnRenamed("id", "i"), path)
    assert rows() == [0, 1, 2] and len([x for x in (tmp_path / "rows").iterdir() if x.name.startswith("v-")]) == 2


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("i", "", "VERDICT: True", "é")], "instruction string, input string, output string, note string")
    path = f"file://{tmp_path}/final"
    assert writers.candidate_swap(df, path) == 1
    assert writers.candidate_swap(df.limit(0), path) == 0
    assert spark.read.json(readers.published(spark, path)).count() == 1
    kept = writers.backup(spark, [path], f"file://{tmp_path}/backup")
    assert readers.exists(spark, f"{kept}/final")
    assert writers.restore_latest(spark, f"file://{tmp_path}/backup", "final", path)
    writers.training_only(df, f"file://{tmp_path}/t")
    assert spark.read.json(f"file://{tmp_path}/t").columns == ["input", "instruction", "output"]
    writers.intermediate(df, f"file://{tmp_path}/j", "json")
    assert json.loads(spark.read.text(f"file://{tmp_path}/j").first()[0])[0]["note"] == "é"
    writers.yaml_config(spark, {"a": {"b": True}, "c": [1]}, f"file://{tmp_path}/y")
    assert {r[0] for r in spark.read.text(f"file://{tmp_path}/y").collect()} == {"a:", "  b: true", "c:", "  - 1"}
    for i in range(4):
        (tmp_path / f"raw_{i}.json").write_text("{}")
    files = writers.listing(spark, [f"file://{tmp_path}/raw_*.json"])
    assert writers.oldest_beyond(files, above=3, keep=1).count() == 3
    assert len(writers.archive(files, f"file://{tmp_path}/archive")) == 4
    assert writers.purge(spark, f"file://{tmp_path}/archive", days=-1)
    assert writers.cleanup(spark, [f"file://{tmp_path}/archive"]) == 1


def test_word_processor_files(spark, tmp_path):
    import zipfile

    body = "".join(f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>" for t in (" first ", "", "ثان"))
    with zipfile.ZipFile(tmp_path / "a.docx", "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')
    (tmp_path / "b.docx").write_bytes(b"no zip")
    assert readers.docx(spark, str(tmp_path / "a.docx")).first()["text"] == "first\n\nثان"
    assert readers.docx(spark, str(tmp_path / "b.docx"), strict=False).first()["text"] == ""
    pair = {r["name"]: r["text"] for r in readers.docx_pair(spark, str(tmp_path / "a.docx"), str(tmp_path / "a.docx")).collect()}
    assert pair["combined"] == "first\nثان\n\nfirst\nثان"


def test_corrections(spark, tmp_path):
    (tmp_path / "c.csv").write_text("seed_id,reviewer_verdict,reviewer_notes\n1,True,a\n1,False,b\n2,,c\n", encoding="utf-8")
    fixes = readers.corrections_csv(spark, str(tmp_path / "c.csv"))
    rows = spark.createDataFrame([("1", "VERDICT: True"), ("2", "VERDICT: True"), ("3", None)], "seed_id string, output string")
    got = {r["seed_id"]: (r["output"], r["human_corrected"]) for r in D.apply_corrections(rows, fixes).collect()}
    assert got == {"1": ("VERDICT: False", True), "2": ("VERDICT: True", False), "3": (None, False)}


def test_document_ids(spark):
    assert one(spark, T.document_id, "https://x.org/document/d/a-B_9/edit") == ["a-B_9"]
    with pytest.raises(Exception, match="no document id"):
        one(spark, T.document_id, "https://x.org/")


def test_model_boundary(spark):
    def broken(prompt, context):
        raise RuntimeError("timeout")

    assert model.with_fallback([broken, model.stub])("p", "c") == model.stub("p", "c")
    with pytest.raises(RuntimeError):
        model.with_fallback([broken])("p", "c")
    df = spark.createDataFrame([("p", "c")], "prompt string, context string")
    assert model.responses(df, broken).first()["error"] == "timeout"


def test_reports(spark):
    rows = spark.createDataFrame([("i", "", "VERDICT: True"), ("نص", "", "VERDICT: False")], "instruction string, input string, output string")
    assert reports.rebalance(rows).first()["verdict_grade"] == "GOOD"
    assert reports.rebalance(rows.limit(0)).first()["balance_ratio"] == 0
    assert reports.steps([("a", True), ("b", False)]).endswith("1 of 2 steps passed")
    assert "not found" in reports.overall({"x": False})


def test_landing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"instruction": "a", "input": "", "output": "o"}\n' * 3 + '{"instruction": "b", "input": "", "output": "o"}\n')
    rows = landing.deduplicated(landing.stream(spark, str(tmp_path / "in"), "instruction string, input string, output string"))
    landing.land(rows, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_containment_meets_every_kind_of_reference(spark):
    """Against brute force: parts of words, two words, runs of spaces, the empty string, null."""
    texts = ["the small cat  sat on a mat", "élan vital", "", None, "x", "   lead", "a b c"]
    refs = ["cat", "ma", "t  s", "small cat  sat", "  ", "   ", "    ", "", None, "n", "zz", "an vi", "b", "a b", "b c", " ", "sat on a", "on mat", "x", "élan", "é", "lan v"]
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(refs)], "id int, reference string")
    want = {i for i, r in enumerate(refs) if r is not None and any(t is not None and r in t for t in texts)}
    corpus = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r["id"] for r in D.reference_any(rows, corpus).collect()} == want
    assert D.reference_any(rows, corpus.limit(0)).count() == 0
    assert D.reference_any(rows.limit(0), corpus).count() == 0


@pytest.mark.parametrize("threshold", [0.4, 0.85, 1.0])
def test_like_pairs_lose_none(spark, threshold):
    rng = random.Random(7)
    words = ["", "a", *("".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 24))) for _ in range(60))]
    words += [w[:-1] + "x" for w in words if w] + [w + "yz" for w in words]
    words = sorted(set(words))
    a, b = spark.createDataFrame([(w,) for w in [*words, None]], "a string"), spark.createDataFrame([(w,) for w in [*words, None]], "b string")
    got = {(r["a"], r["b"]) for r in A.like_pairs(a, b, "a", "b", threshold).collect()}
    assert {(x, y) for x in words for y in words if A.indel_ratio(x, y) >= 100 * threshold} <= got
    assert len(got) < len(words) ** 2


def test_like_pairs_bring_few_together(spark):
    """Sentences of one vocabulary: what meets are the copies with small changes and few others."""
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    sentences = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 14))) for _ in range(300)]
    close = [s[:5] + "xy" + s[7:] for s in sentences[:40]]
    a, b = spark.createDataFrame([(s,) for s in close], "a string"), spark.createDataFrame([(s,) for s in sentences], "b string")
    got = {(r["a"], r["b"]) for r in A.like_pairs(a, b, "a", "b", 0.85).collect()}
    want = {(x, y) for x in close for y in sentences if A.indel_ratio(x, y) >= 85}
    assert len(want) >= 35 and want <= got and len(got) < 0.1 * len(close) * len(sentences)
    assert A.like_pairs(a.limit(0), b, "a", "b", 0.85).count() == 0 and A.like_pairs(a, b.limit(0), "a", "b", 0.85).count() == 0


def test_references_agree_with_all_pairs(spark):
    rng = random.Random(10)
    vocabulary = ["sale", "hire", "rule", "of", "the", "Second", "contract", "witness", "é"]
    texts = [". ".join(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(1, 4))) for _ in range(25)] + ["", None, "q" * 230 + ". x"]
    sentences = [s.strip() for t in texts if t is not None for s in t.lower().split(".")]
    pick = lambda: list(rng.choice(sentences))
    refs = ["UNKNOWN", "", "unknown", None, "q" * 225 + "z"]
    for _ in range(60):
        s = pick()
        for _ in range(rng.randint(0, 4)):
            s.insert(rng.randint(0, len(s)), rng.choice("abz ")) if rng.random() < 0.5 or not s else s.pop(rng.randrange(len(s)))
        refs.append("".join(s))
    rows = spark.createDataFrame(list(enumerate(refs)), "i int, reference string")
    corpus = spark.createDataFrame([(t,) for t in texts], "text string")
    norm = lambda t: " ".join(t.lower().split())
    whole = [t for t in texts if t is not None]
    got = {r["i"]: r["verified"] for r in D.reference_norm(rows, corpus).collect()}
    for i, r in enumerate(refs):
        if r is not None:
            assert got[i] == (r == "UNKNOWN" or any(norm(r) in norm(t) for t in whole) or any(A.indel_ratio(norm(r), s) >= 85 for s in sentences)), r
    got = {r["i"]: r["verified"] for r in D.reference_seq(rows, corpus).collect()}
    for i, r in enumerate(refs):
        key = (r or "").strip().lower()
        assert got[i] == (key in ("", "unknown") or any(key in t.lower() for t in whole) or any(difflib.SequenceMatcher(None, key, s).ratio() >= 0.85 for s in sentences)), r


def _plain_batches(costs, limit, prompt, output):
    out = []
    for i, c in enumerate(costs):
        if out and out[-1][1] + c + output <= limit:
            out[-1] = ([*out[-1][0], i], out[-1][1] + c + output)
        else:
            out.append(([i], prompt + c + output))
    return out


def test_batches_of_one_group_over_many_ranges(spark, monkeypatch):
    """Small ranges and fans, so that functions are composed over several levels; against a plain loop."""
    monkeypatch.setattr(B, "RANGE", 7)
    monkeypatch.setattr(B, "FAN", 3)
    rng = random.Random(4)
    groups = {"hot": [rng.choice([0, 0, 1, 5, 40, 99, 100, 101, 250]) for _ in range(700)], "one": [500], None: [3] * 50}
    rows = spark.createDataFrame([(g, i, c) for g, costs in groups.items() for i, c in enumerate(costs)], "g string, id long, token_count long").repartition(6)
    got = K.pack_batches(rows, group="g", order="id", limit=300, prompt_tokens=20, output_tokens=3).collect()
    for g, costs in groups.items():
        mine = sorted((r["batch_id"], r["chunk_ids"], r["total_tokens"]) for r in got if r["g"] == g)
        assert mine == [(k, *b) for k, b in enumerate(_plain_batches(costs, 300, 20, 3))]
    assert K.pack_batches(rows.limit(0), group="g", order="id").count() == 0


def test_step_functions_compose():
    rng = np.random.default_rng(5)
    for _ in range(200):
        limit = int(rng.integers(1, 60))
        parts = [rng.integers(0, 30, rng.integers(1, 9)) for _ in range(3)]
        whole = B.steps_of(np.concatenate(parts), limit)
        chain = B.steps_of(parts[0], limit).then(B.steps_of(parts[1], limit)).then(B.steps_of(parts[2], limit))
        for amount in [*range(limit + 40), B.FULL]:
            held = amount
            for c in np.concatenate(parts):
                held = held + c if held + c <= limit else c
            assert whole(amount) == chain(amount) == held


def test_batches_and_chunks_of_long_rows(spark):
    """Groups against a plain loop; a document of 20,000 paragraphs takes seconds, as nothing is copied for each item."""
    rng = random.Random(3)
    costs = [rng.choice([0, 1, 5, 40, 99, 100, 101, 250]) for _ in range(2000)]
    rows = spark.createDataFrame([("g", i, c) for i, c in enumerate(costs)], "g string, id long, token_count long")
    got = K.pack_batches(rows, group="g", order="id", limit=300, prompt_tokens=20, output_tokens=3).orderBy("batch_id").collect()
    assert [(r["chunk_ids"], r["total_tokens"]) for r in got] == _plain_batches(costs, 300, 20, 3)
    text = "\n".join("word " * rng.randint(1, 9) + "end" for _ in range(20_000))
    docs = spark.createDataFrame([(1, text, "en"), (2, "", "en"), (3, None, "en")], "doc_id long, text string, lang string")
    got = K.chunk_words(docs, size=50, separator="\n").orderBy("id").collect()
    assert "\n".join(r["text"] for r in got) == text and {r["doc_id"] for r in got} == {1}
    assert all(r["word_count"] <= 50 for r in got)
    assert all(a["word_count"] + len(b["text"].split("\n")[0].split()) > 50 for a, b in zip(got, got[1:], strict=False))
