"""The other operators: near-duplicates and repeats against brute force, round trips, held-out accuracy."""

import random
import time
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.llm import htmltext, langid, neardup, packing, queries, suffixes, tokencount

LONG = "doc_id long, text string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, LONG).withColumn("node", F.lit("clash")).repartition(parts)


# ---- near-duplicates -----------------------------------------------------------------------


def linked(rows):
    sets = {d: neardup.shingle_set(t) for d, t in rows if d is not None}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            both = len(x & y)
            if x and y and 100 * both >= 75 * (len(x) + len(y) - both):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), root(d)) for d in ids}


def crowded(rng):
    """A passage in many short texts, copies with a few to many edits, and a chain of edits."""
    voc = [f"W{i}" for i in range(3000)]
    passage, base = [rng.choice(voc) for _ in range(60)], [rng.choice(voc) for _ in range(120)]
    rows = []
    for _ in range(60):
        own = [rng.choice(voc) for _ in range(rng.randint(0, 40))]
        rows.append(" ".join(own[:5] + passage + own[5:]))
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 8, 12])):
            copy[rng.randrange(120)] = rng.choice(voc)
        rows.append("\t ".join(copy))
    for _ in range(30):
        base = list(base)
        base[rng.randrange(120)] = rng.choice(voc)
        rows.append(" ".join(base).lower())
    return list(enumerate(rows))


@pytest.mark.parametrize(("small", "block"), [(48, 2048), (4, 16)])
def test_near_duplicates(spark, small, block):
    rows = crowded(random.Random(4))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "a b"), (204, "A  b"), (205, "a b c d e f"), (207, rows[0][1]), (208, "x " * 30_000), (209, "x " * 20_000 + "\n")]
    twice = [*rows, (207, rows[0][1]), (None, "a b")]
    got = neardup.near_duplicates(frame(spark, twice), small=small, block=block).collect()
    assert len(got) == len(twice)
    want = linked(rows)
    for r in got:
        if r["doc_id"] is None:
            assert (r["component_id"], r["kept"]) == (None, True)
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_near_duplicates_of_nothing(spark):
    assert neardup.near_duplicates(frame(spark, [])).count() == 0
    kept = neardup.drop_near_duplicates(frame(spark, [(1, "a b c"), (2, "a b c"), (3, None)]))
    assert {r["doc_id"] for r in kept.collect()} == {1, 3} and kept.columns == ["doc_id", "text", "node"]


def test_bayes_keeps_similar_pairs():
    least = neardup.least_matches(0.75, 1e-6)
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 30, (4000, neardup.HASHES))
    alike = np.where(rng.random(a.shape) < 0.75, a, -1)
    apart = np.where(rng.random(a.shape) < 0.3, a, -1)
    assert neardup.bayes_alive(a, alike, least).mean() > 0.999
    assert neardup.bayes_alive(a, apart, least).mean() < 0.01


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(50, 40), (40, 45), (60, 60)]
    got = {r["node"]: r["comp"] for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 21)}, 50: 40, 45: 40}


# ---- repeats -------------------------------------------------------------------------------


def without_repeats(rows, n):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + n] for _, b in data for i in range(len(b) - n + 1))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize(("length", "hot"), [(40, 100_000), (40, 2), (40, 1), (64, 9)])
def test_repeats(spark, length, hot):
    rng = random.Random(length)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [word(rng.randint(length - 8, 3 * length)) for _ in range(6)]
    rows = [(i, word(rng.randint(0, 90)) + "".join(rng.choice(shared) + word(rng.randint(0, 9)) for _ in range(rng.randint(0, 3)))) for i in range(60)]
    rows += [(i, "".join(rng.choice("ab") + shared[0][k : k + 30] for k in range(0, len(shared[0]), 30))) for i in range(60, 66)]
    rows += [(70, None), (71, ""), (72, rows[3][1]), (73, rows[3][1]), (74, "x" * 3 * length), (75, "xy" * length), (76, "short"), (77, "short"), (78, word(3000) * 2), (None, shared[1])]
    got = suffixes.remove_repeats(frame(spark, rows), length=length, hot=hot).collect()
    have = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], len(r["removed"]), bytes(r["kept"])) for r in got)
    assert have == sorted((str(d), *rest) for d, *rest in without_repeats(rows, length))


def test_no_repeats(spark):
    assert suffixes.remove_repeats(frame(spark, [])).count() == 0
    got = suffixes.remove_repeats(frame(spark, [(1, "a" * 500), (1, "b" * 399)])).collect()
    assert sorted((r["n_bytes"], r["n_removed"]) for r in got) == [(399, 0), (500, 500)]


@pytest.mark.parametrize("name", ["op2_near_duplicates", "op6_suffix_dedup"])
def test_queries_agree_with_sql(name, same):
    same(queries.QUERIES[name], queries.ORACLES[name])


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    """As if every table were beyond the bound for a broadcast."""
    rows = crowded(random.Random(9))
    want = {n: sorted(map(str, f(frame(spark, rows), **k).collect())) for n, f, k in (("near", neardup.near_duplicates, {}), ("repeats", suffixes.remove_repeats, {"length": 64}))}
    for module in (neardup, suffixes):
        monkeypatch.setattr(module, "broadcast_if", lambda df: df.hint("merge"))
    assert sorted(map(str, neardup.near_duplicates(frame(spark, rows)).collect())) == want["near"]
    assert sorted(map(str, suffixes.remove_repeats(frame(spark, rows), length=64).collect())) == want["repeats"]


def test_loser_tree_merges():
    rng = random.Random(8)
    runs = [sorted((bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))), b"%d" % r) for _ in range(rng.randint(0, 40))) for r in range(7)]
    out = list(suffixes.LoserTree([suffixes.front_code(r) for r in runs]))
    assert [k for _, k, _ in out] == sorted(k for r in runs for k, _ in r)
    assert all(n == suffixes.shared(a[1], b[1]) for a, b in zip(out, out[1:]) for n in [b[0]])
    assert sorted((k, r) for _, k, r in out) == sorted(x for r in runs for x in r)
    assert list(suffixes.LoserTree([])) == []


def test_large_clusters_agree_with_small_ones():
    rng = random.Random(6)
    n, c = 12, 40
    records = sorted({("".join(rng.choice("ab") for _ in range(6)) + "".join(rng.choice("ab") for _ in range(6)), "".join(rng.choice("ab") for _ in range(6))) for _ in range(c)})
    rights, lefts = [r.encode() for r, _ in records], [x.encode() for _, x in records]
    lcps, low, high = suffixes._common(rights), np.zeros(len(records), np.int64), np.full(len(records), 6)
    least, most = suffixes.repeated_windows(rights, lcps, lefts, low, high, n)
    for i in range(len(records)):
        ds = [d for d in range(7) for j in range(len(records)) if j != i and rights[i][: n - d] == rights[j][: n - d] and lefts[i][:d] == lefts[j][:d]]
        assert (least[i], most[i]) == ((min(ds), max(ds)) if ds else (-1, -1))


# ---- packing and counts --------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers, files = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    return tokenizers.Tokenizer.from_file(files.path("word_bpe_49k.json"))


TEXTS = [None, "", "  ", "Hello, World.", "É x́ İI ΣΑΣ", "a b\tc\n\n'S we'LL 12a3", "<|endoftext|> end", "\x1cab\x85c ,. x., ...", "ºª µ ß", "word " * 5000, "x" * 300, "naïve, café. \U0001f600"]


def test_packing_round_trip(spark, tokenizer):
    rng = random.Random(3)
    rows = list(enumerate(TEXTS)) + [(100 + i, " ".join(rng.choice(["thing", "über", "of,", "Zed."]) for _ in range(rng.randint(1, 900)))) for i in range(120)] + [(100, "again")]
    got = packing.pack(frame(spark, rows, 2)).collect()
    want = Counter()
    for d, t in rows:
        want[d, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()] += 1
    docs, sequences = {}, {}
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] > 0
        docs.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    have = Counter()
    for (d, n), pieces in docs.items():
        pieces.sort(key=lambda r: r["start"])
        assert sum(p["length"] for p in pieces) % n == 0
        have[d, b"".join(bytes(p["ids"]) for p in pieces)] += 1
    assert have == want
    padding = total = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= packing.SEQUENCE
        padding += 0 if at & (at - 1) == 0 else packing.SEQUENCE - at
        total += at
    assert padding < 0.01 * total
    assert packing.pack(frame(spark, [])).count() == 0


def test_most_tokens_are_packed_by_least_squares(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.1')}/documents.parquet").repartition(32)
    n = {r["how"]: r["n"] for r in packing.pack(docs).groupBy("how").agg(F.sum("length").alias("n")).collect()}
    assert n["rest"] < 0.05 * sum(n.values())


def test_open_windows_are_few():
    rng = random.Random(2)
    p, out = packing.Packer(64, most=5), []
    for d in range(500):
        out += p.add(d, b"\0" * 4 * rng.randint(1, 200))
        assert p.n_open == sum(p.counts) <= 5
    out += p.close()
    for d in range(500):
        mine = sorted((r[1], r[2], r[4]) for r in out if r[0] == d)
        assert sum(n for _, n, _ in mine) == mine[0][2] and all(a + n == b for (a, n, _), (b, *_) in zip(mine, mine[1:]))
    assert packing.Packer(64).rest() == p.rest() == []


def test_level_has_least_squares():
    rng = random.Random(9)
    p = packing.Packer(16, most=10**6)
    for _ in range(400):
        n, counts = rng.randint(1, 15), np.array(p.counts)

        def squares(h, n=n, counts=counts):
            c = counts.copy()
            c[h] -= h > 0
            c[h + n] += h + n < 16
            return int((c**2).sum())

        best = min(squares(h) for h in range(16 - n + 1) if h == 0 or counts[h])
        assert squares(p.level(n)) == best
        list(p.add(0, b"\0" * 4 * n))
    assert all(sum(len(x[2]) // 4 for x in w) == k for k, ws in p.open.items() for w in ws)


def test_token_counts(spark, tokenizer):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    vocab, signs = set(tokencount.vocabulary(path)), tokencount.byte_signs()

    def greedy(word):
        n = i = 0
        while i < len(word):
            j = next(e for e in range(len(word), i, -1) if word[i:e] in vocab)
            i, n = j, n + 1
        return n

    def by_hand(text):
        low = unicodedata.normalize("NFC", text or "").lower()
        return sum(greedy("".join(signs[b] for b in w.encode()) + tokencount.END) for w in tokencount.WORD.findall(low))

    got = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in tokencount.token_counts(frame(spark, list(enumerate(TEXTS)))).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] == (len((t or "").split()), by_hand(t))
    assert tokencount.token_counts(frame(spark, [])).count() == 0


def test_automaton_on_random_vocabularies():
    rng = random.Random(5)
    for _ in range(60):
        vocab = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        auto = tokencount.Automaton(sorted(vocab))
        for _ in range(60):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
            n = i = 0
            while i < len(word):
                j = next((e for e in range(len(word), i, -1) if word[i:e] in vocab), None)
                if j is None:
                    n = 1
                    break
                i, n = j, n + 1
            assert auto.count(word) == n


# ---- language and pages --------------------------------------------------------------------


def test_language_on_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet").where("lang is not null")
    rows = [(r["text"], r["lang"], zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in docs.collect()]
    model = langid.fit([(t, y) for t, y, held in rows if not held])
    got = [(*model.predict(t), y) for t, y, held in rows if held]
    right = [p == y for p, _, y in got]
    assert sum(right) >= 0.95 * len(right)
    # scores say about how often predictions are right, on rows that neither trained nor calibrated
    assert abs(sum(s for _, s, _ in got) - sum(right)) < 0.02 * len(right)
    # smoothing alone puts scores of an error-free calibration 1 / (n + 2) below it
    assert model.reliability["calibration_error"] < 0.01 + 1 / (model.reliability["documents"] + 2) and max(s for _, s, _ in got) < 1
    by_score = sorted(got, key=lambda r: r[1])
    assert sum(p == y for p, _, y in by_score[len(got) // 2 :]) >= sum(p == y for p, _, y in by_score[: len(got) // 2])


def test_calibration_of_noisy_languages():
    """A fifth of the labels is noise: scores must not claim more than four fifths or so."""
    rng = random.Random(5)
    words = {"aa": ["xo", "yop", "zil"], "bb": ["mur", "nak", "tev"]}
    rows = [(" ".join(rng.choice(words[y]) for _ in range(30)), y if rng.random() > 0.2 else "bb" if y == "aa" else "aa") for y in ("aa", "bb") * 400]
    model = langid.fit(rows)
    assert model.reliability["calibration_error"] < 0.1
    assert 0.7 < np.mean([model.predict(t)[1] for t, _ in rows]) < 0.9


def test_language_query_of_an_empty_table(spark, tmp_path):
    from sieveline.llm import queries

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES["op4_language_id"](spark, str(tmp_path)).count() == 0


def test_long_sample_texts_are_cut_anywhere(spark, monkeypatch):
    monkeypatch.setattr(langid, "fit", lambda got, **_: got)
    got = langid.train(spark.createDataFrame([("a" * 100 + "b" * 900 + str(i), "en") for i in range(20)], "text string, lang string"), max_chars=50)
    assert len(got) == 20 and all(len(t) == 50 for t, _ in got) and any("b" in t for t, _ in got)


def test_rare_languages_keep_their_share_of_the_sample(spark, monkeypatch):
    rows = [(f"text {y} number {i}", f"l{y:02}") for y in range(13) for i in range(400)] + [(f"rare words {i}", "zz") for i in range(20)]
    monkeypatch.setattr(langid, "fit", lambda got, **_: Counter(y for _, y in got))
    got = langid.train(spark.createDataFrame(rows, "text string, lang string"), per_lang=50, max_docs=280)
    assert got["zz"] == 20 and len(got) == 14 and max(got.values()) <= 20


def test_language_of_odd_rows(spark):
    rows = [("the cat and the dog " * 5, "en"), ("le chat et la souris " * 5, "fr")] * 12
    model = langid.fit(rows, epochs=20)
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "123 !!"), (4, "the dog and the cat"), (4, "the dog and the cat"), (5, "la souris et le chat " * 20_000)], LONG).withColumn("lang", F.lit("clash"))
    got = {r["doc_id"]: r for r in langid.identify(docs, model, reject=False).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4, 5)] == ["und", "und", "und", "en", "fr"]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[1]["score"] == 0
    model.reject = 1.1
    assert {r["lang_pred"] for r in langid.identify(docs, model).collect()} == {"und"}
    empty = langid.train(docs.select("doc_id", "text", F.lit(None).cast("string").alias("lang")))
    assert {r["lang_pred"] for r in langid.identify(docs, empty).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0


def test_slices_cover_long_texts(monkeypatch):
    text = langid.letters("the quick brown fox " * 40)
    whole = np.sort(np.concatenate(list(langid.slices(text))))
    monkeypatch.setattr(langid, "SLICE", 7)
    assert (np.sort(np.concatenate(list(langid.slices(text)))) == whole).all()


BODY = "".join(f"<p>Paragraph {i} has quite some words, and &amp; more &eacute;.</p>" for i in range(6))
MAIN = " ".join(f"Paragraph {i} has quite some words, and & more é." for i in range(6))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("<html><body><nav><a href='/'>x</a></nav></body></html>", ""),
        (f"<html><head><title>t</title></head><body><nav><ul><li><a>menu</a></ul></nav><article><h1>Head</h1>{BODY}</article><footer>f</footer></body></html>", f"Head {MAIN}"),
        (f"<body><header>top</header><div class='ad'>Buy this now please</div><main>{BODY}</main><section class='comments'><p>First comment with many words in it</p></section></body>", MAIN),
        (f"<body><div id=sidebar><p>side words</p></div><div><div>{BODY}</div></div><form><p>Your name</p></form><div class='cookie-notice'>We use cookies</div></body>", MAIN),
        ("<article><h1>H</h1><p><b>unclosed bold<br><p>next <i>in</i>line</article>", "H unclosed bold next inline"),
        ("<article><script>var a='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>a\n\t b&nbsp;c</p>tail</article>", "a b c tail"),
        ("just text & no tags < 3", "just text & no tags < 3"),
        ("<p>a<div>b</div>c", "a b c"),
        ("<article><p>one</p></b></div><p>two</p></article></article>", "one two"),
    ],
)
def test_pages(page, want):
    assert htmltext.main_text(page) == want


def test_pages_without_article_keep_all_sections():
    p = "".join(f"<p>{{0}}{i} " + "some words here " * 25 + "</p>" for i in range(4))
    a, b = p.format(*"a"), "".join(p.format(*"b").partition("<p>b2")[0])
    both = " ".join(htmltext.re.sub("<[^>]*>", " ", a + b).split())
    assert htmltext.main_text(f"<div><section>{a}</section><section>{b}</section></div>") == both
    assert htmltext.main_text(f"<div><section>{b}</section><ul><li><a href=x>more</a></ul><section><div>{a}</div></section></div>") == " ".join(htmltext.re.sub("<[^>]*>", " ", b + a).split())


@pytest.mark.parametrize("sign", ["<a ", '<a x="', "<a x='\"", "<script", "</x ", "<!--", "<div>", "<b><p>", "<div></span>", "&#9", "<nav>", "<p class=ad><div>", "<table><tr><td>", "<a>x", "<", "<b><table></b>"])
def test_hostile_pages_take_linear_time(sign):
    began = time.perf_counter()
    htmltext.main_text(sign * (300_000 // len(sign)) + ">")
    htmltext.main_text("&#" + "9" * 300_000 + ";")
    assert time.perf_counter() - began < 10


@pytest.mark.parametrize("wrapper", ["<div class='widget related'>", "<section id=header>", "<div class=notice><div>"])
def test_wrappers_with_boilerplate_names_keep_the_article(wrapper):
    assert htmltext.main_text(f"<body><div class=menu>m</div>{wrapper}<article>{BODY}</article></body>") == MAIN
    assert htmltext.main_text(f"<body><div class=menu>m</div>{wrapper}<div>{BODY}</div></body>") == MAIN


def by_density(tree):
    """The element with the greatest sum of its children's densities, by the definition."""
    n = len(tree.tag)
    inside = [[j for j in range(n) if i in chain(tree, j)] for i in range(n)]
    total = lambda xs, i: sum(xs[j] for j in inside[i])
    ratio = sum(tree.link_chars) / max(sum(tree.chars), 1)

    def density(i):
        c, lc = total(tree.chars, i), total(tree.link_chars, i)
        t = total(tree.tags, i) + len(inside[i]) - 1
        lt = total(tree.link_tags, i) + sum(tree.tag[j] == "a" for j in inside[i] if j != i)
        if not c:
            return 0.0
        base = np.log(c / max(c - lc, 1) * lc + ratio * c + np.e)
        return c / max(t, 1) * np.log(max(c / max(lc, 1) * max(t, 1) / max(lt, 1), 1)) / np.log(max(base, 1) + 1)

    sums = [sum(density(j) for j in range(1, n) if tree.parent[j] == i) for i in range(n)]
    return max(range(n), key=lambda i: (round(sums[i], 9), -i))


def chain(tree, j):
    out = [j]
    while j > 0:
        out.append(j := tree.parent[j])
    return out


def test_main_element_has_the_greatest_density_sum():
    rng = random.Random(12)
    for _ in range(60):
        part = lambda d: f"<div>{''.join(part(d - 1) for _ in range(rng.randint(1, 3)))}</div>" if d else rng.choice(["<p>{}</p>", "<a href=x>{}</a>", "<p>{}<b>x</b></p>", "<ul><li><a>{}</a></ul>"]).format("word " * rng.choice([1, 3, 30, 80]))
        page = part(3)
        tree = htmltext.Tree(page)
        chosen = {j for i in tree.main() for j in range(abs(i), tree.end[i] if i > 0 else abs(i) + 1)}
        best = by_density(tree)
        assert chosen >= set(range(best, max(tree.end[best], best + 1)))


def test_headings_and_gaps_without_semantic_tags():
    assert htmltext.main_text(f"<body><ul><li><a href=x>menu of links</a></ul><div><div><h2>Head <i>line</i></h2></div><div>{BODY}</div></div></body>").startswith("Head line Paragraph 0")


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p class='ad'>x<p>article text<p>more", "article text more"),
        ("<div><p class=share>x<div><p>a</p></div><p>b</p></div>", "a b"),
        ("<ul><li class=menu>x<li>item<li class=menu>y</ul><p>after", "item after"),
        ("<ul><li class=menu>x<ul><li>inner</ul>z<li>item</ul>", "item"),
        ("<p class=ad>x<hr>text", "text"),
        ("<div><p class=ad>x</div><p>after", "after"),
        ("<table><tr class=ad><td>x<tr><td>cell</table>", "cell"),
        ("<html><head><title>t</title><meta name=a><body><p>text", "text"),
        ("<ul><li>a<nav><ul><li>x<li>y</ul></nav>b<li>c</ul>", "a b c"),
    ],
)
def test_implied_ends_of_boilerplate(page, want):
    assert htmltext.main_text(page) == want


def test_page_rows(spark):
    rows = [(1, "u", f"<article>{BODY}</article>"), (1, "u", f"<article>{BODY}</article>"), (2, None, None), (3, "v", "<article>" + "<div>" * 3000 + "deep" + "<p>x</p>" * 3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in htmltext.extract(df).collect()), key=str)
    assert got[:3] == [(1, "u", MAIN, len(MAIN))] * 2 + [(2, None, "", 0)]
    assert got[3][2] == "deep " + " ".join(["x"] * 3000)
    assert htmltext.extract(df.limit(0)).count() == 0


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near-duplicates", "benchmark decontamination", "secret scans", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, sizes = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, sf_dir).checkpoint()
        assert docs.columns == names
        after = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert after <= before
        sizes.append(len(after))
    want = linked([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert all(d == root for d, (_, root) in want.items())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.collect()}
    empty = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


@pytest.mark.parametrize("empty", ["<!-->", "<!--->", "<!---->", "<!-- a -->", "<!-- a --!>"])
def test_short_comments_end(empty):
    assert htmltext.main_text(f"<p>Before.</p>{empty}<p>After it, more.</p><!-- x --><p>End.</p>") == "Before. After it, more. End."


def test_scanning_is_linear_in_odd_pages():
    n = 400_000
    pages = ["< " * n + ">", "<p><button>" + "<span>" * (n // 8) + "<hr>" * (n // 8), "<div>" * (n // 8) + "</b>" * (n // 8), "<a " * n, "<!-->" * n, "<i><table>" + "<td>x" * (n // 8) + "</i>" * (n // 8)]
    for page in pages:
        began = time.monotonic()
        htmltext.main_text(page)
        assert time.monotonic() - began < 20, page[:30]


def test_boilerplate_is_seen_at_any_depth():
    deep = "<div>" * 600
    assert htmltext.main_text(f"<body>{deep}<p>Main words, {"and more " * 20}.</p><nav>menu entry</nav><form>mail <input></form><aside>side</aside><p>Last words.</p>") == " ".join(f"Main words, {'and more ' * 20}. Last words.".split())


def test_density_decides_where_nothing_has_a_name():
    """Divisions without telling tags, classes or ids: menus of links go by their density alone."""
    rng = random.Random(3)
    prose = [" ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 8))) for _ in range(60)) for _ in range(5)]
    menu = lambda k: "<div>" + "".join(f'<div><a href="/{i}">item {i}</a></div>' for i in range(k)) + "</div>"
    body = "<div>" + "".join(f"<div>{t}</div>" for t in prose) + "</div>"
    page = f"<html><body>{menu(12)}<div>{menu(5)}{body}{menu(9)}</div>{menu(7)}</body></html>"
    assert htmltext.main_text(page) == " ".join(prose)


def test_packing_tells_what_was_filled(spark):
    """With few open windows documents are cut to fill them, which sequences say; without a bound none is."""
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, " ".join(rng.choice(["word", "rain", "tree"]) for _ in range(rng.randint(1, 60)))) for i in range(400)], LONG).repartition(2)
    for most, filled in ((2, True), (10_000, False)):
        pieces = packing.pack(docs, size=128, open_windows=most)
        parts = {r["how"]: r["share"] for r in packing.shares(pieces).collect()}
        assert ("filled" in parts) == filled and sum(parts.values()) == pytest.approx(1)
        assert pieces.groupBy("doc_id").agg((F.sum("length") == F.first("doc_tokens")).alias("whole")).where("not whole").count() == 0
