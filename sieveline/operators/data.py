"""Deduplication, joins on references, balancing, splitting, sampling and aggregates of instruction records."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import records as R
from ..functions import text as T
from .align import indel_ratio_column, like_pairs, seq_ratio_column
from .order import first_rows, keep_first, rank_by_hash, shuffled_key, top_k

# ---- deduplication -------------------------------------------------------------------------


def dedup_hash(df: DataFrame, *, cols: tuple[str, ...] = ("instruction", "input", "output"), order: str = "ordinal") -> DataFrame:
    """The first row of each SHA-256 of the joined columns (no delimiter; null as empty)."""
    return keep_first(df, F.sha2(F.concat(*[F.coalesce(F.col(c), F.lit("")) for c in cols]), 256), order)


def dedup_question(df: DataFrame, *, col: str = "question", lang: str = "language", order: str = "ordinal") -> DataFrame:
    """The first row of each stripped, lower-cased question of a language; rows without a question go."""
    q = F.lower(T.strip(F.coalesce(F.col(col), F.lit(""))))
    return keep_first(df.where(q != ""), F.struct(F.col(lang), q), order)


def dedup_input(df: DataFrame, *, col: str = "input", order: str = "ordinal") -> DataFrame:
    """The first row of each stripped, lower-cased input; an empty one is a value too."""
    return keep_first(df, F.lower(T.strip(F.coalesce(F.col(col), F.lit("")))), order)


# ---- references ----------------------------------------------------------------------------


#: References that are looked for in a text at a time.
REFS = 5000


def _contained(refs: DataFrame, texts: DataFrame) -> DataFrame:
    """The distinct _r of refs that are contained in a _t of texts.

    No pair is tested but those that a word brings together: references with a word between two spaces
    meet the texts that hold that word (the longest one), the others the texts with a word that holds
    the longest part between their spaces, found by the part's first three characters. What consists of
    spaces only is compared with the longest run of spaces.
    """
    texts = texts.where("_t is not null").withColumn("_h", F.xxhash64("_t"))
    longest = lambda parts: F.array_max(F.transform(parts, lambda w: F.struct(F.char_length(w).alias("n"), w.alias("w"))))["w"]
    parts = F.split("_r", " ")
    inner = F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0))), lambda w: w != "")
    keyed = refs.select("_r").where("_r is not null").distinct().select("_r", longest(inner).alias("_w"), longest(F.filter(parts, lambda w: w != "")).alias("_p"))
    words = texts.select("_h", F.explode(F.array_distinct(F.split("_t", " "))).alias("_w"))
    whole = keyed.where("_w is not null").join(words, "_w").select("_r", "_h")
    size = lambda c: F.least(F.char_length(c), F.lit(3))
    grams = words.where("_w <> ''").select("_w").distinct()
    starts = F.sequence(F.lit(1), F.char_length("_w"))
    grams = grams.select("_w", F.explode(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.transform(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda n: F.substring(F.col("_w"), i, n)))))).alias("_g"))
    plain = keyed.where("_w is null and _p is not null").select("_r", "_p", F.substring(F.col("_p"), F.lit(1), size("_p")).alias("_g"))
    holding = plain.join(grams, "_g").where(F.col("_w").contains(F.col("_p"))).select("_r", "_w")
    likely = whole.unionByName(holding.join(words, "_w").select("_r", "_h")).distinct()
    # a text goes to its likely references once, with up to REFS of them at a time
    many = likely.groupBy("_h").agg(F.count("*").alias("_n"))
    lists = likely.join(many, "_h").groupBy("_h", F.pmod(F.xxhash64("_r"), F.ceil(F.col("_n") / REFS)).alias("_k")).agg(F.collect_list("_r").alias("_rs"))
    once = texts.groupBy("_h").agg(F.first("_t").alias("_t"))
    found = lists.join(once, "_h").select(F.explode(F.filter("_rs", lambda r: F.contains(F.col("_t"), r))).alias("_r"))
    run = texts.agg(F.max(F.coalesce(F.array_max(F.transform(F.regexp_extract_all("_t", F.lit("( +)")), F.char_length)), F.lit(0))).alias("_run"))
    blank = keyed.where("_p is null").join(F.broadcast(run)).where(F.char_length("_r") <= F.col("_run")).select("_r")
    return found.unionByName(blank).distinct()


def reference_any(rows: DataFrame, corpus: DataFrame, *, ref_col: str = "reference", text_col: str = "text") -> DataFrame:
    """The rows whose reference is, ignoring case, contained in a corpus text. Distinct references are tested once."""
    found = _contained(rows.select(F.lower(F.col(ref_col)).alias("_r")), corpus.select(F.lower(F.col(text_col)).alias("_t")))
    return rows.join(found, F.lower(F.col(ref_col)) == F.col("_r"), "left_semi")


def _normal(c: Column) -> Column:
    return F.regexp_replace(F.lower(T.strip(c)), f"{T.SPACE}+", " ")


def _close(left: DataFrame, corpus: DataFrame, text_col: str, ratio, threshold: float, full: float = 1.0) -> DataFrame:
    """The distinct _r of left within the ratio of a sentence of the corpus.

    Sentences come from all texts, are taken once each and meet the references that share rare grams with them;
    common characters are counted before the ratio is worked out.
    """
    sentences = corpus.select(F.explode(F.split(F.lower(F.col(text_col)), r"\.")).alias("_s")).select(T.strip(F.col("_s")).alias("_s")).distinct()
    pairs = like_pairs(left.select("_r").distinct(), sentences, "_r", "_s", threshold / full)
    return pairs.where(ratio("_r", "_s") >= threshold).select("_r").distinct()


#: Keys over which rows are spread that need no lookup.
SPREAD = 4096


def _looked_up(rows: DataFrame, good: DataFrame, key: Column, settled: Column) -> DataFrame:
    """rows with _k (key) and _ok, true where good (_r) has the key. Rows that are settled without it, which may be most, are spread over
    many join keys that begin with a new line, as no stripped key does."""
    spread = F.concat(F.lit("\n"), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("string"))
    known = good.select("_r").distinct().withColumn("_ok", F.lit(True))
    out = rows.withColumn("_k", key).withColumn("_j", F.when(settled, spread).otherwise(F.col("_k")))
    return out.join(known, F.col("_j") == F.col("_r"), "left").drop("_r", "_j")


def reference_norm(rows: DataFrame, corpus: DataFrame, *, ref_col: str = "reference", text_col: str = "text", threshold: float = 85.0) -> DataFrame:
    """The rows with `verified`: UNKNOWN, contained with white space collapsed, or within the indel ratio of a sentence.

    The ratio is only worked out for references that aren't contained, and pairs whose lengths and characters allow it.
    """
    refs = rows.select(F.col(ref_col).alias("_ref")).distinct().withColumn("_r", _normal(F.col("_ref")))
    exact = _contained(refs, corpus.select(_normal(F.col(text_col)).alias("_t")))
    left = refs.where("_ref <> 'UNKNOWN'").join(exact, "_r", "left_anti")
    good = exact.unionByName(_close(left, corpus, text_col, indel_ratio_column, threshold, 100.0))
    joined = _looked_up(rows, good, _normal(F.col(ref_col)), F.coalesce(F.col(ref_col) == "UNKNOWN", F.lit(True)))
    return joined.withColumn("verified", F.coalesce("_ok", F.col(ref_col) == "UNKNOWN", F.lit(False))).drop("_k", "_ok")


def reference_seq(rows: DataFrame, corpus: DataFrame, *, ref_col: str = "reference", text_col: str = "text", threshold: float = 0.85) -> DataFrame:
    """The rows with `verified`: blank or UNKNOWN, contained ignoring case, or within the sequence ratio of a sentence."""
    key = F.lower(T.strip(F.coalesce(F.col(ref_col), F.lit(""))))
    refs = rows.select(key.alias("_r")).distinct()
    exact = _contained(refs, corpus.select(F.lower(F.col(text_col)).alias("_t")))
    left = refs.where("_r not in ('', 'unknown')").join(exact, "_r", "left_anti")
    good = exact.unionByName(_close(left, corpus, text_col, seq_ratio_column, threshold))
    joined = _looked_up(rows, good, key, key.isin("", "unknown"))
    return joined.withColumn("verified", F.coalesce("_ok", F.col("_k").isin("", "unknown"))).drop("_k", "_ok")


def fix_references(rows: DataFrame, corpus: DataFrame, *, ref_col: str = "reference", context_col: str = "context", text_col: str = "text") -> DataFrame:
    """The rows with the reference kept, taken from the context, or UNKNOWN."""
    known = reference_any(rows.select(ref_col).distinct(), corpus, ref_col=ref_col, text_col=text_col).select(F.col(ref_col).alias("_k")).withColumn("_in", F.lit(True))
    joined = rows.join(known, F.col(ref_col) == F.col("_k"), "left")
    return joined.withColumn(ref_col, R.fix_reference(F.col(ref_col), F.coalesce("_in", F.lit(False)) | (F.col(ref_col) == ""), F.col(context_col))).drop("_k", "_in")


def anti_referenced(files: DataFrame, reports: DataFrame, *, path_col: str = "path", text_col: str = "text", by_name: bool = False, keep_on_error: bool = False) -> DataFrame:
    """The files whose path (by_name: what follows its last slash) is contained in no report; a null path is in none.

    Files and reports may be many: they meet through words. A report that can't be read has a null text; with keep_on_error
    it may refer to any file, so none is returned.
    """
    ref = F.substring_index(F.col(path_col), "/", -1) if by_name else F.col(path_col)
    texts = reports.select(F.col(text_col).alias("_t"))
    out = files.join(_contained(files.select(ref.alias("_r")), texts), ref == F.col("_r"), "left_anti")
    if keep_on_error:
        unread = texts.where("_t is null").limit(1).select(F.lit(True).alias("_unread"))
        out = out.join(F.broadcast(unread), F.lit(True), "left_anti")
    return out


def apply_corrections(rows: DataFrame, corrections: DataFrame, *, key: str = "seed_id", notes: str = "reviewer_notes") -> DataFrame:
    """Outputs whose verdict a reviewer changed, with where that came from. Later corrections win; blank ones don't count."""
    last = corrections.where(F.coalesce(T.strip(F.col("reviewer_verdict")), F.lit("")) != "").groupBy(key).agg(F.max_by(F.struct(F.col("reviewer_verdict").alias("_v"), F.col(notes).alias("_n")), "ordinal").alias("_c"))
    joined = rows.join(last, key, "left")
    now = F.when(C.verdict_exact(F.col("output")), "True").otherwise("False")
    change = F.coalesce(F.col("output").contains("VERDICT:") & (F.col("_c._v") != now), F.lit(False))
    output = F.when(change, F.replace(F.col("output"), F.concat(F.lit("VERDICT: "), now), F.concat(F.lit("VERDICT: "), F.col("_c._v")))).otherwise(F.col("output"))
    return joined.withColumns({"output": output, "human_corrected": change, "original_verdict": F.when(change, now), "reviewer_notes": F.when(change, F.col("_c._n"))}).drop("_c")


def second_judge(rows: DataFrame, *, input_col: str = "input", key: str = "ordinal") -> DataFrame:
    """A stand-in judge: False if the claim is negated; confidence 0.7 to 0.95 from a hash, a tenth less for False."""
    claim = R.claim_of(F.col(input_col))
    unit = F.conv(F.substring(shuffled_key("judge", F.col(key)), 1, 6), 16, 10).cast("double") / float(16**6)
    base = F.lit(0.7).cast("double") + unit * F.lit(0.25).cast("double")
    bad = C.negated(claim)
    return rows.withColumns({"judge_claim": claim, "judge_verdict": F.when(bad, "False").otherwise("True"), "judge_confidence": F.when(bad, base * F.lit(0.9).cast("double")).otherwise(base)})


def agreement(rows: DataFrame) -> DataFrame:
    """The rows with `agrees`: whether the stated verdict and the second judge's are the same."""
    return rows.withColumn("agrees", F.when(C.verdict_exact(F.col("output")), "True").otherwise("False") == F.col("judge_verdict"))


# ---- aggregates ----------------------------------------------------------------------------


def count_by(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("n"))


def ratio_fixed(true: Column, false: Column) -> Column:
    """Smaller over larger class, zeros included; 0 of nothing."""
    return F.coalesce(F.try_divide(F.least(true, false).cast("double"), F.greatest(true, false)), F.lit(0.0))


def ratio_seen(counts: DataFrame, n: str = "n") -> DataFrame:
    """Smallest over largest observed class, so one class alone scores 1; 0 of nothing."""
    return counts.agg(F.coalesce(F.min(n).cast("double") / F.max(n), F.lit(0.0)).alias("balance_ratio"))


def percentages(df: DataFrame, col: str) -> DataFrame:
    """Count and percentage of each observed class."""
    n = df.groupBy(col).agg(F.count("*").alias("n"))
    return n.withColumn("percentage", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 6))


def targets(df: DataFrame, *, target: int, arabic: Column, true: Column, unknown: Column) -> DataFrame:
    """Percentages and which of the four targets are met; nothing is valid of no rows."""
    pct = lambda c: F.coalesce(F.try_divide(F.count_if(c) * 100.0, F.count("*")), F.lit(0.0))
    row = df.agg(F.count("*").alias("total"), pct(arabic).alias("arabic_percentage"), pct(true).alias("true_percentage"), pct(unknown).alias("unknown_percentage"))
    met = {"size_met": F.col("total") >= target, "arabic_met": F.col("arabic_percentage") >= 40, "verdict_met": F.col("true_percentage").between(47, 53), "reference_met": F.col("unknown_percentage") <= 10}
    row = row.withColumn("valid", F.col("total") > 0).withColumns(met)
    return row.withColumn("needs_rebalancing", F.col("valid") & ~reduce(operator.and_, [F.col(c) for c in met]))


def split_sizes(total: Column) -> Column:
    """Struct train, val, test of int(.8n), int(.1n), int(.1n), which need not add up."""
    part = lambda s: F.floor(total * F.lit(s).cast("double")).cast("bigint")
    return F.struct(part(0.8).alias("train"), part(0.1).alias("val"), part(0.1).alias("test"))


def collect_by_chunk(df: DataFrame, *, key: str = "chunk_id", order: str = "ordinal", cols: tuple[str, ...] = ("question", "answer")) -> DataFrame:
    """Each chunk's pairs in order; a missing chunk is 0."""
    row = F.struct(order, *cols)
    return df.groupBy(F.coalesce(F.col(key), F.lit(0)).alias(key)).agg(F.array_sort(F.collect_list(row)).alias("pairs"))


def issue_summary(df: DataFrame, issues: str = "issues", order: str = "ordinal", shown: int = 10) -> DataFrame:
    """Number of issues, the first `shown` in order, and how many more there are."""
    each = df.select(order, F.posexplode(issues).alias("_p", "issue"))
    first = each.orderBy(order, "_p").limit(shown).agg(F.array_sort(F.collect_list(F.struct(order, "_p", "issue"))).alias("_f")).select(F.transform("_f", lambda x: x["issue"]).alias("first"))
    return each.agg(F.count("*").alias("n_issues")).join(F.broadcast(first)).withColumn("more", F.greatest(F.col("n_issues") - shown, F.lit(0)))


# ---- balancing, splitting, sampling --------------------------------------------------------


def quota_head(df: DataFrame, *, strata: list[str], quota: int, order: str = "ordinal") -> DataFrame:
    """The first `quota` rows of each stratum in order."""
    return top_k(df, strata, [F.col(order)], quota)


def _strata_rank(df: DataFrame, strata: list[str], key: str, seed: int) -> DataFrame:
    """Random rank within the stratum (`rank`) and its size (`size`). A stratum may hold most rows, so it is ranked by hash ranges."""
    df = df.withColumn("_h", shuffled_key(seed, F.col(key))).withColumn("_b", F.substring("_h", 1, 3))
    ns = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\x00"))
    df = df.withColumn("_s", F.concat_ws("\x1f", *[ns(c) for c in strata]) if strata else F.lit(""))
    sizes = df.groupBy("_s", "_b").agg(F.count("*").alias("_n"))
    w = Window.partitionBy("_s")
    sizes = sizes.select("_s", "_b", (F.sum("_n").over(w.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"), F.sum("_n").over(w).alias("size"))
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy("_s", "_b").orderBy("_h", key)))
    return ranked.join(sizes, ["_s", "_b"]).withColumn("rank", F.col("_r") + F.col("_before")).drop("_h", "_b", "_s", "_r", "_before")


def scenario_cap(df: DataFrame, *, text_col: str = "instruction", key: str = "ordinal", share: float = 0.15, seed: int = 42, words: list[str] | None = None) -> DataFrame:
    """At most int(share * total) rows of each scenario, picked at random. Repeated runs shrink a set of one scenario."""
    ranked = _strata_rank(df.withColumn("scenario", C.scenario(F.col(text_col), words)), ["scenario"], key, seed)
    total = df.agg(F.floor(F.count("*") * F.lit(share).cast("double")).alias("_cap"))
    return ranked.join(F.broadcast(total)).where(F.col("rank") <= F.col("_cap")).drop("rank", "size", "_cap")


def balance_languages(df: DataFrame, *, lang: str = "language", order: str = "ordinal", most: int = 500, languages: tuple[str, str] = ("ar", "en")) -> DataFrame:
    """The first m rows of both languages, m the smaller count, `most` at most."""
    n = df.agg(*[F.count_if(F.col(lang) == x).alias(f"_{i}") for i, x in enumerate(languages)]).select(F.least("_0", "_1", F.lit(most)).alias("_m"))
    head = top_k(df.where(F.col(lang).isin(*languages)).withColumn("_o", F.col(order)), [lang], [F.col("_o")], most)
    w = Window.partitionBy(lang).orderBy("_o")
    return head.withColumn("_k", F.row_number().over(w)).join(F.broadcast(n)).where("_k <= _m").drop("_o", "_k", "_m")


def split(df: DataFrame, *, strata: tuple[str, ...] = (), key: str = "ordinal", seed: int = 42, val_from_train: bool = False) -> DataFrame:
    """The rows with `split` (train, val, test): cuts at int(.8n) and int(.9n) of each stratum in random order.

    val_from_train puts the second cut at train end + int(.1n) instead.
    """
    ranked = _strata_rank(df, list(strata), key, seed)
    n = F.col("size")
    first = F.floor(n * F.lit(0.8).cast("double"))
    second = first + F.floor(n * F.lit(0.1).cast("double")) if val_from_train else F.floor(n * F.lit(0.9).cast("double"))
    return ranked.withColumn("split", F.when(F.col("rank") <= first, "train").when(F.col("rank") <= second, "val").otherwise("test")).drop("rank", "size")


def review_uncertain(df: DataFrame, *, suspected: str = "suspected", key: str = "ordinal", seed: int = 42) -> DataFrame:
    """A sample of max(20, min(500, n // 20)) rows: half of it from suspected ones as far as they go, the rest from others."""
    size = df.agg(F.count("*").alias("n"), F.count_if(F.col(suspected)).alias("u")).select(F.greatest(F.lit(20), F.least(F.lit(500), F.floor(F.col("n") / 20))).alias("_size"), "u")
    size = size.withColumn("_u", F.least("u", F.floor(F.col("_size") / 2)))
    ranked = _strata_rank(df, [suspected], key, seed)
    quota = F.when(F.col(suspected), F.col("_u")).otherwise(F.col("_size") - F.col("_u"))
    return ranked.join(F.broadcast(size)).where(F.col("rank") <= quota).drop("rank", "size", "_size", "u", "_u")


def review_simple(df: DataFrame, *, key: str = "ordinal", seed: int = 42) -> DataFrame:
    """A sample of all of fewer than 20 rows, else of min(max(int(.05n), 1), min(200, n)), with sample_id from 0."""
    n = df.agg(F.count("*").alias("_n")).withColumn("_size", F.when(F.col("_n") < 20, F.col("_n")).otherwise(F.least(F.greatest(F.floor(F.col("_n") * F.lit(0.05).cast("double")), F.lit(1)), F.lit(200), F.col("_n"))))
    head = first_rows(df, key, 200, seed).withColumn("_h", shuffled_key(seed, F.col(key)))
    ranked = head.withColumn("sample_id", F.row_number().over(Window.orderBy("_h", key)) - 1)
    return ranked.join(F.broadcast(n)).where(F.col("sample_id") < F.col("_size")).drop("_h", "_n", "_size")


def limit_until(df: DataFrame, n: int, *, key: str = "ordinal", seed: int = 42) -> DataFrame:
    """The first n rows in random order."""
    return first_rows(df, key, n, seed)


def shuffle(df: DataFrame, *, key: str = "ordinal", seed: int = 42) -> DataFrame:
    """The rows with `position`, their place in random order from 1."""
    return rank_by_hash(df, key, seed, "position")


def rebalance(rows: DataFrame, corpus: DataFrame, *, target: int = 2000, seed: int = 42, letters: str | None = None, cut=lambda df: df) -> DataFrame:
    """Relabelled rows by quota, filled with negatives of shuffled correct rows, capped by scenario, trimmed to the target.

    rows: ordinal, instruction, input, output. Result: ordinal (negatives: less than 0), instruction,
    input, output, type, language, source, scenario. References in outputs with a context are fixed first.
    `cut` may store a frame and give it back: the relabelled rows are used twice, and the quota's three times.
    """
    letters = letters or T.ARABIC_LETTERS
    typed = rows.withColumns({"_ctx": R.context_of(F.col("instruction")), "_ref": R.reference_of(F.col("output"))})
    fixed = fix_references(typed.withColumn("_c", F.coalesce("_ctx", F.lit(""))), corpus, ref_col="_ref", context_col="_c")
    verdict = F.when(C.verdict_loose(F.col("output")), "correct").otherwise("incorrect")
    base = fixed.withColumns({"type": verdict, "language": C.lang_any(F.col("instruction"), letters), "source": F.lit("validated")})
    base = base.withColumn("output", F.when(F.col("_ctx").isNull(), F.col("output")).otherwise(R.rewrite_reference(F.col("output"), F.col("_ref"))))
    base = cut(base.select("ordinal", "instruction", "input", "output", "type", "language", "source"))
    quota = int(target * 0.45) // 2
    head = cut(quota_head(base, strata=["type", "language"], quota=quota))
    need = head.agg(F.greatest(F.lit(target) - F.count("*"), F.lit(0)).alias("_need"))
    # at most `target` negatives can be needed, so a top-n of the shuffled correct rows is enough
    pool = first_rows(base.where("type = 'correct'"), "ordinal", target, seed).withColumn("_k", F.row_number().over(Window.orderBy(shuffled_key(seed, F.col("ordinal")), "ordinal")))
    none = F.lit(None).cast("string")
    made = pool.join(F.broadcast(need)).where("_k <= _need").select((-F.col("ordinal") - 1).alias("ordinal"), R.make_negative(none, none, none, none).alias("m"))
    negatives = made.select("ordinal", "m.instruction", "m.input", "m.output", "m.meta.type", "m.meta.language", "m.meta.source")
    capped = cut(scenario_cap(head.unionByName(negatives), seed=seed))
    return first_rows(capped, "ordinal", target, seed)


def key_usage(calls: DataFrame, *, key: str = "key", failed: str = "failed", most: int = 3) -> DataFrame:
    """Calls and failed calls of each key of a call log, and whether it is blocked (at least `most` failures)."""
    per = calls.groupBy(key).agg(F.count("*").alias("calls"), F.count_if(F.col(failed)).alias("failures"))
    return per.withColumn("blocked", F.col("failures") >= most)
