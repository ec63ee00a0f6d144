"""URL filters: a ratio of character language models, below allow and block rules.

Native: DataFrame expressions only. Two variable-order Markov models of URL characters, one of
accepted and one of rejected URLs, are counted with one explode of character grams of orders 0
to `order` and one aggregation with map-side partial sums. Probabilities are Witten-Bell
interpolations down to a uniform floor, so an unseen context falls back to the next shorter one.
A URL's score is the difference of both log-likelihoods divided by its number of characters; it
is blocked if that is above the calibrated threshold.

Training URLs are those on which the rules decide, but for a quarter of them, dealt out by a hash,
which calibrates: of thresholds that block at most `false_block` of its accepted URLs, the one with
the least mean of both error rates, in the middle between the scores on both sides of it. Rates come from counts of scores in fixed bins. With fewer than `min_held` such URLs of
either kind nothing can be calibrated, and URLs without a rule are allowed.

The models read the whole URL; host and path are for the rules only.

Defined results: a null URL or one without `://` has an empty host and path, and no rule fits it; a
null or empty URL scores 0 and is allowed. Repeated rows are judged alike. Without training URLs of both kinds every URL
without a rule is allowed. Extra columns are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, broadcast_if, stored

#: (host, path prefix, verdict)
DEFAULT_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]
ALPHABET = 256
END = "\x03"
START = "\x02"
SCORE_BINS = 100
FALSE_BLOCK = 0.05
MIN_HELD = 20
#: Of so many training URLs one calibrates.
HELD = 4


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ://."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def match_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none does.

    Rules are a configured list, so they become one expression. Longest counts the characters of
    host and path; of equally long rules the first in the list wins.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _grams(text: Column, order: int) -> Column:
    """Array of structs (k, ctx, ch) of each character with its contexts of 0 to order characters."""
    padded = F.concat(F.lit(START * order), text, F.lit(END))
    n = F.char_length(text) + 1
    return F.flatten(
        F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.array(*[F.struct(F.lit(k).alias("k"), F.substr(padded, i + (order - k), F.lit(k)).alias("ctx"), F.substr(padded, i + order, F.lit(1)).alias("ch")) for k in range(order + 1)]),
        )
    )


def train(labelled: DataFrame, *, text_col: str, label_col: str, order: int = 3) -> DataFrame:
    """Counts of both models as a stored table: k, ctx, ch, na, nr (count of the gram), ca, cr (of
    its context), ta, tr (kinds of characters after its context). label_col: true for rejected."""
    grams = labelled.select(F.col(label_col).alias("_y"), F.explode(_grams(F.col(text_col), order)).alias("g")).select("_y", "g.*")
    counts = grams.groupBy("k", "ctx", "ch").agg(F.count_if(~F.col("_y")).alias("na"), F.count_if(F.col("_y")).alias("nr"))
    w = Window.partitionBy("k", "ctx")
    return stored(counts.withColumns({"ca": F.sum("na").over(w), "cr": F.sum("nr").over(w), "ta": F.count_if(F.col("na") > 0).over(w), "tr": F.count_if(F.col("nr") > 0).over(w)}), "url-model")


def score(urls: DataFrame, model: DataFrame, *, key_col: str, text_col: str, order: int = 3) -> DataFrame:
    """key_col and score: log-likelihood under the rejected model less that under the accepted one, a character.

    Keys must be unique. The model's size is bounded by the alphabet and order, and is checked
    before it is broadcast. URLs are dealt out by key before they are cut into grams, so that all
    tasks share the work and the grams themselves aren't shuffled.
    """
    urls = urls.repartition(int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions")), key_col)
    contexts = model.groupBy("k", "ctx").agg(*[F.max(c).alias(c) for c in ("ca", "cr", "ta", "tr")])
    contexts = broadcast_if(stored(contexts, "url-contexts"))
    grams = broadcast_if(model.select("k", "ctx", "ch", "na", "nr"))
    rows = urls.select(key_col, F.posexplode(_grams(F.col(text_col), order)).alias("_p", "_s")).select(key_col, (F.col("_p") / (order + 1)).cast("int").alias("_i"), "_s.*")
    rows = rows.join(grams, ["k", "ctx", "ch"], "left").join(contexts, ["k", "ctx"], "left").fillna(0, ["na", "nr", "ca", "cr", "ta", "tr"])
    wide = rows.groupBy(key_col, "_i").agg(*[F.max(F.when(F.col("k") == k, F.col(c))).alias(f"{c}{k}") for k in range(order + 1) for c in ("na", "nr", "ca", "cr", "ta", "tr")])
    logs = []
    for s in "ar":
        p = F.lit(1.0 / ALPHABET)
        for k in range(order + 1):
            n, c, t = (F.col(f"{x}{s}{k}") for x in "nct")
            wide = wide.withColumn(f"_p{s}{k}", F.when(c > 0, (n + t * p) / (c + t)).otherwise(p))
            p = F.col(f"_p{s}{k}")
        logs.append(F.log(p))
    return wide.select(key_col, (logs[1] - logs[0]).alias("_l")).groupBy(key_col).agg(F.avg("_l").alias("score"))


class Calibration(NamedTuple):
    """Threshold, and of the calibrating URLs how many there were and which shares it judges wrongly."""

    threshold: float
    accepted: int
    rejected: int
    false_block: float
    missed: float


def calibrate(scored: DataFrame, *, score_col: str = "score", label_col: str, false_block: float = FALSE_BLOCK, min_held: int = MIN_HELD) -> Calibration:
    """The threshold above which a URL is blocked; infinite without enough rows of both labels."""
    bins = scored.groupBy(F.round(F.least(F.greatest(F.col(score_col), F.lit(-50.0)), F.lit(50.0)) * SCORE_BINS).cast("long").alias("b")).agg(
        F.count_if(F.col(label_col)).alias("r"), F.count_if(~F.col(label_col)).alias("a")
    )
    up, all_rows = Window.orderBy("b"), Window.partitionBy()
    best = (
        bins.withColumns({"below_r": F.sum("r").over(up), "below_a": F.sum("a").over(up), "all_r": F.sum("r").over(all_rows), "all_a": F.sum("a").over(all_rows)})
        .where((F.col("all_r") >= min_held) & (F.col("all_a") >= min_held))
        .withColumns({"missed": F.col("below_r") / F.col("all_r"), "wrong": (F.col("all_a") - F.col("below_a")) / F.col("all_a")})
        .where(F.col("wrong") <= false_block)
        .orderBy(F.col("missed") + F.col("wrong"), F.desc("b"))
        .limit(1)
        .collect()
    )
    if not best:
        return Calibration(math.inf, 0, 0, 0.0, 1.0)
    nearest = bins.where(F.col("b") > best[0]["b"]).agg(F.min("b")).first()[0]
    middle = (best[0]["b"] + (best[0]["b"] + 1 if nearest is None else nearest)) / 2
    return Calibration(middle / SCORE_BINS, best[0]["all_a"], best[0]["all_r"], best[0]["wrong"], best[0]["missed"])


def judge_urls(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str, str]] | None = None, order: int = 3) -> DataFrame:
    """id_col, host, path, rule, verdict and score for each row of pages."""
    host, path = url_parts(F.col(url_col))
    rules = DEFAULT_RULES if rules is None else rules
    parts = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), F.coalesce(F.col(url_col), F.lit("")).alias("_text")).withColumn("_rule", match_rule(F.col("host"), F.col("path"), rules))
    parts = stored(parts.select(id_col, "host", "path", "_rule.rule", F.col("_rule.verdict").alias("_ruled"), "_text"), "url-parts")
    # each distinct text is scored once, however many rows repeat it
    texts = stored(parts.groupBy("_text").agg(F.max("_ruled").alias("_ruled"), F.count("*").alias("_n")), "url-texts")
    known = texts.where("_ruled is not null and _text <> ''").select("_text", (F.col("_ruled") == "block").alias("_y"))
    held = F.pmod(F.xxhash64(F.lit(5), "_text"), F.lit(HELD)) == 0
    model = train(known.where(~held), text_col="_text", label_col="_y", order=order)
    scored = stored(score(texts, model, key_col="_text", text_col="_text", order=order), "url-scores")
    threshold = calibrate(scored.join(known.where(held), "_text"), label_col="_y").threshold
    out = parts.join(scored, "_text", "left").withColumn("score", F.when(F.col("_text") == "", F.lit(0.0)).otherwise(F.coalesce("score", F.lit(0.0))))
    blocked = (F.col("score") > threshold) & (F.col("_text") != "")
    return out.select(id_col, "host", "path", "rule", F.coalesce(F.col("_ruled"), F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "score")
