"""The queries of this subpackage and their SQL, for registration by the entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, filteraudit, htmltext, langid, mixing, neardup, packing, quality, secrets, suffixes, tokencount, urlfilter, vectorcodes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    names = F.sort_array(F.transform(F.array_compact("hit_items"), lambda x: x.cast("string")))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(F.array_compact("hit_items")).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.corpus_detector(docs))
    return found.select("doc_id", F.sha2("value", 256).alias("value_sha256"), "start", "length", "occurrences", F.round("score", 6).alias("score"), "is_secret")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)))
    model = langid.train(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return langid.identify(docs, model, carry=["doc_id", "held_out"], reject=False)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = filteraudit.masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filteraudit.audit(filteraudit.cells(masked))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vectorcodes.compress(table(spark, sf_dir, "embeddings"))
    code = F.lower(F.array_join(F.transform("codes", lambda c: F.lpad(F.hex(c), 2, "0")), ""))
    return vectorcodes.with_label_error(coded).select("vec_id", code.alias("code"), "error", "label_error", F.lit(vectorcodes.digest(books)).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_secret_scans": op3_secret_scans,
    "op4_language_id": op4_language_id,
    "op5_packing": op5_packing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_html_extraction": op7_html_extraction,
    "op8_quality_rules": op8_quality_rules,
    "op9_url_filters": op9_url_filters,
    "op10_token_counts": op10_token_counts,
    "op11_mixing": op11_mixing,
    "op12_filter_audit": op12_filter_audit,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES: dict[str, str] = {
    "op1_decontamination": r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
grams AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, sizes WHERE len(w) >= k),
occ AS (SELECT t.doc_id, t.s, t.k, win.item_id FROM grams t JOIN win ON win.k = t.k AND win.g = array_to_string(t.w[t.s : t.s + t.k - 1], ' ')),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM occ) GROUP BY 1),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM occ GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
""",
    "op2_near_duplicates": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[s : s + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
""",
    "op6_suffix_dedup": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
part AS (SELECT doc_id, o, substr(h, 2 * o + 1, 2 * (1000 + 399)) AS h FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) / 2 AS BIGINT) - 399, 1000)) AS o FROM d WHERE length(h) >= 800)),
win AS (SELECT doc_id, o + i AS s, md5(substr(h, 2 * i + 1, 800)) AS m FROM (SELECT doc_id, o, h, unnest(range(0, CAST(length(h) / 2 AS BIGINT) - 399)) AS i FROM part)),
hit AS (SELECT doc_id, s FROM win WHERE m IN (SELECT m FROM win GROUP BY m HAVING count(*) > 1)),
run AS (SELECT doc_id, s, sum(CASE WHEN s <= before + 400 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM hit)),
span AS (SELECT doc_id, min(s) AS a, max(s) + 400 AS b FROM run GROUP BY doc_id, r),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f FROM span),
cut AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * f + 1, 2 * (a - f)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS k FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(h) / 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
""",
    "op11_mixing": r"""
WITH d AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size, md5('17-' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
level AS (
  SELECT coalesce(sum(2 * size) OVER before, 0) AS stopped, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open, sum(size) OVER () AS words, size, w,
    row_number() OVER (ORDER BY 2 * size / w, source NULLS LAST) AS i
  FROM s WINDOW before AS (ORDER BY 2 * size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fit AS (SELECT stopped, open, words FROM level WHERE w * (3 * words - 2 * stopped) <= 2 * (2 * size) * open ORDER BY i LIMIT 1),
t AS (
  SELECT source, size AS source_size,
    CASE WHEN w * (3 * words - 2 * stopped) > 2 * (2 * size) * open THEN CAST(2 * size AS DOUBLE) ELSE w * CAST(3 * words - 2 * stopped AS DOUBLE) / CAST(2 * open AS DOUBLE) END AS target
  FROM s, fit),
x AS (SELECT doc_id, source, size, CAST(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS o FROM d)
SELECT doc_id, x.size, source_size, target,
  CAST(CAST(floor(target + 0.5) AS BIGINT) // greatest(source_size, 1) * x.size + greatest(0, least(x.size, CAST(floor(target + 0.5) AS BIGINT) % greatest(source_size, 1) - o)) AS BIGINT) AS taken
FROM x JOIN t ON x.source IS NOT DISTINCT FROM t.source
""",
    "op12_filter_audit": r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY 1),
fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * (length(d.t) - length(regexp_replace(d.t, '[A-Z]', '', 'g'))) > 3 * length(d.t),
     regexp_matches(d.t, '[#$%&*|]'), coalesce(doc_id > first, false)] AS f
  FROM d JOIN firsts ON d.t = firsts.t LEFT JOIN l USING (doc_id)),
cell AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM fails GROUP BY 1, 2),
x AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM x a, x b, x c, x d, x e
  WHERE a.i <> b.i AND a.i <> c.i AND a.i <> d.i AND a.i <> e.i AND b.i <> c.i AND b.i <> d.i AND b.i <> e.i AND c.i <> d.i AND c.i <> e.i AND d.i <> e.i),
run AS (
  SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, s.i AS step, o[s.i] AS k, f[o[s.i]] AS bad,
    len(list_filter(f, lambda y: y)) AS n_bad, len(list_filter(o[1 : s.i - 1], lambda i: f[i])) > 0 AS gone, n, n_good, n_toxic
  FROM cell, orders, x s),
steps AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, k,
    CAST(coalesce(sum(n) FILTER (NOT bad AND NOT gone), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (bad AND NOT gone), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (bad AND gone), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (bad AND n_bad = 1), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(n_good) FILTER (bad AND NOT gone), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(n_toxic) FILTER (bad AND NOT gone), 0) AS BIGINT) AS toxic_lost
  FROM run GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley
FROM steps
""",
    "op13_vector_codes": r"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT r, p AS part, e[p * len(e) // 16 + 1 : (p + 1) * len(e) // 16] AS c FROM kept, (SELECT unnest(range(16)) AS p)),
b0 AS (SELECT part, r - 1 AS entry, c FROM v WHERE r <= 64),
a0 AS (SELECT v.r, v.part, min(list_sum(list_transform(list_zip(v.c, b0.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + entry) AS k FROM v JOIN b0 USING (part) GROUP BY 1, 2),
b1 AS (SELECT part, entry, coalesce(m.c, b0.c) AS c FROM b0 LEFT JOIN (
    SELECT part, entry, list(CAST(floor(s / n) AS BIGINT) ORDER BY j) AS c FROM (
      SELECT part, k % 64 AS entry, j, sum(CAST(c[j] AS DOUBLE)) AS s, count(*) AS n FROM v JOIN a0 USING (r, part), (SELECT unnest(range(1, (SELECT max(len(c)) FROM v) + 1)) AS j) GROUP BY 1, 2, 3) GROUP BY 1, 2) m USING (part, entry)),
a1 AS (SELECT v.r, v.part, min(list_sum(list_transform(list_zip(v.c, b1.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + entry) AS k FROM v JOIN b1 USING (part) GROUP BY 1, 2),
b2 AS (SELECT part, entry, coalesce(m.c, b1.c) AS c FROM b1 LEFT JOIN (
    SELECT part, entry, list(CAST(floor(s / n) AS BIGINT) ORDER BY j) AS c FROM (
      SELECT part, k % 64 AS entry, j, sum(CAST(c[j] AS DOUBLE)) AS s, count(*) AS n FROM v JOIN a1 USING (r, part), (SELECT unnest(range(1, (SELECT max(len(c)) FROM v) + 1)) AS j) GROUP BY 1, 2, 3) GROUP BY 1, 2) m USING (part, entry)),
a2 AS (SELECT v.r, v.part, min(list_sum(list_transform(list_zip(v.c, b2.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + entry) AS k FROM v JOIN b2 USING (part) GROUP BY 1, 2),
coded AS (SELECT r, string_agg(lpad(lower(to_hex(k % 64)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(k // 64) AS BIGINT) AS error FROM a2 GROUP BY 1)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b2) AS codebooks_sha256
FROM coded JOIN kept USING (r)
""",
}
