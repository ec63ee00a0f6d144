"""Secret scans: pattern candidates, false positives removed by a random forest.

Native: DataFrame expressions and the JVM's forest only. Candidates are, in the parts of a text
between white space, runs of at least 12 key characters with a digit, and without any bound on
length or characters what follows an assignment to a word that names secrets, what begins with
a provider's prefix, and the password of a URL (`scheme://user:password@host`); besides, whole PEM
blocks of private keys. Nothing else is: neither passwords in prose without an assignment, nor keys spread over lines
outside PEM blocks, nor names of secrets in other languages.

Each candidate has features of its length, character classes and transitions between them, usual letter pairs, share
covered by dictionary words (a short fixed list, and the corpus's own frequent words), whether it
lies in a path, and words beside it that speak for or against a secret. The forest is trained on
labelled findings; `labelled_findings` makes `n` by rule where a site has none of its own. All patterns take
time in proportion to a part's length, however long it is.

Defined results: null and empty texts have no findings; a value found more than once in a text is
one finding with its number of occurrences, judged by the one that looks most like a secret; rows
that repeat a document give its findings once; extra columns are ignored or, in `redact`,
returned untouched; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if, let, row_key, space_words, stored

VALUE = r"[A-Za-z0-9_+/-]{12,}={0,2}"
DIGIT = "[0-9]"
#: Ends a value behind an assignment: a closing quote, or the next assignment of a list.
_ANY = r"((?:(?![\"'`](?:\W|$)|[&;,][\"']?[\w.-]+[\"']?[=:])\S)+)"
#: Words that speak for and against a secret, and a small dictionary; fixed lists.
FOR = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|apikey|access[_-]?key|private[_-]?key|auth|bearer|credential|client[_-]?secret|sig(nature)?)"
AGAINST = r"(?i)(commit|sha(1|256|512)?|md5|hash|checksum|digest|uuid|guid|version|revision|example|sample|dummy|placeholder|test|redacted|changeme|your)"
PROVIDER = r"^(-----BEGIN |AKIA|ASIA|gh[pousr]_|glpat-|xox[abprs]-|sk-|sk_live_|rk_live_|eyJ|AIza|SG\.|npm_|pypi-)"
PREFIXED = r"(?<![A-Za-z0-9])(?:AKIA|ASIA|gh[pousr]_|glpat-|xox[abprs]-|sk-|sk_live_|rk_live_|eyJ|AIza|SG\.|npm_|pypi-)[A-Za-z0-9_+/.-]+={0,2}"
_NAME = FOR + r"s?(?-i:(?![a-z]))[\w-]{0,40}[\"'`]?\]?"
_GLUE = r"(?:=>|:=|==?|:)"
_OPEN = r"[\"'`]?"
#: The group of the value in INSIDE.
LAST = FOR.count("(") - FOR.count("(?") + 1
INSIDE = _NAME + _GLUE + _OPEN + _ANY
#: What stands before a part whose start is a value, and before one that starts with the sign of assignment.
ASSIGNS, NAMES = _NAME + r"\s?" + _GLUE + r"$|(?:^|\s)[\"']?(?i:bearer)$", _NAME + "$"
MAY_NAME = FOR + r"[\w-]{0,40}[\"'`]?\]?\s{0,9}[=:]|(?i:bearer)\s"
USERINFO = r"[A-Za-z]://[^/\s:@]*:([^/\s@]+)@"
PEM_SIGN = "PRIVATE KEY-----"
PEM = r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[^-]+-----END [A-Z ]{0,30}PRIVATE KEY-----"
TEMPLATE = r"^(\$\{|\$\(|\$[A-Z_]+$|\{|%|<|\[|\*+$|[A-Za-z_][A-Za-z_.]*[(\[])"
PROSE = r"(?i)^(required|none|null|nil|true|false|yes|no|missing|invalid|wrong|unknown|empty|string|str|int|field|optional|the|a|an|is|are|of|and|in|on|to|for|your|my|see|this|that|it|as|not|basic|bearer|digest|oauth2?|redacted|hidden|unset|default|changeme|password|secret|token|user|admin|sk-learn|sk-ip|asian?|asia-[a-z]+)$"
DICTIONARY = r"(?i)(password|secret|token|example|sample|test|demo|user|admin|name|file|path|home|data|index|image|page|html|http|www|com|org|net|main|lib|src|bin|usr|var|log|config|default|value|key|public|private|document|version|the|and|ing|ion|ther|that|with|change|your|here|replace|insert)"
PAIRS = r"(?i)(th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|ed|is|it|al|ar|st|to|nt|ng|se|ha|as|ou|io|le|ve|co|me|de|hi|ri|ro|ic|ne|ea|ra|ce|li|ch|ll|be|ma|si|om|ur)"


def _share(value: Column, pattern: str) -> Column:
    """Share of the characters that matches of the pattern cover."""
    n = F.char_length(value)
    return (n - F.char_length(F.regexp_replace(value, pattern, ""))) / F.greatest(n, F.lit(1))


def _whole(value: Column) -> Column:
    """A pattern for the value where letters and digits neither precede nor follow it."""
    return F.concat(F.lit(r"(?<![A-Za-z0-9])\Q"), F.replace(value, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![A-Za-z0-9])"))


def _is_run(value: Column) -> Column:
    """Whether a value is long enough to be looked for inside words too."""
    return value.rlike(f"^{VALUE}$") & value.rlike(DIGIT)


def _values(part: Column, before: Column) -> Column:
    """All candidate values of a part."""
    trim = lambda v: F.rtrim(v, F.lit(",;.)]}>"))
    none = F.array().cast("array<string>")
    runs = F.filter(F.regexp_extract_all(part, F.lit(VALUE), 0), lambda v: v.rlike(DIGIT))
    inside = F.regexp_extract_all(part, F.lit(INSIDE), LAST)
    behind = F.when(before.rlike(ASSIGNS), F.array(F.regexp_extract(part, "^" + _OPEN + _ANY, 1))).when(before.rlike(NAMES) & part.rlike("^" + _GLUE), F.array(F.regexp_extract(part, "^" + _GLUE + _OPEN + _ANY, 1))).otherwise(none)
    named = F.transform(F.concat(inside, behind, F.regexp_extract_all(part, F.lit(PREFIXED), 0)), trim)
    found = F.array_distinct(F.filter(F.concat(runs, named, F.regexp_extract_all(part, F.lit(USERINFO), 1)), lambda v: v != ""))
    return F.when(part.startswith("-----BEGIN ") & part.contains(PEM_SIGN), F.array(part)).otherwise(found)


def frequent_words(docs: DataFrame, *, text_col: str = "text", n: int = 3000) -> tuple[str, ...]:
    """The n most frequent words of at least four letters a-z, ignoring case, of all texts; ties by word."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit("[a-z]{4,}"), 0)).alias("w"))
    top = words.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(n)
    return tuple(r["w"] for r in top.collect())


def _known(value: Column, words: tuple[str, ...]) -> Column:
    """Share of the characters in letter runs (cut before capitals) that are frequent words."""
    if not words:
        return F.lit(0.0)
    runs = F.filter(F.transform(F.regexp_extract_all(value, F.lit("[A-Z]?[a-z]{3,}|[A-Z]{4,}"), 0), F.lower), lambda w: w.isin(*words))
    return F.aggregate(runs, F.lit(0), lambda n, w: n + F.char_length(w)) / F.greatest(F.char_length(value), F.lit(1))


def features(value: Column, part: Column, near: Column, words: tuple[str, ...] = ()) -> dict[str, Column]:
    """Of a candidate, the part of the text that holds it, and what stands before it: two words and the part's head."""
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return {
        "length": F.char_length(value).cast("double"),
        "digits": _share(value, "[0-9]"),
        "uppers": _share(value, "[A-Z]"),
        "lowers": _share(value, "[a-z]"),
        "others": _share(value, "[^A-Za-z0-9]"),
        "hex": flag(value.rlike("^[0-9a-f]+$|^[0-9A-F]+$")),
        "transitions": F.regexp_count(value, F.lit("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]")) / F.greatest(F.char_length(value), F.lit(1)),
        "kinds": F.size(F.array_distinct(F.split(value, ""))) / F.greatest(F.char_length(value), F.lit(1)),
        "pairs": _share(value, PAIRS),
        "dictionary": _share(value, DICTIONARY),
        "words": _known(value, words),
        "path": flag(part.rlike(r"://|[A-Za-z0-9_.-]/[A-Za-z0-9_.-]+/|\\\\|\.(html?|png|jpe?g|pdf|py|java|js|css|txt|json)\b")),
        "near_for": flag(near.rlike(FOR)),
        "near_against": flag(near.rlike(AGAINST) | value.rlike("(?i)example|changeme|dummy|placeholder|xxxx|0{8}|12345678")),
        "assigned": flag(near.rlike(r"[=:]\s*[\"']?$")),
        "provider": flag(value.rlike(PROVIDER)),
        "named": flag(near.rlike(_NAME + r"\s?" + _GLUE + r"\s?[\"'`]?$")),
        "userinfo": flag(near.rlike(r"[A-Za-z]://[^/\s:@]*:$")),
        "template": flag(value.rlike(TEMPLATE)),
        "prose": flag(value.rlike(PROSE)),
    }


def candidates(docs: DataFrame, *, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A row for each candidate occurrence: `carry`, value, part, before (two parts), after, and
    start (0-based, of the value's first occurrence), length and occurrences of the value."""
    may = lambda x: (x.rlike(DIGIT) & x.rlike(VALUE)) | x.rlike(PREFIXED) | x.rlike(MAY_NAME) | x.rlike(USERINFO)
    near = lambda w, i: F.concat_ws(" ", F.get(w, i - 2), F.get(w, i - 1))
    hit = lambda w, x, i: may(x) | near(w, i).rlike(ASSIGNS) | (x.rlike("^[=:]") & near(w, i).rlike(NAMES))
    hits = lambda w: F.filter(
        F.transform(w, lambda x, i: F.when(hit(w, x, i), F.struct(x.alias("part"), near(w, i).alias("before"), F.get(w, i + 1).alias("after")))),
        lambda x: x.isNotNull(),
    )
    text, none = F.col("_text"), F.lit("")
    pem = text.contains(PEM_SIGN)
    blocks = F.when(pem, F.transform(F.regexp_extract_all(text, F.lit(PEM), 0), lambda x: F.struct(x.alias("part"), none.alias("before"), none.alias("after"))))
    parts = F.concat(let(space_words(F.when(pem, F.regexp_replace(text, PEM, " ")).otherwise(text)), hits), F.coalesce(blocks, F.array()))
    found = F.flatten(F.transform("_parts", lambda c: F.transform(_values(c["part"], c["before"]), lambda v: F.struct(v.alias("value"), c["part"].alias("part"), c["before"].alias("before"), c["after"].alias("after")))))

    def place(v: Column) -> Column:
        size, run = F.char_length(v), _is_run(v)
        times = F.when(~run, F.regexp_count(text, _whole(v))).otherwise((F.char_length(text) - F.char_length(F.replace(text, v, none))) / size).cast("long")
        first = F.when(run, F.instr(text, v) - 1).otherwise(F.char_length(F.element_at(F.split(text, _whole(v), 2), 1))).cast("long")
        return F.struct(first.alias("start"), size.cast("long").alias("length"), times.alias("occurrences"))

    rows = docs.select(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(carry)]).alias("_k"), F.col(text_col).alias("_text")).where(may(text) | pem)
    rows = rows.withColumn("_parts", parts).withColumn("_found", found).withColumn("_values", F.array_distinct(F.transform("_found", lambda x: x["value"])))
    # a text is searched once for each distinct value, and goes no further
    rows = rows.withColumn("_places", F.transform("_values", place))
    at = lambda x: F.element_at("_places", F.array_position("_values", x["value"]).cast("int"))
    # the outer form, as for the plain one the optimiser makes a filter that finds all candidates anew
    each = rows.select("_k", F.explode_outer(F.transform("_found", lambda x: F.struct(x.alias("x"), at(x).alias("at")))).alias("_c")).where("_c is not null")
    return each.select(*[F.col(f"_k.k{i}").alias(c) for i, c in enumerate(carry)], "_c.x.*", "_c.at.*")


@dataclass(frozen=True)
class Detector:
    """A trained forest and the corpus's words that its features use."""

    model: RandomForestClassificationModel
    words: tuple[str, ...] = ()


def labelled_findings(spark: SparkSession, n: int = 6000, seed: int = 11, words: tuple[str, ...] = ()) -> DataFrame:
    """n findings with a label (1: a secret), made by rule: value, part, before, after, label. Harmless names are made of `words`, too."""
    rows = spark.range(n, numPartitions=4)
    h = lambda k: F.sha2(F.concat_ws("-", F.lit(seed), F.lit(k), "id"), 512)
    pick = lambda k, words: F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod(F.xxhash64(F.lit(seed), F.lit(k), "id"), F.lit(len(words))) + 1).cast("int"))
    some = lambda k, lo, hi: (F.pmod(F.xxhash64(F.lit(seed), F.lit(k), "id"), F.lit(hi - lo + 1)) + lo).cast("int")
    b64 = F.translate(F.base64(F.unhex(h(1))), "+=\r\n", "_")
    upper = F.translate(F.upper(F.translate(F.base64(F.unhex(h(2))), "+/=\r\n", "AB")), "01", "XY")
    hexa, word = F.substr(h(3), F.lit(1), some(3, 16, 64)), pick(4, ["image", "document", "version", "chapter", "report", "backup", "release", "section", "summary", "harvest", "meeting"])
    text = pick(5, ["the", "of", "and", "that", "in", "was", "nd", "le", "der", "de"])
    name = pick(6, ["password", "passwd", "token", "secret", "api_key", "apikey", "access_key", "client_secret", "auth_token", "credential"])
    other = pick(7, ["commit", "sha256", "md5", "checksum", "uuid", "hash", "revision", "version", "digest"])
    glue = pick(8, ["=", ":", " = ", ": ", '="', ' = "'])
    if words:
        theirs = lambda k: pick(k, list(words))
        word, text = F.when(F.pmod(F.xxhash64(F.lit("own"), "id"), F.lit(3)) == 0, word).otherwise(theirs(47)), theirs(48)
    uuid = F.concat_ws("-", F.substr(h(9), F.lit(1), F.lit(8)), F.substr(h(9), F.lit(9), F.lit(4)), F.substr(h(9), F.lit(13), F.lit(4)), F.substr(h(9), F.lit(17), F.lit(4)), F.substr(h(9), F.lit(21), F.lit(12)))
    slug = F.concat_ws("-", pick(10, ["the", "new", "old", "my"]), word, pick(11, ["and", "for", "with"]), pick(12, ["house", "market", "river", "people"]), some(13, 1, 2030))
    kinds = [
        (F.concat(F.lit("AKIA"), F.substr(upper, F.lit(1), F.lit(16))), F.lit(""), F.lit(""), 1),
        (F.concat(pick(14, ["ghp_", "glpat-", "sk_live_", "AIza", "npm_"]), F.substr(F.translate(b64, "/", "a"), F.lit(1), some(15, 24, 40))), F.lit(""), F.lit(""), 1),
        (hexa, name, glue, 1),
        (F.substr(b64, F.lit(1), some(16, 20, 60)), name, glue, 1),
        (hexa, other, pick(17, ["", " ", ":", "="]), 0),
        (uuid, pick(18, ["uuid", "id", "", "ref"]), pick(19, ["", " ", "="]), 0),
        (slug, pick(20, ["", "see", "page"]), F.lit(""), 0),
        (F.concat(F.lit("usr/share/"), word, F.lit("/"), text, some(21, 1, 99), F.lit("/index")), F.lit(""), F.lit(""), 0),
        (F.concat(pick(22, ["changeme", "example", "your_password_", "dummy_token_", "placeholder"]), some(23, 1000, 99999)), name, glue, 0),
        (F.concat(word, F.lit("_"), text, F.lit("_"), some(24, 1, 2030)), F.lit(""), F.lit(""), 0),
        (F.concat(some(25, 2000, 2030), F.lit("-0"), some(26, 1, 9), F.lit("-1"), some(27, 0, 9), F.lit("T0"), some(28, 1, 9)), pick(29, ["date", "at", "on"]), F.lit(" "), 0),
        (F.concat(some(30, 100000, 999999), some(31, 100000, 999999)), pick(32, ["number", "phone", "order", "invoice"]), pick(33, [" ", ": "]), 0),
    ]
    letters = F.translate(F.substr(b64, F.lit(1), some(34, 8, 24)), "0123456789/", "qwzxkvjpbgM")
    signs = F.translate(F.substr(b64, F.lit(1), some(35, 8, 20)), "aeinrtAEO/", "!#$@^*!%&?")
    phrase = F.concat_ws("-", pick(36, ["correct", "purple", "seven", "quiet", "lamp"]), pick(37, ["horse", "tiger", "window", "apple"]), pick(38, ["battery", "cloud", "forest"]), pick(39, ["staple", "anchor", "violin"]))
    leet = F.concat(pick(40, ["Tr0ub4", "Hunt3r", "Dr4g0n", "Sunny", "p4ssw", "Qwert"]), F.translate(F.substr(h(1), F.lit(1), some(41, 2, 5)), "abc", "xRk"))
    kinds += [
        (F.substr(F.translate(b64, "/", "k"), F.lit(1), some(42, 6, 11)), name, glue, 1),
        (signs, name, glue, 1),
        (letters, name, glue, 1),
        (phrase, pick(43, ["passphrase", "password", "secret"]), glue, 1),
        (leet, name, glue, 1),
        (F.concat(F.lit("AKIA"), F.translate(F.substr(upper, F.lit(1), F.lit(16)), "23456789", "QRSTUVWX")), F.lit(""), F.lit(""), 1),
        (pick(44, ["required", "none", "null", "true", "false", "missing", "the", "your", "invalid", "a", "is", "string", "redacted"]), name, glue, 0),
        (pick(45, ["${SECRET}", "os.environ[", "getToken(", "%s", "{{", "$TOKEN", "<token", "*****", "config.get("]), name, glue, 0),
        (pick(46, ["ASIAN", "sk-learn", "ASIA-pacific", "sk-ip"]), F.lit(""), F.lit(""), 0),
        (F.when(F.pmod(F.xxhash64(F.lit("u"), "id"), F.lit(2)) == 0, leet).otherwise(letters), F.concat(pick(49, ["mysql", "postgres", "https", "amqp", "redis"]), F.lit("://"), pick(50, ["root", "app", "user", "admin", ""]), F.lit(":")), F.lit(""), 1),
        (F.concat(F.lit("-----BEGIN "), pick(51, ["", "RSA ", "EC ", "OPENSSH "]), F.lit("PRIVATE KEY-----\n"), b64, F.lit("\n-----END PRIVATE KEY-----")), F.lit(""), F.lit(""), 1),
        (F.concat(word, pick(52, ["_", "-", "/"]), text, pick(55, ["_", "-", "/"]), pick(53, ["2", "v1", "10", "2024", "a1"])), pick(54, ["", "see", "id"]), F.lit(""), 0),
    ]
    made = F.array(*[F.struct(v.cast("string").alias("value"), F.concat(a, g).alias("head"), F.lit(y).alias("label")) for v, a, g, y in kinds])
    rows = rows.select("id", text.alias("_t"), F.element_at(made, (F.pmod("id", F.lit(len(kinds))) + 1).cast("int")).alias("_m")).select("id", "_t", "_m.*")
    # what stands directly before the value belongs to its part, the rest to the words before
    tail = F.substring_index(F.col("head"), " ", -1)
    return rows.select("value", F.concat(tail, "value", F.when(tail.contains('"'), F.lit('"')).otherwise(F.lit(""))).alias("part"), F.concat_ws(" ", "_t", F.trim(F.expr("substring(head, 1, length(head) - length(substring_index(head, ' ', -1)))"))).alias("before"), F.col("_t").alias("after"), "label")


def _assembled(df: DataFrame, words: tuple[str, ...] = ()) -> DataFrame:
    # a column of its own, which features share
    df = df.withColumn("_near", F.concat_ws(" ", "before", F.element_at(F.split("part", _whole(F.col("value")), 2), 1)))
    made = features(F.col("value"), F.col("part"), F.col("_near"), words)
    made = {f"_f_{k}": v for k, v in made.items()}
    return VectorAssembler(inputCols=list(made), outputCol="_features").transform(df.withColumns(made))


def train(labelled: DataFrame, *, words: tuple[str, ...] = (), trees: int = 40, depth: int = 8, seed: int = 5) -> Detector:
    """A forest from labelled findings: value, part, before, after, label (0 or 1)."""
    rows = _assembled(labelled, words).select("_features", F.col("label").cast("double").alias("label"))
    return Detector(RandomForestClassifier(featuresCol="_features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.8).fit(rows), words)


def corpus_detector(docs: DataFrame, *, text_col: str = "text") -> Detector:
    """A forest trained on findings made by rule, with the frequent words of docs."""
    words = frequent_words(docs, text_col=text_col)
    return train(labelled_findings(docs.sparkSession, words=words), words=words)


def scan(docs: DataFrame, detector: Detector, *, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), threshold: float = 0.5) -> DataFrame:
    """Findings: `carry`, value, start, length, occurrences, score (0 to 1), is_secret.

    Only candidates are shuffled, to join equal values of a text.
    """
    found = candidates(docs, text_col=text_col, carry=carry)
    scored = detector.model.transform(_assembled(found, detector.words)).withColumn("score", vector_to_array("probability")[1])
    keys = [*carry, "value", "start", "length", "occurrences"]
    return scored.groupBy(*keys).agg(F.max("score").alias("score")).withColumn("is_secret", F.col("score") >= threshold)


def redact(docs: DataFrame, detector: Detector, *, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]", threshold: float = 0.5) -> DataFrame:
    """docs with every occurrence of a secret in the text replaced by the mask; nothing else changes."""
    names = docs.columns
    rows = row_key(docs.select(F.struct(*names).alias("_row"), F.col(id_col).alias("_i"), F.col(text_col).alias("_t")), "_i", "_t")
    found = scan(rows, detector, text_col="_t", carry=("_id", "_th"), threshold=threshold).where("is_secret")
    values = stored(found.groupBy("_id", "_th").agg(F.collect_set("value").alias("_values")), "secrets")
    longest = F.array_sort("_values", lambda a, b: F.char_length(b) - F.char_length(a))
    joined = rows.join(broadcast_if(values), ["_id", "_th"], "left")
    text = F.when(F.col("_values").isNull(), F.col("_t")).otherwise(F.aggregate(longest, F.col("_t"), lambda t, v: F.when(_is_run(v), F.replace(t, v, F.lit(mask))).otherwise(F.regexp_replace(t, _whole(v), F.lit(mask)))))
    return joined.withColumn("_t", text).select(*[F.col("_t").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in names])
