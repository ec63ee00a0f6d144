"""Language identification: averaged hashed subword embeddings and a linear softmax.

Features are character bigrams and trigrams of the lower-cased letters, hashed into `BUCKETS`
rows of an embedding table; a text is the average of its rows, classified by a linear softmax.
Both are trained by stochastic gradient descent in numpy on the driver, on pieces of a bounded
sample of labelled rows (`per_lang` documents a language on average, and at most an equal share of
`max_docs`, picked by a hash of the text; the 1000 most frequent languages, others are never predicted). As the classifier is linear, the trained tables are multiplied once, and a
text's score is the average of one row of class scores for each subword; texts of any length are
read whole, in slices.

Bounds of the sample are parameters: `per_lang`, `max_docs`, 1000 languages, `max_chars` characters
of a document (from a place picked by a hash), and `max_pieces` pieces; predictions read all.

Calibration: a tenth of the sampled documents is kept from training; it sets the temperature of
the softmax and the score below which a prediction is rejected, so that accepted ones reach
`target` accuracy. The temperature minimises the cross-entropy against smoothed labels, in which
each of n documents counts as right with (n + 1) / (n + 2) only: n documents without an error
don't show that there are none. `Model.reliability` tells how far scores and accuracy lie apart.

Defined results: null texts and texts without a letter are `und` with score 0; without any
labelled row every text is `und`; repeated rows are predicted alike; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slim

BUCKETS = 1 << 15
DIM = 8
SLICE = 1 << 17
NOT_LETTERS = re.compile(r"[\W\d_]+")
UNKNOWN = "und"


def letters(text: str | None) -> str:
    """Lower-cased letters with single spaces around words; empty if there is none."""
    out = NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return f" {out} " if out else ""


def grams(text: str, n: int) -> np.ndarray:
    """Bucket of each bigram and trigram that starts within the first n characters."""
    a = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    mix = np.uint32(2654435761)
    two = (a[:-1] * mix) ^ (a[1:] * np.uint32(40503))
    three = (two[:-1] * np.uint32(2246822519)) ^ (a[2:] * np.uint32(3266489917))
    both = np.concatenate([two[:n] * mix, three[:n] * mix])
    return (both >> np.uint32(17)).astype(np.int32)


def slices(text: str) -> Iterator[np.ndarray]:
    """grams() of a whole text, in slices."""
    for i in range(0, max(len(text) - 1, 1), SLICE):
        if len(part := text[i : i + SLICE + 2]) > 1:
            yield grams(part, SLICE)


class Model:
    """langs, table (a row of class scores for each bucket), bias, temperature, and the rejection score."""

    #: Of the calibrating documents: their number, accuracy, mean score, and expected calibration error over ten bins.
    reliability: dict[str, float] = {}

    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray, temperature: float = 1.0, reject: float = 0.0):
        self.langs, self.columns, self.bias, self.temperature, self.reject = langs, [np.ascontiguousarray(c) for c in table.T], bias, temperature, reject

    def logits(self, text: str) -> np.ndarray | None:
        """None if the text has no letter."""
        sums, n = np.zeros(len(self.langs)), 0
        for ids in slices(letters(text)):
            n += len(ids)
            for k, c in enumerate(self.columns):
                sums[k] += c.take(ids).sum(dtype=np.float64)
        return sums / n + self.bias if n else None

    def predict(self, text: str) -> tuple[str, float]:
        z = self.logits(text) if self.langs else None
        if z is None:
            return UNKNOWN, 0.0
        p = np.exp((z - z.max()) / self.temperature)
        k = int(p.argmax())
        return self.langs[k], float(p[k] / p.sum())


def fit(rows: list[tuple[str, str]], *, piece: int = 300, epochs: int = 3, batch: int = 64, rate: float = 20.0, seed: int = 1, target: float = 0.995, max_pieces: int = 40_000) -> Model:
    """A model from (text, lang) rows; every tenth of them calibrates it."""
    langs = sorted({y for _, y in rows})
    if not langs:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    index, rng = {y: k for k, y in enumerate(langs)}, np.random.default_rng(seed)
    held = [r for i, r in enumerate(rows) if i % 10 == 9]
    parts = []
    for text, lang in (r for i, r in enumerate(rows) if i % 10 != 9):
        t = letters(text)
        parts += [(t[i : i + piece], index[lang]) for i in range(0, len(t), piece) if len(t) - i > 8 or i == 0 and len(t) > 1]
    parts = [parts[i] for i in rng.permutation(len(parts))[:max_pieces]]
    ids = [grams(t, piece) for t, _ in parts]
    ys = np.array([y for _, y in parts], np.int64)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM))
    out, bias = rng.normal(0, 0.1, (DIM, len(langs))), np.zeros(len(langs))
    steps, done = max(1, epochs * -(-len(parts) // batch)), 0
    for _ in range(epochs):
        order = rng.permutation(len(parts))
        for lo in range(0, len(order), batch):
            pick = order[lo : lo + batch]
            flat, lens = np.concatenate([ids[i] for i in pick]), np.array([len(ids[i]) for i in pick])
            x = np.add.reduceat(emb[flat], np.concatenate([[0], lens.cumsum()[:-1]])) / lens[:, None]
            z = x @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), ys[pick]] -= 1
            p /= len(pick)
            step = rate * (1 - done / steps)
            back = np.repeat((p @ out.T) / lens[:, None], lens, axis=0)
            for d in range(DIM):
                emb[:, d] -= 10 * step * np.bincount(flat, weights=back[:, d], minlength=BUCKETS)
            out -= step * 0.1 * (x.T @ p)
            bias -= step * 0.01 * p.sum(0)
            done += 1
    model = Model(langs, (emb @ out).astype(np.float32), bias)
    scored = [(z, index[y]) for t, y in held if (z := model.logits(t)) is not None]
    if scored:
        z, y = np.array([s[0] for s in scored]), np.array([s[1] for s in scored])

        def softmax(t: float) -> np.ndarray:
            p = np.exp((z - z.max(1, keepdims=True)) / t)
            return p / p.sum(1, keepdims=True)

        spare = 1 / (len(y) + 2)
        wanted = np.full(z.shape, spare / max(len(langs) - 1, 1))
        wanted[np.arange(len(y)), y] = 1 - spare
        model.temperature = float(min(np.geomspace(0.05, 50, 120), key=lambda t: -(wanted * np.log(softmax(t) + 1e-12)).sum(1).mean()))
        p = softmax(model.temperature)
        best, right = p.max(1), p.argmax(1) == y
        order = np.argsort(-best)
        good = np.cumsum(right[order]) / np.arange(1, len(y) + 1) >= target
        bins = np.minimum((best * 10).astype(int), 9)
        error = sum(abs(best[bins == k].mean() - right[bins == k].mean()) * (bins == k).mean() for k in np.unique(bins))
        model.reliability = {"documents": len(y), "accuracy": float(right.mean()), "mean_score": float(best.mean()), "calibration_error": float(error)}
        model.reject = float(best[order][np.nonzero(good)[0][-1]]) if good.any() else 1.0
    return model


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", per_lang: int = 500, max_docs: int = 6000, max_chars: int = 6000, **options) -> Model:
    """A model from a sample of docs: rows with a text and a language."""
    known = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    share = known.groupBy("lang").agg((per_lang / F.count("*")).alias("share"))
    at = F.pmod(F.xxhash64(F.lit(7), "text"), F.lit(1 << 30))
    sample = known.join(F.broadcast(share.orderBy("share").limit(1000)), "lang").withColumn("at", at).where(F.col("at") < F.col("share") * (1 << 30))
    quota = max(1, max_docs // max(1, min(1000, share.count())))
    ranked = sample.withColumn("_r", F.row_number().over(Window.partitionBy("lang").orderBy("at", "text"))).where(F.col("_r") <= quota)
    place = (F.pmod(F.xxhash64(F.lit(8), "text"), F.greatest(F.char_length("text") - max_chars + 1, F.lit(1))) + 1).cast("int")
    rows = ranked.orderBy("at", "lang", "text").select(F.substr("text", place, F.lit(max_chars)).alias("text"), "lang").collect()
    return fit([(r["text"], r["lang"]) for r in rows], **options)


def identify(docs: DataFrame, model: Model, *, text_col: str = "text", carry: list[Column | str] = ("doc_id",), reject: bool = True) -> DataFrame:
    """The `carry` columns, lang_pred, score (0 to 1) and rejected. With `reject` a rejected text is `und`."""
    rows = docs.select(*carry, F.col(text_col).alias("_text"))
    names = rows.columns[:-1]
    there = docs.sparkSession.sparkContext.broadcast(model)  # bounded: buckets x languages

    @slim
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = there.value
        for batch in batches:
            got = [m.predict(t.as_py()) for t in batch.column(len(names))]
            bad = [y == UNKNOWN or s < m.reject for y, s in got]
            lang = [UNKNOWN if reject and b else y for (y, _), b in zip(got, bad, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lang, pa.string()), pa.array([s for _, s in got], pa.float64()), pa.array(bad, pa.bool_())], names=[*names, "lang_pred", "score", "rejected"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double, rejected boolean")
