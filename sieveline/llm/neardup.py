"""MinHash near-duplicates: banded candidates, sequential Bayesian verification, exact confirmation.

1. One pass over the texts gives each document's shingle set as a count, a 128-bit hash and a
   MinHash signature. Documents with equal sets are one class, known by its smallest id.
2. Signatures of classes are cut into bands; classes that agree on a band share a bucket. All
   members of a bucket are compared with its pivot, the smallest id: as many pairs as members.
3. A pair's signatures are compared in batches of `BATCH` hashes. After each batch the pair is
   given up if the posterior probability that its similarity reaches the threshold (uniform
   prior, so a beta distribution of the matches so far) is below `miss`. Survivors are confirmed
   on their full shingle sets. Links are joined to components.
4. Buckets whose members, without the pivot, still lie in several components are not done. A small
   one has its cross-component pairs compared like pivots. Large ones that share members are put
   together, so each member is there once; those outside the largest component are queries against
   all members. Members and queries are dealt into blocks of at most about `BLOCK` each, and each
   pair of blocks compares signatures, then full sets, in its own task; what comes out is one link
   from a query to each other component that it reaches. So no bucket has a cap, no pairs are
   written out, and a dense group, which its pivot has mostly joined, has few queries.

Defined results: null texts and texts without words have an empty set, no links, and are kept;
a text of fewer words than a shingle is one shingle; rows that share an id are one document with
the links of all; rows without id are linked with nothing and kept; extra columns are ignored or,
in `drop_near_duplicates`, returned untouched; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if, dropped, release, slim, stored

WIDTH = 5
PERCENT = 75
HASHES, ROWS = 128, 4
BATCH = 32
MISS = 1e-6
SMALL = 48
BLOCK = 2048
#: Most shingles in a block, about, and in the sets that a task keeps for its next pairs.
HEAVY, KEPT = 2_000_000, 200_000
MULTIPLIERS = np.random.default_rng(20240607).integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def normal_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str | None, width: int = WIDTH) -> set[bytes]:
    words = normal_words(text)
    if not words:
        return set()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    words = normal_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.uint64)
    ends = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = (np.arange(len(data)) - np.repeat(starts, ends - starts + 1)).astype(np.uint64)
    hashed = _mix(np.add.reduceat(_mix(data + (place << np.uint64(8)) + np.uint64(0x51ED270B)), starts))
    n = max(1, len(words) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(width, len(words))):
        out = _mix(out * np.uint64(0xD6E8FEB86659FD93) + hashed[k : k + n])
    return np.unique(out)


def signature(hashes: np.ndarray) -> bytes:
    """MinHash signature: 32-bit minima under HASHES multiplications."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 2048):
        np.minimum(low, (hashes[i : i + 2048, None] * MULTIPLIERS).min(0), out=low)
    return (low >> np.uint64(32)).astype("<u4").tobytes()


def least_matches(threshold: float, miss: float) -> dict[int, int]:
    """For each number of hashes compared, the fewest matches with which a pair goes on."""
    out = {}
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, -1
        while below < miss:  # P(Beta(m + 1, n - m + 1) >= t) = P(Binomial(n + 1, t) <= m)
            m += 1
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def bayes_alive(a: np.ndarray, b: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Mask of the pairs (rows of signatures) that sequential comparison doesn't give up."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for n, m in least.items():
        matches[alive] += (a[alive, n - BATCH : n] == b[alive, n - BATCH : n]).sum(1)
        alive = alive[matches[alive] >= m]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def document_sets(docs: DataFrame, *, id_col: str, text_col: str, width: int) -> DataFrame:
    """Stored table: node (the id), n_shingles, s1, s2 (hash of the set), sig."""

    @slim
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, s1, s2, sig = [], [], [], []
            for text in batch.column(1):
                h = shingle_hashes(text.as_py(), width)
                d = hashlib.blake2b(h.tobytes(), digest_size=16).digest()
                n.append(len(h))
                s1.append(int.from_bytes(d[:8], "little", signed=True))
                s2.append(int.from_bytes(d[8:], "little", signed=True))
                sig.append(signature(h) if len(h) else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(sig, pa.binary())], names=["node", "n_shingles", "s1", "s2", "sig"])

    return stored(docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "node long, n_shingles long, s1 long, s2 long, sig binary"), "sets")


def _bayes(pairs: DataFrame, sigs: DataFrame, least: dict[int, int]) -> DataFrame:
    @slim
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(-1, HASHES) for i in (2, 3))
                yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), names=["a", "b"]).filter(pa.array(bayes_alive(a, b, least)))

    left = sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
    right = sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long").distinct()


def _confirm(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""

    @slim
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple, set] = {}
        held = 0

        def of(node, text) -> set:
            nonlocal held
            key = (node, hash(text), len(text))
            if key not in kept:
                if held >= KEPT:
                    kept.clear()
                    held = 0
                kept[key] = shingle_set(text, width)
                held += len(kept[key])
            return kept[key]

        for batch in batches:
            good = []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = of(a, x), of(b, y)
                both = len(x & y)
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "near-ids")
    texts = stored(docs.join(broadcast_if(ids), "node"), "near-texts")
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    out = stored(pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct(), "links")
    dropped(ids, texts)
    return out


def components(edges: DataFrame) -> DataFrame:
    """Stored table node, comp (smallest node reachable; rows for nodes with a smaller one only) of edges a, b."""
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    while True:
        least = stored(edges.groupBy("hi").agg(F.min("lo").alias("p"), F.count("*").alias("n")), "least")
        # rounds end when each node has one edge, to a node without one
        more = least.where("n > 1").limit(1).count() or least.join(least.select(F.col("hi").alias("p")), "p", "left_semi").limit(1).count()
        if not more:
            dropped(edges)
            return least.select(F.col("hi").alias("node"), F.col("p").alias("comp"))
        near = edges.join(least.select("hi", "p"), "hi").select("p", F.explode(F.array("hi", "lo")).alias("hi")).where("hi <> p")
        up = least.select(F.col("hi").alias("p"), F.col("p").alias("pp"))
        following = stored(near.join(up, "p", "left").select("hi", F.coalesce("pp", "p").alias("lo")).distinct(), "edges")
        dropped(edges, least)
        edges = following


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored rows (key, node, comp, n) of the buckets whose members lie in several components."""
    placed = members.join(labels, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    keys = stored(placed.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.count("*").alias("n")).where("c1 <> c2").select("key", "n"), "mixed-keys")
    return stored(placed.join(broadcast_if(keys), "key"), "mixed")


def _block_links(sigs: list[bytes], sets: list[np.ndarray], comps: np.ndarray, query: np.ndarray, nodes: np.ndarray, least: dict[int, int], percent: int) -> list[tuple[int, int]]:
    """Links (query, member) of a block, one for each query and other component."""
    members = np.flatnonzero(~query)
    if not len(members):
        return []
    tokens, codes = np.unique(np.concatenate([sets[i] for i in members]), return_inverse=True)
    lens = np.array([len(sets[i]) for i in members])
    starts = np.concatenate([[0], lens.cumsum()[:-1]])
    signs = np.frombuffer(b"".join(sigs[i] for i in members), "<u4").reshape(-1, HASHES)
    out = []
    for q in np.flatnonzero(query):
        alive = bayes_alive(signs, np.broadcast_to(np.frombuffer(sigs[q], "<u4"), signs.shape), least) & (comps[members] != comps[q])
        if not alive.any():
            continue
        mine = np.zeros(len(tokens), bool)
        at = np.minimum(np.searchsorted(tokens, sets[q]), len(tokens) - 1)
        mine[at[tokens[at] == sets[q]]] = True
        both = np.add.reduceat(mine[codes], starts, dtype=np.int64)
        good = members[alive & (100 * both >= percent * (lens + len(sets[q]) - both))]
        _, first = np.unique(comps[good], return_index=True)
        out += [(int(nodes[q]), int(nodes[i])) for i in good[first]]
    return out


def _large(many: DataFrame, docs: DataFrame, sigs: DataFrame, least: dict[int, int], width: int, percent: int, block: int) -> DataFrame:
    """Stored links (a, b) between components within large mixed buckets (key, node, comp)."""
    heads = stored(many.groupBy("key").agg(F.min("node").alias("head")), "heads")
    joined = components(many.join(broadcast_if(heads), "key").select(F.col("node").alias("a"), F.col("head").alias("b")))
    nodes = many.select("node", "comp").distinct().join(joined.withColumnRenamed("comp", "area"), "node", "left").select("node", "comp", F.coalesce("area", "node").alias("area"))
    nodes = stored(nodes.join(sigs.select("node", "n_shingles"), "node"), "areas")
    # a member counts as one, or by its shingles where these are many
    weight = F.greatest(F.lit(1.0), F.col("n_shingles") * (block / HEAVY))
    sizes = nodes.groupBy("area", "comp").agg(F.sum(weight).alias("m"))
    sizes = stored(sizes.groupBy("area").agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), F.sum("m").alias("n"), (F.sum("m") - F.max("m")).alias("q"), F.count("*").alias("k")).where("k > 1").drop("k"), "area-sizes")
    parts = lambda c: F.ceil(F.greatest(F.col(c), F.lit(1.0)) / block).cast("int")
    placed = nodes.join(broadcast_if(sizes), "area").withColumns({"n": parts("n"), "q": parts("q")})
    mine = lambda c: F.pmod(F.xxhash64("node"), F.col(c)).cast("int")
    all_of = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    members = placed.select("node", "comp", "area", F.lit(False).alias("query"), mine("n").alias("mb"), all_of("q").alias("qb"))
    queries = placed.where("comp <> main").select("node", "comp", "area", F.lit(True).alias("query"), all_of("n").alias("mb"), mine("q").alias("qb"))

    @slim
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([shingle_hashes(t.as_py(), width).tobytes() for t in batch.column(2)], pa.binary())], names=["node", "sig", "hashes"])

    ids = broadcast_if(nodes.select("node"))
    facts = docs.join(ids, "node").join(sigs.join(ids, "node"), "node").select("node", "sig", "text").mapInArrow(cut, "node long, sig binary, hashes binary")
    facts = stored(facts, "dense-sets")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(b, np.uint64) for b in table["hashes"].to_pylist()]
        got = _block_links(table["sig"].to_pylist(), sets, table["comp"].to_numpy(), table["query"].to_numpy(zero_copy_only=False).astype(bool), table["node"].to_numpy(), least, percent)
        release()
        return pa.table({"a": pa.array([a for a, _ in got], pa.int64()), "b": pa.array([b for _, b in got], pa.int64())})

    blocks = members.unionByName(queries).join(facts, "node")
    return stored(blocks.groupBy("area", "mb", "qb").applyInArrow(compare, "a long, b long").distinct(), "dense-links")


def link_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, miss: float = MISS, small: int = SMALL, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(sets: node, n_shingles, s1, s2; classes: s1, s2, comp of the sets that aren't alone)."""
    named = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    sets = document_sets(docs, id_col=id_col, text_col=text_col, width=width)
    classes = sets.where("n_shingles > 0 and node is not null").groupBy("s1", "s2").agg(F.min("node").alias("node"), F.count("*").alias("n"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles"))
    classes = stored(classes, "classes")
    sigs = classes.select("node", "sig", "n_shingles")
    band = F.xxhash64("_b", F.substring("sig", 1, 4 * ROWS))
    bands = classes.select("node", F.posexplode(F.array(*[F.substring("sig", 1 + 4 * ROWS * k, 4 * ROWS) for k in range(HASHES // ROWS)])).alias("_b", "sig")).select(band.alias("key"), "node").distinct()
    bands = stored(bands, "bands")
    pivots = stored(bands.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where("n > 1").drop("n"), "pivots")
    members = bands.join(broadcast_if(pivots), "key").where("node <> pivot")
    members = stored(members, "members")
    dropped(bands, pivots)
    least = least_matches(percent / 100, miss)
    pairs = members.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    links = _confirm(stored(_bayes(pairs, sigs, least), "alive"), named, width, percent)
    labels = components(links)
    left = _mixed(members.select("key", "node"), labels)
    few, many = left.where(F.col("n") <= small), left.where(F.col("n") > small)
    across = (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.comp") != F.col("y.comp"))
    pairs = few.alias("x").join(few.alias("y"), across).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    alive = _bayes(stored(pairs.distinct(), "pairs"), sigs, least)
    if many.limit(1).count():
        alive = alive.unionByName(_large(many, named, sigs, least, width, percent, block)).distinct()
    links = links.unionByName(_confirm(stored(alive, "alive"), named, width, percent))
    labels = components(links)
    out = classes.join(labels, "node", "left").where("n > 1 or comp is not null").select("s1", "s2", F.coalesce("comp", "node").alias("comp"))
    return sets.select("node", "n_shingles", "s1", "s2"), stored(out, "linked")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """id_col, n_shingles, component_id (smallest id reachable) and kept for each row of docs."""
    sets, linked = link_components(docs, id_col=id_col, text_col=text_col, **options)
    out = sets.join(broadcast_if(linked), ["s1", "s2"], "left")
    comp = F.when(F.col("n_shingles") > 0, F.coalesce("comp", "node")).otherwise(F.col("node"))
    out = out.select("node", "n_shingles", comp.alias("component_id")).withColumn("component_id", F.when(F.col("node").isNotNull(), F.col("component_id")))
    return out.select(F.col("node").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("node") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that are kept, with all columns: one document of each component."""
    gone = stored(near_duplicates(docs, id_col=id_col, text_col=text_col, **options).where(~F.col("kept")).select(F.col(id_col).cast("long").alias("_gone")).distinct(), "gone")
    return docs.join(broadcast_if(gone), F.col(id_col).cast("long") == F.col("_gone"), "left_anti")
