"""Suffix-array deduplication: a distributed merge sort that knows common prefixes.

A byte goes if a string of `length` bytes that covers it also starts anywhere else.

1. Equal texts are one class; a copied text goes whole and stays as a partner for the others.
2. Each window of `length` bytes has an anchor: the start of the least hash among its
   `length / 2`-byte strings. Equal windows have equal anchors at equal offsets, so only suffixes
   that start at anchors need sorting. A record is an anchor with its context: all bytes of the
   windows that it anchors. Anchors whose string is unique drop out; equal contexts are counted
   before the shuffle, and if there are two or more, all their windows repeat.
3. One owner of each distinct context is left to sort. Each task sorts its records by the bytes
   from the anchor on and cuts them into runs, front-coded: the length of the prefix shared with
   the record before, and the rest. Runs are exchanged by a hash of the anchor's string, so equal
   prefixes meet, and merged with a loser tree that compares two records by their known common
   prefixes with the last one put out, and reads bytes only behind equal ones.
4. In the merged order, records with a common prefix of at least half a window are neighbours.
   Window sizes on the right follow from neighbouring common prefixes, on the left from a sort of
   the bytes before the anchor; together they give the windows that occur twice.

A string that k distinct contexts share, k more than `hot`, is merged in ceil(k / hot) ways, each for
a range of offsets of the anchor in the window. The windows of a range have more bytes in common than
the anchor's string, so their records are exchanged by a digest of all these bytes, up to whole
windows; the merge is the same.

Defined results: null and empty texts have 0 bytes; texts shorter than a window lose nothing;
repeated rows are copies of each other; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, broadcast_if, dropped, release, slim, stored

LENGTH = 400
SLICE = 1 << 16
BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
RUN_BYTES = 48 << 20
HOT = 100_000


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    x = 1
    for i in range(n):
        out[i] = x
        x = x * base & (2**64 - 1)
    return out


_tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _rolling(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of the base, of its inverse, and a random value for each byte."""
    if n not in _tables:
        base = int(BASE)
        _tables[n] = (_powers(n, base), _powers(n, pow(base, -1, 2**64)), np.random.default_rng(97).integers(1, 2**63, 256, dtype=np.uint64))
    return _tables[n]


def anchors(data: bytes, length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays (hash of the anchor's string, anchor, first window start, last window start), in slices."""
    k = length // 2
    w = length - k + 1
    room = SLICE + length
    powers, inverse, values = _rolling(room + 1)
    whole = np.frombuffer(data, np.uint8)
    for base in range(0, len(data) - length + 1, SLICE):
        part = whole[base : base + SLICE + length - 1]
        n = len(part)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[part] * powers[:n], out=sums[1:])
        h = (sums[k:] - sums[: n - k + 1]) * inverse[: n - k + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        low = np.uint64((1 << 18) - 1)
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while span < w:  # least over windows of `span` starts, doubled up to w
            step = min(span, w - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.concatenate([first[1:] - 1, [len(least) - 1]])
        at = (least[first] & low).astype(np.int64)
        yield h[at].view(np.int64), at + base, first + base, last + base


def shared(x: bytes, y: bytes, known: int = 0) -> int:
    """Length of the common prefix of x and y, of which `known` bytes are known."""
    n = min(len(x), len(y))
    if x[known:n] == y[known:n]:
        return n
    a, b = int.from_bytes(x[known:n], "big"), int.from_bytes(y[known:n], "big")
    return n - ((a ^ b).bit_length() + 7) // 8


def front_code(records: list[tuple[bytes, bytes]]) -> list[tuple[int, bytes, bytes]]:
    """Sorted (key, rest) records as (bytes shared with the key before, the key's other bytes, rest)."""
    out, before = [], b""
    for key, rest in records:
        n = shared(before, key)
        out.append((n, key[n:], rest))
        before = key
    return out


def decoded(run: Iterable[tuple[int, bytes, bytes]]) -> Iterator[tuple[int, bytes, bytes]]:
    """(bytes shared with the key before, key, rest) of a front-coded run."""
    key = b""
    for n, tail, rest in run:
        key = key[:n] + tail
        yield n, key, rest


class LoserTree:
    """Merges front-coded runs. Each contender carries its common prefix with the last key put out."""

    def __init__(self, runs: list[Iterable[tuple[int, bytes, bytes]]]):
        self.runs = [decoded(r) for r in runs]
        self.size = 1
        while self.size < len(self.runs):
            self.size *= 2
        self.now: list = [next(r, None) for r in self.runs] + [None] * (self.size - len(self.runs))
        self.lcp = [0] * self.size  # with the last key put out
        self.loser = [-1] * self.size
        self.winner = self._build(1)
        self.compared = 0  # bytes that comparisons began behind

    def _beats(self, a: int, b: int) -> bool:
        """Whether contender a comes before b. The loser's common prefix is then the one with the winner."""
        x, y = self.now[a], self.now[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        if self.lcp[a] != self.lcp[b]:
            return self.lcp[a] > self.lcp[b]
        known = self.lcp[a]
        n = shared(x[1], y[1], known)
        kx, ky = x[1], y[1]
        first = (n == len(kx) and (n < len(ky) or a < b)) or (n < len(kx) and n < len(ky) and kx[n] < ky[n])
        self.lcp[b if first else a] = n
        return first

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._build(2 * node), self._build(2 * node + 1)
        win, lose = (a, b) if self._beats(a, b) else (b, a)
        self.loser[node] = lose
        return win

    def __iter__(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(bytes shared with the key put out before, key, rest) in order."""
        at = self.winner
        while (item := self.now[at]) is not None:
            yield self.lcp[at], item[1], item[2]
            self.now[at] = following = next(self.runs[at], None) if at < len(self.runs) else None
            # its run's own front coding is the common prefix with what was put out
            self.lcp[at] = following[0] if following else 0
            node = (at + self.size) // 2
            while node:
                other = self.loser[node]
                if self._beats(other, at):
                    self.loser[node], at = at, other
                node //= 2


def _common(strings: list[bytes]) -> np.ndarray:
    """Common prefix of each string with the next, for sorted strings."""
    return np.array([shared(a, b) for a, b in zip(strings, strings[1:])], np.int64)


def repeated_windows(rights: list[bytes], lcps: np.ndarray, lefts: list[bytes], low: np.ndarray, high: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each record of a cluster the least and greatest offset d of a window that another record repeats; -1 if none.

    rights are sorted, lcps[i] is common to rights i and i + 1; lefts hold the bytes before the
    anchor, nearest first; offsets d of a record's windows go from low to high.
    """
    c = len(rights)
    order = sorted(range(c), key=lefts.__getitem__)
    left = _common([lefts[i] for i in order])
    least, most = np.full(c, -1, np.int64), np.full(c, -1, np.int64)
    if c <= 24:
        r = np.full((c, c), length, np.int64)
        m = np.full((c, c), length, np.int64)
        for i in range(c - 1):
            r[i, i + 1 :] = np.minimum.accumulate(lcps[i:])
            m[i, i + 1 :] = np.minimum.accumulate(left[i:])
        r, m = np.minimum(r, r.T), np.minimum(m, m.T)
        place = np.empty(c, np.int64)
        place[order] = np.arange(c)
        m = m[np.ix_(place, place)]
        lo = np.maximum(np.maximum(low[:, None], low[None, :]), length - r)
        hi = np.minimum(np.minimum(high[:, None], high[None, :]), m)
        ok = lo <= hi
        np.fill_diagonal(ok, False)
        some = ok.any(1)
        least[some] = np.where(ok, lo, length).min(1)[some]
        most[some] = np.where(ok, hi, -1).max(1)[some]
        return least, most
    by_left = np.empty(c, np.int64)
    for d in range(int(low.min()), int(high.max()) + 1):
        right_class = np.concatenate([[0], np.cumsum(lcps < length - d)])
        by_left[order] = np.concatenate([[0], np.cumsum(left < d)])
        there = np.flatnonzero((low <= d) & (d <= high))
        _, which, n = np.unique(right_class[there] * c + by_left[there], return_inverse=True, return_counts=True)
        hit = there[n[which] > 1]
        least[hit] = np.where(least[hit] < 0, d, least[hit])
        most[hit] = d
    return least, most


_A = "_t1 long, _t2 long, f long, at long, lo long, hi long, c1 long, c2 long"


def _digest(data: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    names = [x.split()[0] for x in _A.split(", ")]

    @slim
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in names]

            def flush() -> pa.RecordBatch:
                out = pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in cols], names=names)
                for c in cols:
                    c.clear()
                return out

            total = 0
            for t1, t2, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                for f, at, lo, hi in anchors(data, length):
                    # the context with the anchor's place in it
                    hashed = np.array([_digest(data[i : j + length] + (a - i).to_bytes(4, "little")) for a, i, j in zip(at.tolist(), lo.tolist(), hi.tolist(), strict=True)], np.int64)
                    for c, v in zip(cols, (np.full(len(f), t1), np.full(len(f), t2), f, at, lo, hi, hashed[:, 0], hashed[:, 1]), strict=True):
                        c.append(v)
                    total += len(f)
                    if total >= 50_000:
                        yield flush()
                        total = 0
            yield flush()

    return texts.mapInArrow(run, _A)


def _ways(data: bytes, x: dict, length: int, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, first and last window start) of each way in which the context x is merged."""
    at, lo, hi, ways = x["at"], x["lo"], x["hi"], x["ways"]
    if ways == 1:
        yield x["f"] % buckets, lo, hi
        return
    offsets = length // 2 + 1
    for j in range(ways):
        first, last = j * offsets // ways, (j + 1) * offsets // ways - 1
        if max(first, at - hi) <= min(last, at - lo):
            key = _digest(data[at - first : at + length - last] + j.to_bytes(4, "little"))[0]
            yield key % buckets, at - min(last, at - lo), at - max(first, at - hi)


def _runs(owned: DataFrame, length: int, buckets: int) -> DataFrame:
    """Front-coded runs (bucket, run) of the contexts that texts own. owned: _t1, _t2, text, own array<f, at, lo, hi, ways>."""

    @slim
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, bytes]] = []

        def flush() -> pa.RecordBatch:
            held.sort()
            keys, shares, tails, rests = [], [], [], []
            i = 0
            while i < len(held):
                j = i
                while j < len(held) and held[j][0] == held[i][0]:
                    j += 1
                coded = front_code([h[1:] for h in held[i:j]])
                keys.append(held[i][0])
                shares.append([c[0] for c in coded])
                tails.append([c[1] for c in coded])
                rests.append([c[2] for c in coded])
                i = j
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(shares, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.binary())), pa.array(rests, pa.list_(pa.binary()))], names=["bucket", "shares", "tails", "rests"])

        size = 0
        for batch in batches:
            for t1, t2, text, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                for x in own:
                    for bucket, lo, hi in _ways(data, x, length, buckets):
                        at = x["at"]
                        right, left = data[at : hi + length], data[lo:at][::-1]
                        # rest: whose the record is, its place and offsets, and the bytes before the anchor
                        rest = np.array([t1, t2, at, at - hi, at - lo], "<i8").tobytes() + left
                        held.append((bucket, right, rest))
                        size += len(right) + len(rest)
                if size >= RUN_BYTES:
                    yield flush()
                    size = 0
        yield flush()

    return owned.mapInArrow(run, "bucket long, shares array<int>, tails array<binary>, rests array<binary>")


def _merged(runs: DataFrame, length: int) -> DataFrame:
    """Spans (_t1, _t2, start, end) of the repeated windows of the merged runs' records."""

    def spans(cluster: list[tuple[int, bytes, bytes]]) -> Iterator[tuple]:
        facts = np.array([np.frombuffer(r[:40], "<i8") for _, _, r in cluster])
        least, most = repeated_windows([k for _, k, _ in cluster], np.array([n for n, _, _ in cluster[1:]], np.int64), [r[40:] for _, _, r in cluster], facts[:, 3], facts[:, 4], length)
        for (t1, t2, at, _, _), a, b in zip(facts.tolist(), least.tolist(), most.tolist(), strict=True):
            if a >= 0:
                yield t1, t2, at - b, at - a + length

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        runs = [list(zip(*r, strict=True)) for r in zip(table["shares"].to_pylist(), table["tails"].to_pylist(), table["rests"].to_pylist(), strict=True)]
        out: list[tuple] = []
        cluster: list[tuple[int, bytes, bytes]] = []
        for item in LoserTree(runs):
            if item[0] < length // 2 and cluster:
                if len(cluster) > 1:
                    out.extend(spans(cluster))
                cluster = []
            cluster.append(item)
        if len(cluster) > 1:
            out.extend(spans(cluster))
        cols = list(zip(*out, strict=True)) or [[], [], [], []]
        release()
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("_t1", "_t2", "start", "end"), cols, strict=True)})

    return runs.groupBy("bucket").applyInArrow(merge, "_t1 long, _t2 long, start long, end long")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("_doc"), text.alias("text"), F.xxhash64(text).alias("_t1"), F.xxhash64(F.lit(1), text, F.lit(2)).alias("_t2"))


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(copied: _t1, _t2 of texts that occur more than once; spans: _t1, _t2 and the maximal spans of distinct texts), stored."""
    rows = _keyed(docs, id_col, text_col).where(F.octet_length("text") >= length)
    ids = F.coalesce(F.col("_doc").cast("long"), F.lit(NULL_ID))
    copied = stored(rows.groupBy("_t1", "_t2").agg(F.min(ids).alias("_first"), F.count("*").alias("n")).where("n > 1").drop("n"), "copied")
    few = broadcast_if(copied)
    texts = rows.withColumn("_own", ids).join(few, ["_t1", "_t2"], "left").where("_first is null or _first = _own").select("_t1", "_t2", "text")
    records = stored(_anchor_rows(texts, length), "anchors")
    known = broadcast_if(stored(records.groupBy("f").agg(F.count("*").alias("_n")).where("_n > 1").select("f"), "anchors-twice"))
    records_twice = stored(records.join(known, "f", "left_semi"), "anchors-left")
    dropped(records)
    contexts = stored(records_twice.groupBy("f", "c1", "c2").agg(F.count("*").alias("n"), F.min(F.struct("_t1", "_t2", "at", "lo", "hi")).alias("o")), "contexts")
    again = stored(contexts.where("n > 1").select("c1", "c2"), "contexts-twice")
    spans = records_twice.join(broadcast_if(again), ["c1", "c2"], "left_semi").select("_t1", "_t2", F.col("lo").alias("start"), (F.col("hi") + length).alias("end"))
    sharing = stored(contexts.groupBy("f").agg(F.count("*").alias("k")).where("k > 1"), "strings")
    ways = F.least(F.lit(length // 2 + 1), F.ceil(F.col("k") / hot)).cast("int").alias("ways")
    owned = contexts.join(broadcast_if(sharing), "f").select("o._t1", "o._t2", F.struct("f", "o.at", "o.lo", "o.hi", ways).alias("x"))
    owned = stored(owned.groupBy("_t1", "_t2").agg(F.collect_list("x").alias("own")), "owned")
    size = owned.agg(F.sum(F.aggregate("own", F.lit(0).cast("long"), lambda n, x: n + x["ways"]))).first()[0]
    out = spans
    if size:
        # an identical row twice in the table gives its texts twice; one is enough
        there = texts.join(broadcast_if(owned), ["_t1", "_t2"]).select("_t1", "_t2", "text", "own")
        buckets = max(8, -(-size * length * 2 // RUN_BYTES))
        out = out.unionByName(_merged(stored(_runs(there, length, buckets), "runs"), length))
    per = out.groupBy("_t1", "_t2").agg(_joined_up(F.sort_array(F.collect_set(F.struct("start", "end")))).alias("spans"))
    return copied, stored(per, "spans")


def _joined_up(spans: Column) -> Column:
    """Sorted spans, at least one, with those that overlap or touch made one: the windows of a copied passage are many."""
    one = lambda acc: F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end")))
    none = F.lit(None).cast("long")

    def step(acc: Column, x: Column) -> Column:
        apart = acc["end"].isNull() | (x["start"] > acc["end"])
        done = F.when(apart & acc["end"].isNotNull(), F.concat(acc["done"], one(acc))).otherwise(acc["done"])
        return F.struct(done.alias("done"), F.when(apart, x["start"]).otherwise(acc["start"]).alias("start"), F.when(apart, x["end"]).otherwise(F.greatest(acc["end"], x["end"])).alias("end"))

    zero = F.struct(F.array().cast("array<struct<start: long, end: long>>").alias("done"), none.alias("start"), none.alias("end"))
    return F.aggregate(spans, zero, step, lambda acc: F.concat(acc["done"], one(acc)))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **options) -> DataFrame:
    """id_col, n_bytes, n_removed, removed (maximal spans start, end) and kept (the other bytes) of each row."""
    copied, spans = repeated_spans(docs, id_col=id_col, text_col=text_col, length=length, **options)
    rows = _keyed(docs, id_col, text_col)
    rows = rows.join(broadcast_if(copied.select("_t1", "_t2", F.lit(True).alias("_copied"))), ["_t1", "_t2"], "left").join(broadcast_if(spans), ["_t1", "_t2"], "left")
    rows = rows.select("_doc", "text", F.coalesce("_copied", F.lit(False)).alias("_copied"), F.when(F.col("_copied").isNull(), F.col("spans")).alias("spans"))

    @slim
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, copy, got in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                data = text.as_py().encode("utf-8", "surrogatepass")
                whole: list[list[int]] = [[0, len(data)]] if copy else []
                for s in got or ():
                    if whole and s["start"] <= whole[-1][1]:
                        whole[-1][1] = max(whole[-1][1], s["end"])
                    else:
                        whole.append([s["start"], s["end"]])
                kept, at = [], 0
                for a, b in whole:
                    kept.append(data[at:a])
                    at = b
                kept.append(data[at:])
                for c, v in zip(out, (len(data), sum(b - a for a, b in whole), [{"start": a, "end": b} for a, b in whole], b"".join(kept)), strict=True):
                    c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names=[id_col, "n_bytes", "n_removed", "removed", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_removed long, removed array<struct<start: long, end: long>>, kept binary")
