"""Packing: sum-of-squares online packing of token sequences.

A document's ids are encoded once and cut into full windows and a remainder. Each remainder goes,
as it arrives, to the fill level that minimises the sum of squared counts of partially filled
windows (a new window is level 0); the counts stand in an array by level. When more than `OPEN`
windows are open (a parameter, `open_windows`), the next document's first ids fill the fullest one, so that a task
keeps few; such sequences are called "filled", and `shares` tells how much of all that is.

First pass: each task packs its part of the table, without a shuffle. What it completes is final.
Second pass: the pieces of windows still open, of `FAN` tasks each, meet in one task and are packed
alike, in a fixed order. A task leaves at most `OPEN` windows, however many rows it had, so a
second task reads a bounded amount. What is open after that is laid end to end
and cut at the window length, its last window into powers of two, which need no padding. The
column `how` tells by which of these ("first", "second", "filled", "rest") a sequence came about.

Encoding: if the tokenizer drops white space and never joins over it, as the default one, the ids
of a text are those of its parts between spaces and line feeds, which are cached for each worker
(twice `CACHED` entries at most, those in use kept). A part that is a Latin word goes to the tokenizer's model
directly, and a point or comma after a word is a part of its own. Other tokenizers must be given
with `split=False`; their texts are encoded whole.

Defined results: a null or empty text has the closing id only; repeated rows are packed each;
an empty table gives no rows; extra columns are ignored. Sequence ids are unique in a result and
deterministic for a given partitioning, so a lost task is redone alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cache, slim, stored
from .tokencount import byte_signs

SEQUENCE = 2048
END_ID = 1
OPEN = 64
FAN = 64
CACHED = 500_000
LONGEST_CACHED = 64
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, how string"
TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
#: Sequence ids of the second pass begin here.
SECOND = 1 << 62


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder(Cache):
    """Ids of text parts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, split: bool = True):
        from tokenizers import Tokenizer

        super().__init__(CACHED)
        self.tokenizer, self.split = Tokenizer.from_file(path), split
        self.model, self.signs = self.tokenizer.model, byte_signs()

    def _ids(self, part: str) -> bytes:
        if len(part) > 1 and part[-1] in ".," and part[-2].isalpha():
            return self[part[:-1]] + self[part[-1]]
        if part.isalpha() and max(part) < "\u0100":
            ids = [x.id for x in self.model.tokenize("".join([self.signs[b] for b in part.lower().encode()]))]
        else:
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def __missing__(self, part: str) -> bytes:
        out = self.old.get(part)
        if out is None:
            out = self._ids(part)
        if len(part) <= LONGEST_CACHED:
            self.keep(part, out)
        return out

    def encode(self, text: str) -> bytes:
        if not self.split:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, split: bool) -> Encoder:
    """One for each worker process."""
    if (path, split) not in _encoders:
        _encoders[path, split] = Encoder(path, split)
    return _encoders[path, split]


class Packer:
    """Online packing. A piece is (doc_id, start, ids, doc_tokens); rows are those of SCHEMA."""

    def __init__(self, size: int, first_id: int = 0, how: str = "first", most: int = OPEN):
        self.size, self.next_id, self.how, self.most = size, first_id, how, most
        self.counts = [0] * (size + 1)
        self.open: dict[int, list[list[tuple]]] = {}
        self.n_open = 0
        self.short: list | None = None  # the window that the next document fills: [tokens, pieces]

    def level(self, n: int) -> int:
        """The fill level at which n more tokens least raise the sum of squares; the fuller one of equals."""
        counts, size = self.counts, self.size
        best, least = 0, 2 * counts[n] + 1 if n < size else 0
        for h in self.open:
            if h + n <= size:
                rise = (2 * counts[h + n] + 1 if h + n < size else 0) - 2 * counts[h] + 1
                if rise < least or rise == least and h > best:
                    best, least = h, rise
        return best

    def emit(self, pieces: list[tuple], how: str | None = None) -> Iterator[tuple]:
        at = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            yield doc, start, n, ids, total, self.next_id, at, how or self.how
            at += n
        self.next_id += 1

    def add(self, doc, ids: bytes, start: int = 0, total: int | None = None) -> Iterator[tuple]:
        """Packs the ids of a document, or of a part of it that begins at `start`."""
        total = len(ids) // 4 if total is None else total
        if self.short:
            cut = ids[: 4 * (self.size - self.short[0])]
            self.short[0] += len(cut) // 4
            self.short[1].append((doc, start, cut, total))
            ids, start = ids[len(cut) :], start + len(cut) // 4
            if self.short[0] == self.size:
                yield from self.emit(self.short[1], "filled")
                self.short = None
        while len(ids) >= 4 * self.size:
            yield from self.emit([(doc, start, ids[: 4 * self.size], total)])
            ids, start = ids[4 * self.size :], start + self.size
        if ids:
            n = len(ids) // 4
            at = self.level(n)
            pieces = self._take(at) if at else []
            pieces.append((doc, start, ids, total))
            if at + n == self.size:
                yield from self.emit(pieces)
                return
            self.open.setdefault(at + n, []).append(pieces)
            self.counts[at + n] += 1
            self.n_open += 1
            if self.n_open > self.most:
                top = max(self.open)
                self.short = [top, self._take(top)]

    def _take(self, level: int) -> list[tuple]:
        """The pieces of an open window of this level, which it gives up."""
        self.counts[level] -= 1
        self.n_open -= 1
        pieces = self.open[level].pop()
        if not self.open[level]:
            del self.open[level]
        return pieces

    def rest(self) -> list[list[tuple]]:
        """The open windows, fullest first, which it gives up."""
        if self.short:
            self.open.setdefault(self.short[0], []).append(self.short[1])
        out = [pieces for at in sorted(self.open, reverse=True) for pieces in self.open[at]]
        self.open, self.short, self.n_open = {}, None, 0
        self.counts = [0] * (self.size + 1)
        return out

    def carry(self) -> Iterator[tuple]:
        """The pieces of the open windows, for the second pass."""
        for pieces in self.rest():
            yield from self.emit(pieces, "open")

    def close(self) -> Iterator[tuple]:
        """Lays the open windows end to end, fullest first, and cuts them anew."""
        rest = [p for pieces in self.rest() for p in pieces]
        left = sum(len(p[2]) // 4 for p in rest)
        window: list[tuple] = []
        room = size = self._next_size(left)
        for doc, start, ids, total in rest:
            while ids:
                cut = ids[: 4 * room]
                window.append((doc, start, cut, total))
                ids, start, room = ids[len(cut) :], start + len(cut) // 4, room - len(cut) // 4
                if not room:
                    yield from self.emit(window, "rest")
                    window, left = [], left - size
                    room = size = self._next_size(left)

    def _next_size(self, left: int) -> int:
        return self.size if left >= self.size else 1 << max(left.bit_length() - 1, 0)


def _batches(rows: Iterator[tuple], most: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), TYPES, strict=True)], names=NAMES)
            held.clear()
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), TYPES, strict=True)], names=NAMES)


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, tokenizer: str | None = None, split: bool = True, end_id: int = END_ID, fan: int = FAN, open_windows: int = OPEN) -> DataFrame:
    """Pieces of packed sequences: doc_id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset, how. size should be a power of two.

    The first pass is written to the shared folder, open windows apart, so that texts are encoded
    once and the second pass reads open windows only.
    """
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()

    @slim
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, split)
        packer = Packer(size, TaskContext.get().partitionId() << 32, "first", open_windows)

        def rows() -> Iterator[tuple]:
            enc.begin()
            try:
                for batch in batches:
                    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                        yield from packer.add(doc, enc.encode(text.as_py() or "") + end)
                yield from packer.carry()
            finally:
                enc.end()

        return _batches(rows())

    @slim
    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(size, SECOND | TaskContext.get().partitionId() << 32, "second", open_windows)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc, start, _, ids, total, *_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield from packer.add(doc, ids, start, total)
            yield from packer.close()

        return _batches(rows())

    packed = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text").mapInArrow(first, SCHEMA)
    packed = stored(packed, "packed", by="how")
    left = packed.where("how = 'open'")
    group = F.floor(F.shiftright("sequence_id", 32) / fan)
    most = left.agg(F.max(group)).first()[0]
    done = packed.where("how <> 'open'").select(*NAMES)
    if most is None:
        return done
    again = left.repartition(most + 1, group).sortWithinPartitions("sequence_id", "offset").select(*NAMES)
    return done.unionByName(again.mapInArrow(second, SCHEMA))


def shares(pieces: DataFrame) -> DataFrame:
    """how, tokens and share of all tokens, of packed pieces."""
    by = pieces.groupBy("how").agg(F.sum("length").alias("tokens"))
    return by.join(F.broadcast(pieces.agg(F.sum("length").alias("_all")))).select("how", "tokens", (F.col("tokens") / F.col("_all")).alias("share"))
