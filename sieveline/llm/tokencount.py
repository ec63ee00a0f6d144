"""Token counts: a linear longest-match automaton over a word-piece vocabulary.

The vocabulary is a trie. Each node has a failure link and the number of pieces that taking the
link pops, both computed once, breadth first. A word is then read once, character by character:
where the trie has no next node, the popped count is added and the link followed, so greedy
longest-match lengths come out without building a piece, in time linear in the word.

The default vocabulary is that of a byte-level file with word ends: a word is its UTF-8 bytes as
that file writes them, closed by an end mark; all single bytes are pieces, so every word splits.
In other vocabularies a word that can't be split counts as one piece. Words are those of the
file's pattern (letters, single digits, runs of other signs) in composed lower case.

Counts of parts between spaces are cached for each worker, twice `CACHED` entries at most.

Defined results: null and empty texts have 0 tokens; repeated rows are counted each; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import Cache, slim

CACHED = 500_000
LONGEST_CACHED = 64
END = "\0"
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


class Automaton:
    """Trie with failure links and popped counts. Node 0 is the root; a link of -1 is none."""

    def __init__(self, pieces: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        whole = {0: False}
        for piece in pieces:
            at = 0
            for c in piece:
                there = self.next[at].get(c)
                if there is None:
                    there = len(self.next)
                    self.next[at][c] = there
                    self.next.append({})
                at = there
            if at:
                whole[at] = True
        n = len(self.next)
        self.link, self.pops = [-1] * n, [0] * n
        queue = [0]
        for at in queue:
            for c, child in self.next[at].items():
                queue.append(child)
                if whole.get(child):
                    self.link[child], self.pops[child] = 0, 1
                    continue
                popped, z = self.pops[at], self.link[at]
                while z >= 0 and c not in self.next[z]:
                    popped += self.pops[z]
                    z = self.link[z]
                if z >= 0:
                    self.link[child], self.pops[child] = self.next[z][c], popped

    def count(self, word: str) -> int:
        """Number of pieces of the word; 1 if it can't be split, 0 if it is empty."""
        at = n = 0
        step, link, pops = self.next, self.link, self.pops
        for c in word:
            there = step[at].get(c)
            while there is None:
                if link[at] < 0:
                    return 1
                n += pops[at]
                at = link[at]
                there = step[at].get(c)
            at = there
        while at:
            if link[at] < 0:
                return 1
            n += pops[at]
            at = link[at]
        return n


def byte_signs() -> list[str]:
    """The sign by which byte-level files write each byte: itself if printable, else the next one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [""] * 256, 0x100
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


def vocabulary(path: str) -> list[str]:
    """Pieces of a tokenizer file, with `</w>` as the end mark; without its special tokens."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    special = {x["content"] for x in data.get("added_tokens", [])}
    return [x.removesuffix("</w>") + END if x.endswith("</w>") else x for x in data["model"]["vocab"] if x not in special]


class Counter(Cache):
    """Cached token counts of text parts."""

    def __init__(self, path: str):
        super().__init__(CACHED)
        self.automaton, self.signs = Automaton(vocabulary(path)), byte_signs()

    def __missing__(self, part: str) -> int:
        n = self.old.get(part)
        if n is None:
            text = unicodedata.normalize("NFC", part).lower()
            n = sum(self.automaton.count("".join(self.signs[b] for b in w.encode()) + END) for w in WORD.findall(text))
        if len(part) <= LONGEST_CACHED:
            self.keep(part, n)
        return n


_counters: dict[str, Counter] = {}


def token_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """id_col, n_words (parts between white space) and n_tokens of each row."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    path = tokenizer

    @slim
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = Counter(path)
        counter = _counters[path]
        count = counter.__getitem__
        counter.begin()
        try:
            for batch in batches:
                words, tokens = [], []
                for text in batch.column(1):
                    whole = text.as_py() or ""
                    words.append(len(whole.split()))
                    # cut where the pattern always cuts, which is less than str.split() takes for white space
                    tokens.append(sum(map(count, whole.replace("\n", " ").split(" "))))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=[id_col, "n_words", "n_tokens"])
        finally:
            counter.end()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_tokens long")
