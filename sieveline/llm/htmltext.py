"""HTML extraction by composite text density.

A page is read into a tree by a tolerant scanner, in time linear in the page. Elements that name
themselves boilerplate, by tag or role, are left out with all they hold; one that does so only by
class or id is, unless it holds an `article` or `main` element, or more than half of the text in
paragraphs of a page without one.

For each element the characters, tags, linked characters and link tags of its subtree give its
composite density: characters for each tag, adjusted by a logarithm of the shares of linked and
unlinked text. The sum of its children's densities is what an element is chosen by. The threshold is
the least density on the path from the element with the greatest sum up to the body. From the body
down, each subtree whose density reaches it gives its element with the greatest sum, and the
children of those not yet chosen are looked at likewise; all chosen elements are the main content.
What lies in page order between chosen elements, headings directly before the first, and what else
an `article` or `main` element around a chosen one holds, is the same content (short paragraphs,
captions), if its links hold no more than half of its characters.

Text: character references decoded, blocks in page order, white space runs as one space.

Defined results: a null or empty page, or one without text outside boilerplate, gives an empty
text; unclosed and stray tags are tolerated, to any depth; `<!-->` and `<!--->` are empty comments;
nothing is cut off; repeated rows give equal texts; extra columns are ignored or carried by name.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slim

NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
STOP = re.compile(r"""[>"']""")
ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']+))?""")
RAW = frozenset({"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed"})
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
#: A start tag of the first kind ends an open element of the second kind, unless a third is met before.
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), **dict.fromkeys(("tbody", "thead", "tfoot"), ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}))}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEAD_ONLY = frozenset("base link meta".split()) | RAW
P_SCOPE = frozenset({"body", "html", "article", "section", "div", "td", "th", "table", "li", "button", "blockquote", "main", "aside", "header", "footer", "nav", "form", "object", "caption"})
BOILERPLATE_TAGS = RAW | frozenset("nav menu header footer aside form button select option input dialog svg canvas audio video object embed head".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
BOILERPLATE_NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs
    header masthead footer sidebar aside cookie cookies consent gdpr notice notices alert disclaimer popup modal overlay comment comments commentlist disqus respond
    share sharing social related recommended newsletter subscribe subscription signup login search pagination pager toolbar widget""".split()
)
NAME_PARTS = re.compile(r"[^a-z0-9]+")
KEEPS = frozenset({"body", "html", "article", "main"})
CORE = frozenset({"article", "main"})


def attributes(source: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(source)}


def boilerplate(tag: str, source: str) -> int:
    """2 if an element names itself boilerplate by tag, role or being hidden, 1 if only by class or id, else 0."""
    if tag in BOILERPLATE_TAGS:
        return 2
    if not source or tag in KEEPS or source.isspace():
        return 0
    a = attributes(source)
    if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "").lower() or a.get("role", "").lower() in BOILERPLATE_ROLES:
        return 2
    names = NAME_PARTS.split(f"{a.get('class', '')} {a.get('id', '')}".lower())
    return int(not BOILERPLATE_NAMES.isdisjoint(names) or any("comment" in x or "sidebar" in x or "advert" in x for x in names))


def unescaped(text: str) -> str:
    if "&" not in text:
        return text
    try:
        return html.unescape(text)
    except ValueError:  # a number of thousands of digits
        return html.unescape(re.sub(r"&#[0-9]{8,};?", "\ufffd", text))


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """Parts of a page in order: ("", text, "") or (name, "/" or "", attributes), comments left out.

    Each search for a sign that isn't there is made once, so no page takes more than linear time.
    """
    at, n, quotes = 0, len(page), True
    known: dict[str, tuple[int, int]] = {}  # of each sign where it was last looked for, and where it was

    def find(sign: str, start: int) -> int:
        since, there = known.get(sign, (0, -2))
        if since <= start and (there == -1 or there >= start):
            return there
        there = page.find(sign, start)
        known[sign] = start, there
        return there

    while at < n:
        start = find("<", at)
        if start != at:
            yield "", page[at : start if start >= 0 else n], ""
            if start < 0:
                return
            at = start
        if find(">", at) < 0:  # no tag ends any more
            yield "", page[at:], ""
            return
        m = NAME.match(page, at + 1)
        if m is None:
            if page.startswith("<!--", at):
                short = next((x for x in ("<!-->", "<!--->") if page.startswith(x, at)), None)
                ends = [(find(x, at + 4), len(x)) for x in ("-->", "--!>")]
                end, size = min((e for e in ends if e[0] >= 0), default=(n, 0))
                at = at + len(short) if short else end + size
            elif page[at + 1] in "!?/":
                at = find(">", at + 1) + 1
            else:
                yield "", "<", ""
                at += 1
            continue
        end, first = m.end(), find(">", m.end())
        while quotes:  # the first > outside quotes
            stop = STOP.search(page, end)
            if stop is None:
                quotes = False  # a quote is never closed: from here on they are plain signs
            elif stop[0] == ">":
                first = stop.start()
                break
            elif (end := find(stop[0], stop.end()) + 1) == 0:
                quotes = False
        name, closing = m[1].lower(), page[at + 1] == "/"
        yield name, "/" if closing else "", page[m.end() : first]
        at = first + 1
        if name in RAW and not closing and not page.endswith("/", m.end(), first):
            end = at
            while (end := find("</", end)) >= 0:
                if page[end + 2 : end + 2 + len(name)].lower() == name:
                    break
                end += 2
            stop = find(">", end) if end >= 0 else -1
            at = stop + 1 if stop >= 0 else n


class Tree:
    """Elements in page order, as parallel lists; text pieces with the element that holds them. Element 0 is the root."""

    def __init__(self, page: str):
        self.tag, self.parent, self.end, self.named = ["body"], [-1], [0], [0]
        self.chars, self.link_chars, self.tags, self.link_tags = [0], [0], [0], [0]
        self.texts: list[tuple[int, str]] = []
        self.stack, self.links = [0], 0
        self.open: dict[str, list[int]] = {}  # of each tag the places of its open elements in the stack
        for name, sign, rest in tokens(page):
            if not name:
                self._text(sign)
            elif name in ("body", "html"):
                if self.tag[self.stack[-1]] == "head":
                    self._pop(len(self.stack) - 1)
            elif sign:
                self._close(name)
            else:
                self._open(name, rest)
        self._pop(0)
        self._drop_boilerplate()

    def _text(self, piece: str) -> None:
        blank = piece.isspace()
        if not blank and self.tag[self.stack[-1]] == "head":
            self._pop(len(self.stack) - 1)
        here = self.stack[-1]
        piece = unescaped(piece)
        self.texts.append((here, piece))
        if not blank:
            n = len("".join(piece.split()))
            self.chars[here] += n
            if self.links:
                self.link_chars[here] += n

    def _innermost(self, names: Iterable[str]) -> int:
        """The highest place in the stack of an open element with one of these names, or 0."""
        return max((places[-1] for x in names if (places := self.open.get(x))), default=0)

    def _close(self, name: str) -> None:
        at = self._innermost((name,))
        if at and not (name in INLINE and self._innermost(("article", "main", "table")) > at):
            self._pop(at)
        self.texts.append((self.stack[-1], "" if name in INLINE else "\n"))

    def _open(self, name: str, rest: str) -> None:
        stack = self.stack
        if self.tag[stack[-1]] == "head" and name not in HEAD_ONLY:
            self._pop(len(stack) - 1)
        inner, bounds = ({"p"}, P_SCOPE) if name in CLOSES_P else IMPLIED.get(name, ((), ()))
        if any(self.open.get(x) for x in inner):
            # the outermost of them that stands above all bounds
            bound, outermost = self._innermost(x for x in bounds if x not in inner), len(stack)
            for x in inner:
                places = self.open.get(x, ())
                k = bisect_right(places, bound)
                if k < len(places):
                    outermost = min(outermost, places[k])
            if outermost < len(stack):
                self._pop(outermost)
        here = stack[-1]
        if name not in INLINE:
            self.texts.append((here, "\n"))
        ends = rest.endswith("/")
        if name in VOID or name in RAW:
            self.tags[here] += name in VOID
            return
        self.tag.append(name)
        self.parent.append(here)
        self.end.append(len(self.tag))
        self.named.append(boilerplate(name, rest))
        for x in (self.chars, self.link_chars, self.tags, self.link_tags):
            x.append(0)
        if not ends:
            self.open.setdefault(name, []).append(len(stack))
            stack.append(len(self.tag) - 1)
            self.links += name == "a"

    def _pop(self, k: int) -> None:
        """Ends all from the k-th open element on."""
        for x in self.stack[k:]:
            self.end[x] = len(self.tag)
            if x:
                places = self.open[self.tag[x]]
                del places[bisect_left(places, k) :]
                self.links -= self.tag[x] == "a"
        del self.stack[k:]

    def _drop_boilerplate(self) -> None:
        """Marks the elements of boilerplate as gone; their counts become 0."""
        n = len(self.tag)
        self.gone = gone = bytearray(n)
        for i in range(1, n):
            gone[i] = self.named[i] == 2 or gone[self.parent[i]]
        prose = bytearray(n)  # paragraphs and what they hold
        for i in range(1, n):
            prose[i] = self.tag[i] == "p" or prose[self.parent[i]]
        held, core = [self.chars[i] - self.link_chars[i] if prose[i] and not gone[i] else 0 for i in range(n)], [x in ("article", "main") and not g for x, g in zip(self.tag, gone, strict=True)]
        for i in range(n - 1, 0, -1):
            held[self.parent[i]] += held[i]
            core[self.parent[i]] |= core[i]
        for i in range(1, n):
            gone[i] = gone[i] or gone[self.parent[i]] or (self.named[i] == 1 and not core[i] and (core[0] or self.tag[i] == "p" or 2 * held[i] <= held[0]))
            if gone[i]:
                self.chars[i] = self.link_chars[i] = self.tags[i] = self.link_tags[i] = 0

    def main(self) -> list[int]:
        """The elements that hold the main content, in page order."""
        n, there = len(self.tag), [not g for g in self.gone]
        chars, links, tags, link_tags = self.chars[:], self.link_chars[:], self.tags[:], self.link_tags[:]
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            chars[p] += chars[i]
            links[p] += links[i]
            tags[p] += tags[i] + there[i]
            link_tags[p] += link_tags[i] + (there[i] and self.tag[i] == "a")
        ratio = links[0] / max(chars[0], 1)
        density, total = [0.0] * n, [0.0] * n
        for i in range(n - 1, -1, -1):
            if c := chars[i]:
                lc, t, lt = max(links[i], 1), max(tags[i], 1), max(link_tags[i], 1)
                base = math.log(c / max(c - links[i], 1) * links[i] + ratio * c + math.e)
                density[i] = c / t * math.log(max(c / lc * t / lt, 1.0)) / math.log(max(base, 1.0) + 1.0)
            if i:
                total[self.parent[i]] += density[i]
        # of each subtree the element with the greatest sum, the first of equals
        top = list(range(n))
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            if (total[top[i]], -top[i]) > (total[top[p]], -top[p]):
                top[p] = top[i]
        at = top[0]
        threshold = density[at]
        while at > 0:
            at = self.parent[at]
            threshold = min(threshold, density[at])
        chosen, open_ = {top[0]}, [0]
        while open_:
            i = open_.pop()
            if i and not (chars[i] and density[i] >= threshold):
                continue
            chosen.add(top[i])
            if top[i] != i:
                open_ += self.children(i)
        return sorted(chosen | self._between(chosen, chars, links))

    def _between(self, chosen: set[int], chars: list[int], links: list[int]) -> set[int]:
        """Elements between the chosen ones, headings before them, and others in the same article or main element, that aren't mostly links."""
        first, last = min(chosen), max(max(self.end[i], i + 1) for i in chosen)
        n = len(self.tag)
        core, block = [0] * n, [0] * n  # nearest article or main, and nearest element that isn't inline
        for i in range(1, n):
            core[i] = i if self.tag[i] in CORE else core[self.parent[i]]
            block[i] = i if self.tag[i] not in INLINE else block[self.parent[i]]
        for i in filter(None, {core[i] for i in chosen}):
            first, last = min(first, i), max(last, self.end[i])
        holds = bytearray(len(self.tag))  # those that hold a chosen element
        for i in chosen:
            while i > 0 and not holds[i]:
                holds[i] = 1
                i = self.parent[i]
        for i in range(first - 1, 0, -1):
            if holds[i] or not chars[i]:
                continue
            if self.tag[block[i]] not in HEADINGS:
                break
            first = i
        out, i = set(), first
        while i < last:
            if holds[i] and i not in chosen:
                out.add(-i)  # its own text, but not all it holds
            elif i not in chosen and chars[i] and 2 * links[i] <= chars[i]:
                out.add(i)
            i = i + 1 if holds[i] and i not in chosen else max(self.end[i], i + 1)
        return out

    def children(self, element: int) -> list[int]:
        out, i = [], element + 1
        while i < (self.end[element] or len(self.tag)):
            if self.parent[i] == element:
                out.append(i)
            i = max(self.end[i], i + 1)
        return out

    def text(self, elements: list[int]) -> str:
        """The text of the subtrees of elements, in page order; of an element -i the text that is directly in i."""
        inside = bytearray(len(self.tag))
        for e in elements:
            if e < 0:
                inside[-e] = 1
            else:
                end = max(self.end[e], e + 1)
                inside[e:end] = b"\x01" * (end - e)
        return " ".join("".join(t if inside[i] and not self.gone[i] else "\n" for i, t in self.texts).split())


def main_text(page: str | None) -> str:
    """The main text of a page."""
    if not page:
        return ""
    tree = Tree(page)
    return tree.text(tree.main())


def extract(pages: DataFrame, *, html_col: str = "html", carry: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The `carry` columns with text and n_chars (code points) of each row."""
    rows = pages.select(*carry, html_col)

    @slim
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(len(carry))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=[*carry, "text", "n_chars"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(run, f"{schema}, text string, n_chars long")
