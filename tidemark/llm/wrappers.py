"""HTML extraction by union-free regular-expression inference.

A page is a stream of tokens: tags, and slots of text, a slot being named by the elements it stands in. The
streams of one host are aligned with the wrapper found so far, one after another. What two streams share
stays; a token that one of them lacks becomes optional; a piece that follows itself becomes a repeated group.
The result is a regular expression without unions over tokens, and it matches every page it was made from.

What a slot holds decides the rest. A slot that the wrapper requires of every page, and that holds the same
text on all of them, is template: the host wrote it, not the author of the page. All others hold the text
of pages. That needs a host with pages that differ; where one has too few of them, tags, roles and class names
decide alone. They also set aside what differs from page to page and is no article: adverts, comments, forms.

Pages are reduced to their streams with repeats folded, and to a digest for each slot. Both are counted per
host before anything is gathered. A host with many different streams is split: parts of it make wrappers of
their own, which are then aligned with each other in rounds, so no task holds more than ``FAN_IN`` streams, or two of them if
they are very long. Streams of over ``LONGEST_STREAM`` tokens are a kind of page of their own: the host has a second
wrapper, of all of them.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Collection, Iterable, Iterator, Sequence
from difflib import SequenceMatcher
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import Rows, rows_of, small_batches, small_side, stored
from tidemark.llm.reputation import host_of

FAN_IN = 64
LONGEST_GROUP = 24  # tokens of a repeated group, inner groups counting as one
PART_BYTES = 8 << 20  # of streams that a task aligns, beyond the first two
LONGEST_STREAM = 5_000  # folded tokens of a stream that is aligned by longest blocks; longer ones by ``common_places``
DIFFERENT = 3  # texts of a slot that show that a host's pages differ, and pages that show that one's text does not
PROSE = 20  # words a page in a slot that holds prose

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(script|style|noscript|template|iframe|svg|textarea|select|xmp|noembed|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# HTML elements by what they mean for a page's text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr picture source br".split()
)
UNCLOSED = frozenset("p li dt dd td th tr option thead tbody tfoot html body head".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE_TAGS = frozenset(
    "nav header footer aside form head button menu dialog object embed audio video canvas map fieldset".split()
)
MAIN_TAGS = frozenset(["article", "main"])
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay newsletter subscribe subscription signup nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar widget widgets related recommended share sharing social footer header masthead "
    "comment comments disqus reply replies respond discussion login search pagination pager toolbar copyright legal".split()
)
# Of these, the ones that also name parts of an article: inside one they count only for template text.
PART_NAMES = frozenset("header masthead discussion legal copyright search login alert promotion".split())
MAIN_NAMES = frozenset(["articlebody", "postcontent", "entrycontent", "articlecontent", "maincontent"])


class Alphabet:
    """One character for every token, so that streams are strings and wrappers regular expressions."""

    FIRST, LAST = 0x10000, 0x10FFFE  # none of these has a meaning in a regular expression

    def __init__(self) -> None:
        self.of: dict = {}
        self.token: list = []

    def full(self) -> bool:
        return len(self.token) > self.LAST - self.FIRST

    def char(self, token) -> str:
        """The token's letter. When there are none left, all further tokens are one."""
        found = self.of.get(token)
        if found is None:
            if self.full():
                return chr(self.LAST + 1)
            found = self.of[token] = chr(self.FIRST + len(self.token))
            self.token.append(token)
        return found

    def __getitem__(self, char: str):
        at = ord(char) - self.FIRST
        return self.token[at] if at < len(self.token) else "?"


class Element(NamedTuple):
    tag: str
    path: str  # of the element and those it stands in, without html and body
    away: bool  # set aside
    main: bool  # in an article
    part: bool  # set aside by a name that parts of articles have as well
    form: bool  # in a form that does not stand in an article


class Slot(NamedTuple):
    path: str
    text: str
    away: bool
    main: bool
    part: bool
    form: bool


OUTSIDE = Element("", "", False, False, False, False)


def _named(tag: str, attributes: str) -> tuple[bool, bool, bool, str]:
    """Whether tag, role or names set an element aside, whether only a name does that parts of articles have,
    whether it holds an article, and its class names."""
    given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
    label = f"{given.get('class', '')} {given.get('id', '')}"
    names = {n.lower() for n in NAME.findall(label)} & ASIDE_NAMES if tag not in ("body", "html") else frozenset()
    role = given.get("role", "").lower()
    hidden = "hidden" in given or given.get("aria-hidden") == "true"
    away = tag in ASIDE_TAGS or role in ASIDE_ROLES or hidden or bool(names - PART_NAMES)
    joined = re.sub("[^a-z]", "", label.lower())
    main = tag in MAIN_TAGS or role == "main" or given.get("itemprop", "").lower() == "articlebody" or joined in MAIN_NAMES
    return away, bool(names), main, re.sub(r"\d+", "0", given.get("class", ""))[:80]


def _inside(outer: Element, tag: str, attributes: str) -> tuple[Element, str]:
    """An element that opens in ``outer``, and its token."""
    away, named, main, names = _named(tag, attributes)
    token = f"{tag}.{names}" if names else tag
    path = outer.path if tag in ("html", "body") else xxhash.xxh64_hexdigest(f"{outer.path}/{token}")
    if tag == "header" and outer.main:
        away = outer.away  # the head of an article is part of it
    form = outer.form
    if tag == "form" and not outer.main:
        away, form = False, True  # some sites wrap a form around the page
    part = outer.part or (outer.main and named and not away)
    away = outer.away or away or (named and not outer.main)
    main = outer.main or (main and not (away and tag not in MAIN_TAGS))
    return Element(tag, path, away, main and not away, part, form and not (main and not away)), token


def stream(page: str | None) -> tuple[list[str], list[Slot]]:
    """Tokens of a page, and its texts in order with the slots they stand in.

    Inline tags are part of the text around them, a line break in it is white space, and end tags that HTML
    lets out are left out.
    """
    page = page or ""
    tokens: list[str] = []
    slots: list[Slot] = []
    open_: list[Element] = [OUTSIDE]
    pieces: list[str] = []

    def close_text() -> None:
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                _, path, *flags = open_[-1]
                slots.append(Slot(path, text, *flags))
                tokens.append(f"#{path}")

    at = 0
    for match in TOKEN.finditer(page):
        pieces.append(page[at : match.start()])
        at = match.end()
        tag = (match[3] or "").lower()
        if not tag:
            continue  # comments, declarations, scripts and the like
        if tag in INLINE:
            if tag == "br" or tag == "img":
                pieces.append(" ")
            continue
        if match[2]:
            depth = next((i for i in range(len(open_) - 1, 0, -1) if open_[i].tag == tag), None)
            close_text()
            if depth is not None:
                del open_[depth:]
                if tag not in UNCLOSED:
                    tokens.append(f"/{tag}")
            continue
        close_text()
        if tag in UNCLOSED and tag not in ("html", "body", "head"):
            # a new paragraph, item or cell ends the one that is open in the same element
            while open_[-1].tag in UNCLOSED and open_[-1].tag in (tag, "p"):
                open_.pop()
        elif open_[-1].tag in ("p", "head"):
            open_.pop()
        element, token = _inside(open_[-1], tag, match[4] or "")
        tokens.append(token)
        if tag not in EMPTY and not (match[4] or "").endswith("/"):
            open_.append(element)
    pieces.append(page[at:])
    close_text()
    return tokens, slots


def fold(chars: str, letters: Alphabet) -> str:
    """Replace a piece that follows itself by one character for the repeated group, inner groups first."""
    for size in (1, 2, 3, 4, 6, 8, 12, LONGEST_GROUP):
        twice = re.compile(f"(.{{1,{size}}}?)\\1+", re.S)
        while not letters.full():
            folded = twice.sub(lambda m: m[1] if is_group(m[1], letters) else letters.char(("+", m[1])), chars)
            folded = absorb(folded, letters)
            if folded == chars:
                break
            chars = folded
    return chars


def is_group(chars: str, letters: Alphabet) -> bool:
    return len(chars) == 1 and isinstance(letters[chars], tuple)


def absorb(chars: str, letters: Alphabet) -> str:
    """A piece beside the group that repeats it belongs to the group."""
    for c in sorted(set(chars)):
        if is_group(c, letters):
            body = letters[c][1]
            chars = re.sub(f"(?:{body}|{c})*{c}(?:{body}|{c})*", c, chars)
    return chars


def written(chars: str, letters: Alphabet) -> list:
    """A stream or group body as nested lists, independent of the alphabet."""
    return [["+", *written(letters[c][1], letters)] if is_group(c, letters) else letters[c] for c in chars]


def read(nodes: Iterable, letters: Alphabet) -> str:
    return "".join(letters.char(("+", read(n[1:], letters)) if isinstance(n, list) else n) for n in nodes)


def common_places(a: str, b: str) -> list[tuple[int, int]]:
    """Places (in a, in b) of a longest common subsequence, in order. Halves of ``a`` find their parts of ``b`` (Hirschberg),
    a row of lengths being the zeros of one integer: memory in proportion to the streams, and 1/64 of a step for
    each pair of tokens."""

    def lengths(x: str, y: str) -> np.ndarray:
        """Of the common subsequences of ``x`` and each beginning of ``y``."""
        where: dict[str, int] = {}
        for c, at in sorted(places_of(y).items()):
            bits = np.zeros(-(-len(y) // 8) * 8, np.uint8)
            bits[at] = 1
            where[c] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
        full = row = (1 << len(y)) - 1
        for c in x:
            hit = row & where.get(c, 0)
            row = ((row + hit) | (row - hit)) & full
        bits = np.unpackbits(np.frombuffer(row.to_bytes(-(-len(y) // 8), "little"), np.uint8), bitorder="little")
        return np.concatenate(([0], np.cumsum(1 - bits[: len(y)].astype(np.int64))))

    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i == j or k == m:
            continue
        if j - i == 1:
            if (at := b.find(a[i], k, m)) >= 0:
                out.append((i, at))
            continue
        half = (i + j) // 2
        both = lengths(a[i:half], b[k:m]) + lengths(a[half:j][::-1], b[k:m][::-1])[::-1]
        cut = k + int(both.argmax())
        todo += [(i, half, k, cut), (half, j, cut, m)]
    return sorted(out)


def places_of(chars: str) -> dict[str, list[int]]:
    found: dict[str, list[int]] = {}
    for at, c in enumerate(chars):
        found.setdefault(c, []).append(at)
    return found


def pieces(a: str, b: str) -> Iterator[tuple[bool, int, int, int, int]]:
    """a[i:j] and b[k:m] that are shared, or that the other lacks: (shared, i, j, k, m), in order."""
    if max(len(a), len(b)) <= LONGEST_STREAM:
        for kind, i, j, k, m in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
            yield kind == "equal", i, j, k, m
        return
    i = k = 0
    for at, other in [*common_places(a, b), (len(a), len(b))]:
        if at > i or other > k:
            yield False, i, at, k, other
        if at < len(a):
            yield True, at, at + 1, other, other + 1
        i, k = at + 1, other + 1


class Wrapper:
    """A union-free regular expression: tokens and repeated groups in order, each of them optional or not."""

    def __init__(self, letters: Alphabet, chars: str = "", optional: Sequence[bool] = ()):
        self.letters, self.chars, self.optional = letters, chars, list(optional)

    def _regroup(self, chars: str, optional: list[bool], groups: list[str]) -> tuple[str, list[bool]]:
        """Runs of a body that is known to repeat, as the group."""
        for g in groups:
            body = self.letters[g][1]
            out, flags, at = [], [], 0
            for m in re.finditer(f"(?:{body}|{g})+", chars):
                flag = optional[m.start() : m.end()]
                if any(flag) and len(body) > 1:
                    continue  # parts of the body may be missing on their own
                out += [chars[at : m.start()], g]
                flags += [*optional[at : m.start()], all(flag)]
                at = m.end()
            chars, optional = "".join(out) + chars[at:], flags + optional[at:]
        return chars, optional

    def align(self, other: Wrapper) -> None:
        """Take ``other`` in: afterwards the wrapper matches what either matched."""
        groups = sorted({c for c in self.chars + other.chars if is_group(c, self.letters)}, key=lambda c: len(self.letters[c][1]))
        a, a_opt = self._regroup(self.chars, self.optional, groups)
        b, b_opt = self._regroup(other.chars, other.optional, groups)
        chars, optional = [], []
        for shared, i, j, k, m in pieces(a, b):
            if shared:
                chars.append(a[i:j])
                optional += [x or y for x, y in zip(a_opt[i:j], b_opt[k:m])]
            else:
                chars += [a[i:j], b[k:m]]
                optional += [True] * (j - i + m - k)
        self.chars, self.optional = "".join(chars), optional

    def nodes(self) -> list:
        return [["?", n] if o else n for n, o in zip(written(self.chars, self.letters), self.optional)]

    @staticmethod
    def of_nodes(nodes: Iterable, letters: Alphabet) -> Wrapper:
        chars, optional = [], []
        for n in nodes:
            maybe = isinstance(n, list) and n[0] == "?"
            chars.append(read([n[1] if maybe else n], letters))
            optional.append(maybe)
        return Wrapper(letters, "".join(chars), optional)

    def expression(self) -> regex.Pattern:
        """Matches the characters of every page the wrapper was made from."""

        def of(chars: str) -> str:
            return "".join(
                f"(?:{of(self.letters[c][1])})+" if is_group(c, self.letters) else c
                for c in chars
            )

        return regex.compile("".join(f"(?:{of(c)})?" if o else of(c) for c, o in zip(self.chars, self.optional)))


def dump(nodes: list) -> str:
    """Nested lists as text that is equal for equal lists."""
    return "\x1e".join("\x1d" + n[0] + dump(n[1:]) + "\x1c" if isinstance(n, list) else n for n in nodes)


PART = re.compile("\x1d([+?])|\x1c|[^\x1c-\x1e]+")


def load(text: str) -> list:
    stack: list[list] = [[]]
    for m in PART.finditer(text):
        if m[1]:
            stack.append([m[1]])
        elif m[0] == "\x1c":
            stack[-2].append(stack.pop())
        else:
            stack[-1].append(m[0])
    return stack[0]


def folded(tokens: Iterable[str]) -> tuple[str, int]:
    """A page's stream with its repeats folded, and its length."""
    letters = Alphabet()
    nodes = written(fold("".join(map(letters.char, tokens)), letters), letters)
    return dump(nodes), len(nodes)


def shape(tokens: Iterable[str]) -> str | None:
    """A page's folded stream; None if it is too long to be aligned by longest blocks (see ``pieces`` for those)."""
    text, length = folded(tokens)
    return text if length <= LONGEST_STREAM else None


def slots_of(nodes: Iterable) -> Iterator[str]:
    """The slots that a wrapper requires of every page."""
    for n in nodes:
        if isinstance(n, list):
            if n[0] == "+":
                yield from slots_of(n[1:])
        elif n[0] == "#":
            yield n[1:]


def infer(shapes: Iterable[str]) -> str:
    """The wrapper of several streams or wrappers, in the order of their texts."""
    letters, wrapper = Alphabet(), None
    for text in sorted(shapes, key=lambda t: (-len(t), t)):
        one = Wrapper.of_nodes(load(text), letters)
        if wrapper is None:
            wrapper = one
        elif (one.chars, one.optional) != (wrapper.chars, wrapper.optional):
            wrapper.align(one)
    return dump(wrapper.nodes()) if wrapper else ""


def measured(pages: DataFrame) -> DataFrame:
    """What the wrappers of ``pages`` (url, html) are made from: per host its different streams (``wrapper``; ``long`` ones
    are of the second), and per slot its different texts (``digest``), with the pages and words of each."""

    def read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("host", pa.string()), ("long", pa.bool_()), ("wrapper", pa.string()), ("slot", pa.string())]
        out = Rows(pa.schema([*kinds, ("digest", pa.int64()), ("words", pa.int64())]))
        seen = set()
        for host, page in rows_of(batches, "host", "html"):
            tokens, slots = stream(page)
            key = (host, xxhash.xxh128_digest("\x1e".join(tokens)))
            if key not in seen:  # a task's repeats; those of other tasks go in the aggregate
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(key)
                wrapper, length = folded(tokens)
                yield from out.add(host, length > LONGEST_STREAM, wrapper, None, None, 0, size=len(wrapper))
            held: dict[str, tuple[xxhash.xxh64, int]] = {}
            for slot in slots:
                digest, n = held.get(slot.path) or (xxhash.xxh64(), 0)
                digest.update(f"{slot.text}\n".encode("utf-8", "surrogatepass"))
                held[slot.path] = digest, n + slot.text.count(" ") + 1
            for path, (digest, n) in held.items():
                yield from out.add(host, False, None, path, digest.intdigest() - (1 << 63), n, size=48)
        yield from out.rest()

    rows = small_batches(pages).select(host_of(F.col("url").cast("string")).alias("host"), F.col("html").cast("string"))
    read_ = rows.mapInArrow(read_pages, "host string, long boolean, wrapper string, slot string, digest long, words long")
    counted = read_.groupBy("host", "long", "wrapper", "slot", "digest").agg(F.count(F.lit(1)).alias("pages"), F.sum("words").alias("words"))
    return stored(counted, "wrappers")


def wrappers(found: DataFrame) -> DataFrame:
    """(host, long, wrapper) for every host of ``measured`` pages; NULL urls are pages of the empty host."""

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        return part[["host", "long"]].head(1).assign(wrapper=infer(part["wrapper"]))

    found = found.where("wrapper is not null").select("host", "long", "wrapper")
    while True:
        kinds = found.groupBy("host", "long").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("wrapper")).alias("bytes"))
        if kinds.filter("n > 1").isEmpty():
            return found
        # a host of many or long streams is dealt to parts of about FAN_IN or PART_BYTES of them, which the next round
        # aligns; parts are half the streams at most, so that some meet
        parts = F.greatest(F.ceil(F.col("n") / FAN_IN), F.least(F.ceil(F.col("bytes") / PART_BYTES), F.ceil(F.col("n") / 2)))
        part = F.pmod(F.xxhash64("wrapper"), parts)
        dealt = found.join(kinds, ["host", "long"]).withColumn("part", part)
        found = stored(dealt.groupBy("host", "long", "part").applyInPandas(merge, "host string, long boolean, wrapper string").distinct(), "wrappers")


def template_slots(found: DataFrame) -> DataFrame:
    """(host, template, longer): the slots that the host's wrapper requires and that hold one text on all pages; for
    ``long`` pages also those that the wrapper of these requires.

    Only for hosts whose pages differ: some slot of prose has ``DIFFERENT`` texts. The array is at most as long
    as the slots of the host's shortest page.
    """

    def required(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(pa.schema([("host", pa.string()), ("long", pa.bool_()), ("slot", pa.string())]))
        for host, long, wrapper in rows_of(batches, "host", "long", "wrapper"):
            for slot in sorted(set(slots_of(load(wrapper)))):
                yield from out.add(host, long, slot)
        yield from out.rest()

    slots = found.where("slot is not null").groupBy("host", "slot")
    slots = slots.agg(F.count(F.lit(1)).alias("texts"), F.sum("pages").alias("pages"), F.sum("words").alias("words"))
    differing = slots.where((F.col("texts") >= DIFFERENT) & (F.col("words") >= PROSE * F.col("pages"))).select("host").distinct()
    same = slots.where((F.col("texts") == 1) & (F.col("pages") >= DIFFERENT)).select("host", "slot")
    needed = wrappers(found).mapInArrow(required, "host string, long boolean, slot string")
    template = same.join(differing, "host", "left_semi").join(needed, ["host", "slot"])
    usual = F.collect_set(F.when(~F.col("long"), F.col("slot")))
    return template.groupBy("host").agg(F.sort_array(usual).alias("template"), F.sort_array(F.collect_set("slot")).alias("longer"))


def blocks_of(page: str | None, template: Collection[str] = ()) -> list[str]:
    """Main text blocks of a page, given its host's template slots.

    Where a page has an article or main element, main text is what stands in one, template text too (an
    article's fixed headings are part of it), but for template text under a name such as ``legal``. Else it is
    what neither the template nor a tag, role or name sets aside. Text of a form around the page is main text if it
    holds prose and nothing else does.
    """
    slots = [s for s in stream(page)[1] if not s.away]
    inside = [s for s in slots if s.main]
    if inside:
        return [s.text for s in inside if not (s.part and s.path in template)]
    slots = [s for s in slots if s.path not in template]
    outside = [s.text for s in slots if not s.form]
    if not outside and any(s.text.count(" ") + 1 >= PROSE for s in slots):
        return [s.text for s in slots]
    return outside


def is_long(page: str | None) -> bool:
    tokens, _ = stream(page)
    return len(tokens) > LONGEST_STREAM and folded(tokens)[1] > LONGEST_STREAM


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    A NULL or empty page, or one without main text, has the empty text. Repeated pages stay repeated. An
    empty table gives an empty result. Extra columns are not looked at.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for page, url, html, template, longer in rows_of(batches, "page_id", "url", "html", "template", "longer"):
            if longer and len(longer) > len(template) and is_long(html):
                template = longer
            text = "\n".join(blocks_of(html, frozenset(template or ())))
            yield from out.add(page, url, text, len(text), size=len(text))
        yield from out.rest()

    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("long"), url.alias("url"), F.col("html").cast("string"), host_of(url).alias("host"))
    found = stored(template_slots(measured(pages)), "templates")
    joined = rows.join(small_side(found), "host", "left").select("page_id", "url", "html", "template", "longer")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
