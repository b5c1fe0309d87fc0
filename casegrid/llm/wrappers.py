"""Main text of web pages by wrappers: union-free regular expressions, inferred by host.

The token streams of a host's pages are aligned one after the other. A wrapper
is a sequence of items, each a tag with the sequence of its content, a text, or a
group; where streams differ, the alignment makes texts into slots, tags that only
some pages have into optional items, and neighbours that come again into repeated
groups - never into alternatives. A sequence that would grow beyond LONGEST items
becomes one repeated group of optional items, which still fits all that it fitted.
Tags within a line (links, emphasis) are no tokens.

An alignment depends on the order of its pages, so that order is fixed by the pages alone: each
page is dealt to a shard of its host by the hash of its content, a shard's pages are folded
in order of that hash, and shards are folded in order, in a tree. What is held is one
wrapper, whose size doesn't grow with the pages; neither the order of rows nor their partitions
change it.

Every page is then read by matching its tokens with the items of its host's wrapper, from left
to right: optional items may be passed over, repeated ones come again. The wrapper says which of
its items hold the article: those marked as such, or else where text varies between the
pages. Items within a marked article are left out only if tag or name say what they are
(a form, comments, an advert); a name that may mean something else counts only if the wrapper
shows the item to be links for the most part, or the same on nearly all pages.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrid.llm.common import staged, with_results
from casegrid.llm.url_filter import host_and_path

LONGEST = 48
PERIOD = 4
SHARD_PAGES = 2048
SHARDS_JOINED = 64
DEEPEST = 100
WIDE, WIDE_READERS = 0.5, 0.8
SEEN = 64
READERS_HELD = 1000
FIXED_SHARE, COPY_SHARE, LINK_SHARE = 0.8, 0.1, 0.6

# HTML's block tags, tags without content, tags whose content is no text.
_BLOCK = frozenset(
    "html body p div section article main nav header footer aside form fieldset ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "h1 h2 h3 h4 h5 h6 hgroup blockquote pre figure figcaption address details summary dialog center menu".split())
_BREAKS = frozenset("br wbr".split())
_RULES = frozenset("hr".split())
_SKIPPED = frozenset("head script style noscript template iframe svg annotation annotation-xml select button textarea title".split())
_IN_HEAD = frozenset("meta link base basefont bgsound noframes html".split()) | _SKIPPED
_RAW = frozenset("script style textarea title".split())
_ENDS = {  # an opening tag ends these, up to the tag that holds them
    "li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}),
}

# What tags and names of classes, ids and roles say about their content.
_OUT_TAGS = frozenset("nav footer aside form dialog menu".split())
_OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "masthead footer sidebar widget widgets cookie cookies consent notice notices notification gdpr popup modal overlay newsletter subscribe "
    "subscription signup comment comments disqus respond reply replies related recommended recommendations share sharing social login search "
    "pagination pager toolbar skip contentinfo complementary".split())
#: Words that leave the meaning of such a name as it is.
_NEUTRAL = frozenset(
    "area bar block body bottom box button buttons container content count feed form group holder inner item items layout left link links list lists media "
    "message more outer panel part post posts reader readers right row section site slot thread title tools top unit user users wrap wrapper".split())
_TOP_OUT = frozenset(["header"])  # only outside the article
_ARTICLE_NAMES = frozenset("article articleBody main".split())
_READERS = frozenset("comment comments disqus respond reply replies".split())  # may hold more text than the article
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_LISTS = frozenset("ul ol table".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>",
    re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")


def _telling(name: str) -> bool:
    return name in _ARTICLE_NAMES or any(w.lower() in _OUT_NAMES or w.lower() in _TOP_OUT for w in _WORD.findall(name))


def _sign(tag: str, attributes: str) -> str:
    """The tag with the names that its attributes carry, in order and without digits; ``!`` marks what isn't shown.

    Of each attribute's names, the first four in alphabetical order count, and all that say something of the content.
    """
    names, hidden = set(), ""
    if attributes.strip():
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), next((v for v in values if v), "")
            if key in ("class", "id", "role", "itemprop"):
                found = sorted({re.sub(r"[\d.!/]+", "", n) for n in value.split()})
                names |= {*found[:4], *(n for n in found[4:] if _telling(n))}
            elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
                hidden = "!"
    return ".".join([tag, *sorted(n for n in names if n)]) + hidden


def tokens(page: str) -> Iterator[tuple[str, str]]:
    """(kind, value): open and close with the sign of a block tag, text, link and unlink around link texts, rule."""
    at, skip = 0, ""
    depth = 0
    head = False  # ends with </head>, any text, or any tag that can't be in it
    while found := _TAG.search(page, at):
        if found.start() > at and not skip:
            between = page[at : found.start()]
            head = head and not between.strip()
            if not head:
                yield "text", between
        at = found.end()
        closing, tag = found[1] or found[4] or "", (found[2] or found[5] or "").lower()
        attributes = found[3] or found[6] or ""
        if not tag:
            continue
        if skip:
            if tag == skip:
                depth += -1 if closing else 1
                skip = skip if depth else ""
            continue
        if tag == "head":
            head = not closing
            continue
        head = head and (bool(closing) or tag in _IN_HEAD)
        if tag in _SKIPPED:
            if closing or attributes.endswith("/"):
                continue
            if tag in _RAW:
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            else:
                skip, depth = tag, 1
        elif tag in _BLOCK or "-" in tag:
            yield ("close", tag) if closing else ("open", _sign(tag, attributes))
        elif tag in _BREAKS:
            yield "text", " "
        elif tag in _RULES:
            yield "rule", ""
        elif tag == "a":
            yield ("unlink" if closing else "link"), ""
    if at < len(page) and not skip:
        yield "text", page[at:]


def _walk(page: str) -> Iterator[tuple[str, str, bool]]:
    """(kind, sign or text, link) of a well-formed stream: every open has its close, texts are blocks of one space.

    Tags that are deeper than DEEPEST aren't given but are counted, so that their
    ends close nothing else; texts in those that are named to be left out are skipped.
    """
    stack: list[str] = []
    deep: list[tuple[str, bool]] = []  # name of a tag beyond, and whether its text is left out
    unseen = 0  # of ``deep``, those left out
    counts: Counter = Counter()  # names in ``stack``
    beyond: Counter = Counter()  # names in ``deep``
    text: list[str] = []
    linked = 0
    in_link = False

    def block() -> Iterator[tuple[str, str, bool]]:
        nonlocal linked
        whole = " ".join(html.unescape("".join(text)).split())
        link = bool(whole) and 2 * linked >= sum(map(len, text))
        text.clear()
        linked = 0
        if whole and not unseen:
            yield "text", whole, link

    def pop() -> str:
        last = stack.pop()
        counts[name(last)] -= 1
        return last

    def rise() -> str:
        nonlocal unseen
        tag, out = deep.pop()
        unseen -= out
        beyond[tag] -= 1
        return tag

    def name(sign: str) -> str:
        return sign.partition(".")[0].rstrip("!")

    for kind, value in tokens(page):
        if kind == "text":
            text.append(value)
            linked += len(value) if in_link else 0
            continue
        if kind in ("link", "unlink"):
            in_link = kind == "link"
            continue
        yield from block()
        in_link = False
        if kind == "open":
            ends, holders = _ENDS.get(name(value), ({"p"}, set()))
            while deep and deep[-1][0] in ends and deep[-1][0] not in holders:
                rise()
            while not deep and stack and name(stack[-1]) in ends and name(stack[-1]) not in holders:
                yield "close", pop(), False
            if len(stack) < DEEPEST:
                stack.append(value)
                counts[name(value)] += 1
                yield "open", value, False
            else:
                out = left_out(value, True) == CERTAIN
                deep.append((name(value), out))
                unseen += out
                beyond[name(value)] += 1
        elif kind == "close" and beyond[value]:
            while rise() != value:
                pass
        elif kind == "close" and counts[value]:
            while deep:
                rise()
            while True:
                last = pop()
                yield "close", last, False
                if name(last) == value:
                    break
    yield from block()
    while stack:
        yield "close", stack.pop(), False


@dataclass
class Item:
    """A tag, a text (``#``) or a group (``()``) of a wrapper, and what its pages have there."""

    sign: str
    items: list[Item] = field(default_factory=list)
    optional: bool = False
    repeated: bool = False
    chars: int = 0
    links: int = 0
    constant: int | None = None  # checksum of a text that has been the same so far
    pages: int = 1  # at least so many have it
    seen: dict[int, tuple[int, int]] = field(default_factory=dict)  # checksum of a text: pages (at least), characters besides links
    number: int = field(default=0, compare=False)  # of the finished wrapper's items, in order

    def key(self) -> tuple:
        return (self.sign, *[k.key() for k in self.items]) if self.sign == "()" else (self.sign,)

    def dump(self) -> list:
        return [self.sign, [k.dump() for k in self.items], int(self.optional), int(self.repeated), self.chars, self.links, self.constant, self.pages,
                [[k, *v] for k, v in self.seen.items()]]

    @staticmethod
    def load(x: list) -> Item:
        return Item(x[0], [Item.load(k) for k in x[1]], bool(x[2]), bool(x[3]), *x[4:8], {k: (n, c) for k, n, c in x[8]})

    def render(self) -> str:
        """The wrapper as a regular expression over tags and texts."""
        inner = " ".join(k.render() for k in self.items)
        if self.sign == "#":
            made = "#text" if self.constant is None else "text"
        else:
            made = f"( {inner} )" if self.sign == "()" else f"<{self.sign}> {inner} </{self.sign}>"
        mark = "*" if self.optional and self.repeated else "?" if self.optional else "+" if self.repeated else ""
        return f"( {made} ){mark}" if mark and self.sign != "()" else made + mark


def _counted(a: dict[int, tuple[int, int]], b: dict[int, tuple[int, int]], apart: bool) -> dict[int, tuple[int, int]]:
    """The two counts in one, which is ``a``; beyond twice ``SEEN`` texts, the most frequent stay."""
    for k, (n, c) in b.items():
        have = a.get(k, (0, 0))[0]
        a[k] = (have + n if apart else max(have, n), c)
    return a if len(a) <= 2 * SEEN else dict(sorted(a.items(), key=lambda x: (-x[1][0], x[0]))[:SEEN])


def _merge(a: Item, b: Item, apart: bool = True) -> Item:
    """``apart``: the two come from different pages."""
    return Item(a.sign, _align(a.items, b.items, apart) if a.sign != "()" else [_merge(x, y, apart) for x, y in zip(a.items, b.items, strict=True)],
                a.optional or b.optional, a.repeated or b.repeated, a.chars + b.chars, a.links + b.links,
                a.constant if a.constant == b.constant else None, a.pages + b.pages if apart else max(a.pages, b.pages),
                _counted(a.seen, b.seen, apart))


def _flat(items: list[Item]) -> Iterator[Item]:
    for x in items:
        if x.sign == "()":
            yield from _flat(x.items)
        else:
            yield x


def _collapse(items: list[Item]) -> list[Item]:
    """Neighbours that come again become repeated items and groups."""
    for period in range(1, PERIOD + 1):
        if len(items) < 2 * period:
            break
        keys = [x.key() for x in items]
        out: list[Item] = []
        i = 0
        while i < len(items):
            unit, j = items[i : i + period], i + period
            while keys[j : j + period] == keys[i : i + period] and len(unit) == period:
                unit = [_merge(x, y, False) for x, y in zip(unit, items[j : j + period], strict=True)]
                j += period
            if j == i + period:
                out.append(items[i])
                i += 1
            elif period == 1:
                unit[0].repeated = True
                out.append(unit[0])
                i = j
            else:
                out.append(Item("()", unit, repeated=True, pages=max(x.pages for x in unit)))
                i = j
        items = out
    if len(items) > LONGEST:
        kinds: dict[tuple, Item] = {}
        for x in _flat(items):
            kinds[x.key()] = _merge(kinds[x.key()], x, False) if x.key() in kinds else x
        for x in kinds.values():
            x.optional = True
        items = [Item("()", list(kinds.values()), repeated=True, pages=max(x.pages for x in kinds.values()))]
    return items


def _align(a: list[Item], b: list[Item], apart: bool = True) -> list[Item]:
    """The longest common subsequence is merged, the rest is optional."""
    ka, kb = [x.key() for x in a], [x.key() for x in b]
    if ka == kb:
        return [_merge(x, y, apart) for x, y in zip(a, b, strict=True)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if ka[i] == kb[j] else max(best[i + 1][j], best[i][j + 1])
    out: list[Item] = []
    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and ka[i] == kb[j]:
            out.append(_merge(a[i], b[j], apart))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            out.append(a[i])
            out[-1].optional = True
            i += 1
        else:
            out.append(b[j])
            out[-1].optional = True
            j += 1
    return _collapse(out)


def page_wrapper(page: str) -> Item:
    """The wrapper of one page."""
    stack = [Item("")]
    for kind, value, link in _walk(page):
        if kind == "open":
            stack.append(Item(value))
        elif kind == "close":
            done = stack.pop()
            done.items = _collapse(done.items)
            stack[-1].items.append(done)
        else:
            of = zlib.crc32(value.encode())
            stack[-1].items.append(Item("#", chars=len(value), links=len(value) * link, constant=of, seen={of: (1, len(value) * (not link))}))
    stack[0].items = _collapse(stack[0].items)
    return stack[0]


CERTAIN, MAYBE = 2, 1


def _tag(sign: str) -> str:
    return sign.partition(".")[0].rstrip("!")


def _names(sign: str) -> list[list[str]]:
    """The words of each name of a sign."""
    return [[w.lower() for w in _WORD.findall(n)] for n in sign.rstrip("!").split(".")[1:]]


def left_out(sign: str, in_article: bool) -> int:
    """Whether tag and names say that the content is none of the article's: 0 no, MAYBE a name has such a word among others, CERTAIN."""
    tag, out = _tag(sign), _OUT_NAMES if in_article else _OUT_NAMES | _TOP_OUT
    if sign.endswith("!") or tag in _OUT_TAGS or not in_article and tag in _TOP_OUT:
        return CERTAIN
    found = 0
    for words in _names(sign):
        if not out.isdisjoint(words):
            found = max(found, CERTAIN if all(w in out or w in _NEUTRAL for w in words) else MAYBE)
    return found


def finished(wrapper: Item) -> Item:
    """The wrapper with its items numbered."""
    count = 0

    def number(x: Item) -> None:
        nonlocal count
        x.number = count
        count += 1
        for k in x.items:
            number(k)

    number(wrapper)
    return wrapper


@dataclass
class _Region:
    """What the pages have in a tag of the wrapper, summed over all below."""

    item: Item
    above: _Region | None
    repeated: bool
    chars: int = 0
    links: int = 0
    same: int = 0  # characters besides links of texts that nearly all pages have there
    inside: list[_Region] = field(default_factory=list)
    share: float = 1.0  # of the text besides links of the pages that have the tag

    @property
    def plain(self) -> int:
        return self.chars - self.links

    @property
    def varied(self) -> int:
        return max(0, self.plain - self.same)

    @property
    def fixed(self) -> bool:
        return self.plain > 0 and self.same >= FIXED_SHARE * self.plain

    @property
    def linked(self) -> bool:
        return self.chars > 0 and self.links > LINK_SHARE * self.chars


def choose(wrapper: Item) -> dict[str, list]:
    """Numbers of the finished wrapper's items: ``take`` hold the article, ``leave`` within them don't belong to it; ``fixed`` are
    [number, checksum] of texts that are the same there on nearly all pages (two at least), in an article that isn't marked.

    The article is in tags that say so (article, else main, or their roles); else
    the walk goes down from the top as long as one tag has four fifths of the text
    that isn't links and varies, and no heading beside it varies. Tags that are left out by name are so if the name is certain, or if it may be
    and the wrapper shows them to be links or fixed. Only outside a marked article, lists and repeated parts that are
    links for the most part are left out without a name, and texts that are fixed, unless they are headings.
    A tag that holds most of the text of its pages that isn't links (``WIDE``; ``WIDE_READERS`` if it is
    named as readers' comments) is around the article, whatever its name, and never left out.
    """
    regions: dict[int, _Region] = {}
    fixed: dict[int, set[int]] = {}

    def collect(region: _Region) -> None:
        pages = region.item.pages
        looped = {id(x) for g in region.item.items if g.sign == "()" for x in _flat(g.items)}
        for x in _flat(region.item.items):
            if x.sign == "#":
                region.chars += x.chars
                region.links += x.links
                for k, (have, size) in x.seen.items():
                    if have > 1 and have >= FIXED_SHARE * pages:
                        fixed.setdefault(x.number, set()).add(k)
                        region.same += have * size
            else:
                below = regions[x.number] = _Region(x, region, x.repeated or id(x) in looped)
                region.inside.append(below)
                collect(below)
                region.chars += below.chars
                region.links += below.links
                region.same += below.same

    root = regions[wrapper.number] = _Region(wrapper, None, False)
    collect(root)
    for r in regions.values():  # in order: what is above comes first
        if r.above is not None:
            around = r.above.plain * r.item.pages / max(1, r.above.item.pages)
            r.share = r.above.share * min(1.0, r.plain / around) if around else 0.0

    def above(r: _Region) -> Iterator[_Region]:
        while r is not None:
            yield r
            r = r.above

    def out(r: _Region, in_article: bool) -> bool:
        sign = r.item.sign
        wide = WIDE_READERS if any(not _READERS.isdisjoint(w) for w in _names(sign)) else WIDE
        said = left_out(sign, in_article)
        return r.share <= wide and (said == CERTAIN or said == MAYBE and (r.linked or r.fixed))

    def marked(tag: str, names: set[str]) -> list[_Region]:
        hits = [r for r in regions.values() if r.chars and (_tag(r.item.sign) == tag or not names.isdisjoint(r.item.sign.rstrip("!").split(".")[1:]))]
        return [r for r in hits if not any(out(q, False) for q in above(r))]

    take = marked("article", {"article", "articleBody"}) or marked("main", {"main"})
    mine = {id(r) for r in take}
    take = [r for r in take if not any(id(q) in mine for q in above(r.above))]
    is_marked = bool(take)
    if not take:
        at = root
        while True:
            kids = [r for r in at.inside if not out(r, False)]
            varies = any(r.varied for r in kids)
            sizes = [r.varied if varies else r.plain for r in kids]
            most = max(range(len(kids)), key=lambda i: (sizes[i], -i), default=None)
            if most is None or not sizes[most] or sizes[most] < 0.8 * sum(sizes) or not kids[most].inside:
                break
            if any(_tag(r.item.sign) in _HEADINGS and r.varied for i, r in enumerate(kids) if i != most):
                break
            at = kids[most]
        take = [at]
    mine = {id(r) for r in take}
    holding = {id(q) for r in take for q in above(r.above)}
    leave, known = [], []

    def sort_out(r: _Region, in_article: bool) -> None:
        for x in _flat(r.item.items):
            if x.sign == "#":
                if not is_marked and _tag(r.item.sign) not in _HEADINGS:
                    known.extend([x.number, k] for k in sorted(fixed.get(x.number, ())))
                continue
            below = regions[x.number]
            listed = not is_marked and below.linked and (_tag(x.sign) in _LISTS or below.repeated and _tag(x.sign) in ("div", "section"))
            if id(below) not in mine and id(below) not in holding and (out(below, in_article) or listed):
                leave.append(x.number)
            else:
                sort_out(below, in_article)

    for r in take:
        sort_out(r, r is not root)
    return {"take": sorted(r.item.number for r in take), "leave": sorted(leave), "fixed": known}


def reading(wrapper: Item) -> bytes:
    """What reading a page needs of the wrapper: its signs, what is repeated, and what is chosen."""

    def shape(x: Item) -> list:
        return [x.sign, int(x.repeated), [shape(k) for k in x.items]]

    return zlib.compress(json.dumps([shape(wrapper), choose(finished(wrapper))], separators=(",", ":")).encode())


class Reader:
    """Reads pages of a host by matching them with its wrapper."""

    def __init__(self, data: bytes):
        def item(x: list) -> Item:
            return Item(x[0], [item(k) for k in x[2]], repeated=bool(x[1]))

        shape, chosen = json.loads(zlib.decompress(data))
        self.wrapper = finished(item(shape))
        self.take, self.leave = frozenset(chosen["take"]), frozenset(chosen["leave"])
        self.fixed = frozenset(map(tuple, chosen["fixed"]))
        self.sequences: dict[int, tuple[list[Item], dict[str, list[int]]]] = {}

    def _sequence(self, item: Item) -> tuple[list[Item], dict[str, list[int]]]:
        """The items of a tag's content, and the places of each sign among them."""
        if item.number not in self.sequences:
            flat = list(_flat(item.items))
            places: dict[str, list[int]] = {}
            for i, x in enumerate(flat):
                places.setdefault(x.sign, []).append(i)
            self.sequences[item.number] = flat, places
        return self.sequences[item.number]

    def _next(self, state: list, sign: str) -> Item | None:
        """The item that the next tag or text fits: the last one again if it is repeated, the next of that sign, or the first if a group
        comes again. ``state`` is [item, place of the last match]."""
        if state[0] is None:
            return None
        flat, places = self._sequence(state[0])
        where = places.get(sign)
        if where is None:
            return None
        last = state[1]
        if not (0 <= last < len(flat) and flat[last].sign == sign and flat[last].repeated):
            state[1] = next((i for i in where if i > last), where[0])
        return flat[state[1]]

    def read(self, page: str) -> str:
        """The blocks of the page that lie in ``take`` and not in ``leave``, joined by an empty line.

        Fixed blocks go, unless hardly any text stays: then the page is itself a copy of most pages.
        """
        stack: list[list] = [[self.wrapper, -1]]
        inside, outside = int(self.wrapper.number in self.take), 0
        blocks, varied = [], []
        for kind, value, _ in _walk(page):
            if kind == "open":
                item = self._next(stack[-1], value)
                stack.append([item, -1])
                if item is not None:
                    inside += item.number in self.take
                    outside += item.number in self.leave
            elif kind == "close":
                item = stack.pop()[0]
                if item is not None:
                    inside -= item.number in self.take
                    outside -= item.number in self.leave
            else:
                item = self._next(stack[-1], "#")
                if inside and not outside:
                    blocks.append(value)
                    if self.fixed and (item is None or (item.number, zlib.crc32(value.encode())) not in self.fixed):
                        varied.append(value)
        if self.fixed and sum(map(len, varied)) >= COPY_SHARE * sum(map(len, blocks)):
            blocks = varied
        return "\n\n".join(blocks)


def _packed(wrapper: Item) -> bytes:
    return json.dumps(wrapper.dump(), separators=(",", ":")).encode()


def _unpacked(data: bytes) -> Item:
    return Item.load(json.loads(data))


def _of_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, shard, spot, html) -> the wrapper of each page."""
    for batch in batches:
        for i in range(0, batch.num_rows, 1000):
            part = batch.slice(i, 1000)
            made = [_packed(page_wrapper(page or "")) for page in part.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in range(3)], pa.array(made, pa.binary())], names=["host", "shard", "spot", "wrapper"])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order of host, shard and spot: one wrapper is held."""
    key, wrapper = None, None

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.string()), pa.array([key[1]], pa.int64()), pa.array([_packed(wrapper)], pa.binary())],
                                          names=["host", "shard", "wrapper"])

    for batch in batches:
        for host, shard, data in zip(*[batch.column(c).to_pylist() for c in ("host", "shard", "wrapper")], strict=True):
            page = _unpacked(data)
            if wrapper is not None and (host, shard) == key:
                wrapper = _merge(wrapper, page)
            else:
                if wrapper is not None:
                    yield made()
                key, wrapper = (host, shard), page
    if wrapper is not None:
        yield made()


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper): the packed wrapper of every host, made from all of its pages."""
    host, page = host_and_path(F.col(url_col).cast("string"))[0], F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(host.alias("host"), F.xxhash64(page).alias("spot"), page.alias("html"))
    most = rows.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    shards = max(1, -(-most // SHARD_PAGES))
    parts = rows.select("host", F.pmod("spot", F.lit(shards)).alias("shard"), "spot", "html").mapInArrow(
        _of_pages, "host string, shard long, spot long, wrapper binary")
    order = ["host", "shard", "spot", "wrapper"]
    while True:
        folded = parts.repartition("host", "shard").sortWithinPartitions(*order).select("host", "shard", "wrapper").mapInArrow(
            _fold, "host string, shard long, wrapper binary")
        if shards == 1:
            return folded.select("host", "wrapper")
        shards = -(-shards // SHARDS_JOINED)
        order = ["host", "shard", "before"]
        parts = folded.select("host", F.pmod("shard", F.lit(shards)).alias("shard"), F.col("shard").alias("before"), "wrapper")


def extract_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Columns ``row`` (the page) and ``main_text``.

    Pages without a host (a null URL, or one without ``://``) share the wrapper of
    the host ``""``; a null page is empty, and a page without text gives an empty
    text. Rows that repeat count as pages of their own. Works on an empty table, and with a single page to a host.
    """

    def decide(wrappers: pa.Array) -> list[pa.Array]:
        return [pa.array([reading(_unpacked(w)) for w in wrappers.to_pylist()], pa.binary())]

    found = with_results(infer_wrappers(pages, url_col, html_col), ["wrapper"], "reading binary", decide)
    readings = staged(found.select("row.host", "reading"), "wrappers")
    placed = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), host_and_path(F.col(url_col).cast("string"))[0].alias("host"))
    joined = placed.join(readings, "host", "left").select("row", "reading")
    place = pages.columns.index(html_col)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, Reader] = {}
        for batch in batches:
            texts = []
            for page, data in zip(batch.column(0).field(place).cast(pa.string()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if data not in known:
                    if len(known) >= READERS_HELD:
                        known.clear()
                    known[data] = Reader(data)
                texts.append(known[data].read(page or ""))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "main_text"])

    return joined.mapInArrow(read, T.StructType([joined.schema["row"], T.StructField("main_text", T.StringType())]))
