"""Main text of web pages by line-block distribution.

1. Strip markup: comments, scripts, styles and other raw elements go; containers that are page
   furniture by element, role, whole class name or id (menus, headers, footers, sidebars, notices, adverts,
   forms, reader comments) go with all they hold, unless that is the article or most of the text. Each block element ends a line; each edge of a layout
   container leaves a gap of empty lines as wide as the window.
2. Sum the text lengths over a sliding window of lines. Where the sum rises from zero is a surge point,
   where it falls back to zero a dive point; the lines between are one stretch of text.
3. Keep the stretches of the article: those inside <article> or <main> if the page has one, else all but
   lists of links, each judged by itself.

Within a line white space becomes one space; lines are joined by a newline.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Collection, Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatloom.llm.arrow import slices
from beatloom.llm.shared import text_or_empty

WINDOW = 3
MOST_LINKED = 0.3
FEW_WORDS = 3
LONG_LINE = 8

_RAW = frozenset("script style textarea iframe title xmp noembed noframes".split())
_HIDDEN = frozenset("noscript template svg select head object canvas math audio video".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"""|<(?P<close>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"|</?[a-z][^>]*+>|<[!?][^>]*>",
    re.I | re.S,
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE = frozenset("nav header footer aside form menu dialog button fieldset datalist".split())
_BLOCKS = frozenset(
    "address blockquote caption center dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr li ol p"
    " pre summary table tbody td tfoot th thead tr ul".split()
)
_LAYOUT = frozenset("article body div main section html".split())
# Fixed values of the HTML standard: which elements end others without an end tag.
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
_ENDS_P = (_BLOCKS | _LAYOUT | _FURNITURE | {"dir", "hgroup", "search"}) - frozenset(
    "body html button datalist caption tbody td tfoot th thead tr".split()
)
_SPECIAL = _BLOCKS | _LAYOUT | _FURNITURE | _HIDDEN
_CELLS = frozenset("table td th caption".split())
_P_SCOPE = _CELLS | frozenset("button object template svg math".split())
_ITEM_SCOPE = _SPECIAL - {"address", "div", "p"}
_TABLE = frozenset({"table", "template"})
_ROW = frozenset("td th tr caption".split())
_GROUP = _ROW | {"tbody", "thead", "tfoot"}
_ENDS = {
    **dict.fromkeys(_ENDS_P, (frozenset({"p"}), _P_SCOPE)),
    **dict.fromkeys(("td", "th"), (frozenset({"td", "th", "caption"}), _TABLE)),
    "tr": (_ROW, _TABLE),
    **dict.fromkeys(("tbody", "thead", "tfoot"), (_GROUP, _TABLE)),
    "li": (frozenset({"li"}), _ITEM_SCOPE - {"li"}),
    **dict.fromkeys(("dt", "dd"), (frozenset({"dt", "dd"}), _ITEM_SCOPE - {"dt", "dd"})),
}
_METADATA = frozenset("base link meta title style script noscript template head html".split())
_DRAWN = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
_BREAKS_OUT = _BLOCKS | _LAYOUT | _FURNITURE | frozenset("b big br code em embed i img s small span strong sub sup u".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form menu dialog alert".split())
# Whole class names and ids: a word for furniture, alone or among words that only say where it is or what of it.
_COMMENTS = r"comments?|disqus|respond|responses?"
_WORD = (
    rf"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|menu|nav|navbar|navigation|breadcrumbs?|side-?bar|header|footer"
    rf"|masthead|cookies?|consent|notice|notification|alert|popup|modal|newsletter|subscri\w+|signup|login|share|sharing"
    rf"|social|related|recommend\w*|{_COMMENTS}|widget|pagination|pager|toolbar|skip-?link)"
)
_BESIDE = (
    r"(?:site|page|web|main|global|top|bottom|left|right|upper|lower|inner|outer|primary|secondary|mobile|desktop"
    r"|sticky|floating|gdpr|privacy|user|reader|sub|mini|off|site-?wide|bar|bars|box|boxes|area|section|block|panel|unit"
    r"|slot|zone|container|wrapper|wrap|inner|outer|list|items?|links?|buttons?|icons?|form|field|thread|posts?|articles?"
    r"|stories|media|content|text|title|body|message|overlay|dialog|js|tools?|\d+)"
)
_MARKED = re.compile(rf"(?:{_BESIDE}[_-]+)*{_WORD}(?:[_-]+(?:{_WORD}|{_BESIDE}))*", re.I)
_COMMENTED = re.compile(rf"(?:^|[_-])(?:{_COMMENTS})(?:$|[_-])", re.I)
_WORDS = re.compile(r"\w+")
_SENTENCE_END = re.compile(r"""[.!?…。！？:;]["'”’»)\]]*$""")
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def _is_furniture(name: str, attrs: str, nested: bool = False) -> str:
    """What marks an element as furniture, else an empty string; `nested` is said of an article in another."""
    if name in _FURNITURE:
        return name
    if not attrs or name in ("html", "body", "main") or (name == "article" and not nested):
        return ""
    for key, a, b, c in _ATTR.findall(attrs):
        value = (a or b or c).strip()
        if key.lower() == "role":
            if value.lower() in _ROLES:
                return value
        else:
            for whole in value.split():
                if _MARKED.fullmatch(whole):
                    return whole
    return ""


def _raw_end(html: str, start: int, name: str, single: bool) -> int:
    """Where a raw element ends: after its own end tag, else at the end of the page.

    Without any end tag behind it, one written as an empty element is empty.
    """
    end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, start)
    return end.end() if end else start if single else len(html)


def _plain(parts: list[str]) -> str:
    return " ".join(unescape("".join(parts)).split()) if parts else ""


class _Box(NamedTuple):
    """A furniture element: the one around it (0 is the page), whether it lies in an article or main, and
    whether it holds reader comments."""

    around: int
    within: bool
    comments: bool


class _Lines:
    """Text lines of a page with the share of link text, the number of words outside links, whether they
    are headings, whether the article holds them, and their box."""

    def __init__(self) -> None:
        self.text: list[str] = []
        self.linked: list[int] = []
        self.words: list[int] = []
        self.heading: list[bool] = []
        self.inside: list[bool] = []
        self.box: list[int] = []
        self.boxes = [_Box(0, False, False)]
        self.holders: set[int] = set()  # boxes an article or main begins in
        self._open: list[str] = []
        self._outside: list[str] = []

    def add(self, text: str, in_link: bool) -> None:
        self._open.append(text)
        self._outside.append(" " if in_link else text)

    def end(self, inside: bool, gap: int = 0, box: int = 0, heading: bool = False) -> None:
        line = _plain(self._open)
        if line:
            own = _plain(self._outside)
            links = len(line) - len(own) if " " in self._outside else 0
            self._put(line, links, len(_WORDS.findall(own)), heading, inside, box)
        self._open, self._outside = [], []
        for _ in range(gap):
            self._put("", 0, 0, False, inside, box)

    def _put(self, line: str, links: int, words: int, heading: bool, inside: bool, box: int) -> None:
        self.text.append(line)
        self.linked.append(links)
        self.words.append(words)
        self.heading.append(heading)
        self.inside.append(inside)
        self.box.append(box)

    def drop_furniture(self) -> None:
        """Lines in boxes go, unless a box is only around the article or around most of the text.

        If no article has text outside of boxes, the outermost boxes around articles are none. A box with
        over half of the page's text outside links is none either; beside an article with text of its own
        only if it lies within it, and reader comments only if there is no article at all.
        """
        if len(self.boxes) == 1:
            return
        own = [0] * len(self.boxes)
        for text, links, box in zip(self.text, self.linked, self.box, strict=True):
            own[box] += max(0, len(text) - links)
        held = own[:]
        for i in range(len(held) - 1, 0, -1):
            held[self.boxes[i].around] += held[i]
        article = any(i and t for i, t in zip(self.inside, self.text, strict=True))
        free = any(i and t and not b for i, t, b in zip(self.inside, self.text, self.box, strict=True))
        boxed = [False] + [
            2 * held[i] <= held[0] or (article and self.boxes[i].comments) or (free and not self.boxes[i].within)
            for i in range(1, len(held))
        ]
        while True:
            outermost = [0] * len(held)
            for i in range(1, len(held)):
                outermost[i] = outermost[self.boxes[i].around] or (i if boxed[i] else 0)
            free = any(
                i and t and not outermost[b] for i, t, b in zip(self.inside, self.text, self.box, strict=True)
            )
            around = {outermost[i] for i in self.holders} - {0}
            if free or not article or not around:
                break
            for i in around:
                boxed[i] = False
        kept = [i for i, b in enumerate(self.box) if not outermost[b]]
        for name in ("text", "linked", "words", "heading", "inside", "box"):
            setattr(self, name, [getattr(self, name)[i] for i in kept])


class _Open(NamedTuple):
    name: str
    hidden: bool
    box: int
    own: bool  # whether it is the box itself


class _Tree:
    """The open elements of a page, closed as the HTML standard says where an end tag is left out."""

    def __init__(self, lines: _Lines, window: int) -> None:
        self.lines, self.window = lines, window
        self.stack: list[_Open] = []
        self.count: Counter[str] = Counter()
        self.hidden = 0

    @property
    def inside(self) -> bool:
        return self.count["article"] + self.count["main"] > 0

    @property
    def box(self) -> int:
        return self.stack[-1].box if self.stack else 0

    def end_line(self, gap: bool) -> None:
        if not self.hidden:
            heading = any(self.count[h] for h in _HEADINGS)
            self.lines.end(self.inside, self.window if gap else 0, self.box, heading)

    def open(self, name: str, mark: str = "") -> None:
        box = self.box
        if mark:
            self.lines.boxes.append(_Box(box, self.inside, bool(_COMMENTED.search(mark))))
            box = len(self.lines.boxes) - 1
        elif name == "main" or (name == "article" and not self.count["article"]):
            self.lines.holders.add(box)
        self.stack.append(_Open(name, name in _HIDDEN, box, bool(mark)))
        self.count[name] += 1
        self.hidden += self.stack[-1].hidden

    def close_from(self, at: int) -> None:
        while len(self.stack) > at:
            self._before_close(self.stack[-1])
            self.stack.pop()

    def _before_close(self, e: _Open) -> None:
        if e.own or e.name in _BLOCKS or e.name in _LAYOUT:
            self.end_line(e.own or e.name in _LAYOUT)
        self.count[e.name] -= 1
        self.hidden -= e.hidden

    def find(self, names: Collection[str], barrier: Collection[str]) -> int:
        """The innermost open element of these names that no barrier hides, else -1."""
        if any(self.count[n] for n in names):
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i].name in names:
                    return i
                if self.stack[i].name in barrier:
                    break
        return -1

    def text(self) -> None:
        """Text that is not only white space ends a head."""
        if self.stack and self.stack[-1].name == "head":
            self.close_from(len(self.stack) - 1)

    def foreign(self) -> bool:
        """Whether the innermost text is part of a drawing or formula."""
        at = self.find(("svg", "math"), _DRAWN) if self.count["svg"] or self.count["math"] else -1
        return at >= 0

    def before(self, name: str) -> None:
        """Ends what the start tag of `name` ends."""
        if self.count["head"] and name not in _METADATA:
            self.text()
        if name in _BREAKS_OUT and self.foreign():
            self.close_from(self.find(("svg", "math"), ()))
        names, barrier = _ENDS.get(name, ((), ()))
        while names and (at := self.find(names, barrier)) >= 0:
            self.close_from(at)
        if name in ("li", "dt", "dd") and (at := self.find(("p",), _P_SCOPE)) >= 0:
            self.close_from(at)
        if name in _HEADINGS and self.stack and self.stack[-1].name in _HEADINGS:
            self.close_from(len(self.stack) - 1)
        if name == "a" and (at := self.find(("a",), _CELLS)) >= 0:
            self._without(at)

    def _without(self, at: int) -> None:
        """Closes a formatting element but not the blocks opened in it."""
        if any(e.name in _SPECIAL for e in self.stack[at + 1 :]):
            gone = self.stack[at]
            self._before_close(gone)
            around = self.lines.boxes[gone.box].around if gone.own else gone.box
            self.stack[at:] = [
                e._replace(box=around) if e.box == gone.box else e for e in self.stack[at + 1 :]
            ]
        else:
            self.close_from(at)

    def end(self, name: str) -> None:
        """Ends what the end tag of `name` ends."""
        if name in ("body", "html"):
            if self.count["head"]:
                self.text()
            return
        names: Collection[str] = _HEADINGS if name in _HEADINGS else (name,)
        if name in _CELLS or name in _GROUP:
            barrier: Collection[str] = _TABLE - {name}
        elif name == "p":
            barrier = _P_SCOPE
        elif name in ("li", "dt", "dd"):
            barrier = _CELLS | {"ol", "ul", "dl"}
        elif name in _SPECIAL or name in _FORMATTING:
            barrier = _CELLS
        else:
            barrier = _SPECIAL
        at = self.find(names, barrier)
        if at >= 0 and name in _FORMATTING:
            self._without(at)
        elif at >= 0:
            self.close_from(at)


def page_lines(html: str, window: int = WINDOW) -> _Lines:
    lines, at, link = _Lines(), 0, False
    tree = _Tree(lines, window)
    while True:
        token = _TOKEN.search(html, at)
        stop = token.start() if token else len(html)
        if stop > at:
            if tree.count["head"] and not html[at:stop].isspace():
                tree.text()
            if not tree.hidden:
                lines.add(html[at:stop], link)
        if token is None:
            break
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        closing = bool(token["close"])
        single = name in _VOID or token["attrs"].endswith("/")
        if closing:
            if name in _BLOCKS or name in _LAYOUT:
                tree.end_line(name in _LAYOUT)
            tree.end(name)
            link = link and name != "a"
            continue
        foreign = tree.foreign()
        if name in _RAW and not (foreign and single):
            if tree.count["head"] and name not in _METADATA:
                tree.text()
            at = _raw_end(html, at, name, single)
            continue
        tree.before(name)
        if not tree.hidden:
            mark = _is_furniture(name, token["attrs"], tree.count["article"] > 0)
            if mark:
                tree.end_line(True)
                if not single:
                    tree.open(name, mark)
                continue
            if name == "br":
                lines.add(" ", False)
            elif name == "a":
                link = True
            elif name in _BLOCKS or name in _LAYOUT:
                tree.end_line(name in _LAYOUT)
        if not single and name not in ("html", "body"):
            tree.open(name)
    tree.end_line(False)
    lines.drop_furniture()
    return lines


def stretches(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """[surge, dive) ranges of lines: the window sum is positive throughout, zero before and after."""
    found, start, total = [], None, 0
    for i, n in enumerate(lengths):
        total += n - (lengths[i - window] if i >= window else 0)
        if total and start is None:
            start = i
        elif not total and start is not None:
            found.append((start, i - window + 1))
            start = None
    if start is not None:
        last = max(i for i in range(len(lengths)) if lengths[i])
        found.append((start, last + 1))
    return found


def main_text(html: str | None, window: int = WINDOW) -> str:
    """The article's blocks, one per line; empty for NULL and for pages without text."""
    lines = page_lines(html or "", window)
    lengths = [len(t) for t in lines.text]
    parts = stretches(lengths, window)
    if any(lines.inside[i] and lengths[i] for i in range(len(lengths))):
        kept = [i for lo, hi in parts for i in range(lo, hi) if lines.inside[i]]
    else:
        kept = [i for lo, hi in _prose(lines, lengths, parts) for i in range(lo, hi)]
    return "\n".join(lines.text[i] for i in kept if lines.text[i])


def _prose(lines: _Lines, lengths: list[int], parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """All stretches but lists of links.

    A list of links is a stretch with more than MOST_LINKED of its text in links and no line of prose. It
    stays if it is nothing but headings and what it heads, the next stretch, stays. On a page of nothing else
    the stretch with the most text outside links stays.
    """
    size = {p: sum(lengths[p[0] : p[1]]) for p in parts}
    links = {p: sum(lines.linked[p[0] : p[1]]) for p in parts}
    kept = {
        p: links[p] <= MOST_LINKED * size[p] or any(_is_prose(lines, i) for i in range(*p)) for p in parts
    }
    for p, following in zip(parts[-2::-1], parts[:0:-1], strict=True):
        heads = all(lines.heading[i] for i in range(*p) if lengths[i])
        kept[p] = kept[p] or (heads and kept[following])
    if not any(kept.values()):
        most = max((size[p] - links[p] for p in parts), default=0)
        return [p for p in parts if size[p] - links[p] == most]
    return [p for p in parts if kept[p]]


def _is_prose(lines: _Lines, i: int) -> bool:
    """Whether a line reads as text: a sentence by its end, or words enough that are no links."""
    words, text = lines.words[i], lines.text[i]
    if not words:
        return False
    return words >= (FEW_WORDS if lines.linked[i] else LONG_LINE) or bool(_SENTENCE_END.search(text))


def extract_pages(pages: DataFrame, window: int = WINDOW) -> DataFrame:
    """page_id, url, text and n_chars (code points) for every row.

    NULL and empty html give an empty text; repeated rows are extracted each; other columns are
    ignored; an empty table gives no rows. Elements left open end where the HTML standard ends them, at the
    latest with the element around them; scripts and the like, which it never ends, with the page.
    """
    schema = "page_id long, url string, text string, n_chars long"

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [main_text(h, window) for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), text_or_empty("html").alias("html")
    )
    return rows.mapInArrow(extracted, schema)
