"""Main text of web pages from a stream of parser events."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements that hold no article text, void elements, blocks, and what class, id and
#: role say of menus, adverts, notices, forms and reader comments.
UNSEEN = frozenset("script style noscript template button select textarea iframe svg canvas object head title datalist".split())
ASIDE = frozenset("nav footer aside form dialog menu".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
MARKED = frozenset(
    "ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo "
    "promotion recommended related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget".split()
)
#: Inside an article these say nothing of what an element holds: a paragraph in a banner's or an alert's style is its text.
STYLES = frozenset("alert banner copyright recommended social".split())
#: Readers' comments and consent to cookies stay out even where they are most of a page.
NEVER = frozenset("comment comments consent cookie cookies disqus gdpr replies respond".split())
#: Words that say nothing of what an element holds. A name of several words marks it only if all are of these or marked,
#: so that ``site-footer`` does and ``menu-of-the-day`` does not.
NEUTRAL = frozenset(
    "area article articles bar block body bottom box button buttons center column container content count desktop fixed form global group head header "
    "icon icons inner item items label layout left link links list main media message messages mobile next outer page panel policy post posts "
    "previous primary reader readers reading region right row secondary section site slot space sticky stories story strip text this thread title tools "
    "top trail unit user users wrap wrapper zone".split()
)
#: A ``header`` in a name is one of the page, unless one of these says that it is the article's.
OWN_HEADER = frozenset("article content entry post story title".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
_HOLDERS = ("article", "main")
#: Blocks that hold a line or a part of a story; a region is never one of them but what they lie in.
_PARTS = frozenset("address blockquote center dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 header hgroup legend li ol p pre section summary table tbody td tfoot th thead tr ul".split())
_CLOSES_P = BLOCKS - {"br"}
#: Whose end a start tag implies, and what they are closed no further than.
_IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table", "thead", "tbody", "tfoot")),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
}
_P_BARS = tuple("div td th li section article main body table blockquote dd".split())
_INLINE_BARS = tuple("div td th li section article main body nav aside footer header table blockquote".split())
_TABLE_PARTS = frozenset("table caption tbody td tfoot th thead tr".split())
_IN_HEAD = frozenset("base link meta noscript script style template title".split())


def _mark(names: list[str], styles: frozenset[str] = frozenset()) -> int:
    """What class and id tokens say: 0 nothing, 1 a menu, advert or the like, 2 one of ``NEVER``. ``styles`` are words that mark nothing here."""
    out = 0
    for name in names:
        words = {w for w in re.split(r"[^a-z]+", name) if w}
        if words <= MARKED | NEUTRAL and words & (MARKED - styles):
            out = max(out, 2 if words & NEVER else 1)
    return out


class _Element:
    __slots__ = ("tag", "number", "up", "aside", "marked", "holder", "inside", "article", "link", "gone", "held", "text")

    def __init__(self, tag: str, number: int, up: _Element | None, unseen: bool, aside: bool, marked: int, holder: bool) -> None:
        self.tag, self.number, self.up, self.marked, self.holder = tag, number, up, marked, holder
        #: Whether it is, or lies in, an article or main; an article; and a link.
        self.inside = holder or (up is not None and up.inside)
        self.article = (holder and tag == "article") or (up is not None and up.article)
        self.link = tag == "a" or (up is not None and up.link)
        #: Whether it is, or lies in, a menu, footer, form or the like by its tag or role.
        self.aside = aside or (up is not None and up.aside)
        #: Whether it is, or lies in, something that no reader sees, readers' comments or consent to cookies.
        self.gone = unseen or marked > 1 or (up is not None and up.gone)
        #: Characters of the cluster, and of all lines that count, below it.
        self.held = self.text = 0


class _Line:
    __slots__ = ("text", "tags", "links", "at", "ratio", "content", "low")

    def __init__(self, text: str, tags: int, links: int, at: _Element | None) -> None:
        self.text, self.tags, self.links, self.at = text, tags, links, at
        self.ratio, self.content, self.low = 0.0, False, False


class _Lines(HTMLParser):
    """Turns events into lines, one a block of text. Elements know what they lie in; each step is quick however deep it is."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.elements: list[_Element] = []
        self.stack: list[_Element] = []
        self.places: dict[str, list[int]] = defaultdict(list)  # where on the stack a tag is open
        self.text: list[str] = []
        self.tags = self.links = 0

    def flush(self) -> None:
        if self.text:
            words = " ".join("".join(self.text).split())
            if words:
                self.lines.append(_Line(words, self.tags, self.links, self.stack[-1] if self.stack else None))
                self.tags = self.links = 0
            self.text = []

    def _last(self, tags: tuple[str, ...]) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def _end(self, tags: tuple[str, ...], bars: tuple[str, ...] = ()) -> None:
        """Closes the innermost of ``tags``, and what lies in it, unless one of ``bars`` lies between."""
        at = self._last(tags)
        if at < 0 or self._last(bars) > at:
            return
        while len(self.stack) > at:
            if self.stack[-1].marked or self.stack[-1].aside:
                self.flush()
            self.places[self.stack.pop().tag].pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        if self.places.get("head") and tag not in _IN_HEAD and tag != "head":
            self.flush()
            self._end(("head",), ("template",))
        if tag in VOID:
            return
        if tag in _CLOSES_P:
            self._end(("p",), _P_BARS)
        if tag in _IMPLIED:
            self._end(*_IMPLIED[tag])
        up = self.stack[-1] if self.stack else None
        inside, in_article = up is not None and up.inside, up is not None and up.article
        unseen, aside, marked = tag in UNSEEN, tag in ASIDE or (tag == "header" and not inside), 0
        if attrs:
            a = dict(attrs)
            role = (a.get("role") or "").lower()
            unseen = unseen or "hidden" in a or a.get("aria-hidden") == "true"
            aside = aside or (role in ROLES and not (in_article and role in STYLES))
            named = f"{a.get('class') or ''} {a.get('id') or ''}"
            if not named.islower():
                named = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", named).lower()
            parts = set(re.split(r"[^a-z0-9]+", named))
            of_page = "header" in parts and not inside and OWN_HEADER.isdisjoint(parts)
            if tag not in ("html", "body", "main") and (of_page or not MARKED.isdisjoint(parts)):
                marked = max(int(of_page), _mark(named.split(), STYLES if in_article else frozenset()))
        holder = tag in _HOLDERS and not (unseen or aside or marked) and not (up is not None and (up.gone or up.aside))
        if marked or aside:
            self.flush()
        e = _Element(tag, len(self.elements), up, unseen, aside, marked, holder)
        if holder and not inside:  # what wraps an article is no menu, whatever its name
            while up is not None and not up.text:
                up.marked, up.text, up = up.marked & 2, 1, up.up
        self.elements.append(e)
        self.places[tag].append(len(self.stack))
        self.stack.append(e)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS and self.stack and self.stack[-1].tag == tag:
            self._end((tag,))

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        if tag == "p" or tag not in BLOCKS:
            self._end((tag,), _INLINE_BARS)
        elif tag not in VOID:
            self._end((tag,), () if tag in _TABLE_PARTS else ("td", "th"))

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1].tag == "head" and not data.isspace():
            self._end(("head",))
        if self.stack and self.stack[-1].gone:
            return
        self.text.append(data)
        if self.stack and self.stack[-1].link:
            self.links += len(data.strip())


def smoothed(values: list[float], sigma: float) -> list[float]:
    """A Gaussian-weighted mean around each value; weights at the ends add up to one as well."""
    reach = max(1, math.ceil(2 * sigma))
    weights = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        got = total = 0.0
        for d, w in enumerate(weights, i - reach):
            if 0 <= d < len(values):
                got += w * values[d]
                total += w
        out.append(got / total)
    return out


def ratios(lines: list[_Line], beside: list[bool]) -> list[float]:
    """Each line's characters by its tags; of a line that lies ``beside`` the story by name, tag or role none count."""
    return [0.0 if out else len(x.text) / max(1, x.tags) for x, out in zip(lines, beside, strict=True)]


def _cluster(lines: list[_Line], beside: list[bool], sigma: float, part: float) -> None:
    """Says of each line whether it is of the content cluster: smoothed, its ratio is ``part`` of their mean or more.

    Lines without a ratio take part in smoothing, but neither in the mean nor in the cluster.
    """
    values = ratios(lines, beside)
    smooth = smoothed(values, sigma)
    counted = [s for s, v in zip(smooth, values, strict=True) if v > 0]
    limit = part * sum(counted) / max(1, len(counted))
    for x, s, v in zip(lines, smooth, values, strict=True):
        x.ratio, x.content, x.low = v, v > 0 and s >= limit, v < limit


def _beside(elements: list[_Element], lines: list[_Line], named: bool) -> list[bool]:
    """Of each line whether it lies beside the story by tag or role or, if ``named``, by a name."""
    out: list[bool] = []
    for e in elements:
        out.append(e.aside or (named and e.marked > 0) or (e.up is not None and out[e.up.number]))
    return [x.at is not None and out[x.at.number] for x in lines]


def _sum(elements: list[_Element], lines: list[_Line]) -> int:
    """Gives each element the characters of its lines with a ratio, and of those in the cluster; returns the cluster's."""
    for e in elements:
        e.held = e.text = 0
    for x in lines:
        if x.at is not None and x.ratio > 0:
            x.at.text += len(x.text)
            x.at.held += len(x.text) * x.content
    for e in reversed(elements):
        if e.up is not None:
            e.up.held += e.held
            e.up.text += e.text
    return sum(len(x.text) for x in lines if x.content)


def _blank_menus(lines: list[_Line]) -> None:
    """Takes their ratio from menus that have no name: runs of lines of low ratio, three quarters links each, that
    reach out of the cluster. An article's own lists of links are its text.
    """
    run: list[_Line] = []
    for x in [*lines, None]:
        if x is not None and x.low and 4 * x.links >= 3 * len(x.text) and not (x.at is not None and x.at.article):
            run.append(x)
            continue
        if len(run) > 1 and not all(r.content for r in run):
            for r in run:
                r.ratio, r.content = 0.0, False
        run = []


def _main_runs(lines: list[_Line]) -> None:
    """Leaves in the cluster its longest run of lines, and runs that have a quarter of its characters or more."""
    runs: list[list[_Line]] = [[]]
    for x in lines:
        if x.content:
            runs[-1].append(x)
        elif runs[-1]:
            runs.append([])
    sizes = [sum(len(x.text) for x in run) for run in runs]
    for run, n in zip(runs, sizes, strict=True):
        if 4 * n < max(sizes):
            for x in run:
                x.content = False


def _within(x: _Line, regions: set[int], known: dict[int, bool]) -> bool:
    """Whether a line lies in one of the elements ``regions``; ``known`` remembers what was found for elements."""
    path, e = [], x.at
    while e is not None and e.number not in known:
        path.append(e)
        known[e.number] = e.number in regions
        e = None if known[e.number] else e.up
    found = bool(path and known[path[-1].number]) or (e is not None and known[e.number])
    for p in path:
        known[p.number] = found
    return found


def _regions(elements: list[_Element], lines: list[_Line], total: int) -> set[int] | None:
    """The elements that hold the content; none for the whole page.

    The cluster chooses: the innermost container around its first line with nine tenths of its text. Tags
    settle what that leaves open: articles in it that hold as much together are taken instead, or else the
    article or main that it lies in.
    """
    e = next(x for x in lines if x.content).at
    while e is not None and not (e.tag in BLOCKS - _PARTS and 10 * e.held >= 9 * total):
        e = e.up
    chosen = e
    over = set()
    while e is not None:
        over.add(e.number)
        e = e.up
    below = [chosen is None] * len(elements)
    holders = []
    for e in elements:
        below[e.number] = below[e.number] or e is chosen or (e.up is not None and below[e.up.number])
        if e.holder and e.held and below[e.number]:
            holders.append(e)
    if holders:
        # Of equals the inner one, then the first. Others beside it belong to it if half of their own text is of the cluster.
        best = min(holders, key=lambda e: (-e.held, e.text, e.number))
        found, held = {best.number}, best.held
        above, e = set(), best.up
        while e is not None:
            above.add(e.number)
            e = e.up
        inner = [False] * len(elements)
        for e in elements:
            inner[e.number] = e.number in found or (e.up is not None and inner[e.up.number])
            if e.holder and below[e.number] and not inner[e.number] and e.number not in above and e.text and 2 * e.held >= e.text:
                found.add(e.number)
                held += e.held
                inner[e.number] = True
        if 10 * held >= 9 * total:
            return found
    around = max((e for e in elements if e.holder and e.number in over), key=lambda e: e.number, default=chosen)
    return None if around is None else {around.number}


def main_text(html: str | None, sigma: float = 1.0, part: float = 0.5) -> str:
    """The article of a page; empty where there is none.

    Each line, a block of text, has a text-to-tag ratio; characters of menus, headers and footers of the page, sidebars, adverts,
    notices and forms, as their tags, roles and names say, count as none. Ratios are smoothed, and lines
    at or over ``part`` of their mean form the content cluster. Its main runs choose the regions (``_regions``), of which
    all lines are taken that are of the cluster or have a ratio, short ones too. Outside articles, runs of links that
    reach out of the cluster are menus without a name. What only a name marks counts if it holds lines with over half of the
    cluster's text, no article stands beside it: no menu is most of a page. Hidden elements, readers' comments and consent
    to cookies are not read. End tags that may be left out are implied. Time and memory grow with the page's length,
    whatever is left open.
    """
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    elements, lines = parser.elements, parser.lines
    if any(e.marked == 1 for e in elements):
        _cluster(lines, _beside(elements, lines, False), sigma, part)
        total = _sum(elements, lines)
        article = any(e.holder and e.text for e in elements)
        several = [0] * len(elements)
        for x in lines:
            if x.content and x.at is not None:
                several[x.at.number] += 1
        for e in reversed(elements):
            if e.up is not None:
                several[e.up.number] += several[e.number]
            if e.marked == 1 and 2 * e.held > total and several[e.number] > 1 and (e.inside or not article):
                e.marked, e.holder = 0, e.tag in _HOLDERS
    _cluster(lines, _beside(elements, lines, True), sigma, part)
    _blank_menus(lines)
    _main_runs(lines)
    total = _sum(elements, lines)
    if not total:
        return ""
    regions = _regions(elements, lines, total)
    known: dict[int, bool] = {}
    return " ".join(x.text for x in lines if (x.content or x.ratio > 0) and (regions is None or _within(x, regions, known)))


def extract(pages: DataFrame) -> DataFrame:
    """A row per page: page_id, url, text, n_chars (code points).

    Null and empty html give an empty text. Broken markup is read as the parser reads it: what is
    left open ends with its parent. Pages are taken one by one, so repeated rows give equal results
    and an empty table none; columns besides page_id, url and html are unread.
    """
    kinds = dict(pages.dtypes)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(each, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
