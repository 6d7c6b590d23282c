"""Main text of web pages by consensus host paths.

Every page's containers are scored: how much running text lies in elements of
one generalised tag-class path, weighted by what the path's last tag and class
promise and by how little of the text is links. The pages of a host vote on
paths (a page's votes go from 0 to 1000), Spark sums the votes, and every page is
extracted again from the elements on the winning path of its host; a page that
has none uses its own best path. Inside the main elements, menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments are left out, told by tag, role, class or id. What a word of a class or
id says is weighed once the page is read: names that only tell of something
elsewhere (``has-sidebar``, ``no-ads``) or of a part of the article
(``entry-header``) mark nothing; no such word removes ``main``, a passage without
a single link that is called related or, where no ``article`` or ``main`` has text,
the element that holds nearly all of it. Marks of reader comments and consents
yield only if all else is empty.

A page is read in linear time: open tags are counted by name, containers know
their parent, and paths beyond ``LONGEST_PATH`` characters go by a hash.

Text is cut into blocks at block-level tags. In a block, character references
are decoded and white space becomes one space; blocks are joined by line
breaks. A ``br`` is white space.

Defined results: null html is empty; a page without text in any container has
an empty text; a null url belongs to the nameless host; equal votes go to the
deeper, then the larger path; rows that repeat a page vote each; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import arrow, batches, cut, text_of

# Names from the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = set("article blockquote body center details div fieldset figure html main section table tbody td th tr".split())
CLOSED_BY = {  # an open element of the key is closed when one of these begins
    "p": BLOCKS - {"html", "body", "head"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot", "thead"},
    "td": {"td", "th", "tr", "tbody"},
    "th": {"td", "th", "tr", "tbody"},
    "option": {"option", "optgroup"},
    "head": {"body"},
}
FENCES = {"table", "ul", "ol", "dl", "article", "section", "div", "body", "html", "main", "aside"}
# Tags and words of a class, id or role that mark what is not the article.
NOT_MAIN_TAGS = set(
    "aside button datalist dialog footer form head header iframe map menu nav noembed noframes noscript object "
    "script search select style svg template textarea title xmp".split()
)
NOT_MAIN_WORDS = set(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice "
    "notices popup promo promoted recommended related respond sharing share sidebar social sponsor sponsored subscribe "
    "subscription toolbar widget".split()
)
MAIN_WORDS = set("article body content entry main post story text".split())
HEADED_WORDS = set("article entry post story".split())  # a header with one of these holds the headline
# Words before another one in a name, which then tells of the layout.
ELSEWHERE_WORDS = set("has hide hides no not off show shows toggle with without".split())
# Marks of text that may well be longer than the article.
FIRM_WORDS = set("comment comments consent cookie cookies disqus gdpr newsletter respond subscribe subscription".split())
NEARLY_ALL = 5  # an element with this many times the running text of all unmarked ones holds the article
LONGEST_PATH = 512

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*+)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))")
WORDS = re.compile(r"[a-z]+")


class Element:
    __slots__ = ("tag", "above", "path", "depth", "box", "marks", "hard", "firm", "out", "main", "chars", "linked", "links")

    def __init__(self, tag: str, above: Element | None):
        self.tag, self.above = tag, above
        self.path, self.depth, self.box = (above.path, above.depth, above.box) if above else ("", 0, self)
        self.marks: frozenset[str] = frozenset()  # words that speak against it
        self.hard = above is not None and above.hard  # left out by tag
        self.firm = above is not None and above.firm  # a mark here or around holds whatever the length
        self.out = self.main = False
        self.chars = self.linked = self.links = 0


def _marks(attributes: str) -> tuple[list[str], frozenset[str]]:
    """Classes of a start tag, and the words of its class, id and role that speak against it."""
    classes, against = [], set()
    if "=" in attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id", "role"):
                value = unescape("".join(values)).lower()
                if name == "class":
                    classes += value.split()
                for token in value.split():
                    words = WORDS.findall(token)
                    if NOT_MAIN_WORDS.isdisjoint(words) or (len(words) > 1 and words[0] in ELSEWHERE_WORDS):
                        continue
                    against.update(w for w in words if w in NOT_MAIN_WORDS and not (w == "header" and not HEADED_WORDS.isdisjoint(words)))
    return classes, frozenset(against)


class Page:
    """Blocks of one page with the elements they stand in."""

    def __init__(self, html: str):
        self.pieces: list[tuple[str, Element, bool]] = []  # text, innermost element, in a link
        self.blocks: list[tuple[int, int, Element]] = []  # first and last piece, innermost element
        self.begun = 0
        root = Element("", None)
        self.elements, self.stack = [root], [root]
        self.open: Counter[str] = Counter()
        self.places: dict[str, list[int]] = {name: [] for name in CLOSED_BY}
        self.fences: list[int] = []
        self._read(html)
        self._weigh()

    def _flush(self) -> None:
        if self.begun < len(self.pieces):
            self.blocks.append((self.begun, len(self.pieces), self.stack[-1]))
            self.begun = len(self.pieces)

    def _text(self, raw: str) -> None:
        if raw and not self.stack[-1].hard:
            text = unescape(raw) if "&" in raw else raw
            self.pieces.append((text, self.stack[-1], any(e.tag == "a" for e in self.stack[-4:])))

    def _pop(self, depth: int) -> None:
        if any(e.tag in BLOCKS for e in self.stack[depth:]):
            self._flush()
        for element in self.stack[depth:]:
            self.open[element.tag] -= 1
            if element.tag in FENCES:
                self.fences.pop()
            if element.tag in self.places:
                self.places[element.tag].pop()
        del self.stack[depth:]

    def _open(self, tag: str, attributes: str) -> None:
        for name, closers in CLOSED_BY.items():
            if tag in closers and self.places[name] and self.places[name][-1] > (self.fences[-1] if self.fences else 0):
                self._pop(self.places[name][-1])
        if tag in BLOCKS:
            self._flush()
        if tag in VOID:
            if tag == "br":
                self._text(" ")
            return
        above = self.stack[-1]
        element = Element(tag, above)
        classes, against = _marks(attributes)
        element.hard = above.hard or tag in NOT_MAIN_TAGS
        if tag not in ("html", "body", "main", "article"):
            element.marks = against
            element.firm = above.firm or not FIRM_WORDS.isdisjoint(against)
        if tag in CONTAINERS:
            names = sorted({re.sub(r"\d+", "N", c) for c in classes})
            element.path, element.depth, element.box = f"{above.path}/{'.'.join([tag, *names])}", above.depth + 1, element
            if len(element.path) > LONGEST_PATH:
                hashed = hashlib.blake2b(element.path.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
                element.path = f"#{hashed}/{tag}"
        if tag == "a":
            above.links += 1
        if tag in FENCES:
            self.fences.append(len(self.stack))
        if tag in self.places:
            self.places[tag].append(len(self.stack))
        self.open[tag] += 1
        self.stack.append(element)
        self.elements.append(element)

    def _close(self, tag: str) -> None:
        if self.open[tag]:
            depth = len(self.stack) - 1
            while self.stack[depth].tag != tag:
                depth -= 1
            self._pop(depth)
        elif tag in ("p", "br"):
            self._flush()

    def _read(self, html: str) -> None:
        at = 0
        while True:
            m = TAG.search(html, at)
            if m is None:
                break
            self._text(html[at : m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                self._close(tag)
                continue
            attributes = m[3] if m[2] else m[6]
            self._open(tag, attributes)
            if tag in RAW and not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{tag}[\s/>]", re.IGNORECASE).search(html, at)
                at = end.start() if end else len(html)
        self._text(html[at:])
        self._flush()

    def _weigh(self) -> None:
        """Decide which marks hold, and with them which elements are out."""
        marked = [e for e in self.elements if e.marks and not e.hard]
        if marked:
            for text, element, linked in self.pieces:
                element.chars += len(text.strip())
                element.linked += len(text.strip()) if linked else 0
            holds_main = set()
            for e in reversed(self.elements[1:]):  # what an element holds, without marked parts of it
                if e.tag == "main" or e in holds_main:
                    holds_main.add(e.above)
                if not e.marks and not e.hard:
                    e.above.chars, e.above.linked, e.above.links = e.above.chars + e.chars, e.above.linked + e.linked, e.above.links + e.links
            self._rule_out()
            free = self.elements[0].chars - self.elements[0].linked
            settled = any(e.chars and not e.out and e.tag in ("article", "main") for e in self.elements)
            soft = [e for e in marked if not free or not settled and not e.firm]
            most = max(soft, key=lambda e: (not e.firm, e.chars - e.linked), default=None)
            for e in marked:
                running = e.chars - e.linked
                wrapper = e is most and running > NEARLY_ALL * free
                passage = e.marks == {"related"} and running and not e.links
                if e in holds_main or passage:
                    e.marks = frozenset()
                while wrapper and e is not None:  # it is no use to let a part in while the whole is out
                    e.marks, e = frozenset(), e.above
        self._rule_out()

    def _rule_out(self) -> None:
        for e in self.elements:
            e.out = e.hard or bool(e.marks) or (e.above is not None and e.above.out)

    def _block(self, first: int, last: int) -> tuple[str, int]:
        """Text of a block without what is out, and the length of its link text."""
        parts = [p for p in self.pieces[first:last] if not p[1].out]
        return " ".join("".join(p[0] for p in parts).split()), sum(len(text.strip()) for text, _, linked in parts if linked)

    def scores(self) -> dict[str, tuple[float, int]]:
        """Score and depth of every container path with text."""
        held: dict[Element, list[int]] = {}
        for first, last, element in self.blocks:
            text, linked = self._block(first, last)
            if text:
                sums = held.setdefault(element.box, [0, 0])
                sums[0] += len(text)
                sums[1] += linked
        found: dict[str, list] = {}
        for e in reversed(self.elements):
            if e.box is e and e in held:
                chars, linked = held[e]
                sums = found.setdefault(e.path, [0, 0, e.depth])
                sums[0] += chars
                sums[1] += linked
                if e.above is not None:
                    above = held.setdefault(e.above.box, [0, 0])
                    above[0] += chars
                    above[1] += linked
        out = {}
        for path, (chars, linked, depth) in found.items():
            tag, *classes = path.rpartition("/")[2].split(".")
            words = {w for c in classes for w in WORDS.findall(c)}
            promise = 1.0 if tag in ("article", "main") or not MAIN_WORDS.isdisjoint(words) else 0.7 if classes or tag in ("div", "section") else 0.5
            out[path] = (chars * promise * (1 - min(linked / chars, 1.0)), depth)
        return out

    def votes(self) -> list[tuple[str, int, int]]:
        """(path, depth, votes) of the page, its best path getting 1000."""
        scores = self.scores()
        best = max((s for s, _ in scores.values()), default=0.0)
        return [(p, d, round(1000 * s / best)) for p, (s, d) in scores.items() if best > 0 and s > 0]

    def text(self, path: str) -> str:
        """Blocks of the elements on the path, in page order."""
        for e in self.elements:
            e.main = (e.above is not None and e.above.main) or (e.box is e and e.path == path and not e.out)
        return "\n".join(text for first, last, e in self.blocks if e.main and (text := self._block(first, last)[0]))


def extract(html: str, path: str | None) -> str:
    """Main text by the host's path, or by the page's own where the page lacks it."""
    page = Page(html)
    if path is not None and (text := page.text(path)):
        return text
    own = sorted(page.votes(), key=lambda v: (v[2], v[1], v[0]))
    return page.text(own[-1][0]) if own else ""


VOTES = arrow("host string,path string,depth int,votes long")
TEXTS = arrow("page_id long,url string,text string,n_chars long")


def _vote(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        total: dict[tuple[str, str, int], int] = {}
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
            for path, depth, votes in Page(html.as_py()).votes():
                key = (host, path, depth)
                total[key] = total.get(key, 0) + votes
        yield from batches([(*key, n) for key, n in total.items()], VOTES)


def _extract(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        rows = []
        for page_id, url, html, path in zip(
            batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), batch.column("html"), batch.column("path").to_pylist(), strict=True
        ):
            text = extract(html.as_py(), path)
            rows.append((page_id, url, text, len(text)))
        yield from batches(rows, TEXTS)


MOST_HOSTS_SENT = 50_000


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path: the winning path of every host."""
    votes = pages.select(host(F.col("url")).alias("host"), text_of("html").alias("html")).mapInArrow(
        _vote, "host string, path string, depth int, votes long"
    )
    summed = votes.groupBy("host", "path", "depth").agg(F.sum("votes").alias("votes"))
    return summed.groupBy("host").agg(F.max(F.struct("votes", "depth", "path"))["path"].alias("path"))


def host(url: F.Column) -> F.Column:
    """Lower-case host of a url, empty if there is none."""
    found = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return F.lower(found)


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    paths = cut(host_paths(pages))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_of("html").alias("html"), host(F.col("url")).alias("host")
    )
    # few hosts are sent to every task, which leaves the pages where they are; many are joined by a shuffle
    few = paths.count() <= MOST_HOSTS_SENT
    found = rows.join(F.broadcast(paths) if few else paths, "host", "left")
    return found.select("page_id", "url", "html", "path").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
