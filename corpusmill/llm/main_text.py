"""Main text of web pages by block rules in two passes.

A page is cut into blocks (the text between block-level tags), each with its
place: inside or outside a container (`article`, `main`), and inside or outside
furniture (menus, forms, scripts, adverts, comments and the like, told by
element, class, id or role). The first pass labels a block good, bad or unclear
by its link density, length and density of stop words. The second lets unclear
blocks inherit the label of the nearest decided block of their region; between
equally near ones that differ a heading goes with what follows; otherwise, and in
a region without decided blocks, a block of a container counts as text and any
other does not.

Pages that are not well formed are read as browsers do: a block-level tag ends
an open paragraph, an end tag closes what stands open inside its element, and
one without a start is ignored. Each page is judged on its own, so the work is
one narrow pass over the table.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINK_DENSITY = 0.2
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.16, 0.30

#: Frequent function words of four languages, without accents folded.
STOP_WORDS = frozenset(
    """
    a an and are as at be been but by can for from had has have he her his i if in into is it its
    not of on one or she so that the their there they this to was we were which who will with you
    aber als am an auch auf aus bei bis das dass dem den der des die ein eine einem einen einer er
    es für hat ich im ist man mit nach nicht noch nur oder sich sie sind so um und von vor war was
    wie wir wird zu zum zur über
    au aux avec ce cette comme dans de des du elle en est et il ils je la le les leur mais ne nous
    on ont ou par pas plus pour qu que qui sa se ses son sont sur un une vous
    al como con de del el ella en entre era es esta este ha la las lo los más me mi no nos o para
    pero por que se ser si sin sobre su sus también un una y ya
    """.split()
)

#: Element names of HTML.
_RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes")
_FURNITURE = frozenset(
    "head nav footer aside form button select option dialog menu object svg math canvas audio video "
    "label input fieldset datalist output progress meter map".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th "
    "thead title tr ul".split()
)
_STRUCTURE = _BLOCKS | _FURNITURE
#: A start of the first ends an open element of the second kind.
_ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    "tbody": ("td", "th", "tr", "tbody", "thead"), "tfoot": ("td", "th", "tr", "tbody", "thead"),
}
_NOT_BEYOND = _FURNITURE | frozenset("ul ol dl table article main section div body".split())
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_AROUND = frozenset("nav header footer form head fieldset".split())

#: Words of class names, ids and roles that mark furniture.
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay disclaimer "
    "sidebar aside menu menubar nav navbar navigation breadcrumb breadcrumbs masthead topbar footer "
    "comment comments disqus reply replies respond share sharing social related recommended "
    "recommendations newsletter subscribe subscription signup login search pagination pager toolbar "
    "widget widgets skip copyright complementary contentinfo hidden".split()
)
_COMMENTS = frozenset("comment comments reply replies disqus respond".split())
_NOT_MARKED = frozenset("with has no without not html body main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)|<[!?][^>]*+(?:>|\Z)"
    # Quotes count after an equals sign only, and only if they are closed.
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|$)", re.I) for name in _RAW}
_WORD = re.compile(r"[^\W\d_]+")
_PARTS = re.compile(r"[^a-z]+")

GOOD, BAD, UNCLEAR = 1, -1, 0
#: An unclosed menu, or a form around the whole page, gives way to an article inside it.
SOFT, HARD = 1, 2


@dataclass(slots=True)
class Block:
    text: str
    linked: int  # characters inside links
    heading: bool
    container: int  # number of the container it lies in, 0 outside all
    furniture: int


def _marked(attributes: str, marks: frozenset[str]) -> bool:
    """Whether class, id or role names furniture, or the element is hidden."""
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id", "role"):
            for word in value.split():
                parts = [p for p in _PARTS.split(word) if p]
                if parts and not _NOT_MARKED.intersection(parts) and (parts[0] in marks or parts[-1] in marks):
                    return True
        elif marks is _MARKS and (
            name == "hidden"
            or (name == "aria-hidden" and value == "true")
            or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
        ):
            return True
    return False


class _Page:
    """The blocks of one page, in page order."""

    def __init__(self, page: str) -> None:
        self.blocks: list[Block] = []
        self.open: list[tuple[str, int, int]] = []  # element, kind of furniture it lies in, container
        self.n_open: dict[str, int] = defaultdict(int)
        self.parts: list[str] = []
        self.linked = self.containers = 0
        self.in_link = False
        self._read(page)
        self._end_block()

    def _place(self) -> tuple[int, int]:
        return self.open[-1][1:] if self.open else (0, 0)

    def _push(self, name: str, furniture: int, container: int) -> None:
        self.open.append((name, furniture, container))
        self.n_open[name] += 1

    def _pop(self, name: str, limits: frozenset[str] = frozenset()) -> None:
        """Close the nearest open element of this name, and what stands open inside it."""
        if not self.n_open[name]:
            return
        i = len(self.open) - 1
        while self.open[i][0] != name:
            if self.open[i][0] in limits:
                return
            i -= 1
        for closed, _, _ in self.open[i:]:
            self.n_open[closed] -= 1
        del self.open[i:]

    def _end_block(self) -> None:
        if not self.parts:
            return
        text = " ".join("".join(self.parts).split())
        if text:
            furniture, container = self._place()
            heading = any(name in _HEADINGS for name, _, _ in self.open[-3:])
            self.blocks.append(Block(text, min(self.linked, len(text)), heading, container, furniture))
        self.parts, self.linked = [], 0

    def _text(self, text: str) -> None:
        if self.open and self.open[-1][1]:
            if self.open[-1][0] not in _STRUCTURE:
                return  # furniture inside a line
            if self.parts or not text.strip():
                return  # that a block is there is enough
        if "&" in text:
            text = html.unescape(text)
        self.parts.append(text)
        if self.in_link:
            self.linked += len(" ".join(text.split()))

    def _start_inline(self, name: str, attributes: str) -> None:
        if name == "br":
            self.parts.append(" ")
        elif name == "a":
            self.in_link = True
        elif name not in _VOID:
            if attributes and _marked(attributes, _MARKS):
                self._push(name, HARD, self._place()[1])
            elif self.n_open[name]:
                self._push(name, *self._place())

    def _start(self, name: str, attributes: str) -> None:
        if name not in _STRUCTURE:
            self._start_inline(name, attributes)
            return
        self._end_block()
        if name in _BLOCKS:
            self._pop("p", _NOT_BEYOND)
            self.in_link = False
        for ended in _ENDS.get(name, ()):
            self._pop(ended, _NOT_BEYOND)
        if name in _VOID:
            return
        furniture, container = self._place()
        if name in ("article", "main"):
            if attributes and _marked(attributes, _COMMENTS):
                furniture = HARD
            elif furniture == SOFT:
                furniture = 0
            if not furniture and not container:
                self.containers += 1
                container = self.containers
        elif name in ("html", "body"):
            furniture = 0
        elif furniture != HARD:
            if name in _AROUND and not (name == "header" and container):
                furniture = SOFT
            elif name in _FURNITURE or (attributes and _marked(attributes, _MARKS)):
                furniture = HARD
        self._push(name, furniture, container)

    def _end(self, name: str) -> None:
        if name == "a":
            self.in_link = False
        if name in _STRUCTURE:
            self._end_block()
        if name not in ("html", "body"):
            self._pop(name)

    def _read(self, page: str) -> None:
        at, end = 0, len(page)
        while at < end:
            found = _TOKEN.search(page, at)
            if not found:
                self._text(page[at:])
                return
            start, stop = found.span()
            if start > at:
                self._text(page[at:start])
            at = stop
            ended, name, attributes = found.groups()
            if not name:
                continue
            name = name.lower()
            if ended:
                self._end(name)
            elif name in _RAW:
                closing = _RAW_END[name].search(page, at)
                at = closing.end() if closing else end
            else:
                self._start(name, attributes)


def _label(block: Block) -> int:
    """The first pass."""
    if block.furniture:
        return BAD
    density = block.linked / len(block.text)
    if density > LINK_DENSITY:
        return BAD
    if len(block.text) < SHORT or block.heading:
        return UNCLEAR
    words = _WORD.findall(block.text.lower())
    stop = sum(map(STOP_WORDS.__contains__, words)) / max(1, len(words))
    if stop >= STOP_HIGH or (stop >= STOP_LOW and len(block.text) >= LONG):
        return GOOD
    return UNCLEAR


def _inherit(labels: list[int], regions: list[int], headings: list[bool]) -> list[int]:
    """The second pass: each unclear block takes the label of the nearest decided one of its region."""
    n, far = len(labels), len(labels) + 1
    before, after, seen = [(far, 0)] * n, [(far, 0)] * n, {}
    for i in range(n):
        if labels[i]:
            seen[regions[i]] = i
        elif regions[i] in seen:
            before[i] = (i - seen[regions[i]], labels[seen[regions[i]]])
    seen = {}
    for i in reversed(range(n)):
        if labels[i]:
            seen[regions[i]] = i
        elif regions[i] in seen:
            after[i] = (seen[regions[i]] - i, labels[seen[regions[i]]])
    out = []
    for label, region, heading, (near, left), (next_, right) in zip(labels, regions, headings, before, after):
        if not label:
            default = GOOD if region else BAD
            if near == next_ and left != right:
                label = right if heading else default
            else:
                label = (left if near <= next_ else right) or default
        out.append(label)
    return out


def main_text(page: str) -> str:
    """The text blocks of a page, one on a line."""
    blocks = _Page(page).blocks
    size = {True: 0, False: 0}
    for b in blocks:
        if not b.furniture:
            size[b.container > 0] += len(b.text)
    inside_only = size[True] > 0 and 2 * size[True] >= size[False]
    # Furniture inside a container is taken out; outside it is a bad neighbour.
    blocks = [b for b in blocks if not (b.furniture and b.container)]
    labels = [BAD if inside_only and not b.container else _label(b) for b in blocks]
    labels = _inherit(labels, [b.container for b in blocks], [b.heading for b in blocks])
    return "\n".join(b.text for b, label in zip(blocks, labels) if label == GOOD)


def extract(table: DataFrame, html_column: str = "html", text: str = "text", size: str = "n_chars") -> DataFrame:
    """The rows of `table` with `text` in place of the html column, and its code points in `size`.

    A null or empty page, and one without any main text, gives an empty text.
    Whole pages are read, whatever their length; a page is held by one task with
    a few times its size in memory. Repeated rows are judged each for itself, an
    empty table gives an empty result, other columns pass unchanged, and those
    named like `text` or `size` (in any case) are replaced.
    """
    taken = {html_column.lower(), text.lower(), size.lower()}
    kept = [c for c in table.columns if c.lower() not in taken]
    rows = table.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html_column}`").cast("string").alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page or "") for page in batch.column(len(kept)).to_pylist()]
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*kept, text])

    found = rows.mapInArrow(run, rows.schema)
    return found.withColumn(size, F.length(text).cast("bigint"))
