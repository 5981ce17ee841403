"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with the path of the elements around it. Text length, punctuation and link
text are summed per path; a path's ratio fuses text and punctuation per block and the share of text outside links. The
ratios of the blocks in page order are smoothed, and blocks above the threshold are content. The innermost element that
holds all content is the article; its blocks, and a title before it, are the main text, less what elements name as something
else.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML and words that name parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr img br".split()
)
NOT_TEXT = frozenset("head script style noscript template iframe object svg math canvas audio video map select option datalist textarea button input form nav footer aside dialog menu title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
CLOSED_BY_SIBLING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HOLDERS = frozenset("html body main article section div td table tbody tr center".split())
OTHER_PARTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget widgets footer header masthead topbar toolbar comment comments disqus respond replies share sharing social related recommended recommendations login search copyright pagination pager skip".split()
)
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
PUNCTUATION = re.compile(r"[.,;:!?、。，！？]")


@dataclass
class _Element:
    tag: str
    label: str
    number: int
    other: bool
    inline: bool


@dataclass
class TextBlock:
    """A block: its text, the elements around it, their labels, the length of its link text, and whether it is named as something else."""

    text: str
    chain: tuple[int, ...]
    tags: tuple[str, ...]
    path: tuple[str, ...]
    linked: int
    other: bool


@dataclass
class _Open:
    parts: list[str] = field(default_factory=list)
    linked: int = 0


def _names_other_part(tag: str, attributes: dict[str, str | None], inside: list[_Element]) -> bool:
    if tag in NOT_TEXT or "hidden" in attributes or (attributes.get("aria-hidden") or "").lower() == "true":
        return True
    if tag == "header" and not any(e.tag in ("article", "main") for e in inside):
        return True
    if (attributes.get("role") or "").lower() in OTHER_ROLES or re.search(r"display\s*:\s*none", attributes.get("style") or "", re.I):
        return True
    if tag in ("html", "body", "article", "main") or tag in HEADINGS:
        return False
    names = " ".join(filter(None, (attributes.get("class"), attributes.get("id"))))
    words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", names).lower())
    return any(w in OTHER_PARTS for w in words)


class _Blocks(HTMLParser):
    """Collects the text blocks of a page; end tags may be missing where HTML lets them, or at all."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[_Element] = []
        self.blocks: list[TextBlock] = []
        self.current = _Open()
        self.number = 0

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.current.parts.append(" ")
            return
        if tag not in INLINE:
            self.end_block()
        if tag in VOID:
            return
        if tag in CLOSES_P:
            self.close_element("p", CLOSES_P - {"p"} | {"td", "th", "li"})
        for sibling in CLOSED_BY_SIBLING.get(tag, ()):
            self.close_element(sibling, frozenset(("ul", "ol", "dl", "table", "menu", "select")))
        if tag == "body":
            self.close_element("head", frozenset())
        attributes = dict(attrs)
        self.number += 1
        names = re.sub(r"[^a-z ]+", "", (attributes.get("class") or "").lower())
        label = ".".join([tag, *sorted(set(names.split()))])
        self.open.append(_Element(tag, label, self.number, _names_other_part(tag, attributes, self.open), tag in INLINE))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in INLINE:
            for i in range(len(self.open) - 1, -1, -1):
                if not self.open[i].inline:
                    return
                if self.open[i].tag == tag:
                    del self.open[i]
                    return
            return
        self.end_block()
        self.close_element(tag, frozenset())

    def finish(self):
        super().close()
        self.end_block()

    def close_element(self, tag: str, barriers: frozenset[str]):
        """Close the innermost ``tag`` with all in it, unless one of ``barriers`` is in between."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                self.end_block()
                del self.open[i:]
                return
            if self.open[i].tag in barriers:
                return

    def handle_data(self, data):
        if any(e.inline and e.other for e in self.open):
            return
        self.current.parts.append(data)
        if any(e.tag == "a" for e in self.open):
            self.current.linked += len("".join(data.split()))

    def end_block(self):
        text = " ".join("".join(self.current.parts).split())
        linked, self.current = self.current.linked, _Open()
        if text:
            around = [e for e in self.open if not e.inline]
            chain, tags, path = (tuple(getattr(e, name) for e in around) for name in ("number", "tag", "label"))
            self.blocks.append(TextBlock(text, chain, tags, path, linked, any(e.other for e in around)))


def text_blocks(html: str) -> list[TextBlock]:
    """The blocks of a page in order; character references are decoded, white space inside is one space."""
    parser = _Blocks()
    parser.feed(html)
    parser.finish()
    return parser.blocks


def path_ratios(found: list[TextBlock]) -> np.ndarray:
    """For each block the fused ratio of its path."""
    sums: dict[tuple[str, ...], list[float]] = {}
    for b in found:
        total = sums.setdefault(b.path, [0.0] * 4)
        length = len(b.text.replace(" ", ""))
        for i, x in enumerate((1, length, len(PUNCTUATION.findall(b.text)), min(b.linked, length))):
            total[i] += x
    ratios = {path: (length / n) * (1 + marks / n) * (1 - linked / max(length, 1)) for path, (n, length, marks, linked) in sums.items()}
    return np.array([0.0 if b.other else ratios[b.path] for b in found])


def smoothed(values: np.ndarray, radius: int = 2) -> np.ndarray:
    """Gaussian means over the neighbouring blocks."""
    offsets = np.arange(-radius, radius + 1)
    kernel = np.exp(-(offsets**2) / 2.0)
    weights = np.convolve(np.ones(len(values)), kernel, "same")
    return np.convolve(values, kernel, "same")[: len(values)] / weights[: len(values)] if len(values) > 2 * radius else values


def _with_neighbours(found: list[TextBlock], content: np.ndarray) -> np.ndarray:
    """Content and the paragraphs next to it, however short; only headings may stand between, no bound of an article or the main element."""
    grown = content.copy()
    for order in (range(len(found)), range(len(found) - 1, -1, -1)):
        last = None
        for i in order:
            b = found[i]
            around = [n for n, tag in zip(b.chain, b.tags, strict=True) if tag in ("article", "main")]
            paragraph = b.tags[-1:] == ("p",) and b.linked <= 0.5 * len(b.text.replace(" ", ""))
            if content[i]:
                last = around
            elif b.other or around != last or not (paragraph or b.tags and b.tags[-1] in HEADINGS):
                last = None
            elif paragraph:
                grown[i] = True
    return grown


def _article(found: list[TextBlock], content: np.ndarray) -> tuple[int, ...]:
    """Numbers of the elements down to the innermost that holds all content; an article or the main element is not gone into."""
    blocks = [found[i] for i in np.flatnonzero(content)]
    depth = 0
    while all(len(b.chain) > depth and b.chain[depth] == blocks[0].chain[depth] for b in blocks) and blocks[0].tags[depth] in HOLDERS:
        depth += 1
    tags = blocks[0].tags[:depth]
    for whole in ("article", "main"):
        if whole in tags:
            return blocks[0].chain[: tags.index(whole) + 1]
    return blocks[0].chain[:depth]


def _title(found: list[TextBlock], content: np.ndarray, inside: list[bool]) -> int:
    """The first block of the headings before the article that head it, or the article's first block if it has its own."""

    def rank(b: TextBlock) -> str:
        return b.tags[-1] if b.tags and b.tags[-1] in HEADINGS and not b.other else ""

    first = inside.index(True)
    own = next(filter(None, map(rank, found[first : int(np.argmax(content))])), "h9")
    title = next((i for i in range(first - 1, -1, -1) if rank(found[i])), None)
    if title is None or rank(found[title]) >= own:
        return first
    while title and rank(found[title - 1]) and found[title - 1].chain[:-1] == found[title].chain[:-1]:
        title -= 1
    return title


def main_text(html: str | None) -> str:
    """The blocks of the article, joined by newlines."""
    found = text_blocks(html or "")
    ratios = path_ratios(found)
    if not len(ratios) or ratios.max() <= 0:
        return ""
    own = (ratios > 0) & (smoothed(ratios) > 0)
    content = own & ((smoothed(ratios) >= ratios.std()) | (ratios >= ratios.std()))
    if not content.any():
        return ""
    content = _with_neighbours(found, content)
    article = _article(found, content)
    inside = [b.chain[: len(article)] == article for b in found]
    first, title = inside.index(True), _title(found, content, inside)
    passing = {b.path for b, ok in zip(found, content, strict=True) if ok}
    named = found[int(np.argmax(content))].tags[: len(article)][-1:] not in ((), ("html",), ("body",))
    # where no element holds all content, an article or the main element that has some is still kept as a whole
    wholes = {n for b, ok in zip(found, content, strict=True) if ok for n, tag in zip(b.chain, b.tags, strict=True) if tag in ("article", "main")}
    texts = []
    for i, b in enumerate(found):
        if b.other or not (inside[i] or title <= i < first):
            continue
        whole = named or not wholes.isdisjoint(b.chain)
        in_header = "header" in b.tags and b.tags[-1] not in HEADINGS
        linked = b.linked > 0.5 * len(b.text.replace(" ", "")) and b.path not in passing and not (whole and inside[i])
        if not in_header and not linked and (whole or b.path in passing or b.tags[-1:] and b.tags[-1] in HEADINGS):
            texts.append(b.text)
    return "\n".join(texts)


def _main_pass(batches):
    for batch in batches:
        texts = [main_text(html) for html in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["page", "text"])


def extract_main_text(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """``(page, text)`` of every row of ``pages``; ``page`` has its ``keep`` columns.

    A null page, and one without content, has the empty text. Nothing of the article is cut off or capped.
    """
    rows = pages.select(F.struct(*keep).alias("page"), F.col(html_col).alias("html"))
    return rows.mapInArrow(_main_pass, rows.select("page").schema.add("text", "string"))
