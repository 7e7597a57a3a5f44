"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides a block by where it stands, its link density, its
length and its share of stop words; short blocks and blocks of a middling share stay open. On a page whose blocks show
few stop words of any listed language, length alone counts in their place. In the second pass an open block takes the
label of its nearest decided neighbours.

Elements of the page's frame hold no article. A class or an id only suggests a frame: it does not count on an element that
is or holds an ``article`` or ``main``, nor on one without which next to nothing of the page is left, unless it names
comments. A page without any good block keeps its short sentences.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "a about after all also an and are as at be been but by can for from had has have he her his i if in into is it its "
    "more not of on one or she so that the their there they this to up was we were what when which who will with you "
    "aber als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich "
    "ihr im in ist mit nach nicht noch nur oder sein sich sie sind so über um und uns unter von vor war was wenn werden "
    "wie wir wird zu zum zur au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur lui "
    "mais ne nous on ou par pas plus pour qu que qui sa se ses son sont sur un une vous y al como con de del el ella en "
    "entre era es esta este fue ha hay la las lo los más me mi muy no nos o para pero por que se ser si sin sobre su sus "
    "también un una uno y ya".split()
)
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
SILENT_TAGS = frozenset("script style noscript template title head textarea select button svg iframe object canvas audio video datalist".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never hold the article, and those that do.
FRAME_TAGS = frozenset("nav footer aside form dialog menu".split())
MAIN_TAGS = frozenset("article main".split())
FRAME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
#: Words in a class or id that mark what is no article, anywhere and outside of the main element.
FRAME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs sidebar comment comments commentlist "
    "reply replies disqus respond share sharing social related recommended newsletter subscribe subscription signup login "
    "widget pagination pager footer".split()
)
#: Those that mark readers' comments, however much of the page these are.
COMMENT_WORDS = frozenset("comment comments commentlist reply replies disqus respond".split())
OUTER_WORDS = frozenset("header masthead topbar toolbar search alert legal copyright tags meta".split())
SENTENCE_ENDS = (".", "!", "?", "…", "。", "！", "？", '."', '!"', '?"', ".”", "!”", "?”", ".»", ".“")
SHORT, LONG = 70, 200
#: A suggested frame holds nearly the whole page if this share of what its blocks would give is not found without it.
WHOLE_PAGE = 0.2
LOW_STOPS, HIGH_STOPS = 0.2, 0.3
LINKS, MAIN_LINKS = 0.2, 0.5

_WORD = re.compile(r"[^\W\d_]+")


#: Start tags that end an open element, and elements beyond which they do not reach.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
HOLDERS = {"p": BLOCK_TAGS - {"p"}, "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
_END_OPTIONAL = frozenset(ENDS) | {"h1", "h2", "h3", "h4", "h5", "h6"}


class Block(NamedTuple):
    """Text, characters in links, in a frame element?, in a main element?, heading?, and the elements whose class suggests a frame."""

    text: str
    links: int
    frame: bool
    main: bool
    heading: bool
    marks: tuple[int, ...] = ()


class _Open(NamedTuple):
    tag: str
    frame: bool
    main: bool
    silent: bool
    marks: tuple[int, ...]


class _Blocks(HTMLParser):
    """Collects the blocks of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[_Open] = []
        self.comments: list[bool] = []  # of each mark
        self.holders: set[int] = set()  # marks that are or hold a main element
        self.parts: list[str] = []
        self.links = 0
        self.in_link = self.heading = False
        self.breaks = 0

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Marked sections are no HTML: one ends at the next >, or with the page."""
        end = self.rawdata.find(">", i + 3)
        return end + 1 if end >= 0 else len(self.rawdata)

    def state(self) -> _Open:
        return self.open[-1] if self.open else _Open("", False, False, False, ())

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            now = self.state()
            self.blocks.append(Block(text, self.links, now.frame, now.main, self.heading, now.marks))
        self.parts, self.links, self.breaks, self.heading = [], 0, 0, False

    @staticmethod
    def words(attrs: list[tuple[str, str | None]], inside: bool) -> set[str]:
        """The words of a class or an id that suggest a frame."""
        given = {k: v or "" for k, v in attrs}
        named = set(re.split(r"[^a-z0-9]+", f"{given.get('class', '')} {given.get('id', '')}".lower()))
        return named & (FRAME_WORDS if inside else FRAME_WORDS | OUTER_WORDS)

    @staticmethod
    def is_frame(attrs: list[tuple[str, str | None]]) -> bool:
        given = {k: v or "" for k, v in attrs}
        return given.get("role", "").lower() in FRAME_ROLES or "hidden" in given or given.get("aria-hidden") == "true"

    def end_implied(self, tag: str) -> None:
        """Close what the start of ``tag`` ends."""
        group = tag if tag in ENDS else "p" if tag in BLOCK_TAGS else None
        if group is None:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag in ENDS[group]:
                del self.open[i:]
                return
            if self.open[i].tag in HOLDERS[group]:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
            self.in_link = False
        elif tag == "br":
            self.breaks += 1
            self.parts.append(" ")
            if self.breaks > 1:
                self.flush()
        elif tag in ("td", "th", "img", "input"):
            self.parts.append(" ")
        if tag == "a":
            self.in_link = True
        if tag in VOID_TAGS:
            return
        if tag in ("body", "html"):
            self.open = [x for x in self.open if x.tag != "head"] if tag == "body" else self.open
            attrs = []
        self.end_implied(tag)
        now = self.state()
        inside = now.main or tag in MAIN_TAGS
        if tag in MAIN_TAGS:
            self.holders.update(now.marks)
        framed = bool(attrs) and self.is_frame(attrs)
        named = self.words(attrs, inside) if attrs and tag not in MAIN_TAGS else set()
        self.heading = tag[0] == "h" and tag[1:].isdigit()
        if tag in _END_OPTIONAL and not (framed or named):
            return
        if framed or named or tag in BLOCK_TAGS or tag in SILENT_TAGS:
            if tag not in BLOCK_TAGS and (framed or named):
                self.flush()
            marks = now.marks
            if named:
                marks = (*marks, len(self.comments))
                self.comments.append(bool(named & COMMENT_WORDS))
            frame = now.frame or framed or tag in FRAME_TAGS or tag == "header" and not inside
            self.open.append(_Open(tag, frame, inside, now.silent or tag in SILENT_TAGS, marks))

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        held = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i].tag == tag), None)
        if tag in BLOCK_TAGS or held is not None and tag not in SILENT_TAGS:
            self.flush()
        if held is not None:
            del self.open[held:]

    def handle_data(self, data: str) -> None:
        if self.state().silent:
            return
        self.parts.append(data)
        if not data.isspace():
            self.breaks = 0
            if self.in_link:
                self.links += len("".join(data.split()))


def _first_pass(block: Block) -> str:
    """good, bad, or open as near (middling), low (few stop words), short or head (a heading)."""
    text = block.text
    density = block.links / max(1, len(text.replace(" ", "")))
    if block.frame or density > (MAIN_LINKS if block.main else LINKS):
        return "bad"
    if block.main:
        return "good"
    if block.heading or len(text) < SHORT:
        return "bad" if block.links else "head" if block.heading else "short"
    stops, words = _stops(text)
    if stops >= HIGH_STOPS * max(1, words):
        return "good" if len(text) > LONG else "near"
    return "near" if stops >= LOW_STOPS * max(1, words) else "low"


def _stops(text: str) -> tuple[int, int]:
    """Stop words and words of a text."""
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words), len(words)


def _first_labels(blocks: list[Block]) -> list[str]:
    """The first pass over a page. If no listed language is told by it, stop words do not count. If no block is good then
    either, those of a middling share are, or else short sentences."""
    labels = [_first_pass(b) for b in blocks]
    if "good" in labels:
        return labels
    open_ = [i for i, b in enumerate(blocks) if not (b.frame or b.heading) and b.links <= LINKS * len(b.text.replace(" ", ""))]
    long = [i for i in open_ if len(blocks[i].text) >= SHORT]
    counts = [_stops(blocks[i].text) for i in long]
    if sum(c[0] for c in counts) < LOW_STOPS * sum(c[1] for c in counts):
        for i in long:
            labels[i] = "good" if len(blocks[i].text) > LONG else "near"
    if "good" not in labels:
        labels = ["good" if x == "near" else x for x in labels]
    if "good" not in labels:
        for i in open_:
            if not blocks[i].links and blocks[i].text.endswith(SENTENCE_ENDS):
                labels[i] = "good"
    return labels


def _second_pass(labels: list[str]) -> list[bool]:
    """Open blocks inherit: of unlike neighbours the nearer one counts, and when equally near, a near block is good. A
    heading takes the label of what follows it, and a low block is good between good ones only."""
    n = len(labels)
    before, after, last = [None] * n, [None] * n, None
    for i in range(n):
        before[i] = last
        last = i if labels[i] in ("good", "bad") else last
    last = None
    for i in range(n - 1, -1, -1):
        after[i] = last
        last = i if labels[i] in ("good", "bad") else last
    out = []
    for i, label in enumerate(labels):
        if label in ("good", "bad"):
            out.append(label == "good")
            continue
        a, b = before[i], after[i]
        if label == "low":
            out.append(a is not None and b is not None and labels[a] == labels[b] == "good")
        elif a is None or b is None:
            near = b if a is None else a
            out.append(label == "near" if near is None else labels[near] == "good")
        elif label == "head":
            out.append(labels[b] == "good")
        elif labels[a] == labels[b] or i - a != b - i:
            out.append(labels[a if i - a <= b - i else b] == "good")
        else:
            out.append(label == "near")
    return out


def _kept(blocks: list[Block], marks: set[int]) -> list[str]:
    """The texts that both passes keep when ``marks`` are frames."""
    settled = [b._replace(frame=b.frame or not marks.isdisjoint(b.marks)) for b in blocks]
    kept = _second_pass(_first_labels(settled))
    return [b.text for b, keep in zip(settled, kept, strict=True) if keep]


def main_text(html: str) -> str:
    """The article's blocks, joined by newlines; empty if there are none. Any string will do."""
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    marks = set(range(len(parser.comments))) - parser.holders
    kept = _kept(parser.blocks, marks)
    loose = {m for m in marks if not parser.comments[m]}
    if loose:
        # The largest of the others may be the page itself.
        sizes = {m: sum(len(b.text) for b in parser.blocks if m in b.marks and not b.frame) for m in loose}
        largest = max(sizes, key=lambda m: (sizes[m], -m))
        around = {m for m in loose if sizes[m] == sizes[largest]}
        other = _kept(parser.blocks, marks - around) if sum(map(len, kept)) < WHOLE_PAGE * sizes[largest] else kept
        kept = other if sum(map(len, kept)) < WHOLE_PAGE * sum(map(len, other)) else kept
    return "\n".join(kept)


def extract(pages: DataFrame, html_column: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``pages`` without the html column, with ``text`` and ``n_chars`` (code points), one row per page in one scan.

    A null or empty page has an empty text; repeated rows give repeated rows; an empty table gives no rows. Other columns
    stay; ``text`` and ``n_chars`` replace columns of those names, whatever their case.
    """
    import pyarrow as pa

    kept = [c for c in pages.columns if c.lower() not in (html_column.lower(), text.lower(), n_chars.lower())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(h.as_py() or "") for h in batch.column(html_column)]
            columns = [*[batch.column(c) for c in kept], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, text, n_chars])

    plain = [F.col(f"`{c}`") for c in kept]
    picked = pages.select(*plain, F.col(f"`{html_column}`").cast("string").alias(html_column))
    return picked.mapInArrow(run, pages.select(*plain).schema.add(text, "string").add(n_chars, "long"))
