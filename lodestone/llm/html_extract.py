"""Main-text extraction from HTML by two-pass block rules.

A page is cut into blocks at block-level tags; each block knows its text, its words inside links, its stop
words, and the structural region it stands in.

Pass one looks at each block by itself. Boilerplate regions (menus, headers, footers, sidebars, forms,
adverts, notices, reader comments) are bad by their markup. Of every other block, inside an article or
not, stop-word density, length and link density decide: long running text is good, link lists and copyright
lines are bad, and what the figures leave open is near-good, short or linked.

Pass two gives each open block the label of its nearest decided neighbour, counted in blocks; at equal
distance the longer neighbour decides. Neighbours are those of the same article, so that a menu or a footer
beside it has no say inside; a run of open blocks without any decided neighbour takes the region's own
label (good in an article, and for the longer ones on a page without any).

Tags are read as browsers do: a quote opens a value only right after ``=``. A value whose closing quote is
missing ends with its tag. One pass over the pages; nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_text

# A closing quote that stands right after "=" opens the next value: the quote before it was never closed.
_VALUE = r""""[^">]*+"|"[^"]*+"(?<!=")|'[^'>]*+'|'[^']*+'(?<!=')|[^\s>]++"""
_ATTRIBUTES = rf"""(?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:{_VALUE})?+)?+|=)*+"""
#: A comment, a CDATA section, a tag (end, name, attributes) or a declaration; what the page's end cuts off is markup as well.
TOKEN = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(rf"""([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+({_VALUE})?+)?+""", re.DOTALL)
# Elements that start a new block, those whose content is raw text, and those that show none.
BLOCKS = frozenset("address article aside blockquote body center caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
RAW_TEXT = frozenset("script style textarea title xmp iframe noembed noframes".split())
NO_TEXT = frozenset("noscript template svg math canvas object".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BAD_REGIONS = frozenset("nav footer aside menu button select dialog".split()) | NO_TEXT
GOOD_REGIONS = frozenset("article main".split())
BAD_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumb\w*|header|masthead|foot(?:er)?|side-?bar|aside|widget\w*|related|share|sharing|social|cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|signup|login|comments?|replies|discussion|disqus|respond|pagination|pager|toolbar|copyright|legal|skip)(?:$|[\s_-])",
    re.IGNORECASE,
)
GOOD_ROLES, BAD_ROLES = frozenset(["main", "article"]), frozenset("navigation banner contentinfo complementary search form dialog alert".split())
STOP_WORDS = frozenset(
    "the of and to in a is that it was for on are with as be this by at from or an not which have has but were they his her he she you we their its can will would there been "
    "de la que el en y los se del las un por con una su para es al lo como más le et les des est dans pour qui au sur pas ne par ce avec plus une du son il elle sont "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über".split()
)
LENGTH_LOW, LENGTH_HIGH = 70, 200
STOPS_LOW, STOPS_HIGH = 0.20, 0.30
MAX_LINK_DENSITY = 0.2
#: So many blocks of links alone, one after the other, are a menu wherever they stand.
MENU_BLOCKS, MENU_DENSITY = 3, 0.9
SIGNS = ".,;:!?\"'()*#$%&|"


@dataclass
class Block:
    """A run of text between block-level tags; ``article`` numbers the region its neighbours are sought in."""

    text: str
    linked: int
    region: str
    article: int = 0
    kind: str = ""
    heading: bool = False
    #: What decided: region, density, neighbour or default.
    by: str = ""


@dataclass
class _Parser:
    blocks: list[Block] = field(default_factory=list)
    stack: list[tuple[str, str, int]] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    anchors: int = 0
    articles: int = 0
    heading: bool = False
    broken: bool = False
    bad: int = 0

    def region(self) -> tuple[str, int]:
        """bad inside any boilerplate element, else good inside an article (a form around one counts for nothing), else bad in a form or empty."""
        if self.bad:
            return "bad", 0
        for _, kind, article in reversed(self.stack):
            if kind == "good":
                return "good", article
            if kind == "form":
                return "bad", 0
        return "", 0

    def text(self, raw: str) -> None:
        if raw:
            self.parts.append(raw)
            self.broken = self.broken and not raw.strip()
            if self.anchors:
                self.linked += len(html.unescape(raw).strip())

    def end_block(self) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            region, article = self.region()
            self.blocks.append(Block(text, self.linked, region, article, heading=self.heading))
        self.parts.clear()
        self.linked, self.heading, self.broken = 0, False, False

    def line_break(self) -> None:
        """One break is white space; a second one after nothing but white space ends the block."""
        if self.broken and self.parts and not self.parts[-1].strip():
            self.end_block()
        self.parts.append(" ")
        self.broken = True

    def open(self, name: str, attributes: str) -> None:
        if name == "br":
            return self.line_break()
        if name in BLOCKS:
            self.end_block()
        if name in VOID:
            return
        if name == "a":
            self.anchors += 1
        if name in ("p", "li", "td", "th", "tr", "option", "dd", "dt"):
            self.close(name, only_open=True)
        kind = "bad" if name in BAD_REGIONS else "good" if name in GOOD_REGIONS else "form" if name == "form" else ""
        # A header inside an article is the article's own; its menus stay bad.
        if name == "header" and not any(k == "good" for _, k, _ in self.stack):
            kind = "bad"
        if attributes and kind in ("", "form") and name not in ("html", "body"):
            found = attribute_values(attributes)
            role = found.get("role", "").lower()
            if role in BAD_ROLES - {"form"} or BAD_NAMES.search(found.get("class", "")) or BAD_NAMES.search(found.get("id", "")) or "hidden" in found:
                kind = "bad"
            elif role in GOOD_ROLES:
                kind = "good"
            elif role == "form":
                kind = "form"
        self.articles += kind == "good"
        self.bad += kind == "bad"
        self.stack.append((name, kind, self.articles))
        self.heading = name[0] == "h" and name[1:].isdigit()

    def close(self, name: str, only_open: bool = False) -> None:
        if name in BLOCKS and not only_open:
            self.end_block()
        if name == "a" and not only_open:
            self.anchors = max(0, self.anchors - 1)
        for i in range(len(self.stack) - 1, -1, -1):
            own = self.stack[i][0]
            if own == name:
                self.bad -= sum(k == "bad" for _, k, _ in self.stack[i:])
                del self.stack[i:]
                return
            # An end tag does not reach through the elements that bound it.
            if only_open and own not in ("b", "i", "em", "strong", "span", "u", "small", "font") or own in ("article", "main", "body") and name not in ("html", "body", "article", "main"):
                return


def attribute_values(attributes: str) -> dict[str, str]:
    """The attributes of a tag by lower-case name; of several of one name the first."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(attributes):
        value = m[2] or ""
        if value[:1] in ('"', "'"):
            value = value[1:].removesuffix(value[0])
        found.setdefault(m[1].lower(), html.unescape(value))
    return found


_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+(?:>|\Z)|\Z", re.IGNORECASE) for name in RAW_TEXT}


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, with character references decoded and white space folded."""
    parser, at = _Parser(), 0
    while (m := TOKEN.search(page, at)) is not None:
        parser.text(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if m[0].startswith("<![CDATA["):
            parser.text(html.escape(m[0][9:].removesuffix("]]>")))
        elif not name:
            continue
        elif m[1]:
            parser.close(name)
        elif name in RAW_TEXT:
            if name in BLOCKS:
                parser.end_block()
            at = _RAW_END[name].search(page, at).end()
        elif name in NO_TEXT and m[3].rstrip().endswith("/"):
            continue
        else:
            parser.open(name, m[3])
    parser.text(page[at:])
    parser.end_block()
    return parser.blocks


def first_pass(found: list[Block]) -> None:
    """Labels each block by itself: good, bad, near (good if in doubt), short or linked."""
    for b in found:
        if b.region == "bad":
            b.kind, b.by = "bad", "region"
            continue
        words = b.text.lower().split()
        density = b.linked / len(b.text)
        stops = sum(w.strip(SIGNS) in STOP_WORDS for w in words) / len(words)
        b.by = "density"
        if b.text[0] == "©":
            b.kind = "bad"
        elif density > MAX_LINK_DENSITY:
            b.kind = "linked" if b.region == "good" else "bad"
        elif len(b.text) < LENGTH_LOW:
            b.kind = "bad" if b.linked and b.region != "good" else "short"
        elif stops >= STOPS_HIGH:
            b.kind = "good" if len(b.text) > LENGTH_HIGH or b.region == "good" else "near"
        elif stops >= STOPS_LOW:
            b.kind = "good" if len(b.text) > LENGTH_HIGH and b.region == "good" else "near"
        else:
            b.kind = "near" if len(b.text) > LENGTH_HIGH else "short"
    run = 0
    for i, b in enumerate([*found, None]):
        if b is not None and b.kind == "linked" and b.linked >= MENU_DENSITY * len(b.text) and len(b.text) < LENGTH_LOW:
            run += 1
            continue
        if run >= MENU_BLOCKS:
            for x in found[i - run : i]:
                x.kind = "bad"
        run = 0


def second_pass(found: list[Block]) -> None:
    """Open blocks take the label of their nearest decided neighbour in the same article, or else their region's."""
    decided = [b.kind in ("good", "bad") for b in found]

    def nearest(order: range) -> list[int]:
        """For each block the place of the nearest decided one before it in ``order``, in the same article, or -1."""
        out, last = [-1] * len(found), {}
        for i in order:
            # Blocks of boilerplate elements are neighbours only outside articles.
            a = found[i].article
            out[i] = last.get(a, -1)
            if decided[i]:
                last[a] = i
        return out

    before, after = nearest(range(len(found))), nearest(range(len(found) - 1, -1, -1))
    # Without any good block (a page of bare text, or short lines) nothing outside the regions tells text from its surroundings.
    alone = not any(b.kind == "good" for b in found)
    for i, (b, left, right) in enumerate(zip(found, before, after)):
        if decided[i]:
            continue
        near = sorted((abs(i - k), -len(found[k].text), k) for k in (left, right) if k >= 0)
        b.by = "neighbour"
        if b.region == "" and b.kind == "short":
            # Short ones outside articles are text only between text, or as the heading of one.
            kinds = {found[k].kind for _, _, k in near}
            between = left >= 0 and right >= 0 and kinds == {"good"}
            b.kind = "good" if between or b.heading and right >= 0 and found[right].kind == "good" or alone and not near else "bad"
        elif b.region == "" and alone:
            b.kind, b.by = "good", "default"
        elif near:
            b.kind = found[near[0][2]].kind
            if b.kind == "bad" and (b.region == "good" or b.kind == "near") and any(found[k].kind == "good" for _, _, k in near):
                b.kind = "good"
        else:
            b.kind, b.by = "good", "default"


def classify(found: list[Block]) -> list[Block]:
    """Both passes; ``kind`` becomes good or bad, and ``by`` names what decided."""
    first_pass(found)
    second_pass(found)
    return found


def decisions(pages: list[str]) -> Counter:
    """How many blocks each rule decided, by (region, kind, rule): for the figures in the README."""
    return Counter((b.region, b.kind, b.by) for p in pages for b in classify(blocks(p)))


def main_text(page: str) -> str:
    """The good blocks, joined by an empty line."""
    return "\n\n".join(b.text for b in classify(blocks(page)) if b.kind == "good")


def extract(pages: DataFrame, key: str = "page_id", text: str = "html", url: str = "url") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points of the text).

    ``pages`` needs the columns that ``key``, ``text`` and ``url`` name. A null or empty page, or one without a
    good block, gives the empty text; very long pages are read whole; repeated rows give repeated results; an
    empty table gives no rows; other columns are ignored, whatever their names.
    """

    def run(batch: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in batch])

    out = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.pandas_udf(run, "string")(whole_text(text)).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
