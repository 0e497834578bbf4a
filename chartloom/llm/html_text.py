"""Main text of web pages by tag-path ratios.

A page becomes a sequence of text blocks, each with the path of block tags from the root.
For every path the blocks' text length and punctuation are added up and divided by the
number of blocks; the two ratios are fused, laid out in page order, smoothed over
neighbouring blocks, and averaged by path again. Paths above a share of the page's best
path are content. Text inside elements that never hold the article (menus, forms, scripts
and the like, by tag) is left out before, and paths that are mostly links after, unless they
lie inside an article or main element with unlinked text: its lists of links are its own. So is text
inside elements with a class, id or role such as "sidebar" or "comments" (the whole name),
but not if the element holds an article or main element, or most of the unlinked text of a
page without text in such elements: there the ratios decide.

A page is worked on alone, in Arrow batches, in one scan without a shuffle: no key or host
gathers pages. Work and memory follow the length of the page, however deep it is nested:
a path is a number, known by the number of the path around it and its last tag.

Defined cases: null or empty html has the text "" with 0 characters; so has a page without
content; broken markup is read as far as it goes (an unclosed tag ends with its parent, a
stray "<" is text, an unclosed comment or script runs to the end); equal rows get equal
results; an empty table gives an empty result; other columns stay, except those named like
the added ones, in any case.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.llm.common import every, table

# Fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style textarea title noscript template iframe xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp"
    " small span strike strong sub sup time tt u var".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset("article main".split())
CLOSES_ITSELF = frozenset("p li dt dd tr td th option thead tbody tfoot".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr main nav ol p pre section table ul".split()
)

# Parts that hold no article text
NEVER = frozenset(
    "head title script style noscript template nav footer aside form button select option textarea input"
    " iframe svg canvas object dialog menu datalist audio video".split()
)
NEVER_NAMED = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|side-?bar|menu|nav(?:bar|igation)?|bread-?crumbs?"
    r"|comments?|discussion|replies|disqus|respond|notices?|alerts?|cookies?|consent|pop-?up|modal|newsletter"
    r"|subscribe|share|sharing|social|related|recommend\w*|widget|footer|masthead|site-?header|page-?header|login"
    r"|contentinfo|complementary|search)",
    re.I,
)

KERNEL = np.array([1.0, 2.0, 4.0, 2.0, 1.0])  # smoothing over neighbouring blocks
SHARE_OF_BEST = 0.08  # a content path's score over the best path's
MAX_LINK_SHARE = 0.5  # of a path's characters

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<closing>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?>[^\"'>]+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<closing2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attributes2>[^>]*)>",
    re.S,
)
DECLARED = re.compile(r"<[!?]")
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")


class _Open(NamedTuple):
    """An open element."""

    tag: str
    path: int  # of block tags down to it
    out: bool  # never holds article text
    link: bool  # in a link
    named: int  # nearest element around with a name of NEVER_NAMED, or -1
    article: bool  # in an article or main element


class _Blocks:
    """Collects text blocks with their paths while markup opens and closes."""

    def __init__(self) -> None:
        self.open: list[_Open] = []
        self.ended_early: set[int] = set()  # places of inline elements that ended before those inside them
        self.places: dict[str, list[int]] = defaultdict(list)  # of the open elements of a tag
        # Paths: number by path around and last tag; whether it ends in a heading; whether in an article.
        self.numbers: dict[tuple[int, str], int] = {}
        self.heading: list[bool] = []
        self.in_article: list[bool] = []
        self.paths: list[int] = []
        self.texts: list[str] = []
        self.links: list[int] = []
        self.has_article = False  # with text of its own
        self.parts: list[tuple[str, bool, int]] = []  # text, in a link, named element
        self.ended: list[tuple[int, list[tuple[str, bool, int]]]] = []  # path, parts
        # Elements with a name of NEVER_NAMED, numbered as they open: the one around each (or -1), ...
        self.around: list[int] = []
        self.holds: list[bool] = []  # an article or main element
        self.unlinked: list[int] = []  # characters outside links, of its own
        self.all_unlinked = 0
        self.root = self.path(-1, "", False)

    def path(self, around: int, tag: str, article: bool) -> int:
        number = self.numbers.setdefault((around, tag), len(self.heading))
        if number == len(self.heading):
            self.heading.append(tag in HEADINGS)
            self.in_article.append(article)
        return number

    def top(self) -> _Open:
        return self.open[-1] if self.open else _Open("", self.root, False, False, -1, False)

    def text(self, raw: str) -> None:
        top = self.top()
        if raw and not top.out:
            said = entities.unescape(raw)
            self.parts.append((said, top.link, top.named))
            if not top.link:
                self.all_unlinked += len(said.strip())
                if top.named >= 0:
                    self.unlinked[top.named] += len(said.strip())

    def end_block(self) -> None:
        if self.parts:
            self.ended.append((self.top().path, self.parts))
            self.parts = []

    def settle(self) -> None:
        """Leave out what the named elements hold, and make blocks of the rest."""
        for i in range(len(self.around) - 1, -1, -1):
            if self.around[i] >= 0:
                self.unlinked[self.around[i]] += self.unlinked[i]
        self.has_article = any(
            self.in_article[path] and any(said.strip() and not link for said, link, _ in parts)
            for path, parts in self.ended
        )
        out: list[bool] = []
        for around, holds, unlinked in zip(self.around, self.holds, self.unlinked):
            much = not self.has_article and 2 * unlinked > self.all_unlinked
            out.append(around >= 0 and out[around] or not (holds or much))
        for path, parts in self.ended:
            kept = [(said, link) for said, link, named in parts if named < 0 or not out[named]]
            text = " ".join("".join(said for said, _ in kept).split())
            if text:
                self.paths.append(path)
                self.texts.append(text)
                self.links.append(min(sum(len(said.strip()) for said, link in kept if link), len(text)))

    def start(self, tag: str, attributes: str) -> None:
        if tag not in INLINE:
            self.end_block()
        if tag in CLOSES_P and any(e.tag == "p" for e in self.open[-8:]):
            self.close("p")
        elif tag in CLOSES_ITSELF and any(e.tag == tag for e in self.open[-3:]):
            self.close(tag)
        if tag in VOID:
            return
        top = self.top()
        named, article = top.named, top.article or tag in ARTICLE
        out = top.out or tag in NEVER or tag == "header" and not top.article
        if not out and tag in ARTICLE:
            around = named
            while around >= 0 and not self.holds[around]:
                self.holds[around] = True
                around = self.around[around]
        elif not out and tag not in ("html", "body") and "=" in attributes:
            names = " ".join(a or b or c for a, b, c in NAMES.findall(attributes))
            if any(map(NEVER_NAMED.fullmatch, names.split())):
                self.around.append(named)
                self.holds.append(False)
                self.unlinked.append(0)
                named = len(self.around) - 1
        path = top.path if tag in INLINE else self.path(top.path, tag, article)
        self.places[tag].append(len(self.open))
        self.open.append(_Open(tag, path, out, top.link or tag == "a", named, article))

    def drop_from(self, place: int) -> None:
        while len(self.open) > place:
            last = self.open.pop()
            if len(self.open) in self.ended_early:
                self.ended_early.discard(len(self.open))
            else:
                self.places[last.tag].pop()

    def close(self, tag: str) -> None:
        if not self.places[tag]:
            return
        place = self.places[tag][-1]
        if tag not in INLINE:
            self.end_block()
            self.drop_from(place)
        else:
            self.places[tag].pop()
            self.ended_early.add(place)
        while self.open and len(self.open) - 1 in self.ended_early:
            self.drop_from(len(self.open) - 1)


def blocks(page: str) -> _Blocks:
    found, at, last_end = _Blocks(), 0, page.rfind(">")
    while at <= last_end and (markup := MARKUP.search(page, at)):
        found.text(page[at : markup.start()])
        at = markup.end()
        closing, tag, attributes = markup.group("closing", "tag", "attributes")
        if tag is None:
            closing, tag, attributes = markup.group("closing2", "tag2", "attributes2")
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            found.close(tag)
            continue
        found.start(tag, attributes)
        if tag in RAW_TEXT and not attributes.endswith("/"):
            end = re.compile(rf"</{tag}\b[^>]*>|\Z", re.I).search(page, at)
            at = end.end()
            found.close(tag)
    # Without another ">" a "<" is text, but for declarations and comments, which run to the end.
    declared = DECLARED.search(page, at)
    found.text(page[at : declared.start()] if declared else page[at:])
    found.end_block()
    found.settle()
    return found


def main_text(page: str | None) -> str:
    """The blocks of the content paths, joined by spaces."""
    found = blocks(page or "")
    if not found.texts:
        return ""
    paths = {path: i for i, path in enumerate(dict.fromkeys(found.paths))}
    place = np.array([paths[path] for path in found.paths])
    length = np.array([len(text) for text in found.texts], dtype=float)
    marks = np.array([len(PUNCTUATION.findall(text)) for text in found.texts], dtype=float)
    n = np.bincount(place)
    fused = np.bincount(place, length) / n * (1.0 + np.bincount(place, marks) / n)
    reach, ends = len(KERNEL) // 2, np.ones(len(place))
    laid = (np.convolve(fused[place], KERNEL) / np.convolve(ends, KERNEL))[reach : reach + len(place)]
    for i in range(len(place) - 2, -1, -1):  # a heading is as good as what it heads
        if found.heading[found.paths[i]]:
            laid[i] = max(laid[i], laid[i + 1])
    score = np.bincount(place, laid) / n
    is_text = np.bincount(place, found.links) <= MAX_LINK_SHARE * np.bincount(place, length)
    is_text |= found.has_article & np.array([found.in_article[path] for path in paths])
    if not is_text.any():
        return ""
    content = is_text & (score >= SHARE_OF_BEST * score[is_text].max())
    return " ".join(text for text, path in zip(found.texts, place) if content[path])


@F.pandas_udf(T.StringType())
def _main_text(pages: pd.Series) -> pd.Series:
    return pages.map(main_text, na_action=None)


def extract_main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with the columns text and n_chars (code points)."""
    kept = every([c for c in pages.columns if c.lower() not in ("text", "n_chars")])
    content = F.coalesce(F.col(html).cast("string"), F.lit(""))
    return pages.select(*kept, _main_text(content).alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
