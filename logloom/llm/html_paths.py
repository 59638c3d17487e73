"""Main text of web pages by tag-path ratios.

A page becomes a sequence of text blocks, each with the elements it lies in.  Over all blocks with the
same root-to-leaf tag path (and weight), text length and punctuation are summed and divided by the number of
blocks; both ratios are smoothed along the page, fused with the share of text outside links, and compared with the
fused values' deviation.  Blocks above that threshold, and above a least value, are content nodes, and all of them are kept.  What is no part
of an article by its tag, role or class words (menus, page headers, footers, sidebars, notices, adverts, forms, comments) weighs little in the
ratios, class words less so inside an article, and blocks of a further article weigh as its share of the largest one's mass.  Of the
unweighed blocks below the threshold, those are added that lie in the article, main or else deepest element that holds
all content nodes, are mostly no links, and stand between content nodes or beside one (in an element below the body that holds one).
Only scripts, styles, titles and embedded drawings are left out without a ratio.

Pages are read in time linear in their length, however broken.

Defined cases: a null or empty page, or one without text, has an empty text; unclosed and misnested tags are
closed where the next block begins; embedded elements (svg, video, select ...) do not split the text around them, and are
empty without a later end tag; an unknown tag is a block; repeated rows each get a row; an empty table gives
no rows; other columns are left out.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, chunks

SCHEMA = "page_id long, url string, text string, n_chars long"

# The element names of HTML by what they mean here.
RAW = set("script style textarea title".split())
EMBEDDED = set("template iframe noframes noembed svg canvas audio video select annotation annotation-xml".split())
MATH = set("math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd mfenced menclose mpadded mphantom mstyle merror semantics".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var".split()) | MATH
CLOSES_P = set("address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = set("ul ol dl table menu".split())
NOT_ARTICLE = set("nav footer aside form button input menu dialog head datalist".split())
NOT_ARTICLE_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
ARTICLE = {"article", "main"}
#: Class and id words of what is no part of an article, and words that may stand beside them in one name.
_HINT = re.compile(
    r"ads?|adbox|adslot|advert\w*|adsense|adsbygoogle|sponsor\w*|promo\w*|banners?|nav|navbar|navigation|navi|menus?|breadcrumbs?|sidebars?|widgets?|footer|footnav|"
    r"masthead|topbar|comments?|commentlist|disqus\w*|respond|cookies?\w*|consent|gdpr|notices?|popups?|modals?|newsletters?|subscribe|"
    r"subscription|signup|social|share|sharing|sharebar|related|recommend\w*|pager|pagination|skiplinks?|toolbar|login|searchform|searchbox"
)
_BESIDE = re.compile(
    r"\d+|[a-z]|box|bars?|lists?|wrap|wrapper|container|section|blocks?|links?|buttons?|btns?|items?|area|inner|outer|top|bottom|left|right|main|primary|secondary|panel|slot|unit|form|title|"
    r"header|heading|content|body|text|posts?|articles?|stories|news|products?|videos?|count|thread|site|page|global|skip|user|read|reader|readers|more|icons?|media|group|row|col|column|overlay|close|accept|policy|message"
)
_HEADER_HINT = re.compile(r"(?:^|[\s\"'])header(?:$|[\s\"'])")
#: Tags and words weigh a block's ratios; nothing is left out for them alone.  Inside an article, words weigh less.
NO_ARTICLE, FORM, WORDED, WORDED_INSIDE = 0.0005, 0.3, 0.02, 0.2
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_MARK = re.compile(r"[>\"']")
_NAMED = re.compile(r"\b(?:class|id)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_ROLE = re.compile(r"\brole\s*=\s*[\"']?([a-zA-Z]+)", re.I)
_SPACE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")
#: Smoothing kernel along the page, threshold in deviations and its least value, and the share of text outside links that an added block must have.
KERNEL = np.exp(-np.arange(-3, 4) ** 2 / 2) / np.exp(-np.arange(-3, 4) ** 2 / 2).sum()
THRESHOLD, FLOOR, UNLINKED_SHARE = 0.5, 2.0, 0.5


def _worded(names: str) -> bool:
    """Whether a class or id is made of words that no article has, and words that stand beside them."""
    for name in names.split():
        words = [w for w in re.split(r"[^a-z0-9]+", name.strip("\"'")) if w]
        hints = [w for w in words if _HINT.fullmatch(w)]
        site = words[:1] in (["site"], ["page"], ["global"]) and words[1:] == ["header"]
        if site or (hints and all(w in hints or _BESIDE.fullmatch(w) for w in words)):
            return True
    return False


class _Scanner:
    """Tags of a page in order; no part of the page is read more than a bounded number of times."""

    def __init__(self, source: str):
        self.source, self.at = source, 0
        self.last, self.cdata = source.rfind(">"), True
        self.open: set[int] = set()  # quotes from which no tag is closed up to the end of the page

    def _end(self, at: int) -> int:
        """The place after a tag's ">"; where its quotes leave it none, after the next ">" of any kind.

        Each quote is passed once without an end at most: a walk that meets one of those can stop, so that many broken tags are read in linear time.
        """
        source, passed, start = self.source, [], at
        while mark := _MARK.search(source, at):
            if mark[0] == ">":
                return mark.end()
            if mark.start() in self.open:
                break
            passed.append(mark.start())
            at = source.find(mark[0], mark.end()) + 1
            if not at:
                break
        self.open.update(passed)
        return source.index(">", start) + 1

    def step(self) -> tuple[str, str | None, tuple[bool, str, str] | None]:
        """The text up to the next tag, plain characters that it holds (CDATA), and the tag as (closing, name, attributes)."""
        source, start, at = self.source, self.at, self.at
        while (at := source.find("<", at)) >= 0:
            if source.startswith("<!--", at):
                end = source.find("-->", at + 4)
                self.at = len(source) if end < 0 else end + 3
                return source[start:at], None, None
            if self.cdata and source.startswith("<![CDATA[", at):
                end = source.find("]]>", at + 9)
                self.cdata = end >= 0
                if self.cdata:
                    self.at = end + 3
                    return source[start:at], source[at + 9 : end], None
            if at < self.last:
                if source[at + 1] in "!?":
                    self.at = source.index(">", at + 1) + 1
                    return source[start:at], None, None
                closing = source[at + 1] == "/"
                name = _NAME.match(source, at + 1 + closing)
                if name and name.end() <= self.last:
                    self.at = self._end(name.end())
                    return source[start:at], None, (closing, name[0].lower(), source[name.end() : self.at - 1])
            at += 1
        self.at = len(source)
        return source[start:], None, None


class _Page:
    """Elements and text blocks of one page."""

    def __init__(self, source: str):
        self.tags, self.parents, self.weights = ["#root"], [-1], [1.0]  # weights: of the element alone
        self.paths, self.in_article = [0], [False]
        self.numbers: dict[tuple[int, str], int] = {}  # of root-to-leaf tag paths
        self.hinted: set[int] = set()
        self.open, self.count = [0], Counter()
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self.parts: list[str] = []
        self.linked = self.links = 0
        self.held: list[tuple[int, list[str], int, int]] = []  # open embedded elements, with the text before each
        self._read(source)
        self._cut(1)
        self._flush()

    def _flush(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.blocks.append((self.open[-1], text, self.linked))
            self.parts, self.linked = [], 0

    def _text(self, raw: str) -> None:
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            self.parts.append(text)
            if self.links:
                self.linked += len(text)

    def _cut(self, k: int) -> None:
        """Close the open elements from the k-th on; the text around an embedded one goes on after it."""
        while len(self.open) > k:
            self._flush()
            if self.held and self.open[-1] == self.held[-1][0]:
                _, self.parts, self.linked, self.links = self.held.pop()
            self.count[self.tags[self.open.pop()]] -= 1

    def _close(self, name: str) -> None:
        if not self.count[name]:
            return
        for k in range(len(self.open) - 1, 0, -1):
            if self.tags[self.open[k]] == name:
                self._cut(k)
                return

    def _embed(self, name: str) -> None:
        self.held.append((len(self.tags), self.parts, self.linked, self.links))
        self.parts, self.linked = [], 0
        self._push(name, 0.0)

    def _push(self, name: str, weight: float) -> None:
        above = self.open[-1]
        self.open.append(len(self.tags))
        self.count[name] += 1
        self.tags.append(name)
        self.parents.append(above)
        self.weights.append(weight)
        self.paths.append(self.numbers.setdefault((self.paths[above], name), len(self.numbers) + 1))
        self.in_article.append(self.in_article[above] or name in ARTICLE)

    def _implied(self, name: str) -> None:
        """Close what an opening tag ends: a paragraph, or the item before."""
        ends = CLOSES_SAME.get(name, set()) | ({"p"} if name in CLOSES_P else set())
        if not any(self.count[tag] for tag in ends):
            return
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.tags[self.open[k]]
            if tag in ends:
                self._cut(k)
                if tag == name or tag == "p":
                    return
            elif tag in HOLDS or tag in ARTICLE or tag in EMBEDDED:
                return

    def _start(self, name: str, attributes: str) -> None:
        if self.held and name in CLOSES_P and self.count["svg"]:  # HTML ends a drawing
            for k in range(len(self.open) - 1, 0, -1):
                if self.tags[self.open[k]] in ("foreignobject", "svg"):
                    if self.tags[self.open[k]] == "svg":
                        self._cut(k)
                    break
        self._flush()
        self._implied(name)
        role = _ROLE.search(attributes)
        inside = self.in_article[self.open[-1]]
        barred = name in NOT_ARTICLE or (name == "header" and not inside) or (role is not None and role[1].lower() in NOT_ARTICLE_ROLES) or bool(_HIDDEN.search(attributes))
        number = len(self.tags)
        names = " ".join(_NAMED.findall(attributes)).lower() if "class" in attributes.lower() or "id" in attributes.lower() else ""
        if names and name not in ARTICLE and name not in ("html", "body") and (_worded(names) or (not inside and _HEADER_HINT.search(names))):
            self.hinted.add(number)
        self._push(name, 1.0 if not barred or name in ("html", "body") else FORM if name == "form" else NO_ARTICLE)

    def _read(self, source: str) -> None:
        scan, n = _Scanner(source), len(source)
        ends: dict[str, int] = {}  # where the last end tag of an embedded element is
        while scan.at < n:
            text, plain, tag = scan.step()
            self._text(text)
            if plain:
                self.parts.append(plain)
            if tag is None:
                continue
            closing, name, attributes = tag
            if name in INLINE:
                if name == "a":
                    self.links = 0 if closing else 1
            elif name in EMBEDDED:
                if closing:
                    self._close(name)
                elif not attributes.endswith("/"):
                    if name not in ends:
                        ends[name] = max((e.start() for e in re.finditer(rf"</{name}(?=[\s/>])", source, re.I)), default=-1)
                    if ends[name] >= scan.at:
                        self._embed(name)
            elif closing:
                if name in RAW:
                    continue
                if name == "p" and not self.count["p"]:
                    self._flush()
                self._close(name)
                self.links = 0
            elif name in RAW:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, scan.at)
                scan.at = end.end() if end else n
            elif name in VOID:
                if name == "br":
                    self.parts.append(" ")
                elif name == "hr":
                    self._flush()
                    self._implied(name)
            elif attributes.endswith("/") and name not in CLOSES_P:
                self._flush()
            else:
                self._start(name, attributes)

    def marked_up(self, elements) -> set[int]:
        """The elements and all that they lie in."""
        out: set[int] = set()
        for element in elements:
            while element >= 0 and element not in out:
                out.add(element)
                element = self.parents[element]
        return out

    def whole_weights(self) -> list[float]:
        """Of every element: its own weight times those of what it lies in."""
        holds_article = self.marked_up(self.parents[e] for e, t in enumerate(self.tags) if t in ARTICLE)
        out: list[float] = []
        for element, (parent, weight) in enumerate(zip(self.parents, self.weights, strict=True)):  # parents come first
            if element in self.hinted and element not in holds_article:
                weight *= WORDED_INSIDE if self.in_article[element] else WORDED
            out.append(weight * out[parent] if parent >= 0 else weight)
        return out

    def marked_down(self, elements: set[int]) -> list[bool]:
        """Of every element, whether it is or lies in one of these."""
        out: list[bool] = []
        for element, parent in enumerate(self.parents):  # parents come first
            out.append(element in elements or (parent >= 0 and out[parent]))
        return out


def _article_shares(page: _Page, blocks: list, fused: np.ndarray) -> np.ndarray:
    """For each block in one of several articles (none inside another), that article's share of the largest one's mass; else 1."""
    top = [-1] * len(page.tags)  # the outermost article of each element
    for element, parent in enumerate(page.parents):
        if parent >= 0:
            top[element] = top[parent] if top[parent] >= 0 else element if page.tags[element] == "article" else -1
    at = np.array([top[b[0]] for b in blocks])
    mass = np.bincount(at + 1, weights=fused, minlength=len(page.tags) + 1)
    most = mass[1:].max(initial=0)
    return np.where(at >= 0, mass[at + 1] / most, 1.0) if most > 0 else np.ones(len(blocks))


def main_text(source: str | None) -> str:
    """The article's blocks, joined by line ends."""
    if not source:
        return ""
    page = _Page(source)
    kept = page.blocks
    weights = page.whole_weights()
    weight = np.array([weights[b[0]] for b in kept])
    if not weight.any():
        return ""

    length = np.array([len(t) for _, t, _ in kept], dtype=float)
    marks = np.array([len(_PUNCTUATION.findall(t)) for _, t, _ in kept], dtype=float)
    unlinked = 1 - np.minimum(np.array([k for _, _, k in kept]) / length, 1)
    path = np.unique(np.array([page.paths[b[0]] for b in kept]) + 1j * weight, return_inverse=True)[1]
    count = np.bincount(path)
    ratios = [np.bincount(path, weights=w)[path] / count[path] for w in (length * unlinked * weight, marks * weight)]
    padded = [np.pad(r, 3, mode="edge") for r in ratios]
    smooth = [np.convolve(r, KERNEL, mode="valid") for r in padded]
    fused = smooth[0] * (1 + smooth[1]) * unlinked * weight
    fused *= _article_shares(page, kept, fused)
    above = fused >= min(THRESHOLD * fused.std(), fused.max())
    content = above & (fused >= FLOOR)
    if not content.any():  # a short article: what stands above the threshold in it, however little
        within = page.marked_down({e for e, tag in enumerate(page.tags) if tag in ARTICLE})
        content = above & (weight == 1) & np.array([within[b[0]] for b in kept])
    if not content.any():
        return ""

    chosen = np.flatnonzero(content)
    elements = sorted({kept[k][0] for k in chosen})
    # elements are numbered in the order they open, so what holds the first and the last holds all
    around = sorted(page.marked_up(elements[:1]) & page.marked_up(elements[-1:]), reverse=True)  # the deepest first
    region = next((e for e in around if page.tags[e] in ARTICLE), None)
    if region is None:  # one long paragraph is no region
        region = next((e for e in around if page.tags[e] not in CLOSES_P - {"div", "section"}), 0)
    inside = page.marked_down({region})
    beside = page.marked_down({e for e in page.marked_up(elements) if page.tags[e] not in ("#root", "html", "body")})
    out = []
    for k, (element, text, _) in enumerate(kept):
        near = chosen[0] < k < chosen[-1] or beside[element]
        if content[k] or (weight[k] == 1 and unlinked[k] >= UNLINKED_SHARE and near and inside[element]):
            out.append(text)
    return "\n".join(out)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    bounded_batches(pages.sparkSession)
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"))

    def extract(batches):
        for batch in chunks(batches, "html"):
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(extract, SCHEMA)
