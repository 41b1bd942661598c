"""HTML extraction (7): the main text of web pages, by line-block distribution.

Markup is stripped into lines, one per block element. Parts that are no article by their tag, role or name (menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments) leave no lines. On a page with
article elements, their lines are the text, but for articles that are mostly links.

On all other pages the distribution decides. A line's length is that of its text outside links; lengths are summed over
sliding windows of `WINDOW` lines. Where a sum reaches the height (`SURGE`, or half the page's largest sum if that is
less) is a surge, where it then falls below a quarter of the height a dive; what lies between is a region. So a run of
short lines (a menu without links) separates regions, a short line or two among long ones doesn't. At its edges a region
starts and ends with a long line; from there it takes in the heading above it, whole sentences on either side, and list
items and cells behind it, but no copyright line.

A name may stand for a layout (`page no-sidebar`): a part that holds most of the page's text isn't dropped for its name. Reader comments
may be longer than what they are about; they are dropped unless there is nothing else.

A dropped element ends where HTML ends it, also if its end tag is left out (p, li, dt, dd, tr, td, th, option).

Character references are decoded, white space within a block becomes one space, blocks are joined by a line feed.

Defined results: null, empty and textless pages give an empty text; a page whose text is all in links keeps it all; markup cut
off anywhere is read as far as it goes; rows with the same or no id are pages of their own; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import UID, table, tidy, tune

#: Lines of a window, the characters in it that make a surge, and the part of them below which it dives.
WINDOW, SURGE, DIVE = 3, 100, 0.25
#: A line or an article is a list of links if more than this share of it is linked.
MOST_LINKS = 0.5

_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose end tag may be left out: the open ones that a start tag ends, itself included. Any block's tag ends a p.
_ENDED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option",), "td": ("td", "th"), "th": ("td", "th")} | dict.fromkeys(("tr", "thead", "tbody", "tfoot"), ("td", "th", "tr"))
_OPTIONAL = frozenset("p li dt dd tr td th option".split())
_SECTIONS = ("thead", "tbody", "tfoot")
_DROPPED = frozenset("nav header footer aside form menu dialog head button select label fieldset object".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
_BEFORE = r"(?:^|(?<!\bno)(?<!\bhas)(?<!\bwith)(?<!\bwithout)[\s_-])"
_NAMES = re.compile(
    _BEFORE + r"(?:ads?|adverts?|advertisement|adsense|banner|breadcrumbs?|byline-share|comments?|commentlist|consent|cookies?|disqus|footer|header|masthead|menu|"
    r"modal|nav|navbar|navigation|newsletter|notice|notification|pager|pagination|popup|promo|promotion|related|replies|respond|share|sharing|sidebar|side-?bar|"
    r"social|sponsor|sponsored|subscribe|subscription|toolbar|topbar|widget)(?:$|[\s_-])",
    re.I,
)
_COMMENTS = re.compile(_BEFORE + r"(?:comments?|commentlist|disqus|replies|respond)(?:$|[\s_-])", re.I)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ITEMS = frozenset("li td th dt dd pre figcaption summary".split())
_SENTENCE = re.compile(r"[.!?:;\u2026\u3002\uff01\uff1f][\"'\u2019\u201d\u00bb)\]]*\Z")
_NOTICE = re.compile(r"\s*(?:\u00a9|\(c\)|copyright\b|all rights reserved)", re.I)
_RAW = "script|style|noscript|template|iframe|svg|math|textarea|title|canvas|video|audio|xmp|noembed|noframes"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)()[^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")


def attributes_of(text: str) -> dict[str, str]:
    """Attributes of a start tag by name; of repeated ones the first."""
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), value.strip("\"'"))
    return out


def _boilerplate(tag: str, text: str, share: float) -> bool:
    """Is an element dropped, which holds a share of the page's text?"""
    if tag in _DROPPED:
        return True
    if tag in ("main", "body", "html") or not text:
        return False
    attributes = attributes_of(text)
    if attributes.get("role", "").lower() in _ROLES or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return tag != "article"
    for value in (attributes.get("class", ""), attributes.get("id", "")):
        if share < 1 and _COMMENTS.search(value) or tag != "article" and share <= 0.5 and (found := _NAMES.search(value)) and not (tag in _HEADINGS and "head" in found[0].lower()):
            return True
    return False


def _ends(tags: list[tuple[str, bool]]) -> list[int]:
    """For each start tag (name, closing), the tag that ends it if it is dropped: its own end, but where end tags are missing, at the latest an article (an unclosed menu doesn't hold it)."""
    n = len(tags)
    out, starts = [n] * n, {}
    for k, (tag, closing) in enumerate(tags):
        if not closing:
            starts.setdefault(tag, []).append(k)
        elif starts.get(tag):
            out[starts[tag].pop()] = k
    missing = {tag for tag, left in starts.items() if left}
    _omitted(tags, out)
    article = end = n
    for k in range(n - 1, -1, -1):
        tag, closing = tags[k]
        out[k] = min(out[k], end, article if tag in missing else n)
        if tag in ("article", "main"):
            article = k
        elif closing and tag in ("body", "html"):
            end = k
    return out


def _omitted(tags: list[tuple[str, bool]], out: list[int]) -> None:
    """Lower the ends in `out` of elements without an end tag: to the next start tag of their kind, or to their parent's end tag."""
    # open containers from the outermost: name, and the open elements right inside; names are counted, so that no stray end tag searches all
    stack: list[tuple[str, dict[str, int]]] = [("", {})]
    count: Counter[str] = Counter()

    def end(names: Iterable[str], k: int) -> None:
        for name in names:
            if (start := stack[-1][1].pop(name, None)) is not None:
                out[start] = min(out[start], k)

    def leave(k: int) -> str:
        end(list(stack[-1][1]), k)
        name = stack.pop()[0]
        count[name] -= 1
        return name

    for k, (tag, closing) in enumerate(tags):
        if tag not in _BLOCKS and tag not in ("optgroup", "button", "object"):
            continue
        end(("p",), k)
        if tag in _OPTIONAL:
            end(_ENDED.get(tag, ()), k)  # an end tag is that of a cell's row, too
            if not closing:
                stack[-1][1][tag] = k
        elif closing:
            if count[tag]:
                while leave(k) != tag:
                    pass
        elif tag not in _VOID:
            if tag in _SECTIONS and stack[-1][0] in _SECTIONS:
                leave(k)
            end(_ENDED.get(tag, ()), k)
            stack.append((tag, {}))
            count[tag] += 1


def _sizes(page: str, marks: list[re.Match], tags: list[tuple[str, bool]], ends: list[int]) -> list[int]:
    """Letters of the page before each tag and in all, without parts that are dropped by their tag."""
    out, total, at, until = [], 0, 0, -1
    for k, m in enumerate(marks):
        if k > until:
            total += len("".join(page[at : m.start()].split()))
        out.append(total)
        at = m.end()
        if k >= until and tags[k][0] in _DROPPED and not tags[k][1]:
            until = ends[k]
    if until < len(marks):
        total += len("".join(page[at:].split()))
    return [*out, total]


@dataclass
class _Lines:
    """Lines of a page: text, letters in links, the article that a line lies in (-1: none), and the block element it is."""

    text: list[str] = field(default_factory=list)
    links: list[int] = field(default_factory=list)
    article: list[int] = field(default_factory=list)
    block: list[str] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)

    def end(self, article: int, block: str) -> None:
        if self.parts:
            text = _plain(self.parts)
            if text:
                self.text.append(text)
                self.links.append(len(_plain(self.linked)) if self.linked else 0)
                self.article.append(article)
                self.block.append(block)
            self.parts, self.linked = [], []


def _plain(parts: list[str]) -> str:
    return " ".join(_html.unescape("".join(parts)).split())


def lines_of(page: str) -> _Lines:
    """Strip a page's markup."""
    out, at = _Lines(), 0
    marks = list(_TOKEN.finditer(page))
    tags = [((m[3] or m[6] or "").lower(), bool(m[2] or m[5])) for m in marks]
    ends = _ends(tags)
    sizes = _sizes(page, marks, tags, ends)
    skipped, until = "", -1  # the tag that is dropped with all it holds, and where it ends
    articles, article, opened, links, block = 0, -1, 0, False, ""
    for k, (m, (tag, closing)) in enumerate(zip(marks, tags)):
        if k > until and m.start() > at:
            out.parts.append(text := page[at : m.start()])
            if links:
                out.linked.append(text)
        at = m.end()
        if not tag or k < until or k == until and closing and tag == skipped:
            continue
        if tag == "br":
            out.parts.append(" ")
        elif tag == "a":
            links = not closing
        elif not closing and tag not in _VOID and _boilerplate(tag, m[4] or m[7] or "", (sizes[ends[k]] - sizes[k]) / (sizes[-1] or 1)):
            out.end(article, block)
            skipped, until, links = tag, ends[k], False
        elif tag in _BLOCKS:
            out.end(article, block)
            block = "" if closing else tag
            if tag in ("article", "main"):
                if not closing:
                    if opened == 0:
                        article, articles = articles, articles + 1
                    opened += 1
                elif opened:
                    opened -= 1
                    if opened == 0:
                        article = -1
    if until < len(marks) and at < len(page):
        out.parts.append(page[at:])
    out.end(article, block)
    return out


def regions(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """Line ranges between surges and dives of the windows' sums; without any text there are none."""
    n = len(lengths)
    sums, total = [0] * n, 0
    for i in range(n - 1, -1, -1):
        total += lengths[i] - (lengths[i + window] if i + window < n else 0)
        sums[i] = total
    height = min(SURGE, max(sums, default=0) / 2)
    out, start = [], -1
    for i, x in enumerate(sums):
        if start < 0 and x >= height > 0:
            start = i
        elif start >= 0 and x < DIVE * height:
            out.append((start, i))
            start = -1
    return [*out, (start, n)] if start >= 0 else out


def _by_distribution(lines: _Lines, window: int = WINDOW) -> list[bool]:
    """Which lines of a page without articles are its text."""
    n = len(lines.text)
    lengths = [len(t) - x for t, x in zip(lines.text, lines.links)]
    found = regions(lengths, window)
    if not found:
        return [True] * n
    height = min(SURGE, max(sum(lengths[i : i + window]) for i in range(n)) / 2)
    listed = [x > MOST_LINKS * len(t) for t, x in zip(lines.text, lines.links)]
    heading = [b in _HEADINGS for b in lines.block]
    sentence = [bool(_SENTENCE.search(t)) and not _NOTICE.match(t) for t in lines.text]
    kept = [False] * n
    for a, b in found:
        long = [i for i in range(a, b) if lengths[i] >= height / window]
        first, last = long[0], long[-1]
        # a heading not far above the first long line, with what stands in between
        for i in range(first - 1, max(-1, first - 1 - 2 * window), -1):
            if listed[i]:
                break
            if heading[i]:
                first = i
                break
        while first and not listed[first - 1] and (heading[first - 1] or sentence[first - 1]):
            first -= 1
        i = last + 1
        while i < n and not listed[i] and (heading[i] or sentence[i] or lines.block[i] in _ITEMS and not _NOTICE.match(lines.text[i])):
            last = last if heading[i] else i
            i += 1
        kept[first : last + 1] = [True] * (last + 1 - first)
    return kept


def main_text(page: str | None) -> str:
    """The main text of a page."""
    if not page:
        return ""
    lines = lines_of(page)
    articles: dict[int, list[int]] = {}
    for i, k in enumerate(lines.article):
        if k >= 0:
            articles.setdefault(k, []).append(i)
    if articles:
        of_links = {k for k, own in articles.items() if sum(lines.links[i] for i in own) > MOST_LINKS * sum(len(lines.text[i]) for i in own)}
        kept = [k >= 0 and (k not in of_links or len(of_links) == len(articles)) for k in lines.article]
    else:
        kept = _by_distribution(lines)
    return "\n".join(x for x, keep in zip(lines.text, kept) if keep)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(row, page_id, url, text) of every page."""
    tune(pages.sparkSession)
    rows = pages.select(F.monotonically_increasing_id().alias(UID), F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.record_batch([batch.column(UID), batch.column("page_id"), batch.column("url"), pa.array(text, pa.string())], [UID, "page_id", "url", "text"])

    return rows.mapInArrow(tidy(run), f"{UID} long, page_id long, url string, text string")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the main text of every page."""
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
