"""Main text of web pages by line-block distribution.

Markup is stripped into lines (one per block element).  Elements that never hold article text
(scripts, forms, menus, headers and footers of the page, adverts, notices, comments) leave a
gap of empty lines.  The text lengths of lines, without link text, are summed over windows of
``WINDOW`` lines.  A surge point is a window that rises to ``SURGE`` characters, a dive point
one that falls to nothing; text between a surge and the next dive is kept.  Where the page
marks its articles, lines outside them count nothing and end a stretch, and lines inside them
weigh ``SURGE`` times their length, so that a short line is a surge too.  The marks count only
if the marked articles hold half of the page's text and the longest of them is not shorter
than the longest stretch outside; else teasers or comments may be what is marked.

Edge cases: a null or empty page has an empty text; unclosed, nested and truncated markup is
read as far as it goes; repeated rows are extracted one by one; extra columns are kept out.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm.shared import table

WINDOW = 3
SURGE = 80

# fixed values: elements of HTML by their role here
RAW = "script|style|noscript|template|svg|iframe|textarea|select|object|title"
DROPPED = {"nav", "footer", "aside", "form", "button", "dialog", "head", "menu"}
ARTICLE = {"article", "main"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q",
    "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# elements that a sibling closes, with the elements whose begin does it and the one that holds them
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "option": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th", "tr", "tbody", "thead", "tfoot"}, {"table"}), "th": ({"td", "th", "tr", "tbody", "thead", "tfoot"}, {"table"}),
    "tr": ({"tr", "tbody", "thead", "tfoot"}, {"table"}),
}
# words in class, id or role that mark what is not the article
HINTS = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie",
    "cookies", "footer", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo", "related",
    "share", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}

# words that only place or hold what the first word of a class name says
LAYOUT = {
    "area", "bar", "block", "bottom", "box", "buttons", "column", "container", "content", "header", "holder", "icons", "inner", "item", "items", "label", "left",
    "link", "links", "list", "main", "outer", "panel", "right", "section", "slot", "text", "title", "top", "unit", "wrap", "wrapper",
}

# a quote means something only where the value of an attribute begins; no alternative can match in two ways
_REST = r"(?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+')?)*+"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<svg(?=[\s/]){_REST}(?<=/)>|<(?P<raw>{RAW})(?=[\s/>]).*?(?:</(?P=raw)\s*>|\Z)|<!\[CDATA\[|<[!?][^>]*>?"
    rf"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>{_REST})(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)


def _hint(name: str) -> bool:
    """A class name that is a hint, ends with one, or starts with one and only goes on to place it."""
    words = re.split(r"[_\-:]+", name)
    return words[-1] in HINTS or words[0] in HINTS and LAYOUT.issuperset(words[1:])


def _dropped(name: str, rest: str, in_article: bool) -> bool:
    if name in DROPPED or (name == "header" and not in_article):
        return True
    if not rest or name in ("html", "body", "main"):
        return False
    return any(_hint(w) for found in _ATTRIBUTE.findall(rest) for w in "".join(found).lower().split())


class _Open:
    """The open elements of a page."""

    def __init__(self) -> None:
        self.names: list[str] = []

    def begin(self, name: str) -> None:
        """An element begins, after those that its begin closes."""
        names = self.names
        sibling = any(name in closers for closers, _ in SIBLINGS.values())
        if name not in INLINE and (name not in VOID or name == "hr"):
            for k in range(len(names) - 1, -1, -1):
                closers, holders = SIBLINGS.get(names[k], ((), ()))
                if name in closers or names[k] == "p":
                    del names[k:]
                elif names[k] in ARTICLE or not sibling and names[k] not in INLINE or any(names[k] in h for c, h in SIBLINGS.values() if name in c):
                    break
        if name not in VOID:
            names.append(name)

    def end(self, name: str) -> None:
        """An end tag closes its element and all in it; inline ones stay in their block, others in their article."""
        for k in range(len(self.names) - 1, -1, -1):
            here = self.names[k]
            if here == name:
                del self.names[k:]
                return
            if name in INLINE and here not in INLINE or here in ARTICLE and name not in ("body", "html", *ARTICLE):
                return


def lines_of(page: str) -> list[tuple[str, int, int]]:
    """(text, length without links, number of the outermost article or 0) of each line; gaps are empty lines."""
    lines: list[tuple[str, int, int]] = []
    parts: list[str] = []
    linked, link_depth, articles = 0, 0, 0
    marked = 0
    # the number of open elements around the dropped one that is skipped
    skipping, around = "", 0
    opened = _Open()

    def end_line() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            lines.append((text, max(0, len(text) - linked), marked if articles else 0))
        parts.clear()
        linked = 0

    def text(part: str) -> None:
        nonlocal linked
        if part and not skipping:
            parts.append(part)
            if link_depth:
                linked += len(part.strip())

    at = 0
    for token in _TOKEN.finditer(page):
        text(page[at : token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        closing, rest = bool(token["close"]), token["rest"]
        if closing:
            opened.end(name)
        else:
            opened.begin(name)
            if rest.endswith("/") and name not in VOID:
                opened.names.pop()
        if skipping:
            # an unclosed element ends where the article begins, an ancestor ends or a sibling begins
            begins = name in ARTICLE and not closing and skipping not in ARTICLE
            depth = len(opened.names) - (not closing and name not in VOID and not rest.endswith("/"))
            if depth > around and not begins:
                continue
            own_end, skipping = closing and name == skipping, ""
            if own_end:
                continue
        if name in INLINE:
            if name == "a":
                link_depth = 0 if closing else 1
            if not closing and name not in VOID and _dropped(name, rest, articles > 0):
                skipping, around = name, len(opened.names) - 1
            continue
        end_line()
        link_depth = 0
        if not closing and name not in VOID and not rest.endswith("/") and _dropped(name, rest, articles > 0):
            skipping, around = name, len(opened.names) - 1
            lines.extend([("", 0, 0)] * WINDOW)
        elif name in ARTICLE:
            if not articles and not closing:
                marked += 1
            articles = max(0, articles - 1) if closing else articles + 1
            if closing and not articles:
                lines.extend([("", 0, 0)] * WINDOW)
    text(page[at:])
    end_line()
    return lines


def _stretches(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of lines from each surge to the next dive."""
    n = len(sizes)
    before = np.concatenate(([0], np.cumsum(sizes)))
    windows = before[np.minimum(np.arange(n) + WINDOW, n)] - before[np.arange(n)]
    surge = min(SURGE, int(windows.max(initial=0)))
    found, i = [], 0
    while i < n and surge:
        if windows[i] < surge:
            i += 1
            continue
        # the surge may begin before its window reaches the limit
        first = i
        while first and sizes[first - 1]:
            first -= 1
        last = i
        while last < n and windows[last]:
            last += 1
        found.append((first, last))
        i = last + 1
    return found


def _marks_count(sizes: np.ndarray, article: np.ndarray) -> bool:
    """Whether the marked articles are what the page is about."""
    own = np.bincount(article, sizes)
    if 2 * own[1:].sum() < sizes.sum():
        return False
    outside = np.where(article > 0, 0, sizes)
    return own[1:].max(initial=0) >= max([outside[a:b].sum() for a, b in _stretches(outside)], default=0)


def main_text(page: str | None) -> str:
    """The article text of a page, one line per block."""
    if not page:
        return ""
    lines = lines_of(page)
    if not lines:
        return ""
    sizes = np.array([own if 2 * own >= len(line) else 0 for line, own, _ in lines], np.int64)
    article = np.array([number for _, _, number in lines], np.int64)
    inside = article > 0
    bounded = bool(inside.any()) and _marks_count(sizes, article)
    if bounded:
        sizes = np.where(inside, sizes * SURGE, 0)
    kept = [i for a, b in _stretches(sizes) for i in range(a, b) if inside[i] or not bounded]
    return "\n".join([lines[i][0] for i in kept if lines[i][0]])


def extract(page: Column) -> Column:
    """The main text of a column of pages."""

    def run(pages: pd.Series) -> pd.Series:
        return pages.map(main_text, na_action=None)

    return F.pandas_udf(run, "string")(page)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "pages").select("page_id", "url", extract(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


# the pages of the given tables mark their article, and use these character references
SQL = r"""
with articles as (
  select page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's') as body from pages
), blocks as (
  select page_id, generate_subscripts(parts, 1) as i, unnest(parts) as part
  from (select page_id, regexp_split_to_array(body, '</?(p|h1|br)>') as parts from articles)
), decoded as (
  select page_id, i, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(part, '<[^>]*>', '', 'g'),
    '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#x27;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) as line from blocks
), texts as (
  select page_id, string_agg(line, chr(10) order by i) as text from decoded where line <> '' group by page_id
)
select a.page_id, a.url, coalesce(t.text, '') as text, length(coalesce(t.text, ''))::bigint as n_chars
from articles a left join texts t using (page_id)
"""
