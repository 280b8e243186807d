"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one for each block element, each with the length of its text outside links. The lengths
summed over a sliding window of lines give a distribution; the text lies between a point where it surges and the point
where it dives to nothing. Elements that are boilerplate by their name, role, class or id are taken out with the markup,
and the edge of a sectioning element leaves empty lines, so that neighbours outside it don't bridge a dive. The distribution
finds the text; structure confirms where it ends: an article that holds such text is taken whole, and where there is none,
so is the container that most of the text is in, from its headline to its last paragraph. What is boilerplate in them goes
by its marks.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML, and words that mark boilerplate in class, id and role.
RAW = frozenset("script style noscript template iframe svg math canvas object audio video textarea title".split())
BOILERPLATE = frozenset("nav footer aside form button select option dialog menu head".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot "
    "th thead tr ul".split()
)
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt figcaption caption summary b i em strong span a".split())
CONTAINERS = frozenset("body div section td center main article".split())
HEADLINES = frozenset("h1 h2 h3".split())
SECTIONS = frozenset("article main section aside nav header footer body".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|sign-?up|login|"
    r"nav\w*|menu|breadcrumbs?|sidebar|side-?bar|widget|related|recommend\w*|share|sharing|social|comments?|disqus|reply|replies|respond|footer|"
    r"pagination|pager|toolbar|search|tags?|byline-?links|copyright|hidden|sr-only|visually-hidden|contentinfo|complementary|navigation|dialog)(?:$|[\s_-])",
    re.I,
)
#: The marks that count on elements that are a block of text themselves: a paragraph may well be called "search" or "tags".
TEXT_MARKS = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|gdpr|newsletter|subscribe|sharing|hidden|sr-only|visually-hidden)(?:$|[\s_-])", re.I)
HEADS = re.compile(r"(?:^|[\s_-])(?:header|masthead)(?:$|[\s_-])", re.I)
ASIDES = re.compile(r"(?:^|\s)(?:comment|reply|related|promo|teaser|sponsored|ad)(?:$|[\s_-])", re.I)

_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'<>]|"[^"]*"|'[^']*')*)>?""", re.S)
_MARKED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_SPACE = re.compile(r"\s+")


def _boilerplate(name: str, attributes: str, inside_article: bool) -> bool:
    """Whether an element goes with all that it holds. A header in an article holds its headline and stays."""
    if name in BOILERPLATE or name == "header" and not inside_article:
        return True
    if name in ("html", "body", "main") or not attributes:
        return False
    marks = [next(filter(None, m.groups()), "") for m in _MARKED.finditer(attributes)]
    if name == "article":
        return any(ASIDES.search(x) for x in marks)
    own = TEXT_MARKS if name in TEXT_BLOCKS else MARKS
    return any(own.search(x) or not inside_article and HEADS.search(x) for x in marks) or bool(_HIDDEN.search(attributes))


def lines(page: str, gap: int) -> list[tuple[str, int, int, tuple[int, ...], bool]]:
    """(text, length of its text outside links, number of its article, numbers of its containers, whether it is a headline)
    of each block in page order.

    The article is the outermost one that is open, else the outermost main, else 0. Articles and boilerplate outside them
    are set apart by ``gap`` empty lines.
    """
    out: list[tuple[str, int, int, tuple[int, ...], bool]] = []
    held: list[str] = []
    linked = 0
    anchors = opened = 0
    articles: list[tuple[str, int]] = []  # open articles and mains with their numbers
    containers: list[tuple[str, int]] = []
    headline = False
    skipped: list[str] = []  # open elements from the boilerplate one down

    def flush() -> None:
        nonlocal linked
        if text := _SPACE.sub(" ", html.unescape("".join(held))).strip():
            out.append((text, max(0, len(text) - linked), next((n for name, n in articles if name == "article"), articles[0][1] if articles else 0), tuple(n for _, n in containers), headline))
        held.clear()
        linked = 0

    def write(text: str) -> None:
        nonlocal linked
        held.append(text)
        if anchors:
            linked += len(_SPACE.sub(" ", text))

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if not skipped:
            write(page[at : m.start() if m else end])
        if not m:
            break
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        if not m[1] and name in RAW:  # up to its end tag; without one, to the end of the page
            close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        # Elements whose end tag is missing end with what can't be inside them.
        if skipped and (name in ("body", "main") or skipped[0] == "head" and name == "article" or not m[1] and skipped[0] == "p" and name in BLOCKS or m[1] and name in ("html", "article") and name not in skipped and articles):
            skipped.clear()
        if skipped:
            if m[1] and name in skipped:
                while skipped.pop() != name:
                    pass
            elif not m[1] and name not in VOID and name == skipped[0]:
                skipped.append(name)
            continue
        if name == "a":
            anchors = 0 if m[1] else 1
        if name in BLOCKS:
            flush()
            anchors, headline = 0, name in HEADLINES and not m[1]
        if name in CONTAINERS:
            if not m[1]:
                containers.append((name, at))
            elif any(name == n for n, _ in containers):
                while containers.pop()[0] != name:
                    pass
        if name in ("article", "main"):
            if not m[1]:
                opened += 1
                articles.append((name, opened))
            elif articles:
                articles.pop()
        boilerplate = not m[1] and name not in VOID and _boilerplate(name, m[3] or "", bool(articles))
        # In an article only another one is set apart; sections that are text are parts of what is around them.
        if name in SECTIONS and (name in ("article", "main", "body") or not articles and (name != "section" or boilerplate)):
            out += [("", 0, 0, (), False)] * gap
        if boilerplate:
            skipped.append(name)
    flush()
    return out


def main_text(page: str, window: int = 3, surge: int = 40) -> str:
    """The text between the surge and dive points of the line-block distribution.

    A region is a run of lines whose windows hold text; it surges when a window of it has ``surge`` characters or more
    outside links. Of the regions that surge, those stay that have a quarter of the largest one's text at least; when none
    surges, the largest stays. An article with a region that stays keeps all of its lines, links among them; without an
    article, the container of the largest region keeps those between its ends.
    """
    rows = lines(page, window)
    sizes = [row[1] for row in rows]
    blocks = [sum(sizes[i : i + window]) for i in range(len(rows))]
    regions, i = [], 0
    while i < len(rows):
        if not blocks[i]:
            i += 1
            continue
        start = i
        while i < len(rows) and blocks[i]:
            i += 1
        start = next((j for j in range(start, i) if sizes[j]), start)
        regions.append((start, i, max(blocks[start:i]), sum(sizes[start:i])))
    if not regions:
        return ""
    surged = [r for r in regions if r[2] >= surge] or regions
    most = max(r[3] for r in surged)
    kept = [r for r in surged if 4 * r[3] >= most and r[3]] if len(surged) > 1 and max(r[2] for r in surged) >= surge else [r for r in surged if r[3] == most][:1]
    stay = {j for start, end, _, _ in kept for j in range(start, end)}
    whole = {rows[j][2] for j in stay if sizes[j]} - {0}
    if not whole:
        stay |= _contained(rows, next(r for r in kept if r[3] == most))
    return " ".join(row[0] for j, row in enumerate(rows) if row[0] and (j in stay or row[2] in whole))


def _contained(rows: list[tuple[str, int, int, tuple[int, ...], bool]], core: tuple[int, int, int, int]) -> set[int]:
    """The lines of the innermost container that has most of a region's text, from its first headline or text to its last."""
    share: Counter[int] = Counter()
    for _, size, _, path, _ in rows[core[0] : core[1]]:
        for n in path:
            share[n] += size
    # Containers that are opened later are further in.
    if not (inner := [n for n, size in share.items() if 10 * size >= 6 * core[3]]):
        return set()
    own = [j for j, row in enumerate(rows) if max(inner) in row[3]]
    text = [j for j in own if rows[j][1]]
    first = min([j for j in own if rows[j][4]] + text)
    return {j for j in own if first <= j <= text[-1]}


def extract(pages: DataFrame, window: int = 3, surge: int = 40) -> DataFrame:
    """page_id, url, text, n_chars (code points) of each page.

    A null page counts as empty and has the empty text; page_id and url pass through, null or not. Repeated rows are
    extracted one by one; pages of any length are read whole; an empty table gives an empty result. Extra columns are
    ignored, whatever their names.
    """

    @F.pandas_udf("string")
    def run(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(x, window, surge) if x else "" for x in html], dtype=object)

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), run(F.coalesce(F.col("html").cast("string"), F.lit(""))).alias("text"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
