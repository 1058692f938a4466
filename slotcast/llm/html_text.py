"""Main text of web pages by tag-path ratios (operator 5).

1. A page is read once into text blocks, each with its root-to-leaf path of elements, told by tag, classes
   and id. Only what cannot be article text is set aside on the way: scripts, styles, form controls,
   hidden elements.
2. For every path, text length and punctuation are summed over its blocks and divided by their
   number, less the share of linked text: the ratio of the path.
3. Ratios are summed over the blocks below every element, and fused: a path has its own ratio or a part of
   the sum below an element that holds it, less for each level between, whichever is more. So headings,
   list items and short paragraphs pass through their neighbours. Names of menus, adverts or comments
   are evidence, not a verdict: they lessen a path's ratio to a tenth.
4. Paths whose fused ratio reaches a share of the page's best one give the text, in page order.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.llm.common import by_batch, table

SCHEMA = "page_id long, url string, text string, n_chars long"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</\s*([a-zA-Z][^\s>/]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s>/]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<([a-zA-Z][^\s>/]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "noframes", "xmp"}
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in _RAW}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
_OUT = set(
    "head form button select option input dialog menu svg canvas object audio video map fieldset datalist".split()
) | _RAW
_FLOW = set("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
_CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
_SCOPES = set("html body article main section div ul ol dl table td th blockquote form aside nav header footer".split())
_ENDS_P = set(
    "p div article section main header footer nav aside ul ol dl table form blockquote pre h1 h2 h3 h4 h5 h6 hr figure "
    "address fieldset".split()
)
# Words in class, id or role that name what is not the article.
_NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay sidebar aside rail comment comments respond reply "
    "replies disqus discussion menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar "
    "header share sharing social follow newsletter subscribe subscription signup login search related recommended "
    "recommendations trending popular widget pagination pager skip complementary contentinfo dialog".split()
)
_STATES = {"has", "with", "no", "without"}
_SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_SIGNS = re.compile(r"[.,;:!?…。，！？]")


def _hidden(tag: str, attributes: list[tuple[str, str]]) -> bool:
    """Whether nothing in the element can be article text."""
    return tag in _OUT or any(
        name == "hidden"
        or (name == "aria-hidden" and value == "true")
        or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        for name, value in attributes
    )


def _named(tag: str, attributes: list[tuple[str, str]], inside: bool) -> bool:
    """Whether tag, class, id or role name what surrounds an article; ``inside``: one is open."""
    if tag in ("nav", "footer", "aside") or (tag == "header" and not inside):
        return True
    if tag in ("html", "body", "main"):
        return False
    for name, value in attributes:
        if name in ("class", "id", "role", "itemprop"):
            for part in value.split():
                words = [x.lower() for x in _SPLIT.split(part) if x]
                if not words or words[0] in _STATES or words[-1] in ("layout", "enabled", "page"):
                    continue  # says something of the page, as in "with-sidebar"
                if any(w in _NAMES and not (inside and w == "header") for w in [*words, "".join(words)]):
                    return True
    return False


def _label(tag: str, attributes: list[tuple[str, str]]) -> str:
    """An element's step in a path: its tag, and classes and id without their numbers."""
    if tag in ("html", "body"):
        return tag
    own = {re.sub(r"\d+", "", part) for name, value in attributes if name in ("class", "id") for part in value.split()}
    return ".".join([tag, *sorted(own)])


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int, bool]]:
    """(path, text, linked code points, named as what is not the article) of each text block, in page order.

    White space is one blank, character references are decoded, markup errors are mended the way
    browsers do: an open paragraph ends at the next block, an unknown end tag is nothing.
    """
    out, path, parts, linked, at, n = [], [], [], 0, 0, len(page)

    def end_block() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text and not any(hidden for _, _, _, hidden in path):
                # the leaf is the innermost block element: inline tags do not make a path of their own
                steps = tuple(label for t, label, _, _ in path if t not in _INLINE)
                out.append((steps, text, linked, any(named for _, _, named, _ in path)))
        parts, linked = [], 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if any(e[0] == "a" for e in path):
                linked += len(text.strip())

    def close(tags: set[str], scopes: set[str]) -> None:
        for i in range(len(path) - 1, -1, -1):
            if path[i][0] in tags:
                end_block()
                del path[i:]
                return
            if path[i][0] in scopes:
                return

    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        ending, tag = m.group(1), m.group(2) or m.group(4)
        if ending:
            ending = ending.lower()
            if ending == "p" and not any(e[0] == "p" for e in path):
                end_block()
                continue
            for i in range(len(path) - 1, -1, -1):
                if path[i][0] == ending:
                    if any(e[0] not in _INLINE for e in path[i:]):
                        end_block()
                    del path[i:]
                    break
                if ending in _INLINE and path[i][0] in _SCOPES:
                    break
            continue
        if not tag:
            if m.group().startswith("<![CDATA["):
                add(m.group()[9:-3])
            continue
        tag, attributes = tag.lower(), m.group(3) or m.group(5) or ""
        if tag in _RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else n
            continue
        if tag in _VOID:
            if tag in ("br", "hr"):
                if tag == "hr":
                    end_block()
                else:
                    parts.append(" ")
            continue
        if tag not in _INLINE:
            end_block()
            if tag in _ENDS_P:
                close({"p"}, _SCOPES)
            if tag in _CLOSES:
                close(_CLOSES[tag], {"ul", "ol", "dl", "table", "select"} if tag != "td" else {"table"})
        if attributes.rstrip().endswith("/") and tag not in _SCOPES and tag not in _ENDS_P:
            continue
        told = [(name.lower(), a or b or c) for name, a, b, c in _ATTRIBUTE.findall(attributes)]
        hidden = _hidden(tag, told)
        named = _named(tag, told, any(e[0] in ("article", "main") for e in path))
        if (hidden or named) and tag in _INLINE:
            end_block()
        path.append((tag, _label(tag, told), named, hidden))
    end_block()
    return out


def ratios(found: list[tuple]) -> dict[tuple, float]:
    """The fused ratio of every path of a page's blocks."""
    sums = defaultdict(lambda: [0, 0, 0, 0])
    for path, text, linked, named in found:
        s = sums[path, named]
        s[0] += len(text)
        s[1] += len(_SIGNS.findall(text))
        s[2] += linked
        s[3] += 1
    trust = {p: max(0.0, 1 - s[2] / s[0]) * (0.1 if p[1] else 1.0) for p, s in sums.items()}
    own = {p: (s[0] + 10 * s[1]) / s[3] * trust[p] for p, s in sums.items()}
    # smooth: what all blocks weigh that lie below an element
    below = defaultdict(float)
    for p, r in own.items():
        for i in range(1, len(p[0])):
            below[p[0][:i]] += r * sums[p][3]
    fused = {}
    for p, r in own.items():
        path, best = p[0], r
        for i in range(1, len(path)):
            # the page as a whole holds anything, so it speaks only for plain blocks right below it
            if path[i - 1] in ("html", "body") and not (i == len(path) - 1 and path[i] in _FLOW):
                continue
            best = max(best, trust[p] * below[path[:i]] * 0.8 ** (len(path) - 1 - i))
        fused[p] = best
    return fused


def content(page: str, threshold: float = 0.4) -> str:
    """The main text of a page, blocks joined by one blank; empty if there is none."""
    found = blocks(page)
    fused = ratios(found)
    least = threshold * max(fused.values(), default=0.0)
    return " ".join(text for path, text, _, named in found if fused[path, named] >= least and fused[path, named] > 0)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **options
) -> DataFrame:
    """Main text of every page, from the whole html.

    Null and empty pages, and pages without text, give an empty text. Repeated rows each get a row,
    null ids and urls are kept, other columns are not read; an empty table gives an empty result.
    """
    work = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.col(f"`{html_col}`").cast("string").alias("html"),
    )

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [content(x or "", **options) for x in batch.column("html").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(x) for x in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

        return one

    return by_batch(work, make, SCHEMA)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
