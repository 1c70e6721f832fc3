"""Main text of web pages by line-block distribution.

Markup is stripped to one line per block. Lines of menus, adverts, forms and the like keep
their place with no text. The text lengths of a sliding window of lines then show where text
surges and where it dives to nothing; what lies between is kept.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import query, ship_code

#: Lines in a window, and the text a window needs for a surge on a page that marks no main part.
WINDOW, SURGE = 3, 80

# Element names of HTML by role.
BLOCKS = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav aside footer form menu dialog button label fieldset legend datalist option optgroup canvas audio video object map".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NAMES = frozenset("nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside footer header masthead banner ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations trending widget toolbar pagination pager comments comment commentlist respond reply replies disqus copyright legal disclaimer search skip".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Elements an opening tag ends if they are still open, as HTML leaves their end tags out.
ENDED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
RAW = "script|style|noscript|template|svg|math|iframe|textarea|title|select|noembed|noframes|xmp|head"

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    rf"|<(?P<raw>{RAW.replace('|head', '')})\b[^>]*(?:>.*?(?:</(?P=raw)\s*[^>]*>|\Z)|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.I)
GAP = re.compile(r"\s+")


def unwanted(name: str, rest: str, inside: bool) -> bool:
    """Whether an element and all in it is no main text; inside: it lies in an article or main part."""
    if name in BOILERPLATE or (name == "header" and not inside):
        return True
    if not rest or name in ("html", "body", "main", "article") or name in HEADINGS:
        return False
    for key, a, b, c, hidden in ATTRIBUTE.findall(rest):
        key, value = key.lower(), (a or b or c).lower()
        if hidden or (key == "aria-hidden" and value == "true") or (key == "role" and value in ROLES) or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return True
        if key in ("class", "id"):
            for word in value.split():
                if word in NAMES or any(x in NAMES for x in re.split(r"[-_]+", word)[:1] + re.split(r"[-_]+", word)[-1:]):
                    return True
    return False


#: Elements that hold blocks of one piece of text.
HOLDERS = frozenset("body div section article main td center blockquote".split())


def blocks(page: str) -> tuple[list[tuple[str, int, bool, int]], bool]:
    """(text, characters of it in links, in a main part, holder) of each block, and whether the page marks a main part.

    Blocks of unwanted elements come out empty, so that they part the text around them.
    """
    lines: list[tuple[str, int, bool, int]] = []
    stack: list[tuple[str, bool, bool]] = []  # name, unwanted, main part
    holders, opened = [0], 0
    text: list[str] = []
    links = bad = main = anchors = 0
    marked = False

    def flush() -> None:
        nonlocal links
        line = GAP.sub(" ", html.unescape("".join(text))).strip()
        if line:
            lines.append((line, links, main > 0, holders[-1]))
        text.clear()
        links = 0

    def pop() -> None:
        nonlocal bad, main, anchors
        name, was_bad, was_main = stack.pop()
        anchors -= name == "a"
        if name in HOLDERS:
            holders.pop()
        if was_bad:
            bad -= 1
            if not bad:
                lines.extend([("", 0, False, -1)] * WINDOW)
        main -= was_main

    at = 0
    for token in TOKEN.finditer(page):
        if not bad and token.start() > at:
            piece = page[at : token.start()]
            text.append(piece)
            if anchors:
                links += len(piece.strip())
        at = token.end()
        name = (token["name"] or token["name2"] or "").lower()
        if not name:
            continue
        rest = token["rest"] or token["rest2"] or ""
        if name in BLOCKS and not bad:
            flush()
        elif name == "br" and not bad:
            text.append(" ")
        if token["end"] or token["end2"]:
            if any(x[0] == name for x in stack):
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in VOID or rest.endswith("/") and name not in BLOCKS and name != "a":
            continue
        if name == "body":  # a head left open ends here
            while any(x[0] == "head" for x in stack):
                pop()
        for ended in ENDED_BY.get(name, ()):
            if stack and stack[-1][0] == ended:
                pop()
        if name == "a" and anchors:
            while stack[-1][0] != "a":
                pop()
            pop()
        is_main = name in ("article", "main") or "articlebody" in rest.lower() or re.search(r"role\s*=\s*[\"']?main\b", rest, re.I) is not None
        if is_main and bad and all(x[0] == "form" or not x[1] for x in stack):
            stack[:] = [(n, False, m) for n, _, m in stack]  # a form around the whole page
            bad = 0
        is_bad = name == "head" or (not is_main and unwanted(name, rest, main > 0))
        if is_bad and not bad:
            flush()
        if is_main and not bad:
            main += 1
            marked = True
        stack.append((name, is_bad, is_main and not bad))
        if name in HOLDERS:
            opened += 1
            holders.append(opened)
        bad += is_bad
        anchors += name == "a"
    if not bad:
        text.append(page[at:])
        flush()
    return lines, marked


def main_text(page: str, window: int = WINDOW, surge: int = SURGE) -> str:
    """The page's main text, a block a line.

    A marked main part (article or main element) holds all of the text: there any text surges
    and lines outside count as empty. Elsewhere a window must reach `surge` characters, and
    lines that are mostly links count as empty.
    """
    lines, marked = blocks(page)
    if not lines:
        return ""
    need = 1 if marked else surge
    weight = np.array([len(t) if (inside if marked else 2 * links <= len(t)) else 0 for t, links, inside, _ in lines])
    sums = np.convolve(weight, np.ones(window, np.int64))[window - 1 :]  # of the window that opens at each line
    if not marked and sums.max(initial=0) < need:
        need = max(1, int(sums.max(initial=0)))
    kept, open_ = set(), False
    for i in range(len(lines)):
        if not open_ and sums[i] >= need and weight[i]:
            open_ = True  # surge
        elif open_ and sums[i] == 0:
            open_ = False  # dive
        if open_ and weight[i]:
            kept.add(i)
    # short blocks that an advert or the like cuts off from the text they stand with
    homes = {lines[i][3] for i in kept}
    return "\n".join(x[0] for i, x in enumerate(lines) if i in kept or (weight[i] and x[3] in homes))


def extract_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """(keep.., text, n_chars) of every row; text is empty where a page has no main text.

    Null pages count as empty. Other columns are not read and may have any name; null ids stay,
    repeated rows come out once a row, an empty table gives no rows. A page is read whole.
    """
    ship_code(pages.sparkSession)
    schema = StructType([*(pages.schema[c] for c in keep), StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    page = F.coalesce(pages[html_col].cast("string"), F.lit(""))
    return pages.select(*[pages[c] for c in keep], page.alias("_page")).mapInArrow(run, schema)


@query("op2_page_text")
def op2(spark, sf_dir):
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
