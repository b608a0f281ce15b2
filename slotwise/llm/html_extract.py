"""HTML extraction: main text by two-pass block rules.

A page is cut into blocks.  Pass one decides each block from what it stands
in, its link density, stop-word density and length; short blocks without
evidence stay open.  Pass two gives each open block the label of its nearest
decided neighbours.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from slotwise.llm.common import table

# Frequent function words of the supported languages.
STOP_WORDS = frozenset("""
a about all an and are as at be but by for from had has have he her his i in is it its not of on or
she so that the their there they this to was we were which who will with you
au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas
plus pour qu que qui sa se son sur un une vous
als am auch auf aus bei das dem den der des die ein eine einen er es für hat ich im ist mit nicht
noch oder sich sie sind um und von war werden wie wir zu zum zur
al como con de del el ella en es esta este la las lo los más no o para pero por que se si sin son su
sus un una y ya
""".split())
# Elements whose content is never text, elements that are page
# furniture, and elements that start a block.
RAW = frozenset("script style noscript template iframe object svg math canvas audio video textarea select title head".split())
FURNITURE = frozenset("nav footer aside form button dialog menu fieldset".split())
MAIN = frozenset("article main".split())
BLOCK = frozenset("""
address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre
section summary table tbody td tfoot th thead tr ul
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
# a new one of these ends an open one of the same list
SIBLINGS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"),
            "th": ("td", "th"), "tr": ("tr", "td", "th"), "option": ("option",)}
# Words in class, id, role or label that mark page furniture.
MARKS = frozenset("""
ad ads adv advert adverts advertisement advertising advertorial alert alertdialog announcement banner
breadcrumb breadcrumbs comment comments commentlist complementary consent contentinfo cookie cookies
copyright dialog discussion disqus dropdown feedback foot footer form gdpr hint legal login masthead menu
menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination
popup popover privacy promo promoted promotion recommended related replies reply respond
responses search share sharing shoutbox sidebar sidebars signup skip social sponsor sponsored
subscribe subscription toast toolbar tooltip topbar warning widget widgets
""".split())
SITE_MARKS = MARKS | {"header", "top"}      # outside article and main
MAIN_MARKS = frozenset("ad advert comment comments promo related replies reply sponsored teaser".split())
HOLDS = frozenset("has have is no not with without".split())

# A tag's attributes are read once, without going back: quoted values whole, a quote that never closes as it stands.
# Where that does not end like a tag, it ends at the next angle bracket.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*"|'[^']*'|["'])*+)(?:>|(?=<[a-zA-Z/!])|\Z)
    |<(/?)([a-zA-Z][^\s/<>]*)([^<>]*+)(?:>|(?=<[a-zA-Z/!])|\Z)""", re.S | re.X)
ATTR = re.compile(r"""\b(class|id|role|aria-label|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
WORD = re.compile(r"\w+")
PIECES = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

SHORT, LONG = 70, 200       # code points
LINKS = 0.2                 # share of a block's text inside links
STOPS_LOW, STOPS_HIGH = 0.2, 0.32


def marked(attrs: str, marks: frozenset) -> bool:
    """Do class, id, role or label name page furniture, or is the element hidden?"""
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2]
        if name == "hidden":
            return True
        for token in (value or "").strip("\"'").split():
            pieces = PIECES.findall(CAMEL.sub(" ", token).lower())
            # "has-sidebar" says what the element holds, not what it is
            if pieces and pieces[0] not in HOLDS and not marks.isdisjoint(pieces):
                return True
    return False


def blocks_of(page: str) -> list[tuple[str, int, bool, bool, bool, bool]]:
    """(text, code points in links, furniture, inside article or main, heading, list item) of each block in order."""
    out: list[tuple[str, int, bool, bool, bool, bool]] = []
    # open elements: (name, furniture, main, link, heading, list item)
    stack: list[tuple[str, bool, bool, bool, bool, bool]] = []
    parts: list[str] = []
    link_parts: list[str] = []
    bad = main = link = head = item = False

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                linked = len(" ".join(html.unescape("".join(link_parts)).split())) if link_parts else 0
                out.append((text, linked, bad, main, head, item))
            parts.clear()
            link_parts.clear()

    def state() -> tuple[bool, bool, bool, bool, bool]:
        return stack[-1][1:] if stack else (False, False, False, False, False)

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            parts.append(page[at:stop])
            if link:
                link_parts.append(page[at:stop])
        if not m:
            break
        at = max(m.end(), stop + 1)
        closing, name, attrs = m.group(1, 2, 3) if m[2] else m.group(4, 5, 6)
        if name is None:
            continue
        name = name.lower()
        if closing:
            if name in BLOCK:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    bad, main, link, head, item = state()
                    break
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at) if not attrs.endswith("/") else None
            if name == "head" and not close:
                close = re.compile(r"(?=<body)", re.I).search(page, at)
            at = close.end() if close else (at if attrs.endswith("/") else end)
            parts.append(" ")
            continue
        if name in BLOCK:
            flush()
            if name in SIBLINGS:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in SIBLINGS[name]:
                        del stack[i:]
                        bad, main, link, head, item = state()
                        break
                    if stack[i][0] in ("ul", "ol", "table", "div", "article", "section", "blockquote", "td"):
                        break
        if name in VOID:
            continue
        if not bad:
            marks = MAIN_MARKS if name in MAIN else MARKS if main else SITE_MARKS
            bad = (name in FURNITURE or (name == "header" and not main)
                   or (name not in ("html", "body") and bool(attrs) and marked(attrs, marks)))
        main = main or name in MAIN
        link = link or name == "a"
        head = head or name in HEADING
        item = item or name == "li"
        stack.append((name, bad, main, link, head, item))
    flush()
    return out


GOOD, BAD, OPEN = 1, 0, -1


def first_pass(block: tuple[str, int, bool, bool, bool, bool]) -> int:
    text, linked, bad, main, head, item = block
    if bad:
        return BAD
    if main:
        # within the article links are text; list items that are nothing but a link may be a menu
        return OPEN if item and not head and linked >= len(text) else GOOD
    if linked > LINKS * len(text):
        return OPEN if head else BAD
    if "©" in text:
        return BAD
    if len(text) < SHORT:
        return OPEN
    words = WORD.findall(text.lower())
    stops = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
    if stops >= STOPS_HIGH or (stops >= STOPS_LOW and len(text) >= LONG):
        return GOOD
    return OPEN if stops >= STOPS_LOW else BAD


def second_pass(blocks: list, labels: list[int]) -> list[int]:
    """Open blocks take the label of the nearest decided neighbours.

    Both neighbours alike: their label.  Unlike: a heading follows the block
    after it; any other block follows the nearer one, on a tie the one before.
    With no decided neighbour at all the page has no furniture to tell apart: good.
    """
    n = len(labels)
    before, after = [None] * n, [None] * n
    last = None
    for i in range(n):
        if labels[i] != OPEN:
            last = i
        before[i] = last
    last = None
    for i in range(n - 1, -1, -1):
        if labels[i] != OPEN:
            last = i
        after[i] = last
    out = []
    for i, x in enumerate(labels):
        if x == OPEN:
            b, a = before[i], after[i]
            if b is None and a is None:
                x = GOOD
            elif b is None or a is None:
                x = labels[a if b is None else b]
            elif labels[b] == labels[a]:
                x = labels[a]
            elif blocks[i][4]:
                x = labels[a]
            else:
                x = labels[b] if i - b <= a - i else labels[a]
        out.append(x)
    return out


def main_text(page: str | None) -> str:
    """The article's blocks in page order, joined by line feeds; empty if there are none."""
    if not page:
        return ""
    blocks = blocks_of(page)
    labels = [first_pass(b) for b in blocks]
    if any(b[3] and x == GOOD for b, x in zip(blocks, labels)):
        # the page says where its article is: nothing outside belongs to it or decides what does
        labels = [x for b, x in zip(blocks, labels) if b[3]]
        blocks = [b for b in blocks if b[3]]
    labels = second_pass(blocks, labels)
    return "\n".join(b[0] for b, x in zip(blocks, labels) if x == GOOD)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with ``html_col`` replaced by ``text_col`` and its code points ``n_chars``.

    Row by row: repeated rows stay, other columns pass through (a clashing
    ``text_col`` or ``n_chars`` is replaced).  A null or empty page has the
    empty text.
    """
    keep = [c for c in pages.columns if c not in (html_col, text_col, "n_chars")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x) for x in b.column(html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=[*keep, text_col, "n_chars"])

    from pyspark.sql.types import LongType, StringType, StructType
    schema = StructType([*(pages.schema[c] for c in keep)]).add(text_col, StringType()).add("n_chars", LongType())
    return pages.select(*keep, html_col).mapInArrow(task, schema)


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
