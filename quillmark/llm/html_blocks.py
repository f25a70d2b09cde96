"""HTML extraction by two-pass block rules.

Markup is cut into blocks at block-level tags. The first pass decides blocks by length, stop-word density and
link density: long or stop-word-rich ones are text, link lists are not. Blocks that stay undecided, short ones above all, inherit,
in the second pass, the label of the nearest decided block before or after them (the nearer by
number of blocks; of two as near, the article's; a heading goes with what it heads).

Markup is evidence beside that, for what no density tells from an article: readers' comments, notices and
sidebars are prose too. A block is set apart that lies in an element for such things (by element, role,
class or id), but not where that element holds the article or main part, or, on a page that marks none, nearly all
the page's prose: then it is a wrapper, whatever its name. A paragraph goes by a whole name only, so that
class="share-price" is no share button. Where a page marks its article or main part, only that part can
hold the text. Density still decides in it: three blocks of links or more in a row are a list and no text, short blocks go
with their neighbours, be those text or list, and a lone link too; where nothing in it is decided, its undecided blocks without links are text.

Defined cases: null html is an empty page with an empty text. Repeated rows are extracted one by
one. Broken markup is read as far as it goes: unclosed elements end with their parents. Pages of any
length are read whole. Ties are settled as said above. An empty table gives an empty result. Extra columns are dropped.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from quillmark.llm.bytebpe import slices
from quillmark.llm.divergence import COMMON_WORDS

RESULT = "page_id long, url string, text string, n_chars long"
#: Elements that start and end blocks.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is no text of the page.
RAW = ("script", "style", "noscript", "template", "textarea", "select", "iframe", "svg", "math", "object", "canvas", "title")
#: Elements that hold no article text.
AROUND = frozenset("nav aside footer header form menu dialog button".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id or role names of markup around an article.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie cookies copyright disclaimer disqus footer header login masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo promoted promotion related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar widget".split()
)
STOP = frozenset(w for words in COMMON_WORDS.values() for w in words)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}
PIECES = re.compile(r"[a-z]+")


#: Elements that hold text themselves; their classes count as whole names only.
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre figcaption dd dt td th".split())
Block = tuple[str, int, tuple[int, ...], bool, bool]


def _set_apart(name: str, attributes: str, in_article: bool) -> bool:
    """Is the element one of those for what is around an article?"""
    if name in AROUND and not (name == "header" and in_article):
        return True
    if name in ("body", "html", "article", "main") or "=" not in attributes:
        return False
    for _, value in ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        if not NAMES.isdisjoint(value.split() if name in TEXT else PIECES.findall(value)):
            return True
    return False


def _is_prose(text: str, linked: int, short: int, long: int, max_link_density: float, low_stop: float, high_stop: float) -> bool:
    if linked > max_link_density * len(text):
        return False
    words = text.lower().split()
    stop = sum(w.strip(".,;:!?") in STOP for w in words) / len(words)
    return len(text) >= long or (len(text) >= short and stop >= low_stop) or (stop >= high_stop and len(words) >= 5)


def blocks_of(page: str) -> tuple[list[Block], set[int]]:
    """Each block with a character (text, characters in links, elements that set it apart, heading?, in the
    article?), and which of those elements hold an article or main part."""
    out: list[Block] = []
    stack: list[tuple[str, int | None]] = []  # open elements, and the number of each that sets apart
    text: list[tuple[str, bool]] = []
    apart: list[int] = []
    holders: set[int] = set()
    links = article = numbered = 0
    heading = False

    def flush() -> None:
        nonlocal text
        if text:
            whole = " ".join(html.unescape("".join(t for t, _ in text)).split())
            if whole:
                linked = len(" ".join(html.unescape("".join(t for t, in_link in text if in_link)).split()))
                out.append((whole, linked, tuple(apart), heading, article > 0))
            text = []

    def close(i: int) -> None:
        nonlocal links, article, heading
        while len(stack) > i:
            name, number = stack.pop()
            if number is not None:
                apart.pop()
            links -= name == "a"
            article -= name in ("article", "main")
            if name[0] == "h" and name[1:] in "123456" and len(name) == 2:
                heading = False

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            text.append((page[at:], links > 0))
            break
        if m.start() > at:
            text.append((page[at : m.start()], links > 0))
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                text.append((html.escape(m[0][9:].removesuffix("]]>")), links > 0))
            continue
        name = m[2].lower()
        if not m[1] and name in RAW_END:
            if name == "title":
                flush()
            end = RAW_END[name].search(page, at)
            at = end.end() if end else n
            continue
        if name == "br":
            text.append((" ", links > 0))
            continue
        block = name in BLOCKS
        if block:
            flush()
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close(i)
                    break
                if not block and stack[i][0] in BLOCKS:
                    break
            continue
        if name in VOID or m[3].endswith("/") and not block:
            continue
        if block:  # a new block ends a paragraph, and a new item the item before it
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or stack[i][0] == name and name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    close(i)
                    break
                if stack[i][0] in BLOCKS:
                    break
        number = None
        if _set_apart(name, m[3], article > 0):
            number, numbered = numbered, numbered + 1
            apart.append(number)
        elif name in ("article", "main"):
            holders.update(apart)
        stack.append((name, number))
        links += name == "a"
        article += name in ("article", "main")
        heading = heading or (len(name) == 2 and name[0] == "h" and name[1] in "123456")
    flush()
    return out, holders


def decisions(blocks: list[Block], holders: set[int], short: int = 70, long: int = 200, max_link_density: float = 0.4, low_stop: float = 0.12, high_stop: float = 0.2, wrapper: float = 0.8) -> list[tuple[bool, str]]:
    """Is each block the article's, and by which rule: prose, links, apart, outside, or neighbour."""
    prose = [_is_prose(b[0], b[1], short, long, max_link_density, low_stop, high_stop) for b in blocks]
    wrappers, marked = set(holders), any(b[4] and holders.issuperset(b[2]) for b in blocks)
    if not marked:
        held: dict[int, int] = {}
        for (text, _, apart, _, _), is_prose in zip(blocks, prose, strict=True):
            for e in apart if is_prose else ():
                held[e] = held.get(e, 0) + len(text)
        total = sum(len(b[0]) for b, is_prose in zip(blocks, prose, strict=True) if is_prose)
        wrappers |= {e for e, chars in held.items() if chars >= wrapper * total}
    labels: list[tuple[bool | None, str]] = []
    dense = [linked > max_link_density * len(text) for text, linked, _, _, _ in blocks]
    # In a marked article a link alone may be a sentence of it; three in a row are a list of links.
    listed = [any(all(dense[max(0, j) : j + 3]) and j >= 0 and j + 3 <= len(blocks) for j in (i - 2, i - 1, i)) for i in range(len(blocks))]
    for i, ((text, linked, apart, _, in_article), is_prose) in enumerate(zip(blocks, prose, strict=True)):
        if not wrappers.issuperset(apart):
            labels.append((False, "apart"))
        elif marked and not in_article:
            labels.append((False, "outside"))
        elif is_prose:
            labels.append((True, "prose"))
        elif linked > max_link_density * len(text) and (not marked or listed[i]):
            labels.append((False, "links"))
        else:
            labels.append((None, "neighbour"))
    n = len(labels)
    # What lies outside a marked article, or is set apart inside it, is no neighbour of its blocks.
    decided = [label is not None and not (marked and rule in ("apart", "outside")) for label, rule in labels]
    before, last = [None] * n, None
    for i in range(n):
        before[i] = last = i if decided[i] else last
    after, last = [None] * n, None
    for i in range(n - 1, -1, -1):
        after[i] = last = i if decided[i] else last
    made = []
    for i, (label, rule) in enumerate(labels):
        if label is None:
            near = [j for j in (before[i], after[i]) if j is not None]
            if not near:
                label = blocks[i][3] or (marked and not dense[i])
            elif blocks[i][3] and after[i] is not None:
                label = labels[after[i]][0]
            else:
                least = min(abs(i - j) for j in near)
                label = any(labels[j][0] for j in near if abs(i - j) == least)
        made.append((bool(label), rule))
    return made


def main_blocks(blocks: list[Block], holders: set[int]) -> list[str]:
    """The texts of the article's blocks, in page order."""
    return [b[0] for b, (label, _) in zip(blocks, decisions(blocks, holders), strict=True) if label]


def extract_text(page: str | None) -> str:
    return "\n\n".join(main_blocks(*blocks_of(page or "")))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in slices(batches, "html"):
            texts = [extract_text(h) for h in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["page_id"].cast(pa.int64()), batch["url"].cast(pa.string()), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, RESULT)
