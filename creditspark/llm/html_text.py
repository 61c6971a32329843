"""Main text of web pages by two passes over their text blocks.

First pass: link density, length and stop-word density decide each block where they can, and
markup that names its role (navigation, header, footer, sidebar, advert, form, comments ...)
decides against. Second pass: a block still open, mostly short ones, takes the label of the
nearest decided block. Distances count the blocks between, and leaving a container counts as
more; the edges of a page count as decided against and those of an article or main element for.

Stop words are of four languages. Where no long block of little linked text on a page has their
density, the page is in another language (or is code, tables, names), and its long blocks are
decided by length and links alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import rows_of

STOP_WORDS = frozenset(
    # English
    "a about after all also an and any are as at be been but by can could do for from had has have he her his how i if in "
    "into is it its may more most no not of on one or other our out over she so some such than that the their them there "
    "these they this to under up was we were what when which who will with would you "
    # German
    "aber als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer es für hat ich ihr im "
    "ist kann man mit nach nicht noch nur oder sein sich sie sind so über um und uns unter vom von vor war was wie wir wird "
    "zu zum zur "
    # French
    "au aux avec ce cette comme dans de des du elle en est et être il ils je la le les leur lui mais ne nous ont ou par pas "
    "plus pour qu que qui sa sans se ses son sont sur un une vous y à été "
    # Spanish
    "al como con cuando de del desde donde el ella en entre es esta este esto fue ha hay la las le lo los mas me más muy no "
    "nos o para pero por porque que se ser si sin sobre son su sus también un una uno y ya".split()
)
SHORT = 70  # characters
LONG = 200
LOW = 0.10  # stop words among words
HIGH = 0.18
LINKS = 0.3  # characters within links

_DROPPED = frozenset(
    "script style noscript template iframe object embed svg canvas math head title textarea select option button "
    "audio video map datalist".split()
)
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_AGAINST = frozenset("nav footer aside form menu dialog".split())
_FOR = frozenset(["article", "main"])
#: Words in class, id and role values that name parts other than the article.
_ROLES = frozenset(
    "ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments contentinfo cookie "
    "cookies consent copyright disqus footer form gdpr login masthead menu modal nav navbar navigation newsletter notice "
    "notification pagination pager popup promo promoted promotion recommended related replies reply respond search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget alert complementary "
    "header topbar".split()
)
_ENDS_P = _BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}}
_HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tr": {"table"}}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</\s*([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:/?>|\Z)",
    re.S,
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORDS = re.compile(r"[^\W\d_]+")
_DENSE = re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")  # kana, Chinese characters, Hangul


class _Element:
    __slots__ = ("tag", "dropped", "against", "link", "path")

    def __init__(self, tag, dropped, against, link, path):
        self.tag, self.dropped, self.against, self.link, self.path = tag, dropped, against, link, path


def _other_role(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element's name, class, id or role says that it is not part of the article.

    Of an article's own header only the word says so: its headline stands there.
    """
    if tag in _AGAINST or tag == "header" and not inside:
        return True
    if tag in ("html", "body") or tag in _FOR or not attributes:
        return False
    names = " ".join(a or b or c for a, b, c in _NAMED.findall(attributes))
    found = {w.lower() for w in _PARTS.findall(names)} & _ROLES
    return bool(found - {"header"} if inside else found)


class _Block:
    __slots__ = ("text", "linked", "against", "path", "label")

    def __init__(self, text, linked, against, path):
        self.text, self.linked, self.against, self.path, self.label = text, linked, against, path, None


def blocks(html: str) -> list[_Block]:
    """Text blocks in page order, character references decoded, blanks within them made one space."""
    found: list[_Block] = []
    stack = [_Element("", False, False, False, ())]
    parts: list[str] = []
    linked, serial, breaks = 0, 0, 0

    def close() -> None:
        nonlocal linked, breaks
        text = " ".join("".join(parts).split())
        if text:
            top = stack[-1]
            found.append(_Block(text, min(linked, len(text)), top.against, top.path))
        parts.clear()
        linked, breaks = 0, 0

    def say(raw: str) -> None:
        nonlocal linked, breaks
        if stack[-1].dropped or not raw:
            return
        text = unescape(raw)
        parts.append(text)
        if text.strip():
            breaks = 0
        if stack[-1].link:
            linked += len(" ".join(text.split()))

    def end(at: int) -> None:
        """Elements from ``at`` on end."""
        if any(e.tag in _BLOCKS or e.tag in _DROPPED for e in stack[at:]):
            close()
        del stack[at:]

    at, size = 0, len(html)
    while at < size:
        token = _TOKEN.search(html, at)
        if token is None:
            say(html[at:])
            break
        say(html[at : token.start()])
        at = token.end()
        if token[1]:
            tag = token[1].lower()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    end(i)
                    break
                if stack[i].tag in ("article", "main", "body", "nav", "table") and tag not in _BLOCKS:
                    break
            else:
                if tag in _BLOCKS:
                    close()
        elif token[2]:
            tag = token[2].lower()
            if tag in ("br", "wbr"):
                breaks += tag == "br"
                if breaks > 1:
                    close()
                elif tag == "br":
                    parts.append(" ")
                continue
            if tag in _ENDS_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        end(i)
                        break
                    if stack[i].tag in _BLOCKS:
                        break
            if tag in _ENDS:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in _ENDS[tag]:
                        end(i)
                        if tag != "tr":
                            break
                    elif stack[i].tag in _HOLDS[tag]:
                        break
            if tag in _BLOCKS:
                close()
            if tag in _VOID or token[0].endswith("/>") and tag not in _BLOCKS and tag not in _RAW:
                continue
            top = stack[-1]
            serial += 1
            inside = any(e.tag in _FOR for e in stack)
            # a page's article stands on its own, whatever a wrapper's class says; one within another (a comment) does not
            own = tag in _FOR and not inside and not any(e.tag in _AGAINST for e in stack)
            against = not own and top.against or tag in _BLOCKS | {"span", "a"} and _other_role(tag, token[3], inside)
            path = (*top.path, (tag, serial)) if tag in _BLOCKS and tag not in ("p", "html", "body") else top.path
            stack.append(_Element(tag, top.dropped or tag in _DROPPED, against, top.link or tag == "a", path))
            if tag in _RAW:
                close_tag = re.compile(rf"</\s*{tag}\b", re.I).search(html, at)
                stop = close_tag.start() if close_tag else size
                say(html[at:stop])
                at = stop
    close()
    return found


def _density(block: _Block, stop_words: frozenset[str]) -> float:
    words = _WORDS.findall(block.text.lower())
    return sum(w in stop_words for w in words) / max(1, len(words))


def _units(text: str) -> int:
    """Length of a text; a letter of scripts that write a word in one or two counts as three."""
    return len(text) + 2 * len(_DENSE.findall(text))


def _decide(block: _Block, density: float | None, known: bool) -> bool | None:
    """Label by the block alone: True, False, or None where it does not suffice.

    ``density``: of stop words, for blocks long enough to have one. ``known``: stop words tell on this page.
    """
    if block.against:
        return False
    if block.linked > LINKS * len(block.text):
        return False
    if density is None:
        return None
    if not known:
        return True
    if density >= HIGH or density >= LOW and len(block.text) >= LONG:
        return True
    if density < LOW and not any(tag in _FOR for tag, _ in block.path):
        return False
    return None


def _steps(a: tuple, b: tuple) -> int:
    """Containers left and entered on the way from one block to another."""
    same = 0
    for x, y in zip(a, b):
        if x != y:
            break
        same += 1
    return len(a) + len(b) - 2 * same


def label(found: list[_Block], stop_words: frozenset[str] = STOP_WORDS) -> None:
    """Both passes over a page's blocks. Of neighbours equally near, the one for the article counts."""
    dense = [_density(b, stop_words) if _units(b.text) >= SHORT else None for b in found]
    # role words and links apart, does any long block have the density of a language known?
    known = any(d is not None and d >= LOW and not b.against and b.linked <= LINKS * len(b.text) for b, d in zip(found, dense))
    for block, density in zip(found, dense):
        block.label = _decide(block, density, known)
    n = len(found)
    # the nearest decided block (or edge) before each block and after it, in one sweep each way
    sides = []
    for order in (range(n), range(n - 1, -1, -1)):
        nearest, seen = [None] * n, (-1 if order.step > 0 else n, (), False)
        edges: dict = {}
        for i in order:
            path = found[i].path
            holder = next((p for p in reversed(path) if p[0] in _FOR), None)
            if holder is not None and holder not in edges:
                edges[holder] = i - order.step  # the article's own edge, just outside its first block
                depth = path.index(holder) + 1
                seen = (edges[holder], path[:depth], True)
            nearest[i] = seen
            if found[i].label is not None:
                seen = (i, path, found[i].label)
        sides.append(nearest)
    for i, block in enumerate(found):
        if block.label is None:
            options = [
                (abs(i - at) + 2 * _steps(block.path, path), not verdict) for side in sides for at, path, verdict in [side[i]]
            ]
            block.label = not min(options)[1]


def main_text(html: str | None, stop_words: frozenset[str] = STOP_WORDS) -> str:
    """The article's blocks in page order, two newlines between them."""
    found = blocks(html or "")
    label(found, stop_words)
    return "\n\n".join(b.text for b in found if b.label)


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    stop_words: frozenset[str] = STOP_WORDS,
) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of each page's whole html; one row per input row.

    A null or empty page, and one without article text, has an empty text. Ids and urls may be
    null or repeated; other columns play no part. No rows give no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, urls, pages_ in rows_of(batches):
            texts = [main_text(p, stop_words) for p in pages_]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    chosen = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return chosen.mapInArrow(read, "page_id long, url string, text string, n_chars long")
