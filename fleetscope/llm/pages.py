"""Main text of web pages by the distribution of text over line blocks.

A page is cut into lines at block-level tags. Markup, scripts, styles, and the contents of containers
that are menus, forms, notices, adverts, footers or comments by tag, role or class become lines of length
0; so do lines that are mostly links outside the article. Sums of text length over a sliding window of
lines rise from zero where a text begins and fall to zero where it ends; what lies between such a surge
and the next dive is kept if a window in it is full enough. Where the page marks an article or main
element, only its lines count, and any text is enough; elsewhere a window needs ``SURGE`` characters, or
as many as the fullest window of the page if none has so many.

Cases: null or empty html, or a page without main text, gives an empty text; unclosed tags end where
their parent does, an unclosed container is not removed, an unclosed comment, script or style runs to the
end of the page; pages of any length are read whole; repeated rows and null ids or urls are rows like any
other; columns with the names of results are replaced, other columns stay.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetscope.llm import words

WINDOW = 3  # lines whose lengths are summed
SURGE = 80  # characters in a window that begin a main text where no element marks it

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+'|["'])*+)>|<[!?][^<>]*+>""", re.S
)
_WORD = re.compile(r"[a-z]+|[0-9]+")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

RAW = {"script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "textarea", "head", "title"}
DROPPED = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select"}
HEADS = {"header"}
ROOTS = {"article", "main"}
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words of a class, id or role that mark a container as no part of the main text.
MARKS = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay pager "
    "pagination popup promo promotion recommended related replies respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe toolbar widget widgets complementary contentinfo".split()
)
#: A name that begins or ends with one of these tells what a container has around it, not what it is.
STATES = {"has", "with", "without", "no", "enabled", "disabled"}
KEPT_WHOLE = {"html", "body", "article", "main", "b", "i", "p", "h1", "h2", "h3", "h4", "h5", "h6"}


def _marked(tag: str, attributes: str) -> bool:
    found: set[str] = set()
    for match in _NAMES.finditer(attributes):
        for name in (match[1] or match[2] or match[3] or "").lower().split():
            parts = _WORD.findall(name)
            if parts and parts[0] not in STATES and parts[-1] not in STATES:
                found.update(parts)
    if tag in KEPT_WHOLE:  # running text is not judged by its class, but an article can be a comment
        return tag == "article" and bool(found & {"comment", "comments", "reply"})
    return bool(found & MARKS) or "header" in found and tag == "div"


def _tokens(page: str) -> list[tuple[str, str, str]]:
    """(kind, tag or text, attributes) with kinds text, open, close; raw elements are left out."""
    out, at = [], 0
    lower = None
    while True:
        match = _TAG.search(page, at)
        if match is None:
            break
        if match.start() > at:
            out.append(("text", page[at : match.start()], ""))
        at, tag = match.end(), (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            out.append(("close", tag, ""))
        elif tag in RAW and not match[3].endswith("/"):
            lower = lower if lower is not None else page.lower()
            end = lower.find(f"</{tag}", at)
            at = len(page) if end < 0 else end
        else:
            out.append(("open", tag, match[3]))
    if at < len(page):
        out.append(("text", page[at:], ""))
    return out


def _ends(tokens: list[tuple[str, str, str]]) -> dict[int, int]:
    """For each opening tag that is closed: the place of its closing tag."""
    ends: dict[int, int] = {}
    waiting: dict[str, list[int]] = {}
    for i, (kind, tag, _) in enumerate(tokens):
        if kind == "open" and tag not in VOID:
            waiting.setdefault(tag, []).append(i)
        elif kind == "close" and waiting.get(tag):
            ends[waiting[tag].pop()] = i
    return ends


def lines_of(page: str) -> tuple[list[str], list[int], bool]:
    """The lines of a page, how much of each counts as main text, and whether an element marks the main text."""
    tokens = _tokens(page)
    ends = _ends(tokens)
    roots = [i for i, (kind, tag, a) in enumerate(tokens) if kind == "open" and tag in ROOTS and not _marked(tag, a)]
    starts = np.array(roots, dtype=np.int64)
    lines: list[str] = []
    counts: list[int] = []
    parts: list[str] = []
    linked = root_until = link_until = 0
    inside_line = False

    def close() -> None:
        nonlocal parts, linked, inside_line
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            lines.append(text)
            counts.append(0 if roots and not inside_line or not roots and 10 * linked > 9 * len(text) else len(text))
        elif not counts or counts[-1]:
            lines.append("")
            counts.append(0)
        parts, linked, inside_line = [], 0, False

    i = 0
    while i < len(tokens):
        kind, tag, attributes = tokens[i]
        if kind == "text":
            parts.append(tag)
            inside_line = inside_line or i < root_until
            if i < link_until:
                linked += len(tag)
        elif kind == "open":
            end = ends.get(i)
            if end is not None:
                own_root = np.searchsorted(starts, i, side="right") < np.searchsorted(starts, end)
                skip = tag in DROPPED or tag in HEADS and i >= root_until or _marked(tag, attributes)
                if skip and not own_root:
                    close()
                    i = end + 1
                    continue
            if tag in ROOTS and not _marked(tag, attributes):
                close()
                root_until = max(root_until, len(tokens) if end is None else end)
            if tag == "a" and end is not None:
                link_until = end
            if tag in BLOCKS:
                close()
            elif tag in ("br", "td", "th", "img"):
                parts.append(" ")
        elif tag in BLOCKS:
            close()
        i += 1
    close()
    return lines, counts, bool(roots)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    lines, counts, marked = lines_of(page)
    if not any(counts):
        return ""
    length = np.array(counts, dtype=np.int64)
    sums = np.convolve(length, np.ones(WINDOW, dtype=np.int64))[WINDOW - 1 :]  # of a line and the next ones
    least = 1 if marked else min(SURGE, int(sums.max()) if len(sums) else 0)
    kept: list[str] = []
    stretch: list[str] = []  # lines since the sums last rose from zero
    peak = 0
    for line, own, ahead in zip(lines, counts, sums):
        if ahead:
            peak = max(peak, int(ahead))
            if own:
                stretch.append(line)
            continue
        kept += stretch if peak >= least else []  # a dive
        stretch, peak = [], 0
    kept += stretch if peak >= least else []
    return "\n\n".join(kept)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` with text and n_chars (its code points) in place of ``column``."""
    spark = pages.sparkSession
    words.use_batches(spark)
    new = ("text", "n_chars")
    kept = [f for f in pages.schema.fields if f.name not in (column, *new)]
    schema = T.StructType([*kept, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for batch in batches:
            texts = [main_text(p) for p in batch.column(column).to_pylist()]
            arrays = [batch.column(f.name) for f in kept]
            arrays += [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in schema])

    return pages.mapInArrow(run, schema)
