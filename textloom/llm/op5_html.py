"""Main text of HTML pages by two passes of block rules.

A page is cut into blocks at block-level tags and at doubled line breaks; scripts, styles, titles, form choices and comments
have no text (nor has one that isn't closed, but for what follows it). The first pass classifies each block on its own:

* bad: over ``LINKS`` of its characters are in links, or it has a copyright sign;
* short: under ``SHORT`` characters, and bad if any of them is in a link;
* good: a share of stop words of ``STOP_HIGH`` or more in over ``LONG`` characters, near-good if shorter;
* near-good: a share of at least ``STOP_LOW``; else bad.

In the second pass a short or near-good block inherits: from its nearest decided neighbours (good or bad; the page's ends are
bad) where they agree. Where they differ, a short block is good only next to a near-good one on the bad side, a near-good
one always. A heading is good before that, when a good or near-good block begins within ``HEADING`` characters below it.

Contract: one row a page (page_id, text, n_blocks, n_good); the good blocks are joined by a blank line. Null, empty and
tag-less pages have the text of their good blocks as others do (none, for null and empty ones). A tag that isn't closed by
``>`` before the next ``<`` is text. Repeated rows each get a row, null ids are carried. An empty table gives no rows. Other
columns don't matter, whatever their names.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import arrays
from textloom.llm.op2_quality import STOP

LINKS, SHORT, LONG, STOP_LOW, STOP_HIGH, HEADING = 0.2, 70, 200, 0.1, 0.14, 200
_STOP = frozenset(STOP)
#: Elements without text: from the tag to its end tag. One that closes itself, or never, holds nothing; a raw one that never closes
#: holds the rest of the page.
_RAW = frozenset("script style textarea title".split())
_SILENT = _RAW | frozenset("noscript template svg iframe object select".split())
_END = {n: re.compile(rf"</{n}\s*>", re.I) for n in _SILENT}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-z][a-z0-9:-]*)[^<>]*>|<[!?][^<>]*>", re.S | re.I)
_BLOCK = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    link_chars: int
    heading: bool
    kind: str = ""


def blocks(page: str) -> list[Block]:
    """The page's blocks with text, in order."""
    out: list[Block] = []
    parts: list[str] = []
    linked = heading = breaks = 0
    in_link = False
    link_parts: list[str] = []

    def clean(p: list[str]) -> str:
        return " ".join(html.unescape("".join(p)).split())

    def flush() -> None:
        nonlocal linked
        text = clean(parts)
        if text:
            out.append(Block(text, min(len(text), linked + len(clean(link_parts))), bool(heading)))
        parts.clear()
        link_parts.clear()
        linked = 0

    at = 0
    open_: set[str] = set()  # silent elements that no longer end
    while m := _TAG.search(page, at):
        if m.start() > at:
            piece = page[at : m.start()]
            parts.append(piece)
            if in_link:
                link_parts.append(piece)
            if not piece.isspace():
                breaks = 0
        at = m.end()
        name = (m[2] or "").lower()
        if name in _SILENT:
            if not m[1] and name not in open_ and (name in _RAW or page[at - 2] != "/"):
                if end := _END[name].search(page, at):
                    at = end.end()
                elif name in _RAW:
                    at = len(page)
                else:
                    open_.add(name)
        elif name == "br":
            breaks += 1
            parts.append(" ")
            if breaks > 1:
                flush()
        elif name == "a":
            linked += len(clean(link_parts))
            link_parts.clear()
            in_link = not m[1]
        elif name in _BLOCK:
            flush()
            breaks = 0
            in_link = False
            heading = int(name[0] == "h" and name[1:].isdigit() and not m[1])
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


def classify(found: list[Block]) -> None:
    """Both passes; sets each block's kind to good or bad."""
    first = []
    for b in found:
        n, share = len(b.text), b.link_chars / len(b.text)
        if share > LINKS or "©" in b.text:
            kind = "bad"
        elif n < SHORT:
            kind = "bad" if b.link_chars else "short"
        else:
            words = _WORD.findall(b.text.lower())
            stops = sum(map(_STOP.__contains__, words)) / max(1, len(words))
            kind = ("good" if n > LONG else "near") if stops >= STOP_HIGH else "near" if stops >= STOP_LOW else "bad"
        first.append(kind)
    below = [0] * len(found)  # characters from the end of a block to the next good or near-good one
    far = HEADING + 1
    for i in range(len(found) - 1, -1, -1):
        below[i] = far
        far = 0 if first[i] in ("good", "near") else far + len(found[i].text)
    own = ["good" if k == "short" and b.heading and d <= HEADING else k for k, b, d in zip(first, found, below)]
    before, last = [], ("bad", "bad")
    for k in own:
        before.append(last)
        last = (k, k) if k in ("good", "bad") else (last[0], "near" if k == "near" else last[1])
    after, last = [], ("bad", "bad")
    for k in reversed(own):
        after.append(last)
        last = (k, k) if k in ("good", "bad") else (last[0], "near" if k == "near" else last[1])
    after.reverse()
    for b, k, (p, p_near), (q, q_near) in zip(found, own, before, after):
        if k in ("good", "bad"):
            b.kind = k
        elif p == q:
            b.kind = p
        elif k == "near":
            b.kind = "good"
        else:
            b.kind = "good" if (p == "bad" and p_near == "near") or (q == "bad" and q_near == "near") else "bad"


def extract(page: str | None) -> tuple[str, int, int]:
    """(text, blocks, good blocks) of a page."""
    found = blocks(page or "")
    classify(found)
    good = [b.text for b in found if b.kind == "good"]
    return "\n\n".join(good), len(found), len(good)


def main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text, n_blocks, n_good) of every page."""

    @F.arrow_udf("text string, n_blocks int, n_good int")
    def run(arr: pa.Array) -> pa.Array:
        got = [extract(p.as_py()) for piece in arrays.pieces(arr) for p in piece]
        text, n, good = zip(*got) if got else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(text, pa.string()), pa.array(n, pa.int32()), pa.array(good, pa.int32())], ["text", "n_blocks", "n_good"])

    got = pages.select(F.col(id_col).alias("page_id"), run(F.col(html_col)).alias("got"))
    return got.select("page_id", "got.text", "got.n_blocks", "got.n_good")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {"op5_html": op5_html}
SQL: dict[str, str] = {}
