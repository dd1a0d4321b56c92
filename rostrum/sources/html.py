"""HTML pages to styled paragraphs: a page becomes a stream of texts and breaks, which is then cut at the breaks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = "array<struct<text:string,bold:boolean,italic:boolean>>"

# Elements that begin and end paragraphs, elements and styles that are bold or italic, weights from which text is bold.
BREAKS = frozenset(("p", "div", "br", "h1", "h2", "h3", "h4", "li"))
BOLD, ITALIC, HEAVY = frozenset(("b", "strong")), frozenset(("i", "em")), 600
#: A comment, an element whose content isn't shown, a tag, or text.
PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|head)\b.*?(?:</\1\s*>|\Z)|<(?P<close>/?)(?P<name>[a-z][a-z0-9]*)(?P<rest>[^>]*)>|(?P<text>[^<]+|<)", re.IGNORECASE | re.DOTALL)
STYLE = re.compile(r"""\bstyle\s*=\s*(?:"([^"]*)"|'([^']*)')""", re.IGNORECASE)
WEIGHT, SLANT = re.compile(r"font-weight\s*:\s*(bold|\d+)", re.IGNORECASE), re.compile(r"font-style\s*:\s*(?:italic|oblique)", re.IGNORECASE)

#: Text with its style, or None for a break.
Piece = tuple[str, bool, bool] | None


def styled(name: str, rest: str, within: tuple[bool, bool]) -> tuple[bool, bool]:
    """The style in an element, given that around it."""
    css = next((a or b for a, b in STYLE.findall(rest)), "")
    weight = WEIGHT.search(css)
    heavy = weight is not None and (weight[1].lower() == "bold" or weight[1].isdigit() and int(weight[1]) >= HEAVY)
    return within[0] or name in BOLD or heavy, within[1] or name in ITALIC or SLANT.search(css) is not None


def stream(html: str) -> Iterator[Piece]:
    """The texts of a page, each with the style of the element in which it stands, and its breaks."""
    open_ = [("", (False, False))]
    for m in PIECE.finditer(html):
        if m["text"] is not None:
            yield unescape(m["text"]), *open_[-1][1]
        elif m["name"] is not None:
            name = m["name"].lower()
            if name in BREAKS:
                yield None
            if m["close"]:
                names = [n for n, _ in open_]
                if name in names:  # with all that wasn't closed in it
                    del open_[len(names) - 1 - names[::-1].index(name) :]
            elif name != "br" and not m["rest"].rstrip().endswith("/"):
                open_.append((name, styled(name, m["rest"], open_[-1][1])))


def parse(html: str) -> list[list[dict]]:
    """The paragraphs of a page; blank texts and paragraphs are left out."""
    shown = (x for x in stream(html) if x is None or x[0].strip())
    return [[{"text": t, "bold": b, "italic": i} for t, b, i in run] for is_break, run in groupby(shown, key=lambda x: x is None) if not is_break]


def html_blocks(pages: DataFrame, key: str, html: str, least: int = 0) -> DataFrame:
    """key, seq, segments of each page's paragraphs; pages with fewer than `least` give none. Null and empty pages give none."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, i, x) for k, h in zip(b["key"], b["html"]) if h for p in (parse(h),) if len(p) >= least for i, x in enumerate(p)]
            yield pd.DataFrame(rows, columns=["key", "seq", "segments"])

    return pages.select(F.col(key).alias("key"), F.col(html).alias("html")).mapInPandas(run, f"key {kind}, seq int, segments {BLOCKS}").withColumnRenamed("key", key)
