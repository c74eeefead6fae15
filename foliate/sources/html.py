"""Web pages as Markdown with the standard library's parser, and the interface for layout converters that are plugged in."""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.sources import pdf
from foliate.sources.office import cell, escape, escape_lead, flat, pipe_table

SILENT = {"script", "style", "template", "noscript", "head"}
BLOCKS = {"p", "div", "section", "article", "main", "header", "footer", "nav", "aside", "figure", "figcaption", "ul", "ol", "dl", "dt", "dd", "form", "address", "blockquote", "body", "html"}


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[str] = []
        self.text: list[str] = []
        self.silent = 0
        self.heading = 0
        self.lists: list[list] = []
        self.item = ""
        self.rows: list[list[str]] | None = None
        self.link: tuple[int, str] | None = None
        self.code = False

    def flush(self) -> None:
        raw = "".join(self.text)
        self.text, self.link = [], None
        if self.code:
            if raw.strip("\n"):
                ticks = "`" * max(3, max(map(len, re.findall("`+", raw)), default=0) + 1)
                self.blocks.append(f"{ticks}\n" + raw.strip("\n") + f"\n{ticks}")
            return
        if body := flat(raw):
            lead = escape_lead(body)
            self.blocks.append("#" * self.heading + " " + lead if self.heading else self.item + body if self.item else lead)
        self.heading, self.item = 0, ""

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SILENT:
            self.silent += 1
        elif self.rows is not None and tag in ("tr", "td", "th"):
            if tag == "tr":
                self.rows.append([])
            self.text = []
        elif re.fullmatch("h[1-6]", tag):
            self.flush()
            self.heading = int(tag[1])
        elif tag == "table":
            self.flush()
            self.rows = []
        elif tag == "pre":
            self.flush()
            self.code = True
        elif tag == "br":
            self.text.append(" ")
        elif tag == "a":
            self.link = (len(self.text), dict(attrs).get("href") or "")
        elif tag == "img" and (alt := dict(attrs).get("alt")):
            self.text.append(escape(alt))
        elif self.rows is None and tag in BLOCKS | {"li", "hr"}:
            self.flush()
            if tag in ("ul", "ol"):
                self.lists.append([tag, 0])
            elif tag == "li":
                kind = self.lists[-1] if self.lists else ["ul", 0]
                kind[1] += 1
                self.item = "  " * max(0, len(self.lists) - 1) + ("- " if kind[0] == "ul" else f"{kind[1]}. ")

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag == "a" and self.link:
            at, url = self.link
            inner = flat("".join(self.text[at:]))
            if inner and url.startswith(("http://", "https://")):
                self.text[at:] = [f"[{inner}]({url})"]
            self.link = None
        elif self.rows is not None:
            if tag in ("td", "th") and self.rows:
                self.rows[-1].append(cell("".join(self.text)))
                self.text = []
            elif tag == "table":
                self.blocks.append(pipe_table(self.rows))
                self.rows, self.text = None, []
        elif tag == "pre":
            self.flush()
            self.code = False
        elif tag in BLOCKS or tag == "li" or re.fullmatch("h[1-6]", tag):
            self.flush()
            if tag in ("ul", "ol") and self.lists:
                self.lists.pop()

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.text.append(data if self.code else escape(data))


def page_markdown(source: str | None) -> str:
    """The visible content of a page as Markdown."""
    page = _Page()
    page.feed(source or "")
    page.close()
    page.flush()
    out, before = "", ""
    for block in filter(None, page.blocks):
        item = bool(re.match(r" *(?:- |\d+\. )", block))
        out += ("" if not out else "\n" if item and before == "item" else "\n\n") + block
        before = "item" if item else "block"
    return out + "\n" if out else ""


@F.pandas_udf(T.StringType())
def html_markdown(source: pd.Series) -> pd.Series:
    return source.map(page_markdown)


#: Converters for layout documents by extension: bytes -> dict(markdown, source_text, properties, error). That for PDF reads the text layer.
LAYOUT: dict[str, Callable[[bytes], dict]] = {"pdf": pdf.convert}


def register_layout_converter(ext: str, convert: Callable[[bytes], dict]) -> None:
    """Plug in a converter; it travels to the executors with the query."""
    LAYOUT[ext.lower().lstrip(".")] = convert


def has_text_layer(pages: list[str], sample: int = 10, least: int = 100) -> bool:
    """Whether the pages at the head and at the tail hold text: the characters of each window a page."""
    windows = [pages[:sample], pages[-sample:]] if len(pages) > sample else [pages]
    return bool(pages) and all(len("".join(w).strip()) / max(1, len(w)) >= least for w in windows)
