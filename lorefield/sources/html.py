"""HTML pages to Markdown."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lorefield.functions.strings import as_column

SKIPPED = {"script", "style", "nav", "noscript", "template"}
# Of these a missing end tag is common; the next main block then ends them.
OPEN = {"nav", "template", "noscript"}
ENDS_SKIPPED = {"main", "article", "section", "h1", "footer"}
CELLS = {"td", "th"}
HEADINGS = {f"h{n}": "#" * n + " " for n in range(1, 7)}
BLOCKS = {"p", "div", "section", "article", "ul", "ol", "table", "tr", "blockquote", "pre", "header", "footer", "main"}


class _Page(HTMLParser):
    """Collects Markdown; tolerates unclosed tags."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.skipped: list[str] = []
        self.links: list[str] = []
        self.pre = 0

    @property
    def skip(self) -> bool:
        return bool(self.skipped)

    def handle_starttag(self, tag, attrs):
        if tag in SKIPPED:
            self.skipped.append(tag)
        elif self.skip and tag in ENDS_SKIPPED and self.skipped[-1] in OPEN:
            self.skipped.clear()  # never closed: the page goes on here
        if tag not in SKIPPED and not self.skip:
            given = dict(attrs)
            if tag in HEADINGS:
                self.parts.append("\n\n" + HEADINGS[tag])
            elif tag == "li":
                self.parts.append("\n- ")
            elif tag == "br":
                self.parts.append("\n")
            elif tag in CELLS:
                self.parts.append(" ")
            elif tag in BLOCKS:
                self.parts.append("\n\n")
                self.pre += tag == "pre"
            elif tag == "img":
                self.parts.append(f"![{given.get('alt') or ''}]({given.get('src') or ''})")
            elif tag == "a":
                self.close_link()  # links do not nest
                self.links.append(given.get("href") or "")
                self.parts.append("[")

    def handle_endtag(self, tag):
        if tag in SKIPPED:
            if tag in self.skipped:
                while self.skipped.pop() != tag:
                    pass
        elif not self.skip:
            if tag == "a":
                self.close_link()
            elif tag in HEADINGS or tag in BLOCKS:
                self.parts.append("\n\n")
                self.pre = max(0, self.pre - (tag == "pre"))

    def close_link(self):
        if self.links:
            self.parts.append(f"]({self.links.pop()})")

    def handle_data(self, data):
        if not self.skip:
            self.parts.append(data if self.pre else re.sub(r"\s+", " ", data))


def _title(html: str) -> re.Match | None:
    return re.search(r"<title[^>]*>.*?</title>", html, re.S | re.I)


def page_markdown(html: str | None) -> str | None:
    """Markdown of one page, without its head title."""
    if html is None:
        return None
    found = _title(html)
    page = _Page()
    page.feed(html[:found.start()] + html[found.end():] if found else html)
    page.close()
    page.close_link()
    lines = (line.strip() for line in "".join(page.parts).split("\n"))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def html_to_markdown(col: Column | str) -> Column:
    @F.pandas_udf("string")
    def convert(pages: pd.Series) -> pd.Series:
        return pages.map(page_markdown)

    return convert(as_column(col))


def convert_pages(df: DataFrame, html: str = "html", name: str = "url") -> DataFrame:
    """+ ``markdown, filename, file_size`` (bytes of the page); the HTML column is dropped."""
    return df.select(*[c for c in df.columns if c != html], html_to_markdown(html).alias("markdown"),
                     F.col(name).alias("filename"), F.octet_length(html).alias("file_size"))
