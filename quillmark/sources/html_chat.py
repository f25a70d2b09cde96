"""Imports that need a parser: HTML to text, and NUL audits of nested JSON."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):  # noqa: ANN001
        self.hidden += tag in ("script", "style")
        if tag in ("p", "div", "li", "br", "tr", "h1", "h2", "h3"):
            self.parts.append("\n")

    def handle_endtag(self, tag):  # noqa: ANN001
        self.hidden -= tag in ("script", "style") and self.hidden > 0

    def handle_data(self, data):  # noqa: ANN001
        if not self.hidden:
            self.parts.append(data)


def html_text(page: str | None) -> str:
    parser = _Text()
    parser.feed(page or "")
    parser.close()
    lines = (" ".join(line.split()) for line in "".join(parser.parts).split("\n"))
    return "\n".join(line for line in lines if line)


def import_html(pages: DataFrame) -> DataFrame:
    """page_id, url and the text of each page, a batch of pages at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"page_id": f["page_id"], "url": f["url"], "text": f["html"].map(html_text)})

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, url string, text string")


def json_nul_count(c: Column) -> Column:
    """NULs in the string values and keys of a JSON text: escapes \\u0000 outside of escaped backslashes, and raw ones."""
    plain = F.regexp_replace(c, r"\\\\", "")
    return (F.coalesce(F.regexp_count(plain, F.lit(r"\\u0000")), F.lit(0)) + F.length(c) - F.length(F.translate(c, "\0", ""))).cast("long")


def parsed_nul_count(c: Column) -> Column:
    """NULs in all keys and string values, at any depth, of the parsed JSON; of a text that is not JSON, the raw ones."""
    parsed = F.to_json(F.try_parse_json(c))
    return F.when(parsed.isNotNull(), json_nul_count(parsed)).otherwise((F.length(c) - F.length(F.translate(c, "\0", ""))).cast("long"))
