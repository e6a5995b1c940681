"""Field extraction from HTML pages held in a table."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

# Elements without an end tag.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr"}


def _wants(selector: str, tag: str, classes: list[str]) -> bool:
    name, _, cls = selector.partition(".")
    return (not name or name == tag) and (not cls or cls in classes)


class _Listing(HTMLParser):
    """Collects, per container element, the text of the first match of every field selector."""

    def __init__(self, container: str, fields: dict[str, str]):
        super().__init__(convert_charrefs=True)
        self.container, self.fields = container, fields
        self.open: list[str] = []
        self.found: list[dict[str, list[str]]] = []
        self.active: list[tuple[int, dict]] = []
        self.reading: list[tuple[int, list[str]]] = []

    def handle_starttag(self, tag, attrs):
        classes = (dict(attrs).get("class") or "").split()
        depth = len(self.open)
        for _, item in self.active:
            for field, selector in self.fields.items():
                if field not in item and _wants(selector, tag, classes):
                    item[field] = []
                    if tag not in VOID:
                        self.reading.append((depth, item[field]))
        if _wants(self.container, tag, classes):
            item: dict[str, list[str]] = {}
            self.found.append(item)
            self.active.append((depth, item))
        if tag not in VOID:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag in self.open:
            depth = len(self.open) - 1 - self.open[::-1].index(tag)
            del self.open[depth:]
            self.active = [a for a in self.active if a[0] < depth]
            self.reading = [r for r in self.reading if r[0] < depth]

    def handle_data(self, data):
        for _, parts in self.reading:
            parts.append(data)


def listings_of(html: str, container: str, fields: dict[str, str]) -> list[dict[str, str | None]]:
    parser = _Listing(container, fields)
    parser.feed(html)
    parser.close()
    return [{f: "".join(item[f]).strip() if f in item else None for f in fields} for item in parser.found]


def extract_listings(pages: DataFrame, container: str = "div.job-listing",
                     fields: dict[str, str] | None = None, key: str = "page_id",
                     html: str = "html") -> DataFrame:
    """One row per ``container`` element of every page that holds all ``fields``.

    Selectors are ``tag``, ``.class`` or ``tag.class``. Pages are handled batch by batch where
    they are stored; only the key and the page text reach Python.
    """
    fields = fields or {"title": "h2", "company": "span.company"}
    key_type = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (page, n, *(item[f] for f in fields))
                for page, text in zip(batch[key], batch[html])
                for n, item in enumerate(listings_of(text or "", container, fields))
                if all(item[f] for f in fields)
            ]
            yield pd.DataFrame(rows, columns=[key, "element", *fields])

    schema = ", ".join([f"`{key}` {key_type}", "element int"] + [f"`{f}` string" for f in fields])
    return pages.select(key, html).mapInPandas(run, schema)


def extract_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Target and position of every ``<a href="...">`` of every page, with JVM expressions only."""
    from pyspark.sql import functions as F

    hrefs = F.regexp_extract_all(F.col(html), F.lit('<a [^>]*href="([^"]*)"'), F.lit(1))
    return pages.select(key, F.posexplode(hrefs).alias("element", "href"))
