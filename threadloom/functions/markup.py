"""Page metadata: one Arrow pass with the standard library's parser."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Elements whose text is left out of a page's main text. Fixed values.
OUTSIDE = ("script", "style", "nav", "header", "footer")
PAGE = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("title", "description", "keywords", "og_title", "og_description", "text_content")]
    + [T.StructField(c, T.ArrayType(T.StringType())) for c in ("links", "images")]
)


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.in_title = None, False
        self.meta: dict[str, str] = {}
        self.links: set[str] = set()
        self.images: set[str] = set()
        self.outside, self.text = 0, []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in OUTSIDE:
            self.outside += 1
        elif tag == "title" and self.title is None:
            self.in_title, self.title = True, ""
        elif tag == "meta" and (name := a.get("name") or a.get("property")):
            self.meta.setdefault(name.lower(), a.get("content") or "")
        elif tag == "a" and _absolute(a.get("href")):
            self.links.add(a["href"])
        elif tag == "img" and _absolute(a.get("src")):
            self.images.add(a["src"])

    def handle_endtag(self, tag):
        if tag in OUTSIDE:
            self.outside = max(0, self.outside - 1)
        elif tag == "title":
            self.in_title = False

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        if not self.outside:
            self.text.append(data)


def _absolute(url: str | None) -> bool:
    scheme, sep, rest = (url or "").partition("://")
    return bool(scheme and sep and rest and rest[0] not in "/?#")


def read_page(html: str | None) -> dict:
    p = _Page()
    try:
        p.feed(html or "")
        p.close()
    except (AssertionError, ValueError):  # what was read so far counts
        pass
    chunks = (x.strip() for line in "".join(p.text).splitlines() for x in line.strip().split("  "))
    return {
        "title": p.title,
        "description": p.meta.get("description"),
        "keywords": p.meta.get("keywords"),
        "og_title": p.meta.get("og:title"),
        "og_description": p.meta.get("og:description"),
        "text_content": " ".join(x for x in chunks if x),
        "links": sorted(p.links),
        "images": sorted(p.images),
    }


@F.pandas_udf(PAGE)
def page_of(html: pd.Series) -> pd.DataFrame:
    """Title, descriptions, main text, absolute links and images of pages."""
    return pd.DataFrame([read_page(h) for h in html], columns=PAGE.names)


def title_of(html: Column) -> Column:
    """The title alone, as an expression, for pages that close their tags."""
    return F.nullif(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit(""))


def links_of(html: Column) -> Column:
    """Distinct absolute links of well-formed pages, sorted, as an expression."""
    found = F.regexp_extract_all(html, F.lit(r'<a\s[^>]*href="([^"]*)"'), F.lit(1))
    return F.array_sort(F.array_distinct(F.filter(found, lambda u: u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]"))))
