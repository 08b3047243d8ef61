"""Articles and links of HTML pages. The tree is built inside one Arrow function; only its results are columns."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import html as H
from corpusloom.schemas import JUNK_SELECTORS, TITLE_LENGTH

DEFAULTS = {"title": "h1", "date": "time", "date_attr": "datetime", "body": "article, main"}


def body_text(body: H.Node | None) -> str:
    """The text nodes of an element without junk, one a line."""
    if body is None:
        return ""
    for node in H.select_any(body, JUNK_SELECTORS):
        node.remove()
    return re.sub(r"\n{3,}", "\n\n", body.text("\n")).strip()


def read_article(page: str, url: str, selectors: dict, title: str = "", date: str = "") -> tuple[str, str, str]:
    """Title, date as written, and body of a page. What the feed said about title and date is kept."""
    root = H.parse(page)
    s = {k: selectors.get(k) if selectors.get(k) is not None else v for k, v in DEFAULTS.items()}
    if not title:
        node = H.select_first(root, s["title"])
        title = node.text(" ") if node is not None else ""
    if not title:
        node = next((n for n in root.walk() if n.tag == "title"), None)
        title = node.text() if node is not None else url
    if not date:
        for part in H.parts(s["date"]):
            found = H.select(root, part)
            if found:
                date = found[0].attrs.get(s["date_attr"], "") or found[0].text()
                if date:
                    break
    body = H.select_first(root, s["body"])
    if body is None:
        body = next((n for tag in ("main", "article", "body") for n in root.walk() if n.tag == tag), None)
    return title[:TITLE_LENGTH], date, body_text(body)


_ARTICLE = T.StructType([T.StructField(n, T.StringType()) for n in ("title", "date_raw", "body")])


@F.pandas_udf(_ARTICLE)
def _article_udf(html: pd.Series, url: pd.Series, selectors: pd.DataFrame, title: pd.Series, date: pd.Series) -> pd.DataFrame:
    rows = []
    for page, link, chosen, t, d in zip(html, url, selectors.to_dict("records"), title, date):
        try:
            rows.append(read_article(page, link or "", chosen, t or "", d or ""))
        except ValueError:
            # A selector that can't be read: the page counts as unparsable.
            rows.append((None, None, None))
    return pd.DataFrame(rows, columns=["title", "date_raw", "body"])


def selectors_column(title: str = "h1", date: str = "time", date_attr: str = "datetime", body: str = "article, main") -> Column:
    return F.struct(*[F.lit(v).alias(k) for k, v in (("title", title), ("date", date), ("date_attr", date_attr), ("body", body))])


def parse_article(html: Column, url: Column, selectors: Column | None = None, title: Column | None = None, date: Column | None = None) -> Column:
    """A struct of title, date_raw and body; nulls inside where a page can't be read."""
    chosen = selectors if selectors is not None else selectors_column()
    blank = F.lit("")
    return _article_udf(F.coalesce(html, blank), url, chosen, title if title is not None else blank, date if date is not None else blank)


def links_of(page: str, selectors: str) -> list[str]:
    """The distinct hrefs that the selectors match, selector by selector, in page order."""
    root = H.parse(page)
    found = [n.attrs.get("href", "") for part in H.parts(selectors) for n in H.select(root, part)]
    return list(dict.fromkeys(h for h in found if h))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _links_udf(html: pd.Series, selectors: pd.Series) -> pd.Series:
    return pd.Series([links_of(p or "", s or "") for p, s in zip(html, selectors)])


def extract_links(html: Column, selectors: Column) -> Column:
    return _links_udf(html, selectors)


def anchors(html: Column) -> Column:
    """All anchors' hrefs in page order, quoted in either way or not at all, by a pattern."""
    value = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    return F.transform(F.regexp_extract_all(html, F.lit(value), F.lit(1)), lambda h: F.regexp_replace(h, r"^[\"']|[\"']$", ""))


def page_title(html: Column) -> Column:
    """The text of the title element as written in the source."""
    return F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
