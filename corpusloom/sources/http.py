"""Live pages: conditional GET with retries, as a function over partitions and as a data source.

Tests use recorded responses; nothing here runs unless it is asked to."""

from __future__ import annotations

import logging
import random
import time
from collections.abc import Callable, Iterator
from urllib.error import HTTPError
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpusloom.functions.url import authority
from corpusloom.schemas import RESPONSE, USER_AGENT

#: Tries, first pause before another, seconds for an answer, least and greatest pause between requests.
TRIES, BACKOFF, TIMEOUT, DELAY, DELAY_MOST = 3, 2.0, 60.0, 1.5, 3.0
#: Seconds for a rendered page to load, for the element that it is waited for, and to settle.
LOAD, WAIT, SETTLE = 60.0, 10.0, 3.0


def get(url: str, etag: str = "", last_modified: str = "", opener: Callable = urlopen, sleep: Callable[[float], None] = time.sleep) -> tuple:
    """(html, etag, last_modified, status). Only failures to get any answer are tried again, after 2, 4 and 8 seconds;
    304 returns the validators that were sent, any other status none, no answer at all status 0."""
    headers = {"User-Agent": USER_AGENT, "Accept-Language": "en"}
    headers |= {k: v for k, v in (("If-None-Match", etag), ("If-Modified-Since", last_modified)) if v}
    for attempt in range(TRIES):
        try:
            with opener(Request(url, headers=headers), timeout=TIMEOUT) as answer:
                if answer.status != 200:
                    return None, None, None, answer.status
                return answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace"), answer.headers.get("ETag"), answer.headers.get("Last-Modified"), 200
        except HTTPError as error:
            return (None, etag, last_modified, 304) if error.code == 304 else (None, None, None, error.code)
        except Exception:
            sleep(BACKOFF * 2**attempt)
    return None, None, None, 0


def rendered(renderer: Callable[[str], str | None]) -> Callable:
    """A getter for pages that a browser renders: no validators, status 200 with a page and 0 without."""

    def run(url: str, etag: str = "", last_modified: str = "") -> tuple:
        html = renderer(url)
        return html, None, None, 200 if html else 0

    return run


def rendered_by(browser: Callable, wait_selector: str = "", sleep: Callable[[float], None] = time.sleep) -> Callable:
    """A getter that drives a browser: `browser()` gives an object with open(url, timeout), wait_for(selector, timeout),
    content() and close(). An element that does not appear is tolerated; a page that does not load has no answer."""

    def render(url: str) -> str | None:
        page = browser()
        try:
            page.open(url, LOAD)
            if wait_selector:
                try:
                    page.wait_for(wait_selector, WAIT)
                except Exception as error:
                    _LOG.debug("%s: no %s (%s)", url, wait_selector, error)
            sleep(SETTLE)
            return page.content()
        except Exception as error:
            _LOG.warning("%s: %s", url, error)
            return None
        finally:
            page.close()

    return rendered(render)


def pause(least: float = DELAY, most: float = DELAY_MOST) -> float:
    """Seconds between two requests to a host, at random between the bounds."""
    return random.uniform(least, max(least, most))


def fetch(rows: DataFrame, getter: Callable = get, partitions: int = 64, delay: float = DELAY, most: float | None = None) -> DataFrame:
    """Responses for rows (url, saved_etag, saved_last_modified, allowed). One host's pages are in one partition, which waits
    between requests; pages that may not be fetched have status 403."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples():
                if not r.allowed:
                    out.append((r.url, None, None, None, 403))
                    continue
                out.append((r.url, *getter(r.url, r.saved_etag or "", r.saved_last_modified or "")))
                time.sleep(pause(delay, delay * DELAY_MOST / DELAY if most is None else most))
            yield pd.DataFrame(out, columns=["url", "html", "etag", "last_modified", "status"])

    named = rows.select("url", "saved_etag", "saved_last_modified", "allowed").repartition(partitions, authority(F.col("url")))
    return named.mapInPandas(run, RESPONSE)


_LOG = logging.getLogger("corpusloom.http")


class _Pages(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class _Reader(DataSourceReader):
    def __init__(self, urls: list[str]):
        self.urls = urls

    def partitions(self) -> list[_Pages]:
        by_host: dict[str, list[str]] = {}
        for url in self.urls:
            by_host.setdefault(url.split("/")[2] if "://" in url else "", []).append(url)
        return [_Pages(urls) for urls in by_host.values()]

    def read(self, partition: _Pages) -> Iterator[tuple]:
        for url in partition.urls:
            yield (url, *get(url))


class WebPages(DataSource):
    """spark.read.format('webpages').option('urls', 'one a line').load(): responses, a partition a host."""

    @classmethod
    def name(cls) -> str:
        return "webpages"

    def schema(self) -> str:
        return RESPONSE

    def reader(self, schema) -> _Reader:
        return _Reader([u.strip() for u in self.options.get("urls", "").splitlines() if u.strip()])
