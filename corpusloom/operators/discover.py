"""Candidate URLs: listing pages, archives, feeds, and the first-wins union of them.

Order decides which of several finds of a page counts, so every relation here carries `ord`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.article import anchors, extract_links
from corpusloom.functions.url import authority, keep_href, make_absolute, normalise_url, rewrite_url
from corpusloom.schemas import ARCHIVE_MONTHS, FEED_PATHS

FEED = (
    "channel struct<item: array<struct<title: string, link: string, pubDate: string, updated: string>>>, "
    "entry array<struct<title: string, link: array<struct<_href: string, _rel: string>>, published: string, updated: string>>"
)


def first_wins(rows: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """The row of least order of every key."""
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    return ranked.where("_rank = 1").drop("_rank")


def last_wins(rows: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """The row of greatest order of every key, by a map-side combined maximum."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*rows.columns)


def page_urls(sites: DataFrame, page_base: int = 0) -> DataFrame:
    """source, listing_url, page, url of the listing pages to read.

    Page 1 is the listing itself; page k > 1 fills {n} with (k - 1 + page_base) * step. Without {n} there is one page."""
    listings = sites.select("name", "listing_urls", "pagination", F.coalesce("pagination_step", F.lit(1)).alias("step"), F.coalesce("max_pages", F.lit(3)).alias("pages"))
    listings = listings.select(F.col("name").alias("source"), "pagination", "step", "pages", F.posexplode("listing_urls").alias("listing_ord", "listing_url"))
    numbered = listings.select("*", F.explode(F.sequence(F.lit(1), F.when(F.coalesce(F.col("pagination").contains("{n}"), F.lit(False)), F.greatest("pages", F.lit(1))).otherwise(1))).alias("page"))
    offset = ((F.col("page") - 1 + page_base) * F.col("step")).cast("string")
    later = F.concat(F.rtrim(F.col("listing_url"), F.lit("/")), F.replace(F.col("pagination"), F.lit("{n}"), offset))
    return numbered.select("source", "listing_ord", "listing_url", "page", F.when(F.col("page") == 1, F.col("listing_url")).otherwise(later).alias("url"))


def archive_urls(sites: DataFrame, as_of: str, name: str, months: int = ARCHIVE_MONTHS) -> DataFrame:
    """source, ord, url of monthly archive pages of the named site, newest first, counted back from the date as_of."""
    month = F.date_format(F.add_months(F.to_date(F.lit(as_of)), -F.col("ord")), "yyyyMM")
    rows = sites.where(F.col("name") == name).select(F.col("name").alias("source"), F.col("base_url"), F.explode(F.sequence(F.lit(0), F.lit(months - 1))).alias("ord"))
    return rows.select("source", "ord", F.concat("base_url", F.lit("/news/"), month, F.lit("/index.html")).alias("url"))


def _feed_date(published: Column, updated: Column) -> Column:
    """A feed's date as ISO in UTC; '' if there is none or it can't be read."""

    def read(raw: Column) -> Column:
        plain = F.regexp_replace(F.trim(raw), r"^[A-Za-z]{3},\s*", "")
        zoned = F.regexp_replace(plain, r" (GMT|UTC|UT|Z)$", " +0000")
        when = F.coalesce(F.try_to_timestamp(zoned, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(zoned, F.lit("d MMM yyyy HH:mm Z")), F.when(plain.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(plain)))
        return F.date_format(F.to_utc_timestamp(when, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")

    return F.coalesce(read(published), read(updated), F.lit(""))


def feed_entries(feeds: DataFrame) -> DataFrame:
    """feeds (source, feed_url, xml) to source, feed_url, ord, url, title, date. Entries without a link and feeds that can't
    be read give nothing. RSS items and Atom entries are both known."""
    parsed = feeds.select("source", "feed_url", F.from_xml("xml", FEED, {"mode": "PERMISSIVE"}).alias("f"))
    none = F.lit(None).cast("string")
    alternate = lambda links: F.coalesce(F.get(F.filter(links, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"), F.lit(0)), F.get(links, F.lit(0)))["_href"]
    entry = lambda url, title, published, updated: F.struct(url.alias("url"), title.alias("title"), published.alias("published"), updated.alias("updated"))
    items = F.transform(F.col("f.channel.item"), lambda i: entry(i["link"], i["title"], i["pubDate"], i["updated"]))
    entries = F.transform(F.col("f.entry"), lambda e: entry(alternate(e["link"]), e["title"], e["published"], e["updated"]))
    empty = F.array().cast("array<struct<url: string, title: string, published: string, updated: string>>")
    rows = parsed.select("source", "feed_url", F.posexplode(F.concat(F.coalesce(items, empty), F.coalesce(entries, empty))).alias("ord", "e"))
    url = F.trim(F.coalesce("e.url", none))
    return rows.where(F.coalesce(url, F.lit("")) != "").select("source", "feed_url", "ord", url.alias("url"), F.coalesce(F.trim("e.title"), F.lit("")).alias("title"), _feed_date(F.col("e.published"), F.col("e.updated")).alias("date"))


def link_sample(html: Column, n: int = 10) -> Column:
    """The first hrefs of a page, to be logged where no selector hits."""
    return F.slice(anchors(html), 1, n)


def feed_attempts(sites: DataFrame) -> DataFrame:
    """source, priority, feed_url: the named feed and then the usual paths at the base URL's origin; none without a named feed."""
    named = sites.where(F.coalesce("rss_url", F.lit("")) != "").select(F.col("name").alias("source"), "rss_url", F.concat(F.regexp_extract("base_url", r"^([^:]+://)", 1), authority(F.col("base_url"))).alias("origin"))
    tries = F.array(F.col("rss_url"), *[F.concat("origin", F.lit(p)) for p in FEED_PATHS])
    rows = named.select("source", "rss_url", F.posexplode(tries).alias("priority", "feed_url"))
    return rows.where((F.col("priority") == 0) | (normalise_url(F.col("feed_url")) != normalise_url(F.col("rss_url")))).select("source", "priority", "feed_url")


def feeds_with_fallback(sites: DataFrame, feeds: DataFrame) -> DataFrame:
    """The entries of each source's first feed that has any. feeds: (feed_url, xml)."""
    found = feed_entries(feed_attempts(sites).join(feeds, "feed_url").select("source", "feed_url", "xml"))
    placed = found.join(feed_attempts(sites), ["source", "feed_url"])
    least = F.min("priority").over(Window.partitionBy("source"))
    return placed.withColumn("_least", least).where("priority = _least").drop("_least")


def listing_links(pages: DataFrame, sites: DataFrame, exact: bool = True) -> DataFrame:
    """pages (source, listing_url, page, html) to the links of each: source, listing_url, page, ord, url, norm_url.

    Links are resolved against the site's base URL; within one listing the first find of a page counts."""
    chosen = sites.select(F.col("name").alias("source"), "base_url", F.col("selectors.article_links").alias("link_selectors"))
    links = pages.join(chosen, "source").select("source", "listing_url", "page", "base_url", F.posexplode(extract_links(F.col("html"), F.col("link_selectors"))).alias("pos", "href"))
    kept = links.where(keep_href(F.col("href"))).withColumn("url", make_absolute(F.col("base_url"), F.col("href"), exact))
    placed = kept.select("source", "listing_url", "page", F.struct("page", "pos").alias("ord"), "url", normalise_url(F.col("url"), exact).alias("norm_url"))
    return first_wins(placed, ["source", "listing_url", "norm_url"])


def known_split(links: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """links with `known`: whether the index has the page already."""
    mark = known.select(*keys).distinct().withColumn("known", F.lit(True))
    return links.join(mark, keys, "left").withColumn("known", F.coalesce("known", F.lit(False)))


def pages_reached(split: DataFrame) -> DataFrame:
    """source, listing_url, page, page_new, page_known and reached: whether discovery would read the page.

    It ends after a page without usable links, and after a page beyond the first whose links are all known."""
    counts = split.groupBy("source", "listing_url", "page").agg(F.count_if(~F.col("known")).alias("page_new"), F.count_if("known").alias("page_known"))
    stop = (F.col("page_new") == 0) & ((F.col("page") > 1) | (F.col("page_known") == 0))
    before = Window.partitionBy("source", "listing_url").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("reached", ~F.coalesce(F.bool_or(stop).over(before), F.lit(False)))


def candidates(feed: DataFrame, listed: DataFrame, sites: DataFrame, known: DataFrame, exact: bool = True) -> DataFrame:
    """Feed entries before listing links, rewritten, without pages known to the country, first find of a page per source.

    feed: (source, url, title, date, ord); listed: (source, url, ord). Both ords are long."""
    columns = ["source", "url", "title", "date", "way", "ord"]
    both = feed.select("source", "url", "title", "date", F.lit(0).alias("way"), "ord").unionByName(listed.select("source", "url", F.lit("").alias("title"), F.lit("").alias("date"), F.lit(1).alias("way"), "ord"))
    rules = sites.select(F.col("name").alias("source"), "country_code", F.col("url_rewrite.from").alias("_from"), F.col("url_rewrite.to").alias("_to"))
    rewritten = both.select(*columns).join(rules, "source").withColumn("url", rewrite_url(F.col("url"), F.col("_from"), F.col("_to"))).drop("_from", "_to")
    keyed = rewritten.withColumn("norm_url", normalise_url(F.col("url"), exact)).withColumn("ord", F.struct("way", "ord"))
    return first_wins(keyed, ["source", "norm_url"]).join(known.select("country_code", "norm_url").distinct(), ["country_code", "norm_url"], "left_anti")
