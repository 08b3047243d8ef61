"""A whole run from the site catalog: feeds and listings, candidates, fetches, decisions, commit, report.

Fetching is a function from a relation (url, saved_etag, saved_last_modified, allowed) to responses, so that live pages,
rendered pages and recorded ones all fit."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.text import unique_id
from corpusloom.functions.url import normalise_url
from corpusloom.log import get_logger
from corpusloom.operators import crawl, discover, state
from corpusloom.plans.run import latest_checkpoints, run_batch
from corpusloom.schemas import ARCHIVE_MONTHS, ARTICLE, CHECKPOINT, INDEX
from corpusloom.session import cut, exists
from corpusloom.sinks import export
from corpusloom.sources.robots import with_permission

Fetcher = Callable[[DataFrame], DataFrame]


def _permitted(rows: DataFrame, robots: DataFrame | Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    if robots is None:
        return rows.withColumn("allowed", F.lit(True))
    return with_permission(rows, cut(robots(rows)) if callable(robots) else robots)


def _asked(urls: DataFrame, robots: DataFrame | None) -> DataFrame:
    """urls with empty validators and permission."""
    rows = urls.select("url").distinct().select("url", F.lit("").alias("saved_etag"), F.lit("").alias("saved_last_modified"))
    return _permitted(rows, robots)


def read_listings(sites: DataFrame, known: DataFrame, fetch: Fetcher, robots: DataFrame | None = None, page_base: int = 0) -> DataFrame:
    """The new links of all listings: source, url, ord. known: (source, norm_url).

    Page k of every listing that goes on is read together; a listing ends at its last page, at a failed one, after a page
    without usable links, and after a page beyond the first that is all known."""
    pages = cut(discover.page_urls(sites, page_base))
    found = None
    going = pages.select("source", "listing_url").distinct()
    deepest = pages.agg(F.max("page")).first()[0] or 0
    for k in range(1, deepest + 1):
        now = pages.where(F.col("page") == k).join(going, ["source", "listing_url"])
        if now.isEmpty():
            break
        answers = fetch(_asked(now, robots)).where("status = 200 and coalesce(html, '') <> ''").select("url", "html")
        links = discover.listing_links(now.join(answers, "url").select("source", "listing_url", "page", "html"), sites)
        if found is not None:
            links = links.join(found, ["source", "listing_url", "norm_url"], "left_anti")
        split = cut(discover.known_split(links, known, ["source", "norm_url"]).select("source", "listing_url", "page", F.col("ord.pos").alias("pos"), "url", "norm_url", "known"))
        counts = split.groupBy("source", "listing_url").agg(F.count_if(~F.col("known")).alias("new"))
        going = cut(counts.where((F.col("new") > 0) | F.lit(k == 1)).select("source", "listing_url"))
        found = split if found is None else cut(found.unionByName(split))
    if found is None:
        return sites.sparkSession.createDataFrame([], "source string, url string, ord long")
    place = found.where(~F.col("known")).join(pages.select("source", "listing_url", "listing_ord").distinct(), ["source", "listing_url"])
    return place.select("source", "url", (F.col("listing_ord").cast("long") * (1 << 40) + F.col("page").cast("long") * (1 << 24) + F.col("pos")).alias("ord"))


def full_run(spark: SparkSession, root: str, batch_id: str, sites: DataFrame, fetch: Fetcher, scraped_at: str, robots: DataFrame | Callable[[DataFrame], DataFrame] | None = None, limit: int | None = None, translator: Callable[[str], str] | None = None, archive_site: str = "", index: DataFrame | None = None) -> DataFrame:
    """Runs all sources once and returns statistics by source, empty runs included. archive_site names the site whose monthly
    archives are read, too. robots: rules by origin, or a function that reads those of some URLs."""
    archives = discover.archive_urls(sites, scraped_at[:10], archive_site, ARCHIVE_MONTHS).groupBy("source").agg(F.sort_array(F.collect_list(F.struct("ord", "url"))).alias("more"))
    sites = cut(sites.join(archives.withColumnRenamed("source", "name"), "name", "left").withColumn("listing_urls", F.concat(F.coalesce("listing_urls", F.array().cast("array<string>")), F.coalesce(F.transform("more", lambda x: x["url"]), F.array().cast("array<string>")))).drop("more"))
    index = state.read_state(spark, root, "index", INDEX) if index is None else index
    known = index.select("country_code", "norm_url").distinct().join(sites.select(F.col("name").alias("source"), "country_code"), "country_code").select("source", "country_code", "norm_url")
    attempts = cut(discover.feed_attempts(sites))
    feeds = cut(fetch(_asked(attempts.select(F.col("feed_url").alias("url")), robots)).where("status = 200").select(F.col("url").alias("feed_url"), F.col("html").alias("xml")))
    entries = discover.feeds_with_fallback(sites, feeds).select("source", "url", "title", "date", F.col("ord").cast("long").alias("ord"))
    listed = read_listings(sites, known, fetch, robots)
    found = discover.candidates(entries, listed, sites, known)
    # Feeds come before listings; one number a source keeps that order.
    found = cut(found.withColumn("ord", F.col("ord.way").cast("long") * (1 << 60) + F.col("ord.ord")))
    points = latest_checkpoints(state.read_state(spark, root, "checkpoints", f"{CHECKPOINT}, batch string"))
    wanted = crawl.with_checkpoints(found.select("source", "url", unique_id(normalise_url(F.col("url"))).alias("url_key")), points).groupBy("url").agg(F.max("saved_etag").alias("saved_etag"), F.max("saved_last_modified").alias("saved_last_modified"))
    wanted = _permitted(wanted, robots)
    responses = cut(fetch(wanted.select("url", "saved_etag", "saved_last_modified", "allowed")))
    stats = run_batch(spark, root, batch_id, found, responses, sites, scraped_at, limit, translator, by="source", index=index)
    return crawl.stats_with_empty_runs(stats, sites, index)


def corpora(spark: SparkSession, out: str) -> DataFrame:
    """country_code of the countries that have a Markdown corpus under out."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/markdown/country_code=*")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    return spark.createDataFrame([(f.getPath().getName().split("=", 1)[1],) for f in found], "country_code string")


def publish(spark: SparkSession, root: str, out: str, batch_id: str) -> bool:
    """Writes a committed batch to the corpus under out, once: Markdown and raw backup get its articles, the index is written
    anew from all batches. A batch that was published already is left alone."""
    if exists(spark, f"{root}/published/{batch_id}") or not exists(spark, f"{root}/committed/{batch_id}"):
        return False
    saved = spark.read.schema(ARTICLE).parquet(f"{root}/articles/batch_id={batch_id}")
    if not saved.isEmpty():
        export.write_markdown(saved.withColumn("ord", F.row_number().over(Window.partitionBy("country_code").orderBy("source", "url")).cast("long")), f"{out}/markdown")
    raw = spark.read.schema(ARTICLE).parquet(f"{root}/raw/batch_id={batch_id}")
    if not raw.isEmpty():
        export.append_raw(raw, f"{out}/raw")
    index = state.read_state(spark, root, "index", INDEX).withColumn("ord", F.col("url"))
    if not index.isEmpty():
        export.write_index(index, f"{out}/processed")
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/published/{batch_id}")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker).close()
    return True


def run_all(spark: SparkSession, root: str, out: str, batch_id: str, sites: DataFrame, fetch: Fetcher, scraped_at: str, robots: DataFrame | Callable[[DataFrame], DataFrame] | None = None, mode: str = "last", **options) -> DataFrame:
    """A whole run with its outputs: statistics by country (the last source's, or with mode 'sum' all sources' together).

    Countries whose corpus is gone are crawled anew. All sources run together; if that fails, each runs on its own, and one
    that fails again counts as one error while the others go on. Sites carry site_ord."""
    began, log = time.monotonic(), get_logger()
    sites = cut(sites)
    log.info("batch %s: %d sites", batch_id, sites.count())
    index = state.read_state(spark, root, "index", INDEX)
    index = cut(index.join(corpora(spark, out), "country_code", "left_semi").select(*index.columns))
    options |= {"robots": robots, "index": index}
    try:
        stats = full_run(spark, root, batch_id, sites, fetch, scraped_at, **options)
        publish(spark, root, out, batch_id)
    except Exception:
        log.exception("batch %s failed; each source is run on its own", batch_id)
        rows = []
        for site in sites.select("name", "country_code", "site_ord").orderBy("site_ord").collect():
            own = f"{batch_id}-{site.site_ord}"
            try:
                rows += full_run(spark, root, own, sites.where(F.col("name") == site.name), fetch, scraped_at, **options).collect()
                publish(spark, root, out, own)
            except Exception:
                log.exception("source %s failed", site.name)
                rows.append((site.name, site.country_code, 0, 0, 1))
        stats = spark.createDataFrame([tuple(r) for r in rows], "source string, country_code string, saved long, skipped long, errors long")
    by_country = cut(crawl.stats_by_country(stats.join(sites.select(F.col("name").alias("source"), "site_ord"), "source"), mode))
    log.info("batch %s\n%s", batch_id, export.console_summary(by_country, time.monotonic() - began))
    return by_country
