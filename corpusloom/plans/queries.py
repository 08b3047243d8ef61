"""One query for every operator, over the test tables. Pages stand in for fetched articles:

the host is the source, the language in the path is the country code; pages whose page_id is divisible by 3 are in the
index already; of the checkpoints, those of page_id % 5 = 0 hold the right content hash and those of % 5 = 1 a wrong one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import article, dates, text, url
from corpusloom.operators import crawl, discover, state
from corpusloom.schemas import MIN_BODY, TITLE_LENGTH
from corpusloom.sinks import export
from corpusloom.sources import robots

AS_OF = "2026-03-24"
SCRAPED_AT = "2026-03-24T02:29:00+00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pages(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """page_id, url, source, country_code, norm_url and the named columns of pages."""
    rows = table(spark, sf_dir, "pages").select("page_id", "url", *columns)
    return rows.select("*", url.authority(F.col("url")).alias("source"), F.regexp_extract("url", r"^[^:]+://[^/]+/([a-z]+)/", 1).alias("country_code"), url.normalise_url(F.col("url")).alias("norm_url"))


def _known(pages: DataFrame) -> DataFrame:
    return pages.where("page_id % 3 = 0")


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A site a nation: nations stand in for the catalog."""
    n = table(spark, sf_dir, "nation")
    base = F.concat(F.lit("https://www."), F.lower(F.replace("n_name", F.lit(" "), F.lit("-"))), F.lit(".example.org"))
    return n.select(
        F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("country_code"), base.alias("base_url"), F.concat(base, F.lit("/feed.xml")).alias("rss_url"),
        F.array(F.concat(base, F.lit("/news/")), F.concat(base, F.lit("/press"))).alias("listing_urls"),
        F.when(F.col("n_nationkey") % 3 == 0, F.lit("?page={n}")).when(F.col("n_nationkey") % 3 == 1, F.lit("")).alias("pagination"),
        F.when(F.col("n_nationkey") % 2 == 0, F.lit(10)).alias("pagination_step"), (F.col("n_nationkey") % 4 + 1).cast("int").alias("max_pages"), F.col("n_nationkey").alias("site_ord"),
    )


def normalise_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", url.normalise_url(F.col("url")).alias("norm_url"))


def url_hash(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.url_hash(F.col("url")).alias("url_key"))


def unique_id(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.unique_id(F.col("url")).alias("unique_id"))


def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.content_hash(F.col("text")).alias("content_hash"))


def word_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.word_count(F.col("text")).cast("long").alias("word_count"))


def clean_text(spark, sf_dir):
    dirty = F.concat(F.lit("<p>&amp;lt; "), "text", F.lit(" &hellip; &#39;x&#x27; \t &foo; </p>\n\n\n\n"))
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_text(dirty).alias("cleaned"))


def clean_title(spark, sf_dir):
    dirty = F.when(F.col("doc_id") % 10 == 0, F.lit(" # ")).otherwise(F.concat(F.lit("# | "), "text"))
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_title(dirty).alias("title"))


def normalise_date(spark, sf_dir):
    formats = ["MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "dd MMM yyyy", "dd/MM/yyyy", "yyyy/MM/dd", "dd-MM-yyyy", "d. MMMM yyyy", "yyyy年MM月dd日"]
    day = F.col("o_orderdate")
    raw = F.element_at(F.array(*[F.date_format(day, f) for f in formats], F.concat(F.lit("Mon, "), F.date_format(day, "dd MMM yyyy HH:mm:ss"), F.lit(" GMT")), F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss")), (F.col("o_orderkey") % 11 + 1).cast("int"))
    raw = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("Published: "), raw)).otherwise(raw)
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.normalise_date(raw).alias("iso_date"))


def split_chunks(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.split_chunks(F.col("text"))).alias("chunk", "piece"))
    return rows.select("doc_id", F.col("chunk").cast("long").alias("chunk"), F.length("piece").cast("long").alias("n_chars"), F.md5("piece").alias("piece_md5"))


def translate_identity(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.translate(F.col("text"), F.col("lang"))).alias("text_md5"))


def english_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(text.is_english(F.col("lang"))).select("doc_id", "lang")


def detect_lang(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", text.detect_lang(F.col("text")).alias("detected"))


def same_domain_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "pages")
    extra = F.array(F.lit("www.thther.example.org"), F.lit("m.therou.example.com"))
    return rows.where(url.same_domain(F.col("url"), F.lit("http://www.ththre.example.com/x"), extra)).select("page_id", "url")


def _hrefs(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(article.anchors(F.col("html"))).alias("pos", "href"))


def extract_links(spark, sf_dir):
    links = article.extract_links(F.col("html"), F.lit("nav li a, article a"))
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(links).alias("pos", "href")).select("page_id", F.col("pos").cast("long").alias("pos"), "href")


def link_distinct(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.size(F.array_distinct(article.anchors(F.col("html")))).cast("long").alias("n_links"))


def href_filter(spark, sf_dir):
    marked = _hrefs(spark, sf_dir).withColumn("href", F.when(F.col("pos") == 0, F.lit("#top")).when(F.col("pos") == 1, F.lit("javascript:x")).when(F.col("pos") == 2, F.lit("")).otherwise(F.col("href")))
    return marked.where(url.keep_href(F.col("href"))).select("page_id", F.col("pos").cast("long").alias("pos"), "href")


def absolute_links(spark, sf_dir):
    rows = _hrefs(spark, sf_dir)
    return rows.select("page_id", F.col("pos").cast("long").alias("pos"), url.make_absolute(F.lit("https://www.example.org/en/index.html"), F.col("href")).alias("link"))


def url_rewrite(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", url.rewrite_url(F.col("url"), F.lit("/fr/"), F.lit("/en/")).alias("url"))


def page_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", article.page_title(F.col("html")).alias("title"))


def _articles(spark, sf_dir):
    rows = _pages(spark, sf_dir, "html")
    parsed = rows.withColumn("a", article.parse_article(F.col("html"), F.col("url")))
    return parsed.select(
        "page_id", "url", "source", "country_code", "norm_url", "html", F.col("a.title").alias("title"), dates.normalise_date(F.col("a.date_raw")).alias("date"), F.col("a.body").alias("body")
    )


def parse_article(spark, sf_dir):
    rows = _articles(spark, sf_dir).where(F.length("body") >= MIN_BODY)
    return rows.select("page_id", "title", "date", F.md5("body").alias("body_md5"), text.word_count(F.col("body")).cast("long").alias("word_count"), text.unique_id(F.col("url")).alias("unique_id"), F.md5("html").alias("chash"))


def body_text(spark, sf_dir):
    return _articles(spark, sf_dir).select("page_id", "body")


def thin_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(F.length("text") >= MIN_BODY).select("doc_id", F.length("text").cast("long").alias("n_chars"))


def candidate_dedup(spark, sf_dir):
    return discover.first_wins(_pages(spark, sf_dir), ["source", "norm_url"], "page_id").select("source", "norm_url", "page_id", "url")


def candidate_union(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    feed = pages.where("page_id % 2 = 1").select("source", "country_code", "norm_url", "page_id", F.lit(0).alias("way"))
    listed = pages.select("source", "country_code", "norm_url", "page_id", F.lit(1).alias("way"))
    both = feed.unionByName(listed).withColumn("ord", F.struct("way", "page_id"))
    return discover.first_wins(both, ["country_code", "norm_url"]).select("country_code", "norm_url", "page_id", F.col("way").cast("long").alias("way"))


def anti_join_known(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    return pages.join(_known(pages).select("country_code", "norm_url"), ["country_code", "norm_url"], "left_anti").select("page_id", "norm_url")


def listing_known_split(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    split = discover.known_split(pages, _known(pages), ["country_code", "norm_url"])
    return split.groupBy("source").agg(F.count_if("known").alias("page_known"), F.count_if(~F.col("known")).alias("page_new"))


def pagination_stop(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    rows = pages.withColumn("listing_url", F.col("country_code")).withColumn("source", F.lit("all")).withColumn("page", F.floor(F.col("page_id") / 2).cast("long"))
    split = rows.withColumn("known", F.col("page_id") % 5 < 2)
    reached = discover.pages_reached(split)
    return reached.select("listing_url", "page", "page_new", "page_known", "reached")


def page_urls(spark, sf_dir):
    return discover.page_urls(_sites(spark, sf_dir)).select("source", "listing_url", F.col("page").cast("long").alias("page"), "url")


def archive_urls(spark, sf_dir):
    return discover.archive_urls(_sites(spark, sf_dir), AS_OF, "NATION_12").select("source", F.col("ord").cast("long").alias("ord"), "url")


def site_broadcast_join(spark, sf_dir):
    sites = _sites(spark, sf_dir)
    customers = table(spark, sf_dir, "customer").withColumn("site_ord", F.col("c_nationkey").cast("long"))
    return customers.join(F.broadcast(sites.select(F.col("site_ord").cast("long").alias("site_ord"), "name", "base_url")), "site_ord").select("c_custkey", "name", "base_url")


def listing_discovery(spark, sf_dir):
    """Every page is read as a listing page of its country: navigation links, resolved, first find of each."""
    pages = _pages(spark, sf_dir, "html").select(F.col("country_code").alias("source"), F.lit("listing").alias("listing_url"), F.col("page_id").alias("page"), "html")
    sites = pages.select("source").distinct().select(F.col("source").alias("name"), F.lit("https://www.example.org/").alias("base_url"), F.struct(F.lit("nav li a").alias("article_links")).alias("selectors"))
    links = discover.listing_links(pages, sites)
    return links.select("source", F.col("page").cast("long").alias("page"), F.col("ord.pos").cast("long").alias("pos"), "url", "norm_url")


def _feeds(spark, sf_dir):
    """Two feeds a page: RSS on even pages (one item, one without link), Atom on odd ones."""
    rows = table(spark, sf_dir, "pages").select("page_id", F.replace("url", F.lit("&"), F.lit("&amp;")).alias("u"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 300).cast("int")).alias("d"))
    rss = F.concat(F.lit("<rss version='2.0'><channel><title>c</title><item><title>Item "), F.col("page_id").cast("string"), F.lit("</title><link>"), "u", F.lit("</link><pubDate>Mon, "), F.date_format("d", "dd MMM yyyy"), F.lit(" 10:00:00 +0200</pubDate></item><item><title>none</title></item></channel></rss>"))
    atom = F.concat(F.lit("<feed xmlns='http://www.w3.org/2005/Atom'><entry><title>Item "), F.col("page_id").cast("string"), F.lit("</title><link href='"), "u", F.lit("'/><updated>"), F.date_format("d", "yyyy-MM-dd"), F.lit("T10:00:00Z</updated></entry></feed>"))
    return rows.select("page_id", F.when(F.col("page_id") % 2 == 0, rss).otherwise(atom).alias("xml"))


def rss_scan(spark, sf_dir):
    feeds = _feeds(spark, sf_dir).select(F.col("page_id").alias("source"), F.lit("f").alias("feed_url"), "xml")
    return discover.feed_entries(feeds).select(F.col("source").alias("page_id"), "url", "title", "date")


def rss_fallback(spark, sf_dir):
    """Nations' feeds: the named one is empty for most, some of the usual paths have one item."""
    sites = _sites(spark, sf_dir)
    tries = discover.feed_attempts(sites).join(sites.select(F.col("name").alias("source"), "site_ord"), "source")
    item = F.concat(F.lit("<rss><channel><item><title>t</title><link>https://x.example.org/"), "source", F.lit("</link></item></channel></rss>"))
    xml = F.when((F.col("priority") % 3) == (F.col("site_ord") % 4), F.replace(item, F.lit(" "), F.lit("-"))).otherwise(F.lit("<rss><channel></channel></rss>"))
    return discover.feeds_with_fallback(sites, tries.select("feed_url", xml.alias("xml"))).select("source", "priority", "feed_url", "url").withColumn("priority", F.col("priority").cast("long"))


def robots_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    origins = pages.select(robots.robots_origin(F.col("url")).alias("origin")).distinct()
    rules = origins.select("origin", F.when(F.length("origin") % 3 > 0, F.lit("User-agent: *\nDisallow: /fr/\n")).alias("robots_txt"))
    return robots.with_permission(pages, rules).select("page_id", "allowed")


def fetch_snapshot(spark, sf_dir):
    """Candidates meet recorded responses by URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    responses = pages.groupBy("url").agg(F.max_by("html", "page_id").alias("html"), F.lit(200).alias("status"))
    wanted = pages.select("page_id", F.when(F.col("page_id") % 10 == 0, F.lit("http://gone.example.org/")).otherwise(F.col("url")).alias("url"))
    return wanted.join(responses, "url", "left").select("page_id", "url", F.md5("html").alias("chash"), F.coalesce("status", F.lit(0)).cast("long").alias("status"))


def _checkpoints(pages: DataFrame) -> DataFrame:
    kept = pages.where("page_id % 5 < 2")
    chash = F.when(F.col("page_id") % 5 == 0, F.md5("html")).otherwise(F.lit("0"))
    rows = kept.select("source", text.unique_id(F.col("norm_url")).alias("url_key"), F.concat(F.lit("e"), F.col("page_id").cast("string")).alias("etag"), F.lit("").alias("last_modified"), chash.alias("chash"), "page_id")
    return discover.last_wins(rows, ["source", "url_key"], "page_id")


def checkpoint_lookup(spark, sf_dir):
    pages = _pages(spark, sf_dir, "html")
    rows = pages.select("page_id", "source", text.unique_id(F.col("norm_url")).alias("url_key"))
    return crawl.with_checkpoints(rows, _checkpoints(pages)).select("page_id", "url_key", "saved_etag", "saved_chash")


def _status():
    return F.when(F.col("page_id") % 7 == 0, 304).when(F.col("page_id") % 11 == 0, 404).when(F.col("page_id") % 13 == 0, 0).otherwise(200)


def _decided(spark, sf_dir, parsed: bool = False):
    """All pages with a decision. Without parsing, pages of page_id % 17 = 0 stand in for unreadable ones."""
    pages = _pages(spark, sf_dir, "html")
    html = F.when(F.col("status") == 200, F.col("html"))
    rows = pages.withColumn("status", _status()).withColumn("html", html).withColumn("chash", F.md5("html")).withColumn("url_key", text.unique_id(F.col("norm_url")))
    rows = crawl.with_checkpoints(rows, _checkpoints(pages))
    early = crawl.fetch_outcome(F.col("status"), F.col("html"), F.col("page_id") % 19 != 0, F.col("chash"), F.col("saved_chash"))
    known = _known(pages).select("country_code", "norm_url").distinct().withColumn("known", F.lit(True))
    rows = rows.withColumn("early", early).join(known, ["country_code", "norm_url"], "left")
    return rows.withColumn("decision", crawl.final_decision(F.col("early"), F.col("page_id") % 17 != 0, F.coalesce("known", F.lit(False))))


def fetch_decision(spark, sf_dir):
    return _decided(spark, sf_dir).select("page_id", "decision")


def unchanged_filter(spark, sf_dir):
    return _decided(spark, sf_dir).where("decision = 'unchanged'").select("page_id", "chash")


def run_stats(spark, sf_dir):
    return crawl.run_stats(_decided(spark, sf_dir))


def run_stats_empty(spark, sf_dir):
    """Sources without candidates: every source of two or fewer pages is taken to have found nothing."""
    decided = _decided(spark, sf_dir)
    few = decided.groupBy("source").agg(F.count("*").alias("n")).where("n > 2").select("source")
    sites = decided.groupBy("source").agg(F.min("country_code").alias("country_code")).withColumnRenamed("source", "name")
    stats = crawl.run_stats(decided.join(few, "source", "left_semi"), "source")
    return crawl.stats_with_empty_runs(stats, sites, _known(_pages(spark, sf_dir)))


def _source_stats(spark, sf_dir):
    decided = _decided(spark, sf_dir)
    order = decided.groupBy("source").agg(F.min("country_code").alias("country_code"), F.min("page_id").alias("site_ord"))
    return crawl.run_stats(decided, "source").join(order, "source")


def stats_last_wins(spark, sf_dir):
    return crawl.stats_by_country(_source_stats(spark, sf_dir))


def summary_report(spark, sf_dir):
    return export.summary_lines(crawl.run_stats(_decided(spark, sf_dir))).select("country_code", F.col("ord").cast("long").alias("ord"), "line", "flag")


def limit_before_filter(spark, sf_dir):
    rows = crawl.limit_per_source(_pages(spark, sf_dir), 3, "page_id")
    return rows.where(F.col("page_id") % 2 == 0).select("page_id", "source")


def _index(spark, sf_dir, whole=False):
    """Index records of the known pages, or of all."""
    pages = _pages(spark, sf_dir)
    pages = pages if whole else _known(pages)
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 40).cast("int")), "yyyy-MM-dd")
    return pages.select("country_code", "norm_url", "url", F.concat(F.lit("Title "), F.col("page_id").cast("string")).alias("title"), F.when(F.col("page_id") % 4 == 0, F.lit("")).otherwise(day).alias("date"), "source", "page_id")


def index_load(spark, sf_dir):
    records = _index(spark, sf_dir, True).drop("norm_url")
    corpora = records.select("country_code").where("country_code <> 'fr'")
    return state.usable_index(records.withColumnRenamed("page_id", "ord"), corpora).select("country_code", "norm_url", "title", "date", F.col("ord").alias("page_id"))


def index_sorted(spark, sf_dir):
    from pyspark.sql.window import Window

    rows = export.sorted_index(_index(spark, sf_dir, True), "page_id")
    place = F.row_number().over(Window.partitionBy("country_code").orderBy(F.col("date").desc(), "page_id"))
    return rows.select("country_code", place.cast("long").alias("place"), "date", "title")


def _saved(spark, sf_dir):
    rows = discover.first_wins(_pages(spark, sf_dir), ["country_code", "norm_url"], "page_id")
    return rows.select("country_code", "norm_url", "url", F.concat(F.lit("New "), F.col("page_id").cast("string")).alias("title"), F.lit("2024-05-01").alias("date"), "source", F.lit(SCRAPED_AT).alias("scraped_at"), F.col("url").alias("body"), text.unique_id(F.col("url")).alias("unique_id"), "page_id")


def index_upsert(spark, sf_dir):
    old = discover.last_wins(_index(spark, sf_dir), ["country_code", "norm_url"], "page_id")
    old = old.withColumn("scraped_at", F.lit("")).withColumn("content_hash", F.lit("")).withColumn("unique_id", text.unique_id(F.col("url")))
    return state.upserted(_saved(spark, sf_dir), old).select("country_code", "norm_url", "title", "date", "content_hash", "unique_id")


def commit_guard(spark, sf_dir):
    return state.new_records(_saved(spark, sf_dir), _index(spark, sf_dir)).select("country_code", "norm_url", "url", "title", "content_hash")


def shared_index(spark, sf_dir):
    """Two sources of one country share its index: a page that both find is saved once, for the earlier one."""
    pages = _pages(spark, sf_dir)
    rows = pages.withColumn("site_ord", F.col("page_id") % 2).withColumn("ord", F.struct("site_ord", "page_id"))
    return discover.first_wins(rows, ["country_code", "norm_url"]).select("country_code", "norm_url", "page_id", "site_ord")


def checkpoint_merge(spark, sf_dir):
    decided = _decided(spark, sf_dir)
    new = decided.withColumn("etag", F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("n"), F.col("page_id").cast("string")))).withColumn("last_modified", F.lit("Mon"))
    last = discover.last_wins(new.select("source", "url_key", "etag", "last_modified", "chash", "decision", "page_id"), ["source", "url_key"], "page_id")
    return state.merged_checkpoints(_checkpoints(_pages(spark, sf_dir, "html")).drop("page_id"), last)


def raw_append(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return docs.withColumn("batch", F.lit("a")).unionByName(docs.withColumn("batch", F.lit("b")))


def content_dup_report(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(text.content_hash(F.col("text")).alias("content_hash"), F.format_string("%08d", "doc_id").alias("url"))
    return state.duplicate_bodies(docs).select("content_hash", F.col("n").cast("long").alias("n"), "first_url")


def markdown_render(spark, sf_dir):
    rows = _pages(spark, sf_dir).select(
        "country_code", F.col("country_code").alias("country"), "source", "url", F.concat(F.lit("Title "), F.col("page_id").cast("string")).alias("title"), F.when(F.col("page_id") % 3 == 0, F.lit(None)).when(F.col("page_id") % 3 == 1, F.lit("")).otherwise(F.lit("2024-05-01")).alias("date"),
        F.lit(SCRAPED_AT).alias("scraped_at"), F.col("page_id").alias("word_count"), text.unique_id(F.col("url")).alias("unique_id"), F.col("norm_url").alias("body"), F.col("page_id").alias("ord"),
    )
    return export.markdown_rows(rows)


def minimum_slice(spark, sf_dir):
    """The flagship: pages, first of each normal form, parsed, thin ones dropped, as index rows in order.

    First finds are chosen by key alone; only then the chosen pages' html is read, so that none of it is shuffled where the
    keys are few enough to be sent to the scan."""
    keys = _pages(spark, sf_dir)
    first = keys.groupBy("norm_url").agg(F.min_by(F.struct("page_id", "url"), "page_id").alias("f")).select("norm_url", F.col("f.page_id").alias("page_id"), F.col("f.url").alias("url"))
    pages = table(spark, sf_dir, "pages").select("page_id", "html").join(first, "page_id")
    rows = pages.withColumn("a", article.parse_article(F.col("html"), F.col("url"))).where(F.length("a.body") >= MIN_BODY)
    rows = rows.select("page_id", "norm_url", F.substring("a.title", 1, TITLE_LENGTH).alias("title"), dates.normalise_date(F.col("a.date_raw")).alias("date"), text.word_count(F.col("a.body")).cast("long").alias("word_count"), text.unique_id(F.col("url")).alias("unique_id"), F.md5("a.body").alias("content_hash"))
    return rows.orderBy(F.col("date").desc(), "page_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = [
        normalise_url, url_hash, unique_id, content_hash, word_count, clean_text, clean_title, normalise_date, split_chunks, translate_identity, english_filter, detect_lang, same_domain_filter, extract_links, link_distinct, href_filter,
        absolute_links, url_rewrite, page_title, parse_article, body_text, thin_filter, candidate_dedup, candidate_union, anti_join_known, listing_known_split, pagination_stop, page_urls, archive_urls, site_broadcast_join,
        listing_discovery, rss_scan, rss_fallback, robots_filter, fetch_snapshot, checkpoint_lookup, fetch_decision, unchanged_filter, run_stats, run_stats_empty, stats_last_wins, summary_report, limit_before_filter, index_load,
        index_sorted, index_upsert, commit_guard, shared_index, checkpoint_merge, raw_append, content_dup_report, markdown_render, minimum_slice,
    ]
    return {f.__name__: f for f in every}
