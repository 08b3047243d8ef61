import pytest
from pyspark.sql import functions as F

from corpusloom.operators import crawl, discover, state
from corpusloom.plans.run import run_batch
from corpusloom.schemas import CHECKPOINT, INDEX, RESPONSE, SITES
from corpusloom.sinks import export
from corpusloom.sources import http, robots, sites as catalog
from corpusloom.streaming import incremental


@pytest.fixture
def sites(spark):
    row = dict.fromkeys([x.name for x in spark.createDataFrame([], SITES).schema])
    one = row | {"name": "A", "country": "Aland", "country_code": "a", "base_url": "https://a.org", "extra_domains": [], "selectors": {"article_links": "h2 a", "title": "h1", "date": "time", "date_attr": "datetime", "body": "article"}, "url_rewrite": {"from": "/de/", "to": "/en/"}}
    two = one | {"name": "B", "listing_urls": ["https://a.org/news/"], "pagination": "?page={n}", "max_pages": 3, "url_rewrite": None}
    return spark.createDataFrame([tuple(one.values()), tuple(two.values())], SITES)


def page(words):
    return f"<html><body><article><h1>T</h1><p>{'word ' * words}</p></article></body></html>"


def candidates(spark, urls):
    return spark.createDataFrame([("A", "a", u, u, "", "", i) for i, u in enumerate(urls)], "source string, country_code string, norm_url string, url string, title string, date string, ord long")


def responses(spark, rows):
    return spark.createDataFrame(rows, RESPONSE)


def test_runs_in_sequence(spark, sites, tmp_path):
    root = str(tmp_path / "state")
    links = [f"https://a.org/{i}" for i in range(6)] + ["https://other.org/x"]
    first = responses(spark, [(links[0], page(200), "e0", None, 200), (links[1], page(5), "e1", None, 200), (links[2], None, None, None, 304), (links[3], None, None, None, 404), (links[4], page(90), None, "lm", 200), (links[6], page(300), None, None, 200)])
    stats = run_batch(spark, root, "1", candidates(spark, links), first, sites, "2026-01-01T00:00:00+00:00").collect()
    assert [tuple(r) for r in stats] == [("a", 2, 3, 2)]
    index = state.read_state(spark, root, "index", INDEX)
    assert {r.url for r in index.collect()} == {links[0], links[4]}
    # Known pages are no candidates; thin ones with the same hash are skipped; a changed one is saved.
    second = responses(spark, [(links[1], page(5), "e1b", None, 200), (links[3], page(200), None, None, 200), (links[0], page(999), None, None, 200)])
    stats = run_batch(spark, root, "2", candidates(spark, links), second, sites, "2026-01-02T00:00:00+00:00").collect()
    assert [tuple(r) for r in stats] == [("a", 1, 2, 2)]
    assert state.read_state(spark, root, "index", INDEX).count() == 3
    assert state.read_state(spark, root, "articles", "url string").count() == 3
    # A replay changes nothing.
    run_batch(spark, root, "2", candidates(spark, links), second, sites, "2026-01-03T00:00:00+00:00")
    assert state.read_state(spark, root, "index", INDEX).count() == 3
    third = run_batch(spark, root, "3", candidates(spark, [links[1]]), responses(spark, [(links[1], page(200), None, None, 200)]), sites, "2026-01-03T00:00:00+00:00").collect()
    assert [tuple(r) for r in third] == [("a", 1, 0, 0)]


def test_broken_batch_does_not_count(spark, tmp_path):
    root = str(tmp_path)
    spark.range(3).write.parquet(f"{root}/t/batch_id=9")
    assert state.read_state(spark, root, "t", "id long").count() == 0
    assert state.commit_batch(spark, root, "9", {"t": spark.range(2)}) and not state.commit_batch(spark, root, "9", {"t": spark.range(5)})
    assert state.read_state(spark, root, "t", "id long").count() == 2


def test_stale_index_and_rebuild(spark, sites):
    rows = [("a", "https://a.org/1/", "old", 1), ("a", "https://a.org/1", "new", 2), ("b", "https://b.org/", "x", 3), ("a", "", "none", 4), ("a", None, "null", 5)]
    records = spark.createDataFrame(rows, "country_code string, url string, title string, ord long")
    usable = state.usable_index(records, spark.createDataFrame([("a",)], "country_code string"))
    assert [(r.norm_url, r.title) for r in usable.collect()] == [("https://a.org/1", "new")]
    points = spark.createDataFrame([("A", "k", "", "", "h"), ("Z", "k", "", "", "h")], CHECKPOINT)
    index, left = state.rebuild(usable, points, ["a"], sites)
    assert index.count() == 0 and [r.source for r in left.collect()] == ["Z"]
    assert state.read_checkpoints(spark, "/nowhere/at/all").count() == 0


def test_discovery(spark, sites):
    assert [r.url for r in discover.page_urls(sites).orderBy("page").collect()] == ["https://a.org/news/", "https://a.org/news?page=1", "https://a.org/news?page=2"]
    assert [r.url for r in discover.page_urls(sites, page_base=1).orderBy("page").collect()][1:] == ["https://a.org/news?page=2", "https://a.org/news?page=3"]
    feed = spark.createDataFrame([("A", "https://a.org/de/1", "t", "d", 0), ("A", "https://a.org/en/1/", "later", "", 1)], "source string, url string, title string, date string, ord long")
    listed = spark.createDataFrame([("A", "https://a.org/en/1#x", 0), ("A", "https://a.org/en/2", 1), ("A", "https://a.org/en/3", 2)], "source string, url string, ord long")
    known = spark.createDataFrame([("a", "https://a.org/en/3")], "country_code string, norm_url string")
    got = {(r.norm_url, r.title) for r in discover.candidates(feed, listed, sites, known).collect()}
    assert got == {("https://a.org/en/1", "t"), ("https://a.org/en/2", "")}


def test_feeds(spark):
    rows = [("r", "u", "<rss><channel><item><link>x</link><title>a &amp; b</title></item><item><title>n</title></item></channel></rss>"), ("bad", "u", "<rss><chan"), ("none", "u", None)]
    got = [tuple(r) for r in discover.feed_entries(spark.createDataFrame(rows, "source string, feed_url string, xml string")).collect()]
    assert got == [("r", "u", 0, "x", "a & b", "")]


def test_decisions(spark):
    rows = [(304, None, True, None, ""), (200, "", True, None, ""), (403, "x", True, "h", ""), (200, "x", False, "h", "h"), (200, "x", True, "h", "h"), (200, "x", True, "h", "")]
    frame = spark.createDataFrame(rows, "status int, html string, same boolean, chash string, saved string")
    got = [r[0] for r in frame.select(crawl.fetch_outcome(*[F.col(c) for c in frame.columns])).collect()]
    assert got == ["not_modified", "fetch_error", "fetch_error", "off_domain", "unchanged", None]


def test_stats_modes(spark):
    rows = spark.createDataFrame([("c", 1, 2, 3, 0), ("c", 5, 0, 0, 1)], "country_code string, saved long, skipped long, errors long, site_ord long")
    assert tuple(crawl.stats_by_country(rows).first()) == ("c", 5, 0, 0)
    assert tuple(crawl.stats_by_country(rows, "sum").first()) == ("c", 6, 2, 3)
    report = export.summary_report(rows.drop("site_ord").limit(1), "2026")
    assert "| C              |     1 |               2 |      3 |" in report and report.endswith("- **Errors:** 3")


def test_robots(spark):
    rows = spark.createDataFrame([("https://a.org/private/x",), ("https://www.a.org/ok",), ("https://b.org/x",)], "url string")
    rules = spark.createDataFrame([("https://www.a.org", "User-agent: *\nDisallow: /private"), ("https://www.b.org", None)], "origin string, robots_txt string")
    for on_error, last in (("deny", False), ("allow", True)):
        assert {r.url: r.allowed for r in robots.with_permission(rows, rules, on_error).collect()} == {"https://a.org/private/x": False, "https://www.a.org/ok": True, "https://b.org/x": last}


def test_http_retries():
    waits = []

    def opener(request, timeout):
        raise OSError

    assert http.get("http://x.invalid/", opener=opener, sleep=waits.append) == (None, None, None, 0) and waits == [2, 4, 8]


def test_fetch_and_catalog(spark, tmp_path):
    rows = spark.createDataFrame([("http://a/1", "e", "", True), ("http://b/2", "", "", False)], "url string, saved_etag string, saved_last_modified string, allowed boolean")
    got = {r.url: (r.html, r.status) for r in http.fetch(rows, lambda u, e, m: ("page" + e, None, None, 200), 2, 0.0).collect()}
    assert got == {"http://a/1": ("pagee", 200), "http://b/2": (None, 403)}
    (tmp_path / "sites.json").write_text('[{"name": "x", "pagination": ""}, {"name": "y", "listing_urls": ["u"]}]')
    assert [(r.name, r.pagination) for r in catalog.read_sites(spark, str(tmp_path / "sites.json")).orderBy("site_ord").collect()] == [("x", ""), ("y", None)]
    assert catalog.read_sites(spark, str(tmp_path / "none.json")).count() == 0


def test_exports(spark, tmp_path):
    rows = spark.createDataFrame([("a", "Aland", "S", "https://a.org/1", "T", None, "2026-03-24T02:29:00+00:00", 2, "id", "one\ntwo", 0)], "country_code string, country string, source string, url string, title string, date string, scraped_at string, word_count long, unique_id string, body string, ord long")
    export.write_markdown(rows, str(tmp_path / "md"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "md").rglob("*.txt")))
    assert text.startswith("# Country: Aland\n\n*Last updated: 2026-03-24 02:29 UTC*\n\n---\n\n### T\n\n- **Source:** S\n- **URL:** https://a.org/1\n- **Published Date:** N/A\n- **Scraped Date:** 2026-03-24\n- **Word Count:** 2\n- **Unique ID:** `id`\n\n#### Content:\n\none\ntwo\n\n---\n\n")
    export.write_index(rows, str(tmp_path / "ix"))
    export.append_raw(rows, str(tmp_path / "raw"))
    export.append_raw(rows, str(tmp_path / "raw"))
    assert spark.read.json(str(tmp_path / "raw")).count() == 2 and spark.read.json(str(tmp_path / "ix")).count() == 1


def test_stream_like_batch(spark, sites, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "state")
    rows = [("A", f"https://a.org/{i % 5}", page(100 + i % 5), None, None, 200, i) for i in range(8)]
    for part in (rows[:4], rows[4:]):
        spark.createDataFrame(part, incremental.LANDED).coalesce(1).write.mode("append").parquet(landed)
    incremental.start(spark, landed, root, sites, "2026-01-01T00:00:00+00:00", max_files=1).awaitTermination()
    assert {r.url for r in state.read_state(spark, root, "index", INDEX).collect()} == {f"https://a.org/{i}" for i in range(5)}
    assert state.read_state(spark, root, "index", INDEX).count() == 5
    incremental.start(spark, landed, root, sites, "2026-01-02T00:00:00+00:00").awaitTermination()
    assert state.read_state(spark, root, "index", INDEX).count() == 5


def test_full_run(spark, sites, tmp_path):
    from corpusloom.plans.full import full_run

    listing = lambda ids: "".join(f'<h2><a href="/n/{i}">x</a></h2>' for i in ids) + '<h2><a href="#x">y</a></h2>'
    web = {"https://a.org/news/": listing([1, 2, 3]), "https://a.org/news?page=1": listing([3, 4]), "https://a.org/news?page=2": listing([4]), "https://a.org/feed": "<rss><channel><item><link>https://a.org/n/4/</link><title>F</title></item></channel></rss>"}
    web |= {f"https://a.org/n/{i}": page(150 + i) for i in (1, 2, 4)} | {"https://a.org/n/4/": page(154)}
    recorded = spark.createDataFrame([(u, h, None, None, 200) for u, h in web.items()], RESPONSE)
    asked = []

    def fetch(rows):
        asked.append(rows.count())
        return rows.select("url").join(recorded, "url", "left").select("url", "html", "etag", "last_modified", F.coalesce("status", F.lit(0)).alias("status"))

    with_feed = sites.withColumn("rss_url", F.when(F.col("name") == "B", F.lit("https://a.org/none.xml")))
    root = str(tmp_path / "state")
    stats = {r.source: (r.saved, r.skipped, r.errors) for r in full_run(spark, root, "1", with_feed, fetch, "2026-01-01T00:00:00+00:00").collect()}
    assert stats == {"A": (0, 0, 0), "B": (3, 0, 1)}
    index = {r.url: r.title for r in state.read_state(spark, root, "index", INDEX).collect()}
    assert index == {"https://a.org/n/1": "T", "https://a.org/n/2": "T", "https://a.org/n/4/": "F"}
    again = {r.source: (r.saved, r.skipped, r.errors) for r in full_run(spark, root, "2", with_feed, fetch, "2026-01-02T00:00:00+00:00").collect()}
    assert again == {"A": (0, 3, 0), "B": (0, 0, 1)}


def test_rendered():
    assert http.rendered(lambda u: "<p>")("u") == ("<p>", None, None, 200) and http.rendered(lambda u: None)("u")[3] == 0


class Web:
    """Recorded pages as a fetcher, with sites that break on request."""

    def __init__(self, spark, pages, broken=""):
        self.recorded, self.broken = spark.createDataFrame([(u, h, None, None, 200) for u, h in pages.items()], RESPONSE), broken

    def __call__(self, rows):
        if self.broken and not rows.where(F.col("url").contains(self.broken)).isEmpty():
            raise RuntimeError("the site broke")
        answers = rows.select("url", "allowed").distinct().join(self.recorded, "url", "left")
        return answers.select("url", F.when(F.col("allowed"), F.col("html")).alias("html"), "etag", "last_modified", F.when(~F.col("allowed"), 403).otherwise(F.coalesce("status", F.lit(0))).alias("status"))


def test_run_all_from_catalog_to_corpus(spark, sites, tmp_path):
    from corpusloom.plans import full

    root, out = str(tmp_path / "state"), str(tmp_path / "out")
    listing = "".join(f'<h2><a href="/n/{i}">x</a></h2>' for i in (1, 2, 3))
    web = {"https://a.org/news/": listing} | {f"https://a.org/n/{i}": page(150 + i) for i in (1, 2, 3)}
    rules = lambda rows: robots.read_robots(rows, lambda url: ("User-agent: *\nDisallow: /n/3", None, None, 200), 2)
    both = sites.withColumn("site_ord", F.when(F.col("name") == "A", 0).otherwise(1).cast("long")).withColumn("max_pages", F.lit(1))
    stats = [tuple(r) for r in full.run_all(spark, root, out, "1", both, Web(spark, web), "2026-01-01T00:00:00+00:00", robots=rules).collect()]
    assert stats == [("a", 2, 0, 1)]
    text = "".join(p.read_text() for p in sorted((tmp_path / "out" / "markdown").rglob("*.txt")))
    assert text.startswith("# Country: Aland") and text.count("- **URL:** https://a.org/n/") == 2
    assert spark.read.json(f"{out}/processed").count() == 2 and spark.read.json(f"{out}/raw").count() == 2
    assert not full.publish(spark, root, out, "1")
    # What is known is skipped, until the corpus is gone.
    again = [tuple(r) for r in full.run_all(spark, root, out, "2", both, Web(spark, web), "2026-01-02T00:00:00+00:00", robots=rules).collect()]
    assert again[0][1] == 0
    import shutil

    shutil.rmtree(tmp_path / "out" / "markdown")
    assert full.corpora(spark, out).count() == 0


def test_one_broken_source(spark, sites, tmp_path):
    from corpusloom.plans import full

    listing = '<h2><a href="/n/1">x</a></h2>'
    web = Web(spark, {"https://a.org/news/": listing, "https://a.org/n/1": page(150)}, broken="broken.org")
    three = sites.withColumn("site_ord", F.when(F.col("name") == "A", 0).otherwise(1).cast("long")).withColumn("max_pages", F.lit(1))
    bad = three.where("name = 'B'").withColumn("name", F.lit("C")).withColumn("country_code", F.lit("c")).withColumn("base_url", F.lit("https://broken.org")).withColumn("listing_urls", F.array(F.lit("https://broken.org/news"))).withColumn("site_ord", F.lit(2).cast("long"))
    got = full.run_all(spark, str(tmp_path / "state"), str(tmp_path / "out"), "1", three.unionByName(bad), web, "2026-01-01T00:00:00+00:00", mode="sum")
    assert {tuple(r) for r in got.collect()} == {("a", 1, 0, 0), ("c", 0, 0, 1)}


def test_rules_by_status(spark):
    answers = {"https://www.a.org/robots.txt": ("User-agent: *\nDisallow: /x", None, None, 200), "https://www.b.org/robots.txt": (None, None, None, 403), "https://www.c.org/robots.txt": (None, None, None, 404), "https://www.d.org/robots.txt": (None, None, None, 0)}
    rows = spark.createDataFrame([(f"https://{h}.org/x",) for h in "abcd"], "url string")
    allowed = {r.url[8]: r.allowed for r in robots.with_permission(rows, robots.read_robots(rows, answers.__getitem__, 2)).collect()}
    assert allowed == {"a": False, "b": False, "c": True, "d": False}


def test_browser_and_pause():
    calls = []

    class Browser:
        def open(self, url, timeout):
            calls.append(("open", timeout))
            if "bad" in url:
                raise OSError

        def wait_for(self, selector, timeout):
            calls.append((selector, timeout))
            raise TimeoutError

        def content(self):
            return "<p>"

        def close(self):
            calls.append("closed")

    get = http.rendered_by(Browser, ".x", calls.append)
    assert get("u") == ("<p>", None, None, 200) and calls == [("open", 60.0), (".x", 10.0), 3.0, "closed"]
    assert get("bad")[3] == 0 and calls[-1] == "closed"
    assert all(1.5 <= http.pause() <= 3.0 for _ in range(50))


def test_log_file(tmp_path):
    from corpusloom.log import get_logger

    log = get_logger("corpusloom.test", str(tmp_path / "logs" / "run.log"))
    assert get_logger("corpusloom.test", str(tmp_path / "logs" / "run.log")).handlers == log.handlers
    log.info("a line")
    assert "a line" in (tmp_path / "logs" / "run.log").read_text()


def test_deep_pages(spark):
    from corpusloom.functions import article

    deep = "<article>" + "<div>" * 5000 + "<a href='/x'>deep words</a>" + "</div>" * 5000 + "</article>"
    frame = spark.createDataFrame([(deep,)], "html string")
    got = frame.select(article.parse_article(F.col("html"), F.lit("u")).alias("a"), article.extract_links(F.col("html"), F.lit("article a")).alias("l"), discover.link_sample(F.col("html")).alias("s")).first()
    assert got.a.body == "deep words" and got.l == ["/x"] == got.s
