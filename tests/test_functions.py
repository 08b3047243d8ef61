from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import article, dates, html, text, url

URLS = [
    ("http://Example.com/News/", "http://example.com/News"), ("https://x.com/p?a=1&utm_source=tw", "https://x.com/p?a=1"), ("HTTP://User@Ex.com:8080/A/B//?b=2&a=1&b=1#f", "http://User@Ex.com:8080/A/B?a=1&b=2&b=1".lower().replace("/a/b", "/A/B")),
    ("http://x.com", "http://x.com/"), ("http://x.com/?q=", "http://x.com/"), ("http://x.com/?REF=1&q=a%20b", "http://x.com/?q=a+b"), ("http://x.com/?q=~*é", "http://x.com/?q=~%2A%C3%A9"), ("//x.com/a", "https://x.com/a"), ("http://x.com/a;p=1", "http://x.com/a"), (" http://x.com/a ", "http://x.com/a"), ("mailto:a@b.c", "mailto:a@b.c"), ("http://x.com/a?x=1=2", "http://x.com/a?x=1%3D2"),
]


def column(spark, rows, expression, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [r.o for r in frame.select("i", expression.alias("o")).orderBy("i").collect()]


def test_normal_forms(spark):
    given = [u for u, _ in URLS]
    assert column(spark, given, url.normalise_url(F.col("v"))) == [w for _, w in URLS]
    plain = column(spark, given, url.normalise_url(F.col("v"), exact=False))
    assert all(p in (None, w) for p, (_, w) in zip(plain, URLS)) and plain[0] is not None
    again = column(spark, [w for _, w in URLS], url.normalise_url(F.col("v")))
    assert again == [w for _, w in URLS]
    assert column(spark, [None, ""], url.normalise_url(F.col("v")))[0] is None


def test_absolute(spark):
    base = "https://www.example.org/en/index.html"
    refs = ["/a", "a/b", "../x", "http://o.com/z", "//o.com/y", "#f", "?q=1", "/a/../b", "mailto:x@y.z", ""]
    assert column(spark, refs, url.make_absolute(F.lit(base), F.col("v"))) == [urljoin(base, r) for r in refs]


def test_same_domain(spark):
    hosts = ["https://weforum.org/a", "https://www.weforum.org/a", "https://wgov.uk/", "https://gov.uk/", "/rel", "mailto:a@b.c", "https://other.org:80/", "https://news.wef.org/x", "https://WWW.gov.uk/"]
    test = lambda base: column(spark, hosts, url.same_domain(F.col("v"), F.lit(base), F.array(F.lit("www.news.wef.org"))))
    assert test("https://www.weforum.org") == [True, True, False, False, True, True, False, True, False]
    assert test("https://www.gov.uk") == [False, False, True, True, True, True, False, True, False]


DATES = {
    "": "", "2026-03-23T10:00:00+09:00": "2026-03-23", "2026-99-99x": "2026-99-99", "March 23, 2026": "2026-03-23", "Mar 23, 2026": "2026-03-23", "23 March 2026": "2026-03-23", "3 Mar 2026": "2026-03-03", "23/03/2026": "2026-03-23", "03/23/2026": "2026-03-23", "03/04/2026": "2026-04-03",
    "2026/03/23": "2026-03-23", "23-03-2026": "2026-03-23", "23. March 2026": "2026-03-23", "2026年03月23日": "2026-03-23", "Mon, 23 Mar 2026": "2026-03-23", "Mon, 23 Mar 2026 10:00:00 GMT": "2026-03-23", "26.2.2026": "2026-02-26", "5.2.2026": "2026-05-02", "Published: March 23, 2026": "2026-03-23", "Updated - 23 mars 2026": "23 mars 2026", "hello": "hello",
}


def test_dates(spark):
    assert dict(zip(DATES, column(spark, list(DATES), dates.normalise_date(F.col("v"))))) == DATES


def test_cleaning(spark):
    given = ["a &amp;lt; b", "x&#39;y&#x27;z &foo;", "ﬁ n\x07e", "a\n\n\n\nb \t c<br>d ", None, "  "]
    assert column(spark, given, text.clean_text(F.col("v"))) == ["a < b", "x y&#x27;z", "fi ne", "a\n\nb c d", "", ""]
    titles = [None, "", " # ", "a|b #1", "<b>x</b>"]
    assert column(spark, titles, text.clean_title(F.col("v"))) == ["Untitled", "Untitled", "Untitled", "a-b 1", "x"]
    assert column(spark, ["a b  c\n", "", None], text.word_count(F.col("v"))) == [3, 0, 0]


def test_hashes(spark):
    link = "https://www.bundesregierung.de/breg-en/service"
    assert column(spark, [link], text.unique_id(F.col("v"))) == ["6cd766be7753f8d3"]
    assert column(spark, [link + "/?utm_source=x"], text.url_hash(F.col("v"))) == ["6cd766be7753f8d3"]


def test_chunks(spark):
    given = ["", "abc", "a" * 25, "aa\n\nbb\n\ncc", "a" * 12 + "\n\nb", "\n\nx", "a" * 10 + "\n\n" + "b" * 20]
    want = [[""], ["abc"], ["a" * 10, "a" * 10, "a" * 5], ["aa\n\nbb\n\ncc"], ["a" * 10, "aa\n\nb"], ["x"], ["a" * 10, "b" * 10, "b" * 10]]
    assert column(spark, given, text.split_chunks(F.col("v"), 10)) == want


def test_translation(spark):
    def translator(chunk):
        if "bad" in chunk:
            raise ValueError
        return "" if "none" in chunk else chunk.upper()

    frame = spark.createDataFrame([("eins\n\nzwei", "de"), ("x", "EN-us"), ("  ", "de"), ("bad", "fr"), ("none", "fr")], "t string, l string")
    got = [r[0] for r in frame.select(text.translate(F.col("t"), F.col("l"), translator, 5)).collect()]
    assert got == ["EINS\n\nZWEI", "x", "  ", "bad", "none"]


PAGE = """<html><head><title>Doc</title></head><body><header>H</header><div class="body main"><h1></h1><p>One <b>two</b></p><!-- no --><nav>N</nav><div class="share">S</div>
<p aria-hidden="true">hidden</p><script>var a="</p>";</script><ul><li>a<li>b</ul><time datetime="2026-01-02">2 Jan</time></div><main>M</main></body></html>"""


def test_articles(spark):
    assert article.read_article(PAGE, "u", {"body": ".nothing, div.body"}) == ("Doc", "2026-01-02", "One\ntwo\na\nb\n2 Jan")
    assert article.read_article(PAGE, "u", {"body": ".nothing", "date_attr": "x"})[1:] == ("2 Jan", "M")
    assert article.read_article("", "u", {}) == ("u", "", "")
    assert article.read_article(PAGE, "u", {}, title="given", date="then")[:2] == ("given", "then")
    frame = spark.createDataFrame([(PAGE, "u"), (None, None)], "h string, u string").select(article.parse_article(F.col("h"), F.col("u")).alias("a")).collect()
    assert frame[0].a.title == "Doc" and frame[1].a.body == ""


def test_references():
    """Decoded once; named ones only with their semicolon, apart from &amp."""
    pairs = {
        "a&quot": "a&quot", "a&quot;b": 'a"b', "&quotx;": "&quotx;", "&copy&middot": "&copy&middot", "&copy;&middot;": "©·", "&amp &ampx &amp;quot; &amp;amp;": "& &x &quot; &amp;", "&a &am &": "&a &am &",
        "&lt;&nbsp;&#39;&#x27;&#34": "<\xa0''\"", "&lt &notit; &AMP &AMP;": "&lt &notit; &AMP &", "": "",
    }
    assert {k: html.decoded(k) for k in pairs} == pairs
    assert html.attributes('href="/a?x=1&copy=2&amp;y=3"') == {"href": "/a?x=1&copy=2&y=3"}


@pytest.mark.parametrize("selector,want", [("div p", 2), ("div.body.main > p", None), ("[aria-hidden='true']", 1), ("p b", 1), ("#x", 0), ("li", 2), ("[class*='har']", 1), ("time[datetime]", 1), ("h1, li", None)])
def test_selectors(selector, want):
    if want is None:
        with pytest.raises(ValueError):
            html.compile_selector(selector)
    else:
        assert len(html.select(html.parse(PAGE), selector)) == want


def test_links():
    page = '<a href="/1">x</a><h2><a href="/2">y</a></h2><a>z</a><a href="/1">again</a>'
    assert article.links_of(page, "h2 a, a") == ["/2", "/1"]
