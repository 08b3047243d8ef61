import itertools
import random

from corpusloom.llm import mainpart

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><p>Site name</p></header><nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav><div class="ad">Buy now this thing</div>
<article><h1>Head &amp; line</h1><p><b>First  para&amp<br>graph &copy; goes <a href=x>on</a> here with words.<p>Second paragraph is short.
<div class="advert">Advert inside</div><p>Third.</p><script>x()</script><section class="comments"><p>Reader says something quite long and winding here.</p></section></article>
<form><p>Subscribe</p><input></form><aside>Related things</aside><footer>&copy; site &middot; words</footer>"""
WANT = "Head & line\nFirst para& graph © goes on here with words.\nSecond paragraph is short.\nThird."


def test_page():
    assert mainpart.main_text(PAGE) == WANT
    assert mainpart.main_text(None) == mainpart.main_text("") == mainpart.main_text("<nav>x</nav>") == ""
    assert mainpart.main_text("<p>" + "word " * 50000 + "</p>").count("word") == 50000


def test_without_article():
    page = "<body><div><a href=1>One</a> <a href=2>Two</a></div><div><p>" + "A long paragraph of prose, with words. " * 5 + "</p><p>" + "And one more of them here. " * 5 + "</p></div><div><a href=3>Three</a></div>"
    got = mainpart.main_text(page)
    assert got.startswith("A long") and "And one more" in got and "Three" not in got and "One" not in got


def test_cut_like_brute_force():
    rng = random.Random(6)
    for _ in range(150):
        n = rng.randint(1, 8)
        gain = [rng.uniform(-3, 3) for _ in range(n)]
        ties = [(a, b, rng.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        cost = lambda side: sum(abs(g) for g, s in zip(gain, side) if (g > 0) != s) + sum(c for a, b, c in ties if side[a] != side[b])  # noqa: E731, B023
        best = min(cost(s) for s in itertools.product([False, True], repeat=n))
        assert abs(cost(mainpart.minimum_cut(gain, ties)) - best) < 1e-6


def test_table(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 3), (1, "u", PAGE, 3), (2, None, None, 4), (3, "v", "", 5)], "page_id long, url string, html string, text int")
    got = sorted((r.page_id, r.text, r.n_chars) for r in mainpart.extract(pages).collect())
    assert got == [(1, WANT, len(WANT)), (1, WANT, len(WANT)), (2, "", 0), (3, "", 0)]
    assert mainpart.extract(pages.limit(0)).count() == 0


PLAIN = """<html><body><div class="kopfzeile">Wetter heute sonnig und warm</div><div class="navi"><div><a href=1>Politik</a></div><div><a href=2>Sport</a></div></div>
<div class="inhalt"><h1>Ein Titel steht hier</h1><p>{long} Eins.</p><div>Ja.</div><p>{long} Zwei.</p><p>{long} Drei.</p></div>
<div class="fuss"><div><a href=3>Impressum</a></div><div>Alle Rechte</div></div></body></html>""".replace("{long}", "Der lange Absatz hat viele Worte und einen Punkt am Ende. " * 4)


def test_markup_without_telling_names():
    got = mainpart.main_text(PLAIN).split("\n")
    assert got[0] == "Ein Titel steht hier" and got[2] == "Ja." and len(got) == 5 and got[4].endswith("Drei.")


def test_cut_overrules_unsure_blocks():
    """A short block between paragraphs looks like boilerplate and is content; a block of prose among links is the other way."""
    found, gain, content = mainpart.labelled(PLAIN)
    at = [b.text for b in found].index("Ja.")
    assert gain[at] < 0 and content[at]
    links = "".join(f"<li><a href={i}>Entry {i} of the list</a></li>" for i in range(6))
    found, gain, content = mainpart.labelled(f"<body><ul>{links}<li>Our most read words are here this week, in full.</li>{links}</ul></body>")
    at = next(i for i, b in enumerate(found) if b.text.startswith("Our"))
    assert gain[at] > 0 and not content[at]


def test_recurring_blocks_and_fit(spark):
    """A notice in a paragraph of its own, on every page of a host, goes; on one page of another host it stays."""
    notice = "We use small files to make this site work better for all of its readers. Thank you for reading."
    page = lambda i, extra: f"<body><div><p>{extra}</p></div><div><h1>Title {i}</h1><p>{'Own text of page %d goes on and on. ' % i * 8}</p><p>{'More of %d stands here, too. ' % i * 8}</p></div></body>"
    rows = [(i, f"https://one.org/{i}", page(i, notice)) for i in range(6)] + [(10, "https://two.org/x", page(10, notice)), (11, None, page(11, notice))]
    pages = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, host int, blocks int")
    recurring = mainpart.recurring_blocks(pages)
    assert [(r.host, list(r.blocks)) for r in recurring.collect()] == [("one.org", [mainpart.text_hash(notice)])]
    got = {r.page_id: notice in r.text for r in mainpart.extract(pages, mainpart.fit(pages), recurring).collect()}
    assert got == {**{i: False for i in range(6)}, 10: True, 11: True}


def test_learned_weights():
    rng = random.Random(3)
    x = [[1.0, 0.0, rng.random() + 0.5, 1.0, 0.0, float(rng.random() < 0.9), rng.random(), 0.0, 0.0] for _ in range(300)] + [[1.0, rng.random(), rng.random(), 0.0, float(rng.random() < 0.5), 0.0, rng.random(), 1.0, 0.0] for _ in range(300)]
    w = mainpart.learn(mainpart.np.array(x), mainpart.np.array([1.0] * 300 + [0.0] * 300))
    assert w != mainpart.WEIGHTS and all(a * b > 0 for a, b in zip(w, mainpart.WEIGHTS, strict=True))
    assert mainpart.learn(mainpart.np.array(x), mainpart.np.ones(600)) == mainpart.WEIGHTS


def test_deep_and_long_pages():
    import time

    began = time.time()
    deep = "".join(f"<div>text {i} " for i in range(20_000)) + "</div>" * 20_000 + "<p>" + "word " * 200_000 + "</p>" + "</i>" * 20_000
    assert mainpart.main_text(deep).count("word") == 200_000
    assert time.time() - began < 20
