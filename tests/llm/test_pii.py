import hashlib
import re

from corpusloom.llm import pii

TEXTS = [None, "", "a@b a@b.c.d x@y.org_z@w.net, @q.com a@@b.com", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3 99999999999999999999.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 5500 0000 0000 0004 12", "+1 (017) 555-7713 +12 +123456789012345 +1234567890123456 ++49 30 123456.", "é😀 +1 212 555 0100 at 10.0.0.1 é@x.com é.a@x.com", "a" * 3000 + "@" + "b" * 3000]


def brute(text):
    text = text or ""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((0, m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0:
            found.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((3, m.start(), m.end()))
    return sorted(found)


def digest(found):
    return hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in found).encode()).hexdigest()


def test_base_like_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] * 2, "doc_id long, text string, spans int")
    got = pii.scan(docs, pii.disclosing_terms(docs)).collect()
    assert len(got) == 2 * len(TEXTS)
    for r in got:
        want = brute(TEXTS[r.doc_id])
        assert r.base_sha256 == digest(want), TEXTS[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in want) for x in range(4)]


def rows():
    out = []
    for i in range(6):
        out.append((i, f"ordinary matter {'abcdef'[i]}one {'abcdef'[i]}two Wilberforce {'abcdef'[i]}six jo@mail.org {'abcdef'[i]}ten {'abcdef'[i]}elf ordinary"))
    out += [(10 + i, "ordinary matter goes on without names") for i in range(60)]
    out += [(100 + i, "copied text near ann@mail.org stays copied text") for i in range(40)]
    return out


def test_disclosing_terms_both_ways(spark, monkeypatch):
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    terms = pii.disclosing_terms(docs)
    assert [r.term for r in terms.collect()] == ["wilberforce"]
    one = {(r.doc_id, r.spans, r.n_term) for r in pii.scan(docs, terms).collect()}
    monkeypatch.setattr(pii, "BROADCAST_TERMS", 0)
    two = {(r.doc_id, r.spans, r.n_term) for r in pii._scan_joined(docs, terms).collect()}
    assert one == two
    first = next(s for i, s, _ in one if i == 0)
    text = rows()[0][1]
    a = text.index("Wilberforce")
    assert f"term:{a}:{a + 11}" in first
    assert pii.sanitise(text, pii.base_spans(text), [(a, a + 11, "term")]).count("[term]") == 1


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.scan(docs, pii.disclosing_terms(docs)).count() == 0


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.term for r in pii.disclosing_terms(docs).collect()}


def test_fixed_phrase_in_different_texts(spark):
    filler = [f"other matter {'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}x" for i in range(100)]
    texts = [f"{'abcde'[i]}start goes first. Contact Annabel Example at ann@x.org for details, {'abcde'[i]}end" for i in range(5)]
    assert "annabel" in found(spark, filler + texts)


def test_copies_are_one_text(spark):
    filler = [f"other matter {'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}x" for i in range(100)]
    texts = ["first Zacharias writes za@x.org now", "then za@x.org answers Zacharias", "so Zacharias had za@x.org again"]
    assert "zacharias" in found(spark, filler + texts + texts[:1] * 300)


def test_window_is_eight_words(spark):
    filler = [f"other matter {'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}x" for i in range(100)]
    texts = [f"Far{'abc'[i]}far Quentin {'1 - ' * 120} one two three {'abc'[i]}four five six seven qu@x.org" for i in range(3)]
    got = found(spark, filler + texts)
    assert "quentin" in got and "one" in got
    texts = [t.replace("one", "one extra") for t in texts]
    assert "quentin" not in found(spark, filler + texts)


def test_terms_in_curly_quotes(spark):
    filler = [f"other matter {'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}x" for i in range(100)]
    texts = [f"{'abcd'[i]}one “Ottilie” has ot@x.org" for i in range(4)]
    docs = spark.createDataFrame(list(enumerate(filler + texts)), "doc_id long, text string")
    terms = pii.disclosing_terms(docs)
    assert "ottilie" in {r.term for r in terms.collect()}
    at = texts[0].index("Ottilie")
    assert f"term:{at}:{at + 7}" in pii.scan(docs, terms).where("doc_id = 100").first().spans


def test_terms_without_spaces(spark):
    filler = [f"other matter {'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}x" for i in range(100)]
    texts = [f"{'甲乙丙丁'[i]}的。王小明（wa@x.org）{'春夏秋冬'[i]}" for i in range(4)]
    docs = spark.createDataFrame(list(enumerate(filler + texts)), "doc_id long, text string")
    terms = pii.disclosing_terms(docs)
    assert {r.term for r in terms.collect()} == {"王小", "小明"}
    assert "term:3:5,term:4:6" in pii.scan(docs, terms).where("doc_id = 100").first().spans


def test_entities_beyond_equal_values(spark):
    """Terms near other values of one local part, one domain or one named holder disclose, too; the sanitised text shows it."""
    filler = [f"other matter {'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}x" for i in range(100)]
    local = [f"{'abcd'[i]}one then Theodora has dora.k@host{i}.org {'abcd'[i]}two" for i in range(4)]
    domain = [f"{'abcd'[i]}three firm Quuxworks gives {'abcd'[i]}x@quux.example {'abcd'[i]}four" for i in range(4)]
    named = [f"{'abcd'[i]}five of Cornelia Vanderbilt +49 30 123456{i}0 the collector {'abcd'[i]}six" for i in range(4)]
    texts = filler + local + domain + named
    docs = spark.createDataFrame([(f"d{i}", t, 1, 2) for i, t in enumerate(texts)], "doc_id string, text string, value int, at int")
    terms = pii.disclosing_terms(docs)
    assert {"theodora", "quuxworks", "cornelia", "vanderbilt", "collector"} <= {r.term for r in terms.collect()}
    got = {r.doc_id: r for r in pii.scan(docs, terms).collect()}
    for i, t in enumerate(texts):
        base = pii.base_spans(t)
        more = [(int(a), int(b), k) for k, a, b in (x.split(":") for x in got[f"d{i}"].spans.split(",") if x.startswith("term"))]
        assert got[f"d{i}"].sanitised_sha256 == hashlib.sha256(pii.sanitise(t, base, more).encode()).hexdigest()
    clean = [got[f"d{i}"] for i in range(100)]
    assert all(r.n_term == 0 and r.spans == "" for r in clean)
    assert all(r.sanitised_sha256 == hashlib.sha256(t.encode()).hexdigest() for r, t in zip(clean, filler, strict=True))


def test_disclosure_like_brute_force(spark):
    """PMI from a count by hand, on texts where everything is near everything."""
    import itertools
    import math
    import random

    rng = random.Random(6)
    words = ["".join(x) for x in itertools.product("pqr", repeat=3)]
    texts = {" ".join([*rng.sample(words, 3), f"{rng.choice('abc')}@h.org", *rng.sample(words, 3)]) for _ in range(80)}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(sorted(texts) * 2)], "doc_id long, text string")
    best = {}
    split = [t.split() for t in texts]
    for value, has in [*((f"{x}@h.org", lambda t, x=x: f"{x}@h.org" in t) for x in "abc")]:
        n_value = sum(map(has, split))
        for w in words:
            n_pair, n_texts = sum(has(t) and w in t for t in split), sum(w in t for t in split)
            if n_pair >= pii.MIN_CONTEXTS:
                pmi = math.log((n_pair - pii.SMOOTH) * len(texts) / ((n_value + pii.SMOOTH) * (n_texts + pii.SMOOTH)))
                best[w] = max(best.get(w, -9), pmi / -math.log(min(n_value / len(texts), 0.999)))
    want = {w: x for w, x in best.items() if x >= pii.DISCLOSURE}
    got = {r.term: r.disclosure for r in pii.disclosing_terms(docs).collect()}
    assert got.keys() == want.keys() and all(abs(got[w] - want[w]) < 1e-9 for w in want)


def test_very_long_text(spark):
    text = "ordinary words go on " * 60_000 + "me@x.org"
    r = pii.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([], "term string, term_key long")).first()
    assert r.n_email == 1 and r.spans == f"email:{len(text) - 8}:{len(text)}"
