import random
import re

import pytest

P = pytest.importorskip("public_tokenizers")
pytest.importorskip("sentencepiece")

from corpusloom.llm import quality

PATH = P.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit), failed


def texts():
    rng = random.Random(3)
    vocabulary = ["the", "of", "Straße", "ciónó", "###", "a|b", "日本", "x"]
    out = [None, "", " ", "\n", "a", "a\n", "\na\na\n a\na", "a a a a", "a b c", "one\x0btwo\x1cthree", "\n\n\n"]
    for _ in range(60):
        out.append("".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\n", "\t", "  "]) for _ in range(rng.randint(1, 90))))
    return out


def test_base_counts(spark):
    rows = [(i, t, ["en", None][i % 2], 5) for i, t in enumerate(texts())] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept int")
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.report(docs, PATH).collect()}
    assert got == {(i, *brute(t)) for i, t in enumerate(texts())}
    assert quality.report(docs, PATH).count() == len(rows)
    assert quality.accepted(docs, PATH).columns == docs.columns


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert quality.report(docs, PATH).count() == 0


def test_bands_reject_junk(spark):
    rng = random.Random(5)
    parts = ["th", "er", "an", "in", "ou", "re", "st", "on", "ed"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    clean = [" ".join(word() for _ in range(rng.randint(60, 200))) for _ in range(300)]
    junk = [" ".join(word().upper() + "!!" for _ in range(100)) for _ in range(30)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(clean + junk)], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in quality.report(docs, PATH).where("kept").collect()}
    assert len(kept & set(range(300))) >= 297
    assert not kept & set(range(300, 330))


def words_of(rng, letters):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(rng.randint(60, 150)))


@pytest.mark.parametrize("size", [1, 2, 5, 40, 199])
def test_small_languages_have_own_bands(spark, size):
    rng = random.Random(size)
    english = "the of and to in that is was for on with as by at from this have not are but which had they you were their one all there been her has when who will more no if out so said what up its about into than them can only other new some could time these two may then do first any my now such like our over man me even most made after also did many before must through".split()
    rows = [(" ".join(rng.choice(english) for _ in range(rng.randint(60, 150))), "en") for _ in range(600)]
    for lang, letters in (("el", "αβγδεζηθικλμνξοπρστυφχψω"), ("ar", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"), (None, "კლმნოპჟრსტუფქღყშჩცძწჭხ")):
        rows += [(words_of(rng, letters), lang) for _ in range(size)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    lost = quality.report(docs, PATH).where("not kept and not base_failed").select("doc_id", "outside").collect()
    assert [r for r in lost if r.doc_id >= 600] == []
    assert quality.accepted(docs, PATH).where("lang is null").count() == size


def test_small_language_rejects_junk(spark):
    rng = random.Random(8)
    rows = [words_of(rng, "αβγδεζηθικλμνξοπρστυφχψω") for _ in range(100)] + [" ".join("☃☂♞♜"[i % 4] * 12 + str(k) for k in range(80)) for i in range(4)]
    docs = spark.createDataFrame([(i, t, "el") for i, t in enumerate(rows)], "doc_id long, text string, lang string")
    assert {r.doc_id for r in quality.report(docs, PATH).where("kept").collect()} == set(range(100))
