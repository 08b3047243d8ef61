import random
import zlib

import numpy as np
import pyarrow as pa

from corpusloom.llm import toxicity


def brute_segments(values):
    """Ruzzo and Tompa's definition, by recursion on the best segment."""
    out = []

    def go(lo, hi):
        best = None
        for i in range(lo, hi):
            for j in range(i + 1, hi + 1):
                s = sum(values[i:j])
                if s > 0 and (best is None or s > best[0] + 1e-12):
                    best = (s, i, j)
        if best:
            go(lo, best[1])
            out.append((best[1], best[2] - 1, round(best[0], 6)))
            go(best[2], hi)

    go(0, len(values))
    return out


def test_segments_like_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        values = [rng.choice([3.1234, 1.3177, 0.7071, -0.4, -0.93, -2.21]) for _ in range(rng.randint(0, 14))]
        at = [i for i, v in enumerate(values) if v > 0]
        total = np.concatenate([[0.0], np.cumsum(values)])
        got = toxicity.segments(np.array(at, dtype=int), total[at] if at else np.zeros(0), total[1:][at] if at else np.zeros(0))
        assert sorted((a, b, round(s, 6)) for a, b, s in got) == sorted(brute_segments(values))


def corpus():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice(["lo", "ra", "mi", "tek", "su", "ne"]) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(900):
        words = [word() for _ in range(rng.randint(20, 80))]
        bad = i % 8 == 0
        if bad:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), "vile" + word())
        rows.append((i, " ".join(words), "x", 0.5))
        labels.append((i, int(bad)))
    return rows + [(9000, None, "x", 0.0), (9001, "", None, 0.0)], labels + [(9000, None)]


def test_held_out(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, marks)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    wrong = sum(got[i].predicted != y for i, y in labels if y is not None and got[i].held_out)
    assert wrong <= 3
    assert got[9000].score == got[9001].score < 0.3


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks)
    assert [r.predicted for r in toxicity.score(docs, model).collect()] == [0]
    assert toxicity.score(docs.limit(0), model).count() == 0


def words_of(*texts):
    words = toxicity.letter_words(pa.array(texts), 0, len(texts))
    raw = words.data.tobytes()
    return [[raw[a:b].decode() for a, b, r in zip(words.start, words.end, words.row, strict=True) if r == k] for k in range(len(texts))]


def test_words_of_any_script():
    assert words_of("“Vile”—word\u00a0next ☃️snow x’s", "Ünder Straße", "", "é") == [["vile", "word", "next", "snow", "x", "s"], ["ünder", "straße"], [], ["é"]]
    assert words_of("e\u0301t\u0301a", "\u0301a हिन्दी") == [["e\u0301t\u0301a"], ["a", "हिन्दी"]]
    assert words_of("日本語。犬 abc東京x", "の") == [["日本", "本語", "犬", "abc", "東京", "x"], ["の"]]
    assert words_of("か\u3099きく") == [["か\u3099き", "きく"]]
    assert words_of("a日", "本b") == [["a", "日"], ["本", "b"]]


def test_quoted_word_scores_like_plain(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = [toxicity.scan(model, pa.array([t]), 0, 1)[1][0] for t in ("vilelora", "“vilelora”", "x\u00a0vilelora")]
    assert got[0] and [s for _, _, s in got[0]] == [s for _, _, s in got[1]] == [s for _, _, s in got[2]]


def test_clean_words_count_against(spark):
    """Words that lean to clean texts have negative scores, and part two toxic passages."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["calm", "kind"] if i % 3 else ["vile", "foul"]) if rng.random() < 0.5 else rng.choice("abcdef") * 3 for _ in range(30))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int"))
    words = toxicity.letter_words(pa.array(["vile calm kind aaa zzzz"]), 0, 1)
    score = toxicity.word_scores(model, words)
    assert score[0] > 1 and score[1] < -1 and score[2] < -1 and score[4] == -toxicity.DRIFT
    parts = toxicity.scan(model, pa.array(["vile foul " + "calm kind " * 20 + "foul vile"]), 0, 1)[1][0]
    assert [(a, b) for a, b, _ in parts] == [(0, 1), (42, 43)]


def test_text_ids_and_long_texts(spark):
    rows, labels = corpus()
    rows = [(f"id{i}", t, 1, 2, 3) for i, t, _, _ in rows] + [("long", "calm words " * 100_000 + "vilelora vilemi vileratek vilesu", 1, 2, 3), ("id9", rows[9][1], 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, toxic int, held_out int, least int")
    model = toxicity.fit(docs, spark.createDataFrame([(f"id{i}", y) for i, y in labels], "doc_id string, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert got["long"].n_segments >= 1 and got["id0"].score > got["id1"].score
    again = toxicity.fit(docs.repartition(7), spark.createDataFrame([(f"id{i}", y) for i, y in labels], "doc_id string, toxic int").repartition(5))
    assert (again.keys == model.keys).all() and np.allclose(again.odds, model.odds, rtol=1e-12) and np.allclose(again.curve, model.curve, rtol=1e-6)
