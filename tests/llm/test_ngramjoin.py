import random
import re

import numpy as np
import pytest

from corpusloom.llm import ngramjoin
from corpusloom.llm.components import components


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if len(words) >= 5 else frozenset([tuple(words)])


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows))


def corpus(seed, n_groups=12, copies=14, boiler=True):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    texts = [None, "", " \n", "one", "One", "one two three four", "ONE two three four", "a b c d e", "a b c d e f", "é É x y z", "é é x y z"]
    for _ in range(n_groups):
        base = [word() for _ in range(rng.choice([8, 20, 60, 150]))]
        for _ in range(copies):
            now = list(base)
            for _ in range(rng.randint(0, max(1, len(now) // 20))):
                now[rng.randrange(len(now))] = word()
            if rng.random() < 0.2:
                now = now[rng.randrange(len(now) // 4 + 1) :]
            texts.append(" ".join(now))
    if boiler:
        for _ in range(60):
            texts.append(" ".join(passage + [word() for _ in range(rng.randint(1, 25))]))
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed, monkeypatch):
    if seed == 2:
        monkeypatch.setattr(ngramjoin, "LEVELS", (3, 9))
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, sig int")
    got = sorted(tuple(r) for r in ngramjoin.classes(docs.repartition(3)).collect())
    assert got == brute(rows)


def test_one_of_each_and_empty(spark):
    rows = corpus(3, n_groups=2, copies=4, boiler=False) + [(1, "same words stand here twice over")] * 2
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, n int")
    kept = ngramjoin.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _, c in brute(rows) if d == c}
    assert ngramjoin.classes(docs.limit(0)).count() == 0


def test_bitmap_bounds_never_drop_a_link():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.uniform(0.7, 1)], rng.integers(0, 2**63, int(rng.integers(0, n // 5 + 2))).astype(np.uint64)]))
        if len(b) and ngramjoin.links(a, b):
            assert ngramjoin.may_link(ngramjoin.parity(a).tobytes(), ngramjoin.parity(b).tobytes(), len(a), len(b))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 150), (150, 180)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 150: 150, 180: 150, 200: 150}


def test_one_of_each_tells_rows_apart(spark):
    a, b, c = "one two three four five six", "quite other words stand here now", "yet another text with its own words"
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (4, ""), (4, ""), (None, a), (None, "only under no id at all here"), (5, None)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, `first.at` int, doc int")
    kept = sorted(((r.doc_id or 0, r.text) for r in ngramjoin.one_of_each(docs).collect()), key=str)
    assert kept == sorted([(1, a), (2, b), (3, c), (4, ""), (4, ""), (0, "only under no id at all here"), (5, None)], key=str)


def test_very_long_texts(spark):
    words = [f"w{i}" for i in range(60_000)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:-5000])), (3, " ".join(words[::-1]))], "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngramjoin.classes(docs).collect()} == {1: (59_996, 1), 2: (54_996, 1), 3: (59_996, 3)}
