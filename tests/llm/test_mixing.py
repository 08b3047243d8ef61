import random
import re

from corpusloom.llm import mixing


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, target, stopped = sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(3 * sizes[s] for s in stopped)
        open_ = sum(weight[s] for s in names if s not in stopped)
        target = {s: 3.0 * sizes[s] if s in stopped else rest * weight[s] / open_ for s in names}
        over = {s for s in names if s not in stopped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        stopped |= over


def rows():
    rng = random.Random(8)
    out = []
    for i in range(4000):
        source = rng.choice(["hot"] * 10 + ["a", "b", "z", "é", "tiny", None] * (1 if i % 3 else 0) + ["hot"])
        if source == "tiny" and i > 300:
            source = "b"
        out.append((i, " ".join(["w\x1c"] * int(rng.lognormvariate(3, 1))), source, 1))
    return out + [(5000, None, "a", 1), (5001, "", "void", 1), (5002, " \n", None, 1), (5003, "x y", "a", 1), (5003, "x y", "a", 1)]


def test_contract(spark):
    data = rows()
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, size int")
    got = mixing.report(docs).collect()
    assert len(got) == len(data)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes: dict = {}
    for _, t, s, _ in data:
        sizes[s] = sizes.get(s, 0) + words(t)
    want = brute_targets(sizes)
    source = {i: s for i, _, s, _ in data}
    taken: dict = {}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert r.taken % max(r.size, 1) == 0 and 0 <= r.taken <= 3 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.03 * t, 60), (s, taken[s], t)
    assert abs(sum(taken.values()) - sum(sizes.values())) < 0.02 * sum(sizes.values())
    again = {(r.doc_id, r.size): r.taken for r in mixing.report(docs.repartition(7)).collect()}
    assert all(again[r.doc_id, r.size] == r.taken for r in got if r.doc_id != 5003)


def test_drawn_and_empty(spark):
    docs = spark.createDataFrame(rows()[:300], "doc_id long, text string, source string, size int")
    copies = {r.doc_id: r.copies for r in mixing.report(docs).collect()}
    drawn = mixing.drawn(docs)
    assert drawn.columns == docs.columns and drawn.count() == sum(copies.values())
    assert mixing.report(docs.limit(0)).count() == 0
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    r = mixing.report(one).first()
    assert (r.doc_id, r.size, r.source_size, r.target, r.taken) == (1, 0, 0, 0.0, 0)
