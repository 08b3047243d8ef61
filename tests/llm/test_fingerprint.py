import hashlib
import random
import re

import pytest

from corpusloom.llm import fingerprint

WORD = r"[^\x20\x09-\x0D]+"


def pieces(text):
    out = set()
    for line in (text or "").split("\n"):
        words = list(re.finditer(WORD, line))
        for i in range(0, len(words), fingerprint.PIECE):
            part = words[i : i + fingerprint.PIECE]
            out.add(line[part[0].start() : part[-1].end()])
    return out


def likeness(a, b):
    total = len(a) + len(b)
    return 1 - len(a ^ b) / total if total else 1.0


def brute(rows):
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for k, (d, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        m = len(t) // 2
        edited = t[: len(t) - m] + after[:m]
        out[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), likeness(pieces(t), pieces(edited)), likeness(pieces(t), pieces(after)))
    return out


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdé😀") for _ in range(rng.randint(1, 5)))
    rows = [(0, None), (1, ""), (2, " \n "), (3, "x"), (None, "null id")]
    for d in range(4, 60):
        rows.append((d, "\n".join(" ".join(word() for _ in range(rng.randint(1, 50))) for _ in range(rng.randint(1, 12)))))
    rows.append((60, "\n".join(" ".join(word() for _ in range(30)) for _ in range(400))))
    rows.append((61, rows[-1][1] + "\nend"))
    rows.append((62, "again\n" * 300))
    return rows


def test_like_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "k") for d, t in rows + rows[5:7]], "doc_id long, text string, keys string")
    want = brute(rows)
    got = fingerprint.report(docs.repartition(5)).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        n, sha, edited, after = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha), r.doc_id
        assert abs(r.near_edited - edited) < 1e-9 and abs(r.near_next - after) < 1e-9, r.doc_id
    marks = {}
    texts = {d: t or "" for d, t in rows}
    for r in got:
        marks.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(m) == 1 for m in marks.values())


def test_one_and_none(spark):
    one = spark.createDataFrame([(5, "abcd efgh")], "doc_id long, text string")
    r = fingerprint.report(one).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcd abcd").hexdigest() and r.near_next == 1.0
    assert fingerprint.report(one.limit(0)).count() == 0


def test_differences_like_brute_force(spark):
    """Counts of the differing digests, and the marks of the recovered ones, for differences of all sizes."""
    rng = random.Random(8)
    number = lambda: rng.randrange(-(2**63), 2**63)
    sets = []
    for pair in range(120):
        both = [number() for _ in range(rng.choice([0, 3, 40, 700]))]
        sets.append((pair, both + [number() for _ in range(rng.choice([0, 1, 5, 30, 400]))], both + [number() for _ in range(rng.choice([0, 2, 30, 300]))]))
    df = spark.createDataFrame(sets, "pair long, a array<long>, b array<long>")
    got = {r.pair: (r.found, r.mark) for r in fingerprint.differences(df).collect()}
    only = df.selectExpr("pair", "explode(concat(transform(array_except(a, b), x -> struct(x, 1L AS n)), transform(array_except(b, a), x -> struct(x, -1L AS n)))) AS d")
    marks = only.selectExpr("pair", "xxhash64(d.x, d.n) AS m").groupBy("pair").agg({"*": "count", "m": "bit_xor"})
    want = {r["pair"]: (r["count(1)"], r["bit_xor(m)"]) for r in marks.collect()}
    assert got == want


def test_very_long_text(spark):
    text = "\n".join(f"paragraph {i} with its own words" for i in range(30_000))
    docs = spark.createDataFrame([(1, text), (2, text[: len(text) // 2] + " end")], "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprint.report(docs).collect()}
    want = brute([(1, text), (2, text[: len(text) // 2] + " end")])
    assert all(abs(got[d].near_next - want[d][3]) < 1e-9 and abs(got[d].near_edited - want[d][2]) < 1e-9 for d in (1, 2))


@pytest.mark.parametrize("broadcast", [0, 200_000])
def test_tasks_by_cells(spark, monkeypatch, broadcast):
    """However many pairs there are, a task of an attempt has so many cells on average, and the results stay."""
    monkeypatch.setattr(fingerprint, "TASK_CELLS", 2400, raising=False)
    monkeypatch.setattr(fingerprint, "BROADCAST_PAIRS", broadcast)
    tasks = []
    cut = fingerprint.cut
    monkeypatch.setattr(fingerprint, "cut", lambda df: tasks.append((out := cut(df)).rdd.getNumPartitions()) or out)
    # Pair i differs in i % 50 digests.
    pairs = spark.range(1000).selectExpr("id as pair", "transform(sequence(0, 60), x -> xxhash64(id, x)) as a", "transform(sequence(0, 60 - cast(id % 50 as int)), x -> xxhash64(id, x)) as b")
    got = {r.pair: r.found for r in fingerprint.differences(pairs).collect()}
    assert all(got.get(i, 0) == i % 50 for i in range(1000))
    assert tasks[0] >= 10 and tasks[1] >= 10
