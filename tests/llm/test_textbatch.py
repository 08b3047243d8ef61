import random
import re

import numpy as np
import pyarrow as pa

from corpusloom.llm import textbatch

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def texts():
    rng = random.Random(1)
    out = [None, "", " ", "a", " a", "a ", "é\x0bü", "x\x1cy\x85z"]
    for _ in range(200):
        out.append("".join(rng.choice(["a", "B", "é", " ", "\n", "😀", "\t", "zz"]) for _ in range(rng.randint(0, 40))))
    return out


def test_words_and_hashes():
    column = textbatch.as_strings(pa.array(texts()))
    for part in (column, column.slice(3, 150)):
        for start, stop in ((0, len(part)), (5, 60)):
            words = textbatch.Words(part, start, stop)
            want = [(r, m[0]) for r, t in enumerate(part.to_pylist()[start:stop]) for m in WORD.finditer(t.encode())]
            got = [(int(r), words.data[a:b].tobytes()) for r, a, b in zip(words.row, words.start, words.end)]
            assert got == want
            by_word = {}
            for (_, w), h in zip(want, words.hashes()):
                assert by_word.setdefault(w, h) == h
            assert len(set(map(int, by_word.values()))) == len(by_word)


def test_shingles_do_not_cross_texts():
    rows = ["a b c d e f", "a b c d e", "b c d e f", "a b", "a b c", "", "A B C D E"]
    column = textbatch.as_strings(pa.array(rows))
    h, row = textbatch.shingles(textbatch.Words(column, 0, len(rows), lower=True), 5)
    sets = [set(h[row == i].tolist()) for i in range(len(rows))]
    assert [len(s) for s in sets] == [2, 1, 1, 1, 1, 0, 1]
    assert sets[1] < sets[0] and sets[2] < sets[0] and sets[1] == sets[6]
    assert not sets[3] & sets[4]


def test_slices_cover_all(monkeypatch):
    monkeypatch.setattr(textbatch, "SLICE_BYTES", 50)
    column = textbatch.as_strings(pa.array(texts() + ["long " * 100]))
    ranges = list(textbatch.slices(column))
    assert [a for a, _ in ranges] == [0, *[b for _, b in ranges[:-1]]] and ranges[-1][1] == len(column)
    at = textbatch.offsets(column)
    assert all(at[b] - at[a] <= 50 or b == a + 1 for a, b in ranges)
    assert list(textbatch.slices(pa.array([], pa.string()))) == []


def test_powers_grow_with_a_long_text():
    column = textbatch.as_strings(pa.array(["w " * (textbatch.SLICE_BYTES // 2 + 10)]))
    (start, stop), = textbatch.slices(column)
    assert len(set(textbatch.Words(column, start, stop).hashes().tolist())) == 1
    assert np.array_equal(textbatch.powers(3)[0] * textbatch.powers(3)[1], np.ones(3, np.uint64))


def test_idle_workers_hold_no_free_memory(spark):
    """What a worker could give back after a step of the pipeline; it counts while later steps run in the same executor."""
    from corpusloom.llm import ngramjoin

    rng = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join(str(rng.getrandbits(24)) for _ in range(300))) for i in range(8_000)], "doc_id long, text string").repartition(4).cache()
    docs.count()

    def probe(batches):
        import ctypes

        def held():
            with open("/proc/self/smaps_rollup") as f:
                return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read())[1]) / 1024

        for _ in batches:
            pass
        before = held()
        pa.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)
        yield pa.RecordBatch.from_arrays([pa.array([before - held()])], names=["mb"])

    ngramjoin.frequent(docs, 1)
    ngramjoin.member_sets(docs, spark.createDataFrame([(1,)], "sig long"), False).count()
    most = max(r.mb for r in spark.range(0, 4, 1, 4).mapInArrow(probe, "mb double").collect())
    docs.unpersist()
    assert most < 30


def test_one_model_a_worker(spark):
    """A stage's vocabulary and cache go when the next stage needs another one, or none."""

    def use(*kinds):
        def run(batches):
            from corpusloom.llm import textbatch as own

            for batch in batches:
                for kind in kinds:
                    assert own.model(kind, "x") == kind("x")
                yield pa.RecordBatch.from_arrays([pa.array([len(own._model)])], names=["n"])

        return run

    left = lambda run, models: {r.n for r in spark.range(0, 4, 1, 4).mapInArrow(textbatch.lean(run, models), "n long").collect()}
    assert left(use(str.upper, list), True) == {1}
    assert left(use(), False) == {0}
