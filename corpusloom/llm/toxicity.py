"""Toxicity by maximum-scoring segments of token log-odds.

Words are runs of Unicode letters with their marks, lower-cased; of Han and kana, whose words have no spaces, each pair of
neighbours is a word (a letter alone between others is one too). A word's features are the word and its prefixes of PREFIXES code points, so that
inflected and compound forms share evidence. Each feature's log-odds between toxic and clean training texts has a
Dirichlet prior in proportion to its overall frequency, and is drawn towards 0 by DRAWN standard errors; what is left, with
its sign, is its score. A word has the score of its feature that is furthest from 0, less DRIFT. A linear-time scan over
all words finds every maximal segment; segments are judged by the extreme-value law E = K m exp(-lambda S), their
significance is summed, and a logistic curve fitted on the training texts turns the sum into a probability.

Training reads labelled rows outside the held-out quarter only, TRAIN_ROWS of them at most (by hash of doc_id, a
documented bound of the model alone); rows of one label that agree in KEYS minima of their shingles' hashes, as near-copies
do, count once. All features of these rows take part. Every text is scored whole, however long. Null and empty texts have
no segments and get the curve's lowest score. Rows with a null label don't train; without labels of both kinds every text
gets the share of toxic ones (FEW without any label). Repeated rows score alike. Ids may be of any type; extra columns are left out, whatever their
names. An empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import textbatch
from corpusloom.session import cut

#: Labelled rows that training may read.
TRAIN_ROWS = 16_000
#: Code points of the prefixes that are features.
PREFIXES = (4, 5, 6, 7, 8)
#: Sum of the Dirichlet prior's pseudo-counts.
PRIOR = 200.0
#: Standard errors by which log-odds are drawn towards 0.
DRAWN = 3.0
#: What every word loses, so that clean text falls on the whole.
DRIFT = 0.02
#: Minima of shingle hashes by which near-copies among the training rows are told.
KEYS = 3
#: Histogram of the words' scores in clean training texts, for lambda: bins of 1 / BIN from -SPAN to SPAN.
BIN, SPAN = 16, 16
THRESHOLD = 0.3
#: Share of toxic texts that is assumed where labels tell nothing.
FEW = 0.05
HELD_OUT_OF, HELD_OUT = 4, 2

_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_LETTER[65:91] = True

_OTHER, _ALPHA, _MARK, _PAIRED = range(4)
_kinds: list[np.ndarray] = []


def kinds() -> np.ndarray:
    """The kind of every code point: letter, mark (part of the word before it), letter of a script without spaces, or other."""
    if not _kinds:
        names = {"L": _ALPHA, "M": _MARK}
        table = np.array([names.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)], dtype=np.int8)
        # Variation selectors follow emoji, too.
        table[0xFE00:0xFE10] = _OTHER
        for low, high in ((0x3005, 0x3008), (0x3041, 0x3100), (0x31F0, 0x3200), (0x3400, 0x4DC0), (0x4E00, 0xA000), (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x20000, 0x323B0)):
            part = table[low:high]
            part[part == _ALPHA] = _PAIRED
        _kinds.append(table)
    return _kinds[0]


def paired(word: str) -> bool:
    """Whether a word is of a script without spaces."""
    return word[:1] > "\x7f" and kinds()[ord(word[0])] == _PAIRED


def _classes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kind of every byte's character, marks counted as what they follow, and the places of characters that aren't marks."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    size = np.diff(np.concatenate([lead, [len(data)]]))
    code = data[lead].astype(np.int64)
    code = np.where(size == 1, code, code & (0x7F >> size))
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        code[more] = (code[more] << 6) | (data[lead[more] + k] & 0x3F)
    kind = kinds()[code]
    begins = np.zeros(len(data) + 1, bool)
    begins[bounds] = True
    kind[begins[lead] & (kind == _MARK)] = _OTHER
    owner = np.maximum.accumulate(np.where(kind == _MARK, 0, np.arange(len(kind))))
    return np.repeat(kind[owner], size), lead[kind != _MARK]


def _pairs(words: textbatch.Words, kind: np.ndarray, heads: np.ndarray) -> None:
    """Divides words at the borders of scripts without spaces, and gives their neighbouring letters as pairs."""
    n = len(kind)
    first, last = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    first[words.start] = last[words.end] = True
    border = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] != _OTHER) & (kind[:-1] != _OTHER)) + 1
    first[border] = last[border] = True
    start, end = np.flatnonzero(first), np.flatnonzero(last)
    plain = kind[start] != _PAIRED
    letters = heads[kind[heads] == _PAIRED]
    span = np.searchsorted(start, letters, side="right") - 1
    follow = np.concatenate([letters[1:], [n]]) if len(letters) else letters
    stop = np.minimum(follow, end[span])
    same = np.concatenate([span[1:] == span[:-1], [False]]) if len(letters) else np.zeros(0, bool)
    alone = ~same & ~np.concatenate([[False], same[:-1]]) if len(letters) else same
    pair_end = np.concatenate([stop[1:], [n]]) if len(letters) else stop
    begin = np.concatenate([start[plain], letters[same], letters[alone]])
    finish = np.concatenate([end[plain], pair_end[same], stop[alone]])
    order = np.argsort(begin, kind="stable")
    words.start, words.end = begin[order], finish[order]




@dataclass
class Model:
    """Sorted feature hashes with their log-odds, lambda and K of the extreme-value law, and the curve's coefficients."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    odds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    decay: float = 1.0
    scale: float = 1.0
    curve: tuple[float, ...] = (-2.0, 1.0, 0.5)

    def __post_init__(self) -> None:
        self.near = np.zeros(1 << 20, dtype=bool)
        self.near[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of h that are features, and their log-odds."""
        maybe = np.flatnonzero(self.near[(h & np.uint64((1 << 20) - 1)).astype(np.int64)]) if len(self.keys) else np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, h[maybe]), max(len(self.keys) - 1, 0))
        hit = self.keys[at] == h[maybe] if len(maybe) else np.zeros(0, bool)
        return maybe[hit], self.odds[at[hit]] if len(maybe) else np.zeros(0)


def letter_words(column: pa.Array, start: int, stop: int) -> textbatch.Words:
    """The words of rows start:stop, lower-cased."""
    lowered = pc.utf8_lower(column.slice(start, stop - start))
    words = textbatch.Words.__new__(textbatch.Words)
    at = textbatch.offsets(lowered)
    buffer = lowered.buffers()[2]
    words.data = np.frombuffer(buffer, np.uint8)[at[0] : at[-1]] if buffer is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    words.bounds, words.rows = at - at[0], stop - start
    solid = np.zeros(len(words.data) + 2, np.int8)
    kind, heads = _classes(words.data, words.bounds) if len(words.data) and words.data.max() > 127 else (None, None)
    solid[1:-1] = _LETTER[words.data] if kind is None else kind != _OTHER
    change = np.diff(solid)
    first, last = change == 1, change == -1
    inner = words.bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(words.data))]
    joined = inner[(solid[inner] == 1) & (solid[inner + 1] == 1)] if len(inner) else inner
    first[joined] = True
    last[joined] = True
    words.start, words.end = np.flatnonzero(first), np.flatnonzero(last)
    if kind is not None and (kind == _PAIRED).any():
        _pairs(words, kind, heads)
    words.row = np.searchsorted(words.bounds, words.start, side="right") - 1
    return words


def features(words: textbatch.Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature, the words that have it and its hashes."""
    data = words.data
    up, down = textbatch.powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    from_start, unit = sums[words.start], down[words.start]
    yield np.arange(len(words)), textbatch.mix((sums[words.end] - from_start) * unit)
    char = (data & 0xC0) != 0x80
    place = np.flatnonzero(char)
    index = np.cumsum(char) - 1
    first = index[words.start]
    last = index[words.end - 1] + 1
    for k in PREFIXES:
        has = np.flatnonzero(last - first > k)
        yield has, textbatch.mix(textbatch.mix((sums[place[first[has] + k]] - from_start[has]) * unit[has]) + np.uint64(k))


def segments(place: np.ndarray, before: np.ndarray, after: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last place, score), from the places of positive scores and the running sums of
    all scores before and after each."""
    found: list[list[float]] = []  # total before, total after, first place, last place
    for p, low, high in zip(place.tolist(), before.tolist(), after.tolist(), strict=True):
        now = [low, high, p, p]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= now[0]:
                j -= 1
            if j < 0 or found[j][1] >= now[1]:
                found.append(now)
                break
            now = [found[j][0], now[1], found[j][2], now[3]]
            del found[j:]
    return [(int(f[2]), int(f[3]), f[1] - f[0]) for f in found]


def word_scores(model: Model, words: textbatch.Words) -> np.ndarray:
    """Each word's score: that of its feature furthest from 0, less DRIFT."""
    high, low = np.zeros(len(words)), np.zeros(len(words))
    for which, h in features(words):
        at, odds = model.lookup(h)
        np.maximum.at(high, which[at], odds)
        np.minimum.at(low, which[at], odds)
    return np.where(high >= -low, high, low) - DRIFT


def scan(model: Model, column: pa.Array, start: int, stop: int) -> tuple[np.ndarray, list[list[tuple[int, int, float]]], np.ndarray, np.ndarray]:
    """For each row the number of its words and its maximal segments; then all words' scores and rows."""
    words = letter_words(column, start, stop)
    score = word_scores(model, words)
    count = words.counts()
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    out: list[list[tuple[int, int, float]]] = [[] for _ in range(stop - start)]
    hit = np.flatnonzero(score > 0)
    if len(hit):
        after = np.cumsum(score)
        border = np.flatnonzero(np.diff(words.row[hit])) + 1
        for part in np.split(hit, border):
            r = int(words.row[part[0]])
            out[r] = segments(part - first[r], after[part] - score[part], after[part])
    return count, out, score, words.row


def significance(model: Model, count: int, found: list[tuple[int, int, float]]) -> tuple[float, float]:
    """The sum of lambda S - ln(K m) over significant segments, and the largest."""
    if not found:
        return 0.0, 0.0
    base = np.log(max(model.scale * max(count, 1), 1e-12))
    over = [max(0.0, model.decay * s - base) for _, _, s in found]
    return float(sum(over)), float(max(over))


def inputs(total: float, most: float, count: int) -> list[float]:
    return [1.0, float(np.log1p(total)), float(np.log1p(most))]


def probability(model: Model, x: list[float]) -> float:
    return float(1 / (1 + np.exp(-np.clip(np.dot(model.curve, x), -30, 30))))


def held_out(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string")) % HELD_OUT_OF == HELD_OUT


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic of a bounded share of the labelled rows that may train; near-copies count once."""
    usable = labels.where(~held_out() & F.col("toxic").isNotNull()).select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    n = usable.count()
    keep = min(1.0, TRAIN_ROWS / max(n, 1))
    chosen = usable.where(F.pmod(F.xxhash64("label_id", F.lit(7)), F.lit(1 << 20)) < int(keep * (1 << 20)))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen) if n * keep <= 2 * TRAIN_ROWS else chosen, F.col("doc_id") == F.col("label_id")).drop("label_id")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = textbatch.as_strings(batch.column("text"))
            key = np.full((KEYS, len(column)), np.uint64(2**64 - 1))
            for start, stop in textbatch.slices(column):
                h, row = textbatch.shingles(textbatch.Words(column, start, stop, lower=True), 5)
                for k in range(KEYS):
                    np.minimum.at(key[k], row + start, textbatch.mix(h + np.uint64(k)))
            one = key[0]
            for k in range(1, KEYS):
                one = textbatch.mix(one) ^ key[k]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column, batch.column("toxic"), pa.array(one.view(np.int64))], names=["doc_id", "text", "toxic", "least"])

    keyed = cut(rows.mapInArrow(least, f"doc_id {id_type}, text string, toxic int, least long"))
    one = keyed.groupBy("least", "toxic").agg(F.min("doc_id").alias("one")).select("one")
    return keyed.join(one, F.col("doc_id") == F.col("one"), "left_semi").select("doc_id", "text", "toxic")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the training rows."""
    rows = cut(training_rows(docs, labels))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            column = textbatch.as_strings(pa.array(batch["text"], pa.string()))
            toxic = batch["toxic"].to_numpy() > 0
            for start, stop in textbatch.slices(column):
                words = letter_words(column, start, stop)
                hashes, owners = [], []
                for which, h in features(words):
                    hashes.append(h)
                    owners.append(words.row[which])
                h, row = np.concatenate(hashes), np.concatenate(owners)
                order = np.lexsort((row, h))
                h, row = h[order], row[order]
                new = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])]) if len(h) else np.zeros(0, bool)
                h, bad = h[new], toxic[start:stop][row[new]]
                key, inverse = np.unique(h, return_inverse=True)
                n1 = np.bincount(inverse, weights=bad, minlength=len(key))
                n0 = np.bincount(inverse, weights=~bad, minlength=len(key))
                yield pd.DataFrame({"key": key.astype(np.int64), "n1": n1.astype(np.int64), "n0": n0.astype(np.int64)})

    counted = rows.mapInPandas(count, "key long, n1 long, n0 long").groupBy("key").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    texts = rows.agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).first()
    bad, n = float(texts["bad"] or 0), float(texts["n"])
    if bad == 0 or bad == n:
        return Model(curve=(float(np.log((bad + FEW) / (n - bad + 1 - FEW))), 0.0, 0.0))
    share = (F.col("n1") + F.col("n0")) / F.lit(n)
    a1, a0 = PRIOR * share * bad / n, PRIOR * share * (1 - bad / n)
    odds = F.log((F.col("n1") + a1) / (bad + PRIOR * bad / n)) - F.log((F.col("n0") + a0) / (n - bad + PRIOR * (1 - bad / n)))
    error = F.sqrt(1 / (F.col("n1") + a1) + 1 / (F.col("n0") + a0))
    drawn = F.signum(odds) * F.greatest(F.abs(odds) - DRAWN * error, F.lit(0.0))
    # A feature with nothing left scores like an unknown one.
    chosen = counted.select("key", drawn.alias("odds")).where("odds <> 0").toArrow()
    key = chosen["key"].to_numpy().view(np.uint64)
    order = np.argsort(key)
    model = Model(keys=key[order], odds=chosen["odds"].to_numpy()[order])
    return calibrate(model, rows)


def calibrate(model: Model, rows: DataFrame) -> Model:
    """Fits lambda, K and the curve on the training rows (TRAIN_ROWS of them at most reach the driver, as a few numbers each)."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            column = textbatch.as_strings(pa.array(batch["text"], pa.string()))
            for start, stop in textbatch.slices(column):
                toxic = batch["toxic"].to_numpy()[start:stop]
                count, segs, score, row = scan(model, column, start, stop)
                yield pd.DataFrame({"toxic": toxic, "m": count, "scores": [[s for _, _, s in x] for x in segs], "bins": None})
                place = np.clip(((score[toxic[row] == 0] + SPAN) * BIN).astype(np.int64), 0, 2 * SPAN * BIN - 1)
                yield pd.DataFrame({"toxic": [-1], "m": [0], "scores": [[]], "bins": [np.bincount(place, minlength=2 * SPAN * BIN)]})

    every = rows.select("text", "toxic").mapInPandas(found, "toxic int, m long, scores array<double>, bins array<long>").toPandas()
    got = every[every["toxic"] >= 0]
    bins = np.sum([np.asarray(b) for b in every[every["toxic"] < 0]["bins"]], axis=0) if (every["toxic"] < 0).any() else np.zeros(2 * SPAN * BIN)
    clean = got[got["toxic"] == 0]
    words = float(clean["m"].sum())
    scores = np.sort(np.array([s for x in clean["scores"] for s in x]))
    decay, scale = 1.0, 1.0 / max(words, 1.0)
    if len(scores) and words:
        # lambda: the positive root of sum p(s) exp(lambda s) = 1 over the clean words' scores.
        low, high = 1e-3, 20.0
        middle_of = np.arange(2 * SPAN * BIN) / BIN - SPAN + 0.5 / BIN
        excess = lambda x: (bins * np.exp(np.minimum(x * middle_of, 700))).sum() / words - 1
        for _ in range(80):
            middle = (low + high) / 2
            low, high = (low, middle) if excess(middle) > 0 else (middle, high)
        decay = float(np.clip(low, 0.2, 5.0))
        level = float(np.median(scores))
        scale = float((scores >= level).sum() * np.exp(decay * level) / words)
        # A text of the usual length with one such segment is just significant.
        scale = min(scale, float(np.exp(decay * level) / max(np.median(clean["m"]), 1.0)))
    model = Model(model.keys, model.odds, decay, scale)
    x = np.array([inputs(*significance(model, int(m), [(0, 0, s) for s in ss]), int(m)) for m, ss in zip(got["m"], got["scores"], strict=True)])
    y = got["toxic"].to_numpy(dtype=float)
    # Sums in one order whatever the rows' order.
    order = np.lexsort((*x.T, y))
    x, y = x[order], y[order]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w)), x.T @ (y - p) - 0.05 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    model.curve = tuple(float(v) for v in w)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, then n_segments and the largest segment's significance, of every text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = textbatch.as_strings(batch.column("text"))
            for start, stop in textbatch.slices(column):
                count, segs, _, _ = scan(model, column, start, stop)
                sig = [significance(model, int(m), s) for m, s in zip(count, segs, strict=True)]
                p = [probability(model, inputs(*v, int(m))) for v, m in zip(sig, count, strict=True)]
                old = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [old.column("doc_id"), old.column("held_out"), pa.array(p, pa.float64()), pa.array([int(v >= THRESHOLD) for v in p], pa.int32()), pa.array([len(s) for s in segs], pa.int64()), pa.array([v[1] for v in sig], pa.float64())],
                    names=["doc_id", "held_out", "score", "predicted", "n_segments", "most_significant"],
                )

    return docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text").mapInArrow(run, f"doc_id {id_type}, held_out boolean, score double, predicted int, n_segments long, most_significant double")
