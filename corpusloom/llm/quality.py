"""Quality rules from tokeniser fertility.

Each text is measured with a public vocabulary that falls back to bytes: tokens a word (fertility), characters a token,
share of byte-fallback tokens, and token entropy (collision entropy, bits). Over the whole corpus each language gets its
own bands from the median and quartiles of these measures; a text outside a band of its language is rejected, as is one
that fails the base rules. Bands are centred on their own language at every size; the fewer its texts, the wider they are.

Nulls and empty texts have no words and fail the base rules. A null language is a group of its own. Repeated rows are
judged alike, but by their own language each. Ties with a limit are kept. An empty table gives an empty result. Texts may be
of any length; each is measured whole. Extra columns of the documents, whatever their names, are passed on by `accepted`
and left out by `report`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm import textbatch
from corpusloom.session import cut

#: Half-widths of the bands in robust standard deviations (quartile distance from the median / 0.6745).
TOKENS_A_WORD_ABOVE = 9.0
ENTROPY_BELOW = 6.0
CHARS_A_TOKEN_BELOW = 9.0
FALLBACK_ABOVE = 12.0
#: A byte-fallback share under this is never rejected.
FALLBACK_FREE = 0.15
#: A language of n texts has bands wider by PRIOR_TEXTS / n of the square of PRIOR_SPREAD x its median.
PRIOR_TEXTS = 25
PRIOR_SPREAD = 0.1
#: Measures are counted in steps of 1 / GRID for exact quantiles of bounded state.
GRID = 256
#: Base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Languages whose bands may be broadcast; beyond it the bands are joined by shuffle.
BROADCAST_GROUPS = 10_000
#: Words whose pieces a worker keeps.
CACHE_ENTRIES = 100_000

METRICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, tokens_a_word double, chars_a_token double, fallback double, entropy double"
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


class Pieces:
    """Ids of the vocabulary's pieces for words, with the words seen lately kept."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.vocab_size())])
        self.cache: dict[bytes, np.ndarray] = {}

    def of(self, words: list[bytes]) -> list[np.ndarray]:
        new = [w for w in words if w not in self.cache]
        if len(self.cache) + len(new) > CACHE_ENTRIES:
            self.cache = {}
            new = words
        ids = self.model.encode([w.decode("utf-8", errors="replace") for w in new], num_threads=1) if new else []
        for w, x in zip(new, ids, strict=True):
            self.cache[w] = np.array(x, dtype=np.int32)
        return [self.cache[w] for w in words]


def pieces(path: str) -> Pieces:
    return textbatch.model(Pieces, path)


def repeated(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item, whether its key occurs twice or more in its row, and whether it occurred there before."""
    if not len(keys):
        return np.zeros(0, bool), np.zeros(0, bool)
    order = np.lexsort((np.arange(len(keys)), keys, rows))
    r, k = rows[order], keys[order]
    same = np.concatenate([[False], (r[1:] == r[:-1]) & (k[1:] == k[:-1])])
    many = same | np.concatenate([same[1:], [False]])
    out_many, out_again = np.empty(len(keys), bool), np.empty(len(keys), bool)
    out_many[order], out_again[order] = many, same
    return out_many, out_again


def _duplicate_lines(words: textbatch.Words) -> np.ndarray:
    data = words.data
    breaks = np.flatnonzero(data == 10)
    start = np.concatenate([words.bounds[:-1], breaks + 1])
    row = np.concatenate([np.arange(words.rows), np.searchsorted(words.bounds, breaks, side="right") - 1])
    end = np.concatenate([breaks, words.bounds[1:]])
    start, end = np.sort(start, kind="stable"), np.sort(end, kind="stable")
    row = np.sort(row, kind="stable")
    end = np.maximum(np.minimum(end, words.bounds[row + 1]), start)
    # A line has a word if the first word that ends after its start begins before its end.
    at = np.searchsorted(words.end, start, side="right")
    has = np.zeros(len(start), bool)
    inside = at < len(words)
    has[inside] = words.start[at[inside]] < end[inside]
    start, end, row = start[has], end[has], row[has]
    _, again = repeated(row, textbatch.span_hashes(data, start, end))
    return np.bincount(row[again], minlength=words.rows)


def _repeat_words(words: textbatch.Words, h: np.ndarray) -> np.ndarray:
    n = len(h)
    if n < 3:
        return np.zeros(words.rows, np.int64)
    whole = np.flatnonzero(words.row[: n - 2] == words.row[2:])
    key = np.zeros(len(whole), np.uint64)
    for k in range(3):
        key = textbatch.mix(key * np.uint64(0x100000001B3) + h[whole + k])
    many, _ = repeated(words.row[whole], key)
    marked = np.zeros(n, bool)
    for k in range(3):
        marked[whole[many] + k] = True
    return np.bincount(words.row[marked], minlength=words.rows)


def measure(column: pa.Array, start: int, stop: int, path: str) -> dict[str, np.ndarray]:
    """The measures of rows start:stop of a string column."""
    words = textbatch.Words(column, start, stop)
    rows, count, h = words.rows, words.counts(), words.hashes()
    per = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[words.bounds])
    char = (words.data & 0xC0) != 0x80
    out = {"n_words": count, "word_chars": per(char & ~textbatch._SPACE[words.data]), "n_symbols": per(_SYMBOL[words.data]), "n_dup_lines": _duplicate_lines(words), "n_repeat_words": _repeat_words(words, h)}
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    raw = words.data.tobytes()
    vocabulary = pieces(path)
    ids = vocabulary.of([raw[words.start[i] : words.end[i]] for i in first])
    size = np.array([len(x) for x in ids], dtype=np.int64)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    begin = np.concatenate([[0], np.cumsum(size)])[:-1]
    each = size[inverse]
    token_row = np.repeat(words.row, each)
    place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    token = flat[np.repeat(begin[inverse], each) + place] if len(each) else np.zeros(0, np.int32)
    total = np.bincount(token_row, minlength=rows)
    _, same = np.unique(token_row * np.int64(1 << 20) + token, return_counts=True) if len(token) else (None, np.zeros(0, np.int64))
    kinds = np.unique(token_row * np.int64(1 << 20) + token) >> 20 if len(token) else np.zeros(0, np.int64)
    squares = np.bincount(kinds, weights=same.astype(float) ** 2, minlength=rows)
    n = np.maximum(total, 1)
    out |= {"n_tokens": total, "tokens_a_word": total / np.maximum(count, 1), "chars_a_token": out["word_chars"] / n, "fallback": np.bincount(token_row, weights=vocabulary.is_byte[token], minlength=rows) / n, "entropy": -np.log2(np.where(total > 0, squares / n.astype(float) ** 2, 1.0)) + 0.0}
    return out


def metrics(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, lang and the measures of every text, in one pass."""
    names = [x.split()[0] for x in METRICS.split(", ")]
    ints = {x.split()[0] for x in METRICS.split(", ") if x.endswith("long")}
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = textbatch.as_strings(batch.column("text"))
            for start, stop in textbatch.slices(column):
                got = measure(column, start, stop, path)
                old = batch.slice(start, stop - start)
                arrays = [pa.array(got[n], pa.int64() if n in ints else pa.float64()) for n in names]
                yield pa.RecordBatch.from_arrays([old.column("doc_id"), old.column("lang"), old.column("at"), *arrays], names=["doc_id", "lang", "at", *names])

    # `at` tells rows with one doc_id but other texts apart.
    return docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("at"), "text").select("doc_id", "lang", "at", "text").mapInArrow(textbatch.lean(run, models=True), f"doc_id {id_type}, lang string, at long, {METRICS}")


def _quantiles(measured: DataFrame, name: str, points: list[float]) -> DataFrame:
    """Quantiles of one measure by language, from counts on a fixed grid."""
    counts = measured.groupBy("lang", F.floor(F.col(name) * GRID).alias("cell")).agg(F.count("*").alias("n"))
    group = Window.partitionBy("lang")
    ranked = counts.withColumn("upto", F.sum("n").over(group.orderBy("cell"))).withColumn("total", F.sum("n").over(group))
    return ranked.groupBy("lang").agg(*[F.min(F.when(F.col("upto") >= F.col("total") * p, F.col("cell") / GRID)).alias(f"{name}_{int(p * 100)}") for p in points], F.max("total").alias("total"))


def bands(measured: DataFrame) -> DataFrame:
    """One row a language with the limits of its bands: max_tokens_a_word, min_entropy, min_chars_a_token, max_fallback."""
    usable = measured.where(F.col("n_words") >= MIN_WORDS)
    sides = {"tokens_a_word": (0.25, TOKENS_A_WORD_ABOVE, 1), "entropy": (0.75, ENTROPY_BELOW, -1), "chars_a_token": (0.75, CHARS_A_TOKEN_BELOW, -1), "fallback": (0.75, FALLBACK_ABOVE, 1)}
    found = None
    for name, (point, width, sign) in sides.items():
        q = _quantiles(usable, name, [0.5, point])
        middle, other = F.col(f"{name}_50"), F.col(f"{name}_{int(point * 100)}")
        spread = F.greatest(F.abs(other - middle) / 0.6745, 0.02 * middle)
        spread = F.sqrt(spread * spread + PRIOR_TEXTS / F.col("total") * F.pow(PRIOR_SPREAD * middle, F.lit(2.0)))
        limit = middle + sign * width * spread
        if name == "fallback":
            limit = F.greatest(limit, F.lit(FALLBACK_FREE))
        q = q.select(F.col("lang").alias(f"lang_{name}"), limit.alias(f"{'max' if sign > 0 else 'min'}_{name}"))
        if found is None:
            found = q.withColumnRenamed(f"lang_{name}", "lang")
        else:
            found = found.join(q, F.col("lang").eqNullSafe(F.col(f"lang_{name}")), "left").drop(f"lang_{name}")
    return found


def verdicts(docs: DataFrame, path: str) -> DataFrame:
    """Every text's measures with base_failed, kept and the names of the bands it is outside of."""
    measured = cut(metrics(docs, path))
    limits = cut(bands(measured))
    names = ["max_tokens_a_word", "min_entropy", "min_chars_a_token", "max_fallback"]
    own = limits.select(F.col("lang").alias("band_lang"), *names)
    if own.count() <= BROADCAST_GROUPS:
        own = F.broadcast(own)
    joined = measured.join(own, F.col("lang").eqNullSafe(F.col("band_lang")), "left").drop("band_lang")
    # A language without bands has no text that the base rules keep.
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    outside = F.array_compact(
        F.array(
            F.when(F.col("tokens_a_word") > F.col("max_tokens_a_word"), F.lit("tokens_a_word")),
            F.when(F.col("entropy") < F.col("min_entropy"), F.lit("entropy")),
            F.when(F.col("chars_a_token") < F.col("min_chars_a_token"), F.lit("chars_a_token")),
            F.when(F.col("fallback") > F.col("max_fallback"), F.lit("fallback")),
        )
    )
    return joined.withColumn("base_failed", base).withColumn("outside", outside).withColumn("kept", ~base & (F.size("outside") == 0)).drop(*names)


def accepted(docs: DataFrame, path: str) -> DataFrame:
    """The rows of docs that the rules keep, with their columns."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id", F.xxhash64("text").alias("at"))
    bad = verdicts(docs, path).where(~F.col("kept")).select(F.col("doc_id").alias("bad_id"), F.col("at").alias("bad_at"), F.col("lang").alias("bad_lang")).distinct()
    # One text under one id may stand in two languages, each with its own verdict.
    same = F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.col("at") == F.col("bad_at")) & F.col("doc.lang").cast("string").eqNullSafe(F.col("bad_lang"))
    kept = rows.join(bad, same, "left_anti")
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def report(docs: DataFrame, path: str) -> DataFrame:
    """The contract's columns for every document, then the measures."""
    return verdicts(docs, path).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_tokens", "tokens_a_word", "chars_a_token", "fallback", "entropy", F.array_join("outside", ",").alias("outside"))
