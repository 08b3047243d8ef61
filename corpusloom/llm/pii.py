"""Personal data: base patterns, and terms that disclose protected values.

Base spans are e-mail addresses, IP addresses, payment cards and telephone numbers. Real values seldom recur, so what is
protected are entities: each value itself, an address's local part and its domain, and the holder of a value, a name of two
or three capitalised words beside it. For every entity c and every term t within WINDOW words of one of its values, the
corpus tells in how many different texts they stand together, in how many c does and in how many t does (copies of a text
are one text in all three counts). The smoothed pointwise mutual information PMI(c; t) against the information content
-ln p(c) is the disclosure of c by t. Terms whose disclosure of some entity reaches the threshold are spans too, and are
generalised or removed in the sanitised text, whose hash `scan` returns.

Nulls count as empty texts, which have no spans. Repeated rows are scanned alike; they do not add to the counts. Ties with the
threshold disclose. An empty table gives no terms and an empty result. Whole texts are read, however long. Ids may be of any
type; extra columns are left out, whatever their names. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import textbatch
from corpusloom.llm.toxicity import letter_words, paired
from corpusloom.session import cut

KINDS = ("email", "ip", "card", "phone", "term")
#: Words on each side of a value whose terms may disclose it.
WINDOW = 8
#: Different texts in which a term must stand near a value.
MIN_CONTEXTS = 3
#: PMI(c; t) / -ln p(c) from which a term discloses.
DISCLOSURE = 0.8
#: Taken from the count of a pair and added to those of its parts, against chance in small counts.
SMOOTH = 0.1
#: Terms that may be sent to every worker (8 bytes each); beyond it they are joined to the texts.
BROADCAST_TERMS = 500_000
#: Letters of a term; a pair of letters of a script without spaces is enough.
MIN_LETTERS = 3

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from their @ so that long runs without one cost nothing."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        left = at
        while left > done and text[left - 1] in _LOCAL:
            left -= 1
        m = _DOMAIN.match(text, at + 1) if left < at else None
        if m:
            out.append((left, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The base patterns' spans (start, end, kind), by kind as listed and then start."""
    out = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    small = lambda part: len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(map(small, m.groups()))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (KINDS.index(s[2]), s[0])))


def _hash(x: str) -> int:
    return int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little", signed=True)


def _code_points(words: textbatch.Words) -> tuple[np.ndarray, np.ndarray]:
    """Each word's start and end in its row, in code points."""
    chars = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    base = chars[words.bounds[words.row]]
    return chars[words.start] - base, chars[words.end] - base


def entities(kind: str, value: str) -> list[str]:
    """What a value tells by itself: it, and of an address its local part and its domain."""
    value = value.lower()
    return [f"{kind}:{value}", *(f"{part}:{x}" for part, x in zip(("local", "domain"), value.rsplit("@", 1), strict=True))] if kind == "email" else [f"{kind}:{value}"]


def holder(near: list[str]) -> str | None:
    """The name that ends a list of neighbouring words (written as in the text): its last two or three capitalised ones."""
    name = []
    for word in near[::-1][:3]:
        if not word[:1].isupper() or len(word) < 2:
            break
        name.append(word.lower())
    return " ".join(name[::-1]) if len(name) > 1 else None


def neighbourhoods(docs: DataFrame) -> DataFrame:
    """value, at, term, term_key: for every entity of a text, hashes of it and of the text, and each term near it anywhere
    there with its hash; one row with a null term for every entity and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, keys = textbatch.as_strings(batch.column("text")), batch.column("at").to_numpy()
            found = [base_spans(text) for text in column.to_pylist()]
            rows = np.flatnonzero([len(spans) > 0 for spans in found])
            own = column.take(pa.array(rows, pa.int64()))
            for start, stop in textbatch.slices(own):
                made: dict[tuple[int, int, str | None], int | None] = {}
                words = letter_words(own, start, stop)
                left, right = _code_points(words)
                h = words.hashes().view(np.int64)
                border = np.searchsorted(words.row, np.arange(words.rows + 1))
                raw = words.data.tobytes()
                for r in range(words.rows):
                    row, lo, hi = rows[start + r], border[r], border[r + 1]
                    text, at = column[int(row)].as_py(), int(keys[row])
                    same = len(text.lower()) == len(text)
                    for a, b, kind in found[row]:
                        before = lo + int(np.searchsorted(right[lo:hi], a, side="right"))
                        after = lo + int(np.searchsorted(left[lo:hi], b, side="left"))
                        places = [*range(max(lo, before - WINDOW), before), *range(after, min(hi, after + WINDOW))]
                        who = entities(kind, text[a:b])
                        if same:
                            # Lower-casing kept all places, so the words can be read as they are written.
                            who += [f"holder:{x}" for side in (range(max(lo, before - 3), before), range(min(hi, after + 3) - 1, after - 1, -1)) if (x := _name(text, side, left, right))]
                        for value in map(_hash, who):
                            made[value, at, None] = None
                            for i in places:
                                term = raw[words.start[i] : words.end[i]].decode()
                                if len(term) >= (2 if paired(term) else MIN_LETTERS):
                                    made[value, at, term] = int(h[i])
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in made], pa.int64()), pa.array([k[1] for k in made], pa.int64()), pa.array([k[2] for k in made], pa.string()), pa.array(list(made.values()), pa.int64())], names=["value", "at", "term", "term_key"])

    return _keyed(docs).mapInArrow(run, "value long, at long, term string, term_key long").distinct()


def _name(text: str, places: range, left: np.ndarray, right: np.ndarray) -> str | None:
    """The holder's name in the words at places, the nearest last; its words stand in the order of the text."""
    words = [text[left[i] : right[i]] for i in places]
    name = holder(words)
    return name if name is None or places.step > 0 else " ".join(name.split()[::-1])


def _keyed(docs: DataFrame) -> DataFrame:
    """The texts (null as empty) with their hashes `at`, by which copies are one text."""
    return docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("at", F.xxhash64("text"))


def frequencies(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """term_key, n_texts: in how many different texts each wanted term (sorted hashes, one at least) stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = textbatch.as_strings(batch.column("text"))
            for start, stop in textbatch.slices(column):
                words = letter_words(column, start, stop)
                h = words.hashes()
                at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
                hit = wanted[at] == h
                pair = np.unique(words.row[hit].astype(np.int64) * len(wanted) + at[hit])
                rows, n = np.unique(pair // len(wanted), return_counts=True)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(pair % len(wanted), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("at").take(pa.array(rows + start, pa.int64())), lists], names=["at", "places"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            total += np.bincount(batch.column("places").flatten().to_numpy(), minlength=len(wanted))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[seen].view(np.int64)), pa.array(total[seen])], names=["term_key", "n"])

    # Copies of a text give equal rows, one of which is left before terms are counted.
    each = _keyed(docs).mapInArrow(run, "at long, places array<int>").distinct()
    return each.mapInArrow(count, "term_key long, n long").groupBy("term_key").agg(F.sum("n").alias("n_texts"))


def disclosing_terms(docs: DataFrame) -> DataFrame:
    """term, term_key, disclosure (the largest over the entities) of the terms to be treated."""
    near = cut(neighbourhoods(docs))
    values = near.where("term is null").groupBy("value").agg(F.count("*").alias("n_value"))
    pairs = near.where("term is not null").groupBy("value", "term", "term_key").agg(F.count("*").alias("n_pair"))
    pairs = cut(pairs.where(F.col("n_pair") >= MIN_CONTEXTS).join(values, "value"))
    terms = cut(pairs.select("term_key").distinct())
    total = _keyed(docs).select("at").distinct().count()
    n = terms.count()
    if n == 0:
        counts = terms.withColumn("n_texts", F.lit(0).cast("long"))
    elif n <= BROADCAST_TERMS:
        counts = frequencies(docs, np.sort(terms.toArrow()["term_key"].to_numpy().view(np.uint64)))
    else:
        counts = _own_terms(_keyed(docs), terms).groupBy("term_key").agg(F.count("*").alias("n_texts"))
    n_all, n_value, n_texts, n_pair = F.lit(float(max(total, 1))), F.col("n_value"), F.greatest("n_texts", "n_pair"), F.col("n_pair")
    # A value's share can't be above 1.
    content = F.greatest(-F.log(F.least(n_value / n_all, F.lit(0.999))), F.lit(1e-3))
    pmi = F.log((n_pair - SMOOTH) * n_all / ((n_value + SMOOTH) * (n_texts + SMOOTH)))
    scored = pairs.join(counts, "term_key").withColumn("disclosure", pmi / content)
    return cut(scored.where(F.col("disclosure") >= DISCLOSURE).groupBy("term", "term_key").agg(F.max("disclosure").alias("disclosure")))


def _term_spans(words: textbatch.Words, h: np.ndarray, wanted: np.ndarray) -> list[list[tuple[int, int, str]]]:
    out: list[list[tuple[int, int, str]]] = [[] for _ in range(words.rows)]
    if not len(wanted) or not len(h):
        return out
    at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
    hit = np.flatnonzero(wanted[at] == h)
    left, right = _code_points(words)
    for i in hit:
        out[words.row[i]].append((int(left[i]), int(right[i]), "term"))
    return out


def _spans(column: pa.Array, start: int, stop: int, wanted: np.ndarray) -> Iterator[tuple[str, list, list]]:
    """Each row's text, base spans, and term spans that touch no base span."""
    words = letter_words(column, start, stop) if len(wanted) else None
    terms = _term_spans(words, words.hashes(), wanted) if words is not None else None
    for i, text in enumerate(column.slice(start, stop - start).to_pylist()):
        base = base_spans(text)
        more = [t for t in terms[i] if not any(a < t[1] and t[0] < b for a, b, _ in base)] if terms else []
        yield text, base, more




def scan(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term and sanitised_sha256 of every text; the terms' number
    is checked before they are sent."""
    if terms.count() > BROADCAST_TERMS:
        return _scan_joined(docs, terms)
    return _scan(docs, np.sort(terms.select("term_key").toArrow()["term_key"].to_numpy().view(np.uint64)))


def _scan(docs: DataFrame, wanted: np.ndarray, per_row: str | None = None) -> DataFrame:
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = textbatch.as_strings(batch.column("text"))
            own = batch.column(per_row).to_pylist() if per_row else None
            for first, last in textbatch.slices(column):
                ranges = [(first, last, wanted)] if own is None else [(i, i + 1, np.sort(np.array(own[i] or [], np.int64).view(np.uint64))) for i in range(first, last)]
                for start, stop, keys in ranges:
                    rows = []
                    for text, base, more in _spans(column, start, stop, keys):
                        n = Counter(k for _, _, k in base)
                        rows.append((n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(joined(base).encode()).hexdigest(), joined([*base, *more]), len(more), hashlib.sha256(sanitise(text, base, more).encode()).hexdigest()))
                    made = pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term", "sanitised_sha256"])
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, stop - start), *(pa.array(made[c]) for c in made)], names=["doc_id", *made])

    return docs.select("doc_id", "text", *([per_row] if per_row else [])).mapInArrow(run, f"doc_id {id_type}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_term long, sanitised_sha256 string")


def _own_terms(keyed: DataFrame, terms: DataFrame) -> DataFrame:
    """at, term_key: which of any number of terms stand in each text, through a join on the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = textbatch.as_strings(batch.column("text"))
            for start, stop in textbatch.slices(column):
                words = letter_words(column, start, stop)
                pair = np.unique(np.stack([words.row.astype(np.int64) + start, words.hashes().view(np.int64)]), axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("at").take(pa.array(pair[0])), pa.array(pair[1])], names=["at", "term_key"])

    return keyed.select("text", "at").mapInArrow(run, "at long, term_key long").distinct().join(terms.select("term_key"), "term_key", "left_semi")


def _scan_joined(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Like `_scan` with any number of terms: each text meets its own terms through a join on (text hash, term)."""
    keyed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("at"))
    lists = _own_terms(keyed, terms).groupBy("at").agg(F.collect_list("term_key").alias("own_terms"))
    return _scan(keyed.join(lists, "at", "left"), np.zeros(0, np.uint64), "own_terms")


def sanitise(text: str | None, base: list[tuple[int, int, str]], terms: list[tuple[int, int, str]]) -> str | None:
    """The text with values and capitalised terms generalised to their kind in brackets and other terms removed."""
    if text is None:
        return None
    out, at = [], 0
    for a, b, k in sorted([*base, *terms]):
        if a >= at:
            label = f"[{k}]" if k != "term" or text[a].isupper() else ""
            out += [text[at:a], label]
        at = max(at, b)
    return "".join([*out, text[at:]])
