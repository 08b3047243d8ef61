"""Secret scans by grammar inference.

Labelled credentials (values that the base patterns find in the corpus, FIT_VALUES of them at most, and examples of public
credential formats) make a prefix tree over character classes. States whose futures agree by Hoeffding's bound are merged
into a probabilistic automaton. In every run of credential characters outside the base patterns' spans, each part of MIN_RUN
or more that starts at the run's start or after a joint and ends at the run's end or before a joint is scored by its
likelihood under the automaton against a class-bigram model of ordinary runs; the best parts that fit a format are added
to the base patterns' spans.

Nulls count as empty texts, which have no spans. Repeated rows are scanned alike. Equal scores go to the earlier part. An empty
table gives an empty result, and a model of the public formats alone. Whole texts are scanned, however long. Ids may be of
any type; extra columns are left out, whatever their names. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import textbatch

KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
#: Parts of the keywords, one of which stands in any text with an assignment (after lower-casing).
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_RUN = 16
#: Characters of runs that may join a credential to other text.
JOINTS = frozenset("/=.-_+")
#: Least probability of a move, an end or a pair.
FLOOR = 1e-4
#: Values of the corpus and ordinary runs that the fit may read: those of least hash among the ones of FIT_LENGTH characters
#: at most. Both bound the sample that the model is fitted on and nothing else.
FIT_VALUES, FIT_LENGTH = 1_000, 1_024
ALPHA = 0.05
#: Nats by which a format must be likelier than ordinary text.
MIN_RATIO = 8.0

#: Prefixes, alphabets and lengths of public credential formats.
FORMATS = (
    ("AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16),
    ("ASIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16),
    ("ghp_", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 36),
    ("glpat-", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", 20),
    ("sk_live_", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 24),
    ("AIza", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", 35),
    ("xoxb-", "0123456789", 12),
    ("eyJhbGciOi", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", 40),
    ("", "0123456789abcdef", 40),
    ("", "0123456789abcdef", 64),
    ("", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 40),
)
EXAMPLES = 40


def examples() -> list[str]:
    """Credentials of every public format, the same in every run."""
    rng = random.Random(11)
    return [prefix + "".join(rng.choice(letters) for _ in range(n)) for prefix, letters, n in FORMATS for _ in range(EXAMPLES)]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The base patterns' spans (start, end, kind), by start and then kind as listed."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def values(text: str) -> list[str]:
    """The credentials in the base spans."""
    low = text.lower()
    found = [m[2] for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_RUN] if any(k in low for k in KEYWORDS) else []
    found += [m[0] for m in ACCESS.finditer(text) if len(m[0]) >= 20] if "AKIA" in text else []
    return found + [m[0] for m in HEX.finditer(text)]


def symbols(run: str) -> str:
    """The run as classes: d digit, h a-f, l other small letters, U A-F, V other capitals, anything else itself."""
    return "".join("d" if c.isdigit() else "h" if "a" <= c <= "f" else "l" if "a" <= c <= "z" else "U" if "A" <= c <= "F" else "V" if "A" <= c <= "Z" else c for c in run)


@dataclass
class Automaton:
    """States with counts: how often each was reached, ended in, and left by each symbol."""

    reached: list[int] = field(default_factory=list)
    ended: list[int] = field(default_factory=list)
    moves: list[dict[str, int]] = field(default_factory=list)
    taken: list[dict[str, int]] = field(default_factory=list)

    def add_state(self) -> int:
        self.reached.append(0)
        self.ended.append(0)
        self.moves.append({})
        self.taken.append({})
        return len(self.reached) - 1

    @classmethod
    def prefix_tree(cls, strings: list[str]) -> Automaton:
        a = cls()
        root = a.add_state()
        for s in strings:
            state = root
            a.reached[state] += 1
            for c in s:
                if c not in a.moves[state]:
                    a.moves[state][c] = a.add_state()
                a.taken[state][c] = a.taken[state].get(c, 0) + 1
                state = a.moves[state][c]
                a.reached[state] += 1
            a.ended[state] += 1
        return a

    def agree(self, p: int, q: int) -> bool:
        """Whether the futures of two states are compatible, to the depth that the second one's tree has."""
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            n, m = self.reached[p], self.reached[q]
            if not n or not m:
                continue
            bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ended[p] / n - self.ended[q] / m) > bound:
                return False
            for c in self.taken[p].keys() | self.taken[q].keys():
                if abs(self.taken[p].get(c, 0) / n - self.taken[q].get(c, 0) / m) > bound:
                    return False
                if c in self.moves[p] and c in self.moves[q]:
                    todo.append((self.moves[p][c], self.moves[q][c]))
        return True

    def fold(self, p: int, q: int) -> None:
        """Adds the tree below q to p."""
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            self.reached[p] += self.reached[q]
            self.ended[p] += self.ended[q]
            for c, k in self.taken[q].items():
                self.taken[p][c] = self.taken[p].get(c, 0) + k
                if c in self.moves[p]:
                    todo.append((self.moves[p][c], self.moves[q][c]))
                else:
                    self.moves[p][c] = self.moves[q][c]

    def merge(self, least: int = 8) -> Automaton:
        """Merges each new state into the first settled one that it agrees with; states seen under `least` times always merge."""
        settled = [0]
        border = sorted(self.moves[0].items())
        edges = [(0, c, q) for c, q in border]
        while edges:
            edges.sort(key=lambda e: -self.reached[e[2]])
            p, c, q = edges.pop(0)
            if q in settled:
                continue
            home = next((r for r in settled if r != q and self.reached[q] >= least and self.agree(r, q)), None)
            if home is None and self.reached[q] < least:
                home = next((r for r in settled if r and self.agree(r, q)), None)
            if home is not None:
                self.moves[p][c] = home
                self.fold(home, q)
            else:
                settled.append(q)
            known = set(settled)
            edges = [(r, c, s) for r in settled for c, s in self.moves[r].items() if s not in known]
        return self

    def reachable(self) -> Automaton:
        """The states that can be reached, renumbered: merging leaves the others behind."""
        number, todo = {0: 0}, [0]
        for q in todo:
            for _, to in sorted(self.moves[q].items()):
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
        return Automaton([self.reached[q] for q in todo], [self.ended[q] for q in todo], [{c: number[to] for c, to in self.moves[q].items()} for q in todo], [self.taken[q] for q in todo])

    def likelihood(self, s: str, floor: float = FLOOR) -> float:
        """ln P(s), unseen moves counted with a small probability."""
        state, total = 0, 0.0
        for c in s:
            n = self.reached[state]
            total += math.log(max(self.taken[state].get(c, 0) / n if n else 0.0, floor))
            state = self.moves[state].get(c, 0)
        return total + math.log(max(self.ended[state] / max(self.reached[state], 1), floor))


@dataclass
class Model:
    """The automaton, the bigram model of ordinary runs, and the least likelihood a symbol that credentials have."""

    grammar: Automaton
    pairs: dict[str, float]
    least: float

    def __post_init__(self) -> None:
        g = self.grammar
        self.steps = [{c: (math.log(max(k / n, FLOOR)), g.moves[q][c]) for c, k in g.taken[q].items()} for q, n in enumerate(g.reached)]
        self.ends = [math.log(max(e / max(n, 1), FLOOR)) for e, n in zip(g.ended, g.reached, strict=True)]

    def ordinary(self, s: str) -> float:
        lost = math.log(FLOOR)
        return sum(self.pairs.get(s[i : i + 2], lost) for i in range(len(s) - 1))

    def fits(self, run: str) -> bool:
        s = symbols(run)
        p = self.grammar.likelihood(s)
        return p - self.ordinary(s) >= MIN_RATIO and p / len(s) >= self.least

    def parts(self, run: str) -> list[tuple[int, int]]:
        """The parts between joints that fit, without overlaps, those furthest above the least likelihood first; else the whole run if it fits.

        All starts are followed at once; a joint that no credential has in a start's state ends it. Starts in one state have
        the same future, so one that is behind another of them both in likelihood and in ratio is dropped.
        """
        s, lost, found = symbols(run), math.log(FLOOR), []
        now: dict[int, list[tuple[float, float, int]]] = {}
        for i, c in enumerate(s):
            if not i or s[i - 1] in JOINTS:
                now.setdefault(0, []).append((0.0, 0.0, i))
            pair = self.pairs.get(s[i - 1 : i + 1], lost) if i else 0.0
            moved: dict[int, list[tuple[float, float, int]]] = {}
            for state, starts in now.items():
                if c in JOINTS and c not in self.steps[state]:
                    continue
                gain, to = self.steps[state].get(c, (lost, 0))
                moved.setdefault(to, []).extend((over + gain - self.least, ratio + gain - (pair if i > a else 0.0), a) for over, ratio, a in starts)
            for state, starts in moved.items():
                if len(starts) > 1:
                    best, kept = -math.inf, []
                    for x in sorted(starts, key=lambda x: (-x[0], -x[1], -x[2])):
                        if x[1] > best:
                            best = x[1]
                            kept.append(x)
                    moved[state] = kept
            now = moved
            if i + 1 == len(s) or s[i + 1] in JOINTS:
                found += [(over + self.ends[q], a, i + 1) for q, starts in now.items() for over, ratio, a in starts if i + 1 - a >= MIN_RUN and over + self.ends[q] >= 0 and ratio + self.ends[q] >= MIN_RATIO]
        out: list[tuple[int, int]] = []
        for _, a, b in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
            if all(b <= x or y <= a for x, y in out):
                out.append((a, b))
        return out or ([(0, len(run))] if self.fits(run) else [])


def learn(credentials: list[str], ordinary: list[str]) -> Model:
    """A model from labelled credentials and ordinary runs."""
    strings = [symbols(x) for x in credentials]
    grammar = Automaton.prefix_tree(sorted(strings)).merge().reachable()
    pairs: Counter[str] = Counter()
    heads: Counter[str] = Counter()
    for run in ordinary or ["abcdefghijklmnopqrstuvwxyz"]:
        s = symbols(run)
        for i in range(len(s) - 1):
            pairs[s[i : i + 2]] += 1
            heads[s[i]] += 1
    table = {k: math.log(n / heads[k[0]]) for k, n in pairs.items()}
    rates = sorted(grammar.likelihood(s) / len(s) for s in strings)
    return Model(grammar, table, rates[len(rates) // 50] - 0.02 if rates else 0.0)


def _least(runs: set[str]) -> list[tuple[str, str]]:
    """Hash and run of those that the fit may read."""
    return sorted((hashlib.md5(x.encode()).hexdigest(), x) for x in runs if len(x) <= FIT_LENGTH)[:FIT_VALUES]


def fit(docs: DataFrame) -> Model:
    """A model from the corpus's base values and ordinary runs, FIT_VALUES of each at most, and the public formats."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = textbatch.as_strings(batch.column("text"))
            good, plain = set(), set()
            for text in column.to_pylist():
                mine = values(text)
                good.update(mine)
                if not mine:
                    # Ordinary runs are those of texts without credentials.
                    plain.update(RUN.findall(text))
            good, plain = _least(good), _least(plain)
            yield pa.RecordBatch.from_arrays([pa.array([x for _, x in [*good, *plain]], pa.string()), pa.array([h for h, _ in [*good, *plain]], pa.string()), pa.array([True] * len(good) + [False] * len(plain))], names=["run", "hash", "good"])

    # Each batch passes on its least hashes, by the order in which the least of all are taken: any partitioning gives the same.
    rows = docs.select("text").mapInArrow(found, "run string, hash string, good boolean").distinct()
    pick = lambda good: [r["run"] for r in rows.where(F.col("good") == good).orderBy("hash", "run").limit(FIT_VALUES).collect()]
    rows = rows.persist()
    try:
        return learn([*pick(True), *examples()], pick(False))
    finally:
        rows.unpersist()


def format_spans(text: str, base: list[tuple[int, int, str]], model: Model) -> list[tuple[int, int, str]]:
    """Parts of runs that fit a credential format, outside the base spans."""
    out = []
    for m in RUN.finditer(text):
        at = m.start()
        for a, b in [*sorted((s, e) for s, e, _ in base if s < m.end() and m.start() < e), (m.end(), m.end())]:
            if a - at >= MIN_RUN:
                out += [(at + x, at + y, "format") for x, y in model.parts(text[at:a])]
            at = max(at, b)
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_format of every text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = textbatch.as_strings(batch.column("text"))
            for start, stop in textbatch.slices(column):
                rows = []
                for text in column.slice(start, stop - start).to_pylist():
                    base = base_spans(text)
                    more = format_spans(text, base, model)
                    kinds = Counter(k for _, _, k in base)
                    rows.append((kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(joined(base).encode()).hexdigest(), joined([*base, *more]), len(more)))
                made = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format"])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, stop - start), *(pa.array(made[c]) for c in made)], names=["doc_id", *made])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long")


def mask(text: str | None, model: Model) -> str | None:
    """The text with every span replaced by its kind in brackets; null stays null."""
    if text is None:
        return None
    base = base_spans(text)
    out, at = [], 0
    for a, b, k in sorted([*base, *format_spans(text, base, model)]):
        if a >= at:
            out += [text[at:a], f"[{k}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])
