"""Byte-pair encoding and decoding of whole texts with a public byte-level vocabulary.

Every pre-token starts as one symbol a byte. A segment tree over the pairs of neighbouring symbols holds the key
(rank of the pair, position), so the root is the leftmost pair of lowest rank; a merge changes three leaves and their
paths. The trees of many pre-tokens of like size are updated together as arrays, one merge in each at a time.

Nulls count as empty texts, which have no tokens. Repeated rows are encoded each on its own. An empty table gives an empty
result. Texts may be of any length: a tree has two nodes a byte of its pre-token, and a merge costs its depth. Ids may be of
any type. Extra columns pass through `encode_documents` untouched unless they bear the names of its results, and are left
out by `digests`.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from corpusloom.llm import textbatch

#: Fixed pattern that cuts a text into pre-tokens for this kind of vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens whose ids a worker keeps; when full, it starts anew.
CACHE_ENTRIES = 150_000
#: Leaves of all the trees that are updated together.
TREE_LEAVES = 1 << 18
_NONE = np.int64(1) << 62


def byte_symbols() -> list[str]:
    """The character by which byte-level vocabularies write each byte: itself if printable, else the next one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + other.index(b)) for b in range(256)]


class ByteBpe:
    """The vocabulary of a tokenizer file, and the two directions."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        signs = byte_symbols()
        self.byte_id = np.array([vocab[c] for c in signs], dtype=np.int64)
        back = {c: b for b, c in enumerate(signs)}
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *self.specials.values()])
        self.token_bytes: list[bytes] = [b""] * size
        for text, i in vocab.items():
            self.token_bytes[i] = bytes(back[c] for c in text)
        for text, i in self.specials.items():
            self.token_bytes[i] = text.encode()
        self.base = size
        pair = np.array([vocab[a] * size + vocab[b] for a, b in merges], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        order = np.argsort(pair, kind="stable")
        self.pair_sorted, self.pair_rank = pair[order], order.astype(np.int64)
        self.made = made
        self.split = regex.compile(SPLIT)
        self.special_split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")") if self.specials else None
        self.cache: dict[str, bytes] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or a number past every rank if it never merges. A symbol of -1 is none."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.pair_sorted, key), len(self.pair_sorted) - 1)
        hit = (self.pair_sorted[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_rank[at], -1)

    def merge_all(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word: all merges, by segment trees in groups of like size."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        for i in np.flatnonzero(lengths == 1):
            out[i] = self.byte_id[[words[i][0]]]
        size = 2
        while True:
            group = np.flatnonzero((lengths > max(1, size // 2)) & (lengths <= size))
            step = max(1, TREE_LEAVES // size)
            for k in range(0, len(group), step):
                part = group[k : k + step]
                for i, ids in zip(part, self._merge_group([words[i] for i in part], lengths[part], size), strict=True):
                    out[i] = ids
            if size >= lengths.max(initial=0):
                return out
            size *= 2

    def _merge_group(self, words: list[bytes], lengths: np.ndarray, size: int) -> list[np.ndarray]:
        n = len(words)
        place = np.arange(size + 2)
        # Column p + 1 is position p; columns 0 and size + 1 stand for "no neighbour".
        symbol = np.full((n, size + 2), -1, dtype=np.int64)
        inside = (place[None, :] >= 1) & (place[None, :] <= lengths[:, None])
        symbol[inside] = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        after = np.tile(np.minimum(place + 1, size + 1), (n, 1))
        before = np.tile(np.maximum(place - 1, 0), (n, 1))
        tree = np.full((n, 2 * size), _NONE, dtype=np.int64)
        rank = self.rank(symbol[:, 1:-1].ravel(), symbol[:, 2:].ravel()).reshape(n, size)
        tree[:, size:] = np.where(rank >= 0, rank * size + np.arange(size), _NONE)
        level = size
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level = half
        rows = np.flatnonzero(tree[:, 1] < _NONE)
        while len(rows):
            best = tree[rows, 1]
            here = best % size + 1
            gone = after[rows, here]
            new_next = after[rows, gone]
            prior = before[rows, here]
            symbol[rows, here] = self.made[best // size]
            symbol[rows, gone] = -1
            after[rows, here] = new_next
            before[rows, new_next] = here
            mine = symbol[rows, here]
            r = self.rank(mine, symbol[rows, new_next])
            tree[rows, size + here - 1] = np.where(r >= 0, r * size + here - 1, _NONE)
            tree[rows, size + gone - 1] = _NONE
            has = prior > 0
            r = self.rank(symbol[rows, prior], mine)
            left_leaf = np.where(has, size + prior - 1, size + here - 1)
            tree[rows, left_leaf] = np.where(has, np.where(r >= 0, r * size + prior - 1, _NONE), tree[rows, left_leaf])
            paths = [size + here - 1, size + gone - 1, left_leaf]
            while paths[0][0] > 1:
                paths = [p >> 1 for p in paths]
                for p in paths:
                    tree[rows, p] = np.minimum(tree[rows, 2 * p], tree[rows, 2 * p + 1])
            rows = rows[tree[rows, 1] < _NONE]
        kept = [s[s >= 0] for s in symbol]
        return kept

    def encode_packed(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut: list[list[str]] = []
        for text in texts:
            if self.special_split is None:
                cut.append(self.split.findall(text))
                continue
            parts: list[str] = []
            for piece in self.special_split.split(text) if any(s in text for s in self.specials) else [text]:
                parts.extend([piece] if piece in self.specials else self.split.findall(piece))
            cut.append(parts)
        missing = list({t for parts in cut for t in parts if t not in self.cache})
        if len(self.cache) + len(missing) > CACHE_ENTRIES:
            self.cache = {}
            missing = list({t for parts in cut for t in parts})
        plain = [t for t in missing if t not in self.specials]
        for t, ids in zip(plain, self.merge_all([t.encode() for t in plain]), strict=True):
            self.cache[t] = ids.astype("<u4").tobytes()
        for t in missing:
            if t in self.specials:
                self.cache[t] = np.array([self.specials[t]], dtype="<u4").tobytes()
        get = self.cache.__getitem__
        return [b"".join(map(get, parts)) for parts in cut]

    def decode_packed(self, ids: bytes) -> str:
        """The text of packed ids, special tokens included."""
        table = self.token_bytes
        return b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", errors="replace")


def tokenizer(path: str) -> ByteBpe:
    """A worker's tokenizer."""
    return textbatch.model(ByteBpe, path)


def encode_documents(docs: DataFrame, path: str, text: str = "text", ids_column: str = "ids", decoded_column: str | None = "decoded") -> DataFrame:
    """The rows of docs with `ids` (packed little-endian unsigned 32-bit) and the text decoded from them.

    A null text gives empty ids and an empty decoded text. Columns of docs with the names of results are replaced."""
    drop = {ids_column, decoded_column}
    keep = [c for c in docs.columns if c not in drop]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[f"`{c}`" for c in keep]).schema), f"`{ids_column}` binary", *([f"`{decoded_column}` string"] if decoded_column else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            column = textbatch.as_strings(batch.column(batch.schema.get_field_index(text)))
            for start, stop in textbatch.slices(column):
                ids = bpe.encode_packed(column.slice(start, stop - start).to_pylist())
                made = [pa.array(ids, pa.binary())]
                if decoded_column:
                    made.append(pa.array([bpe.decode_packed(x) for x in ids], pa.string()))
                old = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*(old.column(c) for c in keep), *made], names=[*keep, ids_column, *([decoded_column] if decoded_column else [])])

    return docs.mapInArrow(textbatch.lean(run, models=True), schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text; see `encode_documents` for nulls and empty texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            column = textbatch.as_strings(batch.column("text"))
            for start, stop in textbatch.slices(column):
                ids = bpe.encode_packed(column.slice(start, stop - start).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, stop - start),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                        pa.array([hashlib.sha256(bpe.decode_packed(x).encode()).hexdigest() for x in ids]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(textbatch.lean(run, models=True), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
