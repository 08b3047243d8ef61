"""Exact Jaccard join of documents on word shingles.

A document is the set of its distinct 5-word shingles (hashes of 51 bits); equal sets are one entity from the start. Shingles
have one global order: those of few documents first, those of many last, by hash within. Two sets with Jaccard 0.8 share a
shingle among the first n - ceil(0.8 n) + 1 of each, so entities meet only in tiles of (such a shingle, size band), where
a band and its neighbour hold all sizes that can link. In a tile every entity is paired with the tile's pivot; pairs are
bounded from above by the bit counts of hashed parity bitmaps and then compared exactly as sorted arrays. What is not in
its pivot's component afterwards meets all members of other components that share the pivot. Pairs inside one component
need no comparison: only classes are returned, and no link between different texts is lost.

Null and empty texts, and texts without words, have empty sets and link with nothing. Repeated rows are in one class.
A null doc_id is never the least of its class. Ties (exactly 80 %) link. An empty table gives an empty result. Texts may be of
any length; a text's set is held by one task at a time. Extra columns of any name pass through `one_of_each` and are left out
by `classes`. Nothing is capped or sampled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import textbatch
from corpusloom.llm.components import components
from corpusloom.session import cut

SHINGLE = 5
#: Similarity in percent.
PERCENT = 80
#: Tiles of postings; a fixed number of hash ranges for each thousand documents, 1024 at least.
BUCKETS = 1024
#: Levels of document frequency from which a shingle may count as frequent; the least that gives few enough is taken.
LEVELS = (16, 64, 256, 1024, 4096)
#: Frequent shingles that may be sent to every worker (4 bytes each); it only orders shingles, results don't depend on it.
FREQUENT_LIMIT = 1 << 20
_FREQUENT_BITS = 24
#: Members of a block.
BLOCK = 2048
#: Shingles that a worker holds before it passes them on.
FLUSH = 1 << 20
#: Bits of the set of entities that take part in some pair, sent to every worker (2 MB); false members cost time only.
_MEMBER_BITS = 24
#: Bits of a shingle's hash.
HASH_BITS = 64 - textbatch.ROW_BITS
_COUNTED = np.dtype([("low", "<u4"), ("n", "<u4")])
_POSTING = np.dtype([("key", "<u8"), ("sig", "<u8"), ("n", "<u4")])


def _sets(column: pa.Array, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of rows start:stop and their rows, in order of (row, shingle). One plain sort does for both."""
    h, row = textbatch.shingles(textbatch.Words(column, start, stop, lower=True), SHINGLE)
    both = np.sort((row.astype(np.uint64) << np.uint64(HASH_BITS)) | (h >> np.uint64(64 - HASH_BITS)))
    if len(both):
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
    return both & np.uint64((1 << HASH_BITS) - 1), (both >> np.uint64(HASH_BITS)).astype(np.int64)


def _signatures(h: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's number of shingles and a 64-bit signature of its set."""
    n = np.bincount(row, minlength=rows)
    first = np.concatenate([[0], np.cumsum(n)])
    sums = np.concatenate([[np.uint64(0)], np.cumsum(textbatch.mix(h), dtype=np.uint64)])
    return n, textbatch.mix((sums[first[1:]] - sums[first[:-1]]) ^ textbatch.mix(n.astype(np.uint64)))


def _unseen(sig: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are the first of their signature, given those seen before in the batch: copies in a batch count once."""
    own, first = np.unique(sig, return_index=True)
    keep = np.zeros(len(sig), bool)
    keep[first[~np.isin(own, seen)]] = True
    return keep, np.union1d(seen, own)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h >> np.uint64(HASH_BITS - 20)).astype(np.int64) * buckets >> 20


def _blobs(keys: np.ndarray, values: np.ndarray, buckets: int) -> tuple[list[int], list[bytes]]:
    """The values as bytes by bucket of their keys."""
    b = _bucket(keys, buckets)
    order = np.argsort(b, kind="stable")
    b, values = b[order], values[order]
    at = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])) if len(b) else np.zeros(0, np.int64)
    return b[at].tolist(), [x.tobytes() for x in np.split(values, at[1:])] if len(b) else []


def frequent(docs: DataFrame, buckets: int) -> np.ndarray:
    """The low 32 bits of shingles in many documents, FREQUENT_LIMIT at most (by the level of frequency)."""
    top = LEVELS[-1]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = textbatch.as_strings(batch.column("text"))
            found, held, seen = [], 0, np.zeros(0, np.uint64)
            for start, stop in textbatch.slices(column):
                h, row = _sets(column, start, stop)
                keep, seen = _unseen(_signatures(h, row, stop - start)[1], seen)
                found.append(h[keep[row]])
                held += len(found[-1])
                if held < FLUSH and stop < len(column):
                    continue
                h, n = np.unique(np.concatenate(found), return_counts=True)
                found, held = [], 0
                # Counts are summed before they are sent: a shingle of many documents is sent once, with its number.
                many = n > 1
                b, blobs = _blobs(h[~many], (h[~many] & np.uint64(0xFFFFFFFF)).astype("<u4"), buckets)
                counted = np.zeros(int(many.sum()), _COUNTED)
                counted["low"], counted["n"] = h[many] & np.uint64(0xFFFFFFFF), np.minimum(n[many], top)
                c, sums = _blobs(h[many], counted, buckets)
                yield pa.RecordBatch.from_arrays([pa.array(b + c, pa.int32()), pa.array(blobs + [None] * len(c), pa.binary()), pa.array([None] * len(b) + sums, pa.binary())], names=["bucket", "blob", "sums"])

    def count(group: pa.Table) -> pa.Table:
        join = lambda name, kind: np.frombuffer(b"".join(x for x in group.column(name).to_pylist() if x is not None), kind)
        once, sums = join("blob", "<u4"), join("sums", _COUNTED)
        low, place = np.unique(np.concatenate([once, sums["low"]]), return_inverse=True)
        n = np.bincount(place, weights=np.concatenate([np.ones(len(once)), sums["n"]]), minlength=len(low))
        level = np.searchsorted(LEVELS, n, side="right")
        keep = level > 0
        return pa.table({"low": pa.array(low[keep].astype(np.int64)), "level": pa.array(level[keep].astype(np.int32))})

    levels = cut(docs.select("text").mapInArrow(textbatch.lean(emit), "bucket int, blob binary, sums binary").groupBy("bucket").applyInArrow(count, "low long, level int"))
    have = {r["level"]: r["n"] for r in levels.groupBy("level").agg(F.count("*").alias("n")).collect()}
    for level in range(1, len(LEVELS) + 1):
        if sum(n for k, n in have.items() if k >= level) <= FREQUENT_LIMIT:
            rows = levels.where(F.col("level") >= level).select("low").toPandas()
            return np.unique(rows["low"].to_numpy().astype(np.uint32))
    return np.zeros(0, np.uint32)


def prefix_length(n: np.ndarray) -> np.ndarray:
    """Leading shingles of which similar sets must share one."""
    return np.where(n > 0, n - -(-n * PERCENT // 100) + 1, 0)


def bands(n: np.ndarray) -> np.ndarray:
    """Size bands; sets that can link are in one band or in neighbouring ones."""
    return np.floor(np.log(np.maximum(n, 1)) / np.log(100 / PERCENT) + 1e-9).astype(np.int64)


def tiles(docs: DataFrame, buckets: int, often: np.ndarray) -> DataFrame:
    """Two kinds of rows. Without a tile: doc_id, sig, n of every document. With one: sig and n of every member of a tile of
    two entities or more."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << _FREQUENT_BITS, bool)
        table[often & np.uint32((1 << _FREQUENT_BITS) - 1)] = True
        for batch in batches:
            column = textbatch.as_strings(batch.column("text"))
            postings, seen = [np.zeros(0, _POSTING)], np.zeros(0, np.uint64)
            for start, stop in textbatch.slices(column):
                h, row = _sets(column, start, stop)
                n, sig = _signatures(h, row, stop - start)
                old = batch.slice(start, stop - start)
                spread = ((sig + np.arange(len(sig), dtype=np.uint64)) % np.uint64(buckets)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(spread), pa.nulls(stop - start, pa.binary()), old.column("doc_id"), pa.array(sig.view(np.int64)), pa.array(n.astype(np.int32))], names=["bucket", "blob", "doc_id", "sig", "n"]
                )
                fresh, seen = _unseen(sig, seen)
                h, row = h[fresh[row]], row[fresh[row]]
                n = np.where(fresh, n, 0)
                many = table[(h & np.uint64((1 << _FREQUENT_BITS) - 1)).astype(np.int64)]
                # Within a row the shingles are sorted, so a stable sort by frequency is all that is wanted.
                order = np.argsort(row * 2 + many, kind="stable")
                h, row = h[order], row[order]
                place = np.arange(len(h)) - np.concatenate([[0], np.cumsum(n)])[row]
                keep = place < prefix_length(n)[row]
                made = np.zeros(int(keep.sum()), _POSTING)
                made["key"], made["sig"], made["n"] = h[keep], sig[row[keep]], n[row[keep]]
                postings.append(made)
            every = np.concatenate(postings)
            b, blobs = _blobs(every["key"], every, buckets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(b, pa.int32()), pa.array(blobs, pa.binary()), pa.nulls(len(b), batch.column("doc_id").type), pa.nulls(len(b), pa.int64()), pa.nulls(len(b), pa.int32())], names=["bucket", "blob", "doc_id", "sig", "n"]
            )

    def meet(group: pa.Table) -> pa.Table:
        blob = group.column("blob")
        every = np.frombuffer(b"".join(x for x in blob.to_pylist() if x is not None), _POSTING)
        # Keys of one posting go first: they are most.
        order = np.argsort(every["key"])
        same = every["key"][order][1:] == every["key"][order][:-1]
        every = every[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]] if len(order) else every
        order = np.lexsort((every["sig"], every["key"]))
        every = every[order]
        if len(every):
            every = every[np.concatenate([[True], (every["key"][1:] != every["key"][:-1]) | (every["sig"][1:] != every["sig"][:-1])])]
        band = bands(every["n"])
        # A tile holds a band and the one above it.
        key = np.concatenate([every["key"], every["key"]])
        tile_band = np.concatenate([band, band - 1])
        both = np.concatenate([every, every])
        order = np.lexsort((both["sig"], tile_band, key))
        both, key, tile_band = both[order], key[order], tile_band[order]
        first = np.concatenate([[True], (key[1:] != key[:-1]) | (tile_band[1:] != tile_band[:-1])]) if len(key) else np.zeros(0, bool)
        number = np.cumsum(first) - 1
        at = np.flatnonzero(first)
        size = np.diff(np.concatenate([at, [len(key)]]))
        keep = size[number] > 1
        tile = textbatch.mix(key + textbatch.mix(tile_band.astype(np.uint64)))
        k = int(keep.sum())
        docs_rows = group.filter(pc.is_null(blob))
        m = docs_rows.num_rows
        long = lambda x: pa.array(x.astype(np.uint64).view(np.int64))
        return pa.table(
            {
                "doc_id": pa.chunked_array([*docs_rows.column("doc_id").chunks, pa.nulls(k, group.schema.field("doc_id").type)], group.schema.field("doc_id").type),
                "sig": pa.chunked_array([*docs_rows.column("sig").chunks, long(both["sig"][keep])], pa.int64()),
                "n": pa.chunked_array([*docs_rows.column("n").chunks, pa.array(both["n"][keep].astype(np.int32))], pa.int32()),
                "tile": pa.chunked_array([pa.nulls(m, pa.int64()), long(tile[keep])], pa.int64()),
            }
        )

    rows = docs.select("doc_id", "text").mapInArrow(textbatch.lean(emit), f"bucket int, blob binary, doc_id {id_type}, sig long, n int")
    return cut(rows.groupBy("bucket").applyInArrow(meet, f"doc_id {id_type}, sig long, n int, tile long"))


def _width(n: np.ndarray | int) -> np.ndarray:
    """Bits of a parity bitmap for a set of n: the power of two at or above n, 64 at least."""
    return 1 << np.maximum(6, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))


def parity(h: np.ndarray) -> np.ndarray:
    """The parity bitmap of a set, as bytes of bits: bit i is the parity of the number of members that hash to it."""
    width = int(_width(len(h)))
    bits = np.bincount((h >> np.uint64(20)).astype(np.int64) & (width - 1), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8))


def _fold(bits: np.ndarray, size: int) -> np.ndarray:
    """A bitmap narrowed to `size` bytes; a hash's low bits choose its bit, so the parts are added modulo 2."""
    return bits if len(bits) == size else np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)


def may_link(a: bytes, b: bytes, n: int, m: int) -> bool:
    """False only if the parity bitmaps show that two sets of n and m are less similar than asked.

    Bits that differ are at most the members in just one of the sets; overlap = (n + m - those) / 2."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    apart = int(np.bitwise_count(_fold(x, size) ^ _fold(y, size)).sum())
    most = (n + m - apart) // 2
    return 100 * most >= PERCENT * (n + m - most)


def links(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted arrays of distinct shingles are as similar as asked."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    same = int((b[at] == a).sum())
    return 100 * same >= PERCENT * (len(a) + len(b) - same)


def member_sets(docs: DataFrame, wanted: DataFrame, whole: bool) -> DataFrame:
    """sig, n and data of the entities in wanted (sig), one row each: the sorted shingles if whole, else the parity bitmap.

    A few entities that are not wanted may be among them."""
    width = 1 << _MEMBER_BITS
    position = F.pmod(F.col("sig"), F.lit(width))
    parts = wanted.select(F.bitmap_bucket_number(position).alias("part"), F.bitmap_bit_position(position).alias("bit")).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    filled = np.zeros(width // 8, np.uint8)
    for r in parts:
        # Bucket k holds the values (k - 1) * 32768 + 1 to k * 32768; value 0 is in bucket 0's last bit.
        bits = np.frombuffer(bytes(r["bits"]), np.uint8)
        filled[(r["part"] - 1) * 4096 : r["part"] * 4096] |= bits if r["part"] > 0 else np.uint8(0)
    zero = any(r["part"] <= 0 for r in parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = textbatch.as_strings(batch.column("text"))
            seen: set[int] = set()
            for start, stop in textbatch.slices(column):
                h, row = _sets(column, start, stop)
                n, sig = _signatures(h, row, stop - start)
                v = sig.view(np.int64) % width
                hit = np.where(v > 0, filled[np.maximum(v - 1, 0) >> 3] >> ((v - 1) & 7).astype(np.uint8) & 1, zero).astype(bool) & (n > 0)
                first = np.concatenate([[0], np.cumsum(n)])
                out = []
                for i in np.flatnonzero(hit):
                    if int(sig[i]) not in seen:
                        seen.add(int(sig[i]))
                        members = h[first[i] : first[i + 1]]
                        out.append((int(sig[i].astype(np.int64)), int(n[i]), members.tobytes() if whole else parity(members).tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else ([], [], []), (pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["sig", "n", "data"])

    found = docs.select("text").mapInArrow(textbatch.lean(run), "sig long, n int, data binary")
    return cut(found.groupBy("sig").agg(F.first("n").alias("n"), F.first("data").alias("data")))


def _bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) whose bitmaps allow a link."""
    joined = pairs.join(sets.select(F.col("sig").alias("a"), F.col("n").alias("n_a"), F.col("data").alias("bits_a")), "a").join(sets.select(F.col("sig").alias("b"), F.col("n").alias("n_b"), F.col("data").alias("bits_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = {c: batch.column(c).to_pylist() for c in ("bits_a", "bits_b", "n_a", "n_b")}
            keep = [may_link(*v) for v in zip(x["bits_a"], x["bits_b"], x["n_a"], x["n_b"], strict=True)]
            yield batch.select(["a", "b", "shared"]).filter(pa.array(keep, pa.bool_()))

    return joined.select("a", "b", "shared", "bits_a", "bits_b", "n_a", "n_b").mapInArrow(textbatch.lean(run), "a long, b long, shared long")


def _apart_pairs(labelled: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of different classes that share a pivot, one of them apart from it, whose bitmaps allow a link.

    The tiles of one pivot are taken together, so that a pair comes up once and not in every tile. Bitmaps meet in blocks of
    BLOCK members by BLOCK; no rows are made for pairs that the bound excludes."""
    rows = labelled.select("pivot", "sig", "n", "class", (F.col("class") != F.col("pivot_class")).alias("apart"))
    sizes = rows.groupBy("pivot").agg(F.count("*").alias("size"), F.count_if("apart").alias("n_apart")).where("n_apart > 0").drop("n_apart")
    rows = rows.join(sizes, "pivot").join(sets.select("sig", "data"), "sig")
    chunk = F.pmod(F.xxhash64("sig"), F.ceil(F.col("size") / BLOCK))
    packed = rows.groupBy("pivot", chunk.alias("chunk")).agg(F.collect_list(F.struct("sig", "n", "class", "apart", "data")).alias("members"))
    left = packed.select("pivot", F.filter("members", lambda m: m["apart"]).alias("own")).where(F.size("own") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = _block_pairs(batch.column("own")[i].as_py(), batch.column("members")[i].as_py())
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    return left.join(packed.select("pivot", "members"), "pivot").mapInArrow(textbatch.lean(run), "a long, b long").distinct()


def _block_pairs(own: list[dict], members: list[dict]) -> list[tuple[int, int]]:
    """The pairs of a block that may link, the lesser signature first."""

    def columns(rows: list[dict], size: int) -> tuple[np.ndarray, ...]:
        bits = np.stack([_fold(np.frombuffer(r["data"], np.uint8), size) for r in rows]).view(np.uint64)
        return np.array([r["sig"] for r in rows]), np.array([r["n"] for r in rows], np.int64), np.array([r["class"] for r in rows]), np.array([r["apart"] for r in rows]), bits

    size = min(len(r["data"]) for r in [*own, *members])
    sig_a, n_a, class_a, _, bits_a = columns(own, size)
    sig_b, n_b, class_b, apart_b, bits_b = columns(members, size)
    out = []
    step = max(1, (1 << 21) // max(1, len(members) * bits_b.shape[1]))
    for k in range(0, len(own), step):
        part = slice(k, k + step)
        total = n_a[part, None] + n_b[None, :]
        # Two members that are both apart meet twice; the lesser one counts.
        fits = (class_a[part, None] != class_b[None, :]) & (100 * np.minimum(n_a[part, None], n_b[None, :]) >= PERCENT * np.maximum(n_a[part, None], n_b[None, :])) & (~apart_b[None, :] | (sig_a[part, None] < sig_b[None, :]))
        differ = np.bitwise_count(bits_a[part, None, :] ^ bits_b[None, :, :]).sum(axis=2, dtype=np.int64)
        most = (total - differ) // 2
        for i, j in np.argwhere(fits & (100 * most >= PERCENT * (total - most))):
            x, y = own[k + i], members[j]
            out.append((min(x["sig"], y["sig"]), max(x["sig"], y["sig"])))
    return out


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by exact intersection of the sets read again from docs."""
    if pairs.isEmpty():
        return pairs.select("a", "b")
    sets = member_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct(), True)
    joined = pairs.join(sets.select(F.col("sig").alias("a"), F.col("data").alias("members_a")), "a").join(sets.select(F.col("sig").alias("b"), F.col("data").alias("members_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("members_a"), batch.column("members_b")
            keep = [links(np.frombuffer(a[i].as_buffer(), "<u8"), np.frombuffer(b[i].as_buffer(), "<u8")) for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.select("a", "b", "members_a", "members_b").mapInArrow(textbatch.lean(run), "a long, b long")


def _classed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows doc_id, sig, n of every document, and the classes: sig (of a text's set), component (of sets) and
    component_id (least doc_id) of every set."""
    buckets = max(BUCKETS, docs.count() // 1000)
    every = tiles(docs, buckets, frequent(docs, buckets))
    entities, met = every.where(F.col("tile").isNull()), every.where(F.col("tile").isNotNull())
    fits = lambda n, m: F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT
    sets = member_sets(docs, met.select("sig").distinct(), False)

    # A tile's pivot is its member of most tiles: an original rather than one of its edited copies, whose own shingles meet nobody.
    weight = met.groupBy("sig").agg(F.count("*").alias("weight"))
    central = met.join(weight, "sig").groupBy("tile").agg(F.max(F.struct("weight", "sig", "n")).alias("p"))
    met = cut(met.select("tile", "sig", "n").join(central.select("tile", F.col("p.sig").alias("pivot"), F.col("p.n").alias("pivot_n")), "tile"))

    # First each entity with its likeliest pivot.
    star = met.where((F.col("sig") != F.col("pivot")) & fits(F.col("n"), F.col("pivot_n"))).groupBy(F.col("sig").alias("a"), F.col("pivot").alias("b")).agg(F.count("*").alias("shared"))
    near = cut(_bounded(star, sets))
    best = near.groupBy("a").agg(F.max_by("b", F.struct("shared", "b")).alias("b"))
    first = cut(_verified(cut(best), docs))
    found = cut(components(first))

    # Then whatever is still apart from its pivot, with all members of other components that share it.
    label = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"{c}_class"))
    labelled = met.select("sig", "n", "pivot").distinct().join(label("sig"), "sig", "left").join(label("pivot"), "pivot", "left").select("sig", "n", "pivot", F.coalesce("sig_class", "sig").alias("class"), F.coalesce("pivot_class", "pivot").alias("pivot_class"))
    second = _verified(cut(_apart_pairs(cut(labelled), sets)), docs)
    linked = components(first.unionByName(second))

    ids = entities.groupBy("sig").agg(F.min("doc_id").alias("least"), F.max("n").alias("n"))
    classed = cut(ids.join(linked.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig")))
    least = classed.groupBy("component").agg(F.min("least").alias("component_id"))
    return entities.select("doc_id", "sig", "n"), classed.join(least, "component").select("sig", "component", "component_id")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    entities, found = _classed(docs)
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return entities.join(found.drop("component"), "sig", "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of docs for every class of texts: that of the least doc_id (nulls last), and among its rows that of the least
    hash. Texts without words are in no class and stay, each row of them. Rows are told apart by the hashes of all their
    columns, not by doc_id: other texts under one id are judged on their own. Columns may have any names."""
    hashed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id", "text")
    hashed = hashed.withColumn("at", F.xxhash64("doc"))
    # The operator's key is a row's hash here, so that what comes back names the row.
    entities, found = _classed(hashed.select(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("at")).alias("doc_id"), "text"))
    first = found.select("component_id").distinct().select(F.col("component_id.at").alias("first_at"))
    blank = entities.where("n = 0").select(F.col("doc_id.at").alias("first_at"))
    stay = cut(first.join(blank, "first_at", "left_anti").unionByName(blank.distinct()))
    kept = hashed.join(stay, F.col("at") == F.col("first_at"), "left_semi")
    # Equal rows of a class are one; equal rows without words are kept.
    if not hashed.groupBy("at").count().where("count > 1").isEmpty():
        marked = kept.withColumn("blank", ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
        kept = marked.where(~F.col("blank")).dropDuplicates(["at"]).unionByName(marked.where("blank"))
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
