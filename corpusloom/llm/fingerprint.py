"""Document fingerprints by invertible Bloom lookup sketches. DataFrame operations only.

A document is the set of digests of its paragraphs, long ones cut into pieces of PIECE words. Its fingerprint is a sketch of
three tables of BASE cells, each holding the number, the combined digests and the combined checks of the digests that
fall into it. Two sketches are subtracted cell by cell (a sketch is linear, so the difference is the sum of one set's entries
and the other's with their sign changed); peeling pure cells, one table after the other, then recovers the digests in just
one of the documents. Cells that are left estimate how many digests differ beyond those found: the next sketches of such a
pair are made for that number, and twice as large again until nothing is left. No set is ever compared but by sketches.

Cells are rows, all those of a pair in one task, so that peeling is a chain of aggregations without exchanges between them.

Likeness is 1 less the share of differing digests among both sets (1 for two empty sets). Nulls count as empty texts. Rows
are ordered by doc_id, nulls first, and by text hash within one doc_id; equal rows are one document and get one result
each. A single document is its own next one. Texts may be of any length; a text's digests are held by one task at a time.
Extra columns of the documents are left out, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.session import cut, stored

PIECE = 16
#: Cells of each of the three tables of a fingerprint.
BASE = 8
TABLES = 3
#: Turns of peeling in an attempt, each over all tables; each takes all pure cells of a table.
TURNS = 2
#: Cells a table for each digest that is expected to differ. Three tables need 1.23 cells a digest together; with more room,
#: two turns are enough.
ROOM = 1.0
#: Pairs that may be broadcast to be tried again (16 bytes each).
BROADCAST_PAIRS = 200_000
#: Cells that meet in one task, on average, apart from those of one very long text: the aggregations of an attempt hold them several
#: times over, so that tasks are counted by cells and not by bytes.
TASK_CELLS = 1 << 17
#: Rows for each range in which the order of documents is found, and ranges at most (their first rows are broadcast).
RANGE_ROWS, RANGES = 50_000, 1 << 16
_PIECES = r"(?:[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*){1,%d}" % PIECE


def digests(text: Column) -> Column:
    """The distinct digests of a text's pieces, sorted."""
    pieces = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0))
    return F.sort_array(F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(F.rtrim(p)))))


def _cell(key: Column, table: Column | int, size: Column) -> Column:
    table = F.lit(table) if isinstance(table, int) else table
    return F.pmod(F.xxhash64(key, table), size) + table * size


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(7))


def _entries(sets: DataFrame, names: list[str]) -> DataFrame:
    """The named columns with the cell, n, key and check of every entry of sets (names, size, n, keys)."""
    keys = sets.select(*names, "size", "n", F.explode("keys").alias("key"))
    spread = keys.select(*names, "size", "n", "key", F.explode(F.array(*[F.lit(t) for t in range(TABLES)])).alias("t"))
    return spread.select(*names, "size", _cell(F.col("key"), F.col("t"), F.col("size")).alias("cell"), "n", "key", _check(F.col("key")).alias("check"))


def _tasks(cells: int) -> int:
    return max(1, math.ceil(cells / TASK_CELLS))


def _added(entries: DataFrame, names: list[str]) -> DataFrame:
    """The cells that are not empty, each the sum of its entries."""
    # A struct as key: for plain numbers each aggregation would take a page of memory of its own before it begins.
    sums = entries.groupBy(*names, F.struct("size", "cell").alias("at")).agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check"))
    sums = sums.where((F.col("n") != 0) | (F.col("key") != 0) | (F.col("check") != 0))
    return sums.select(*names, "at.size", "at.cell", "n", "key", "check")


def fingerprints(sets: DataFrame, n: int) -> DataFrame:
    """row, side, fingerprint of sets (row, side, keys) with a digest: the number of digests, then cell, count, digests and
    checks of every filled cell. n: the number of sets. They are dealt by row once, and so is the result."""
    names = ["row", "side"]
    # No fewer than what the result is joined with gets, else it would be dealt again.
    tasks = max(_tasks(n * TABLES * BASE), int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = sets.repartition(tasks, "row").withColumns({"size": F.lit(BASE).cast("long"), "n": F.lit(1).cast("long")})
    cells = _added(_entries(dealt, names), names)
    one = F.concat_ws(".", F.col("cell").cast("string"), F.col("n").cast("string"), F.lower(F.hex("key")), F.lower(F.hex("check")))
    rows = F.transform(F.sort_array(F.collect_list(F.struct("cell", one.alias("one")))), lambda c: c["one"])
    # Every digest has one entry in the first table.
    count = F.sum(F.when(F.col("cell") < BASE, F.col("n")).otherwise(0))
    return cells.groupBy(*names).agg(F.concat(count.cast("string"), F.lit(":"), F.array_join(rows, ",")).alias("fingerprint"))


def _peeled(cells: DataFrame, table: int) -> DataFrame:
    """The cells of differences (pair, size, cell, n, key, check) after the pure ones of one table were taken out of all.

    A digest has one cell in the table, so none is taken twice. What was found adds up in a cell of its own, -1: how many
    digests, and their hashes with the side that has them."""
    pure = (F.floor(F.col("cell") / F.col("size")) == table) & (F.abs("n") == 1) & (F.col("check") == _check(F.col("key")))
    row = lambda cell, n, key, check: F.struct(cell.alias("cell"), n.alias("n"), key.alias("key"), check.alias("check"))
    less = [row(_cell(F.col("key"), t, F.col("size")), -F.col("n"), F.col("key"), F.col("check")) for t in range(TABLES) if t != table]
    found = row(F.lit(-1).cast("long"), F.lit(1).cast("long"), F.lit(0).cast("long"), F.xxhash64("key", "n"))
    same = row(*[F.col(c) for c in ("cell", "n", "key", "check")])
    moved = cells.select("pair", "size", F.explode(F.when(pure, F.array(*less, found)).otherwise(F.array(same))).alias("c"))
    return _added(moved.select("pair", "size", "c.*"), ["pair"])


def _attempt(pairs: DataFrame, turns: int = TURNS) -> DataFrame:
    """pair, size, found, mark, remain of the pairs (pair, size, a, b) whose sketches differ, which must be dealt by pair.

    remain is 0 if all cells came out empty; else it estimates the digests that were not found, by the squares of the cells'
    counts: n digests of two signs in a table of m cells give n (1 - 1/m) + d d / m, where d is their signed sum."""
    sides = F.array(*[F.struct(F.lit(sign).cast("long").alias("n"), F.col(side).alias("keys")) for side, sign in (("a", 1), ("b", -1))])
    sets = pairs.select("pair", "size", F.explode(sides).alias("s")).select("pair", "size", "s.n", "s.keys")
    cells = reduce(_peeled, list(range(TABLES)) * turns, _added(_entries(sets, ["pair"]), ["pair"]))
    n, size, left = F.col("n"), F.col("size"), F.col("cell") >= 0
    sums = cells.groupBy("pair", "size").agg(
        F.max(F.when(~left, n)).alias("found"), F.max(F.when(~left, F.col("check"))).alias("mark"), F.count_if(left).alias("open"), F.sum(F.when(left, n * n)).alias("squares"), F.sum(F.when(left & (F.col("cell") < size), n)).alias("signed")
    )
    signed = F.coalesce("signed", F.lit(0))
    apart = (F.col("squares") / TABLES - signed * signed / size) / (1 - 1 / size)
    remain = F.when(F.col("open") == 0, F.lit(0)).otherwise(F.greatest(F.ceil(apart), F.abs(signed), F.lit(1)))
    return sums.select("pair", "size", F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("mark", F.lit(0)).alias("mark"), remain.cast("long").alias("remain"))


def differences(pairs: DataFrame, n: int | None = None) -> DataFrame:
    """pair, found, mark of the pairs of sets (pair, a, b) that differ: how many digests stand in just one of the sets, and
    the recovered digests' hashes with their sides, combined. Pairs that are left out have equal sets. n: the number of pairs, where it is known.

    The fingerprints' own sketches, subtracted, estimate the difference; they are peeled where it is small enough for them, and
    sketches of the size that it asks for otherwise. Nearly all pairs are decoded so. For the others sizes at least double, so
    the loop ends after a few rounds even for the longest texts."""
    n = pairs.count() if n is None else n
    tasks = max(_tasks(n * TABLES * BASE), pairs.sparkSession.sparkContext.defaultParallelism)
    tried = cut(_attempt(pairs.withColumn("size", F.lit(BASE).cast("long")).repartition(tasks, "pair"), 0))
    size = F.when(F.col("remain") <= 2 * BASE, F.lit(BASE)).otherwise(F.ceil(F.col("remain") * ROOM) + BASE)
    done = []
    while True:
        still = tried.where("remain > 0").select(F.col("pair").alias("own"), size.cast("long").alias("size"))
        n, sizes = still.agg(F.count("*"), F.sum("size")).first()
        if n == 0:
            return reduce(DataFrame.unionByName, done or [tried]).select("pair", "found", "mark")
        tasks, same = _tasks(sizes * TABLES), F.col("pair") == F.col("own")
        if n <= BROADCAST_PAIRS:
            met = pairs.join(F.broadcast(still), same).drop("own").repartition(tasks, "pair")
        else:
            met = pairs.repartition(tasks, "pair").join(still.repartition(tasks, "own").hint("merge"), same).drop("own")
        tried = cut(_attempt(met))
        done.append(tried.where("remain = 0"))
        size = F.greatest(F.col("size") * 2, F.ceil((F.col("found") + F.col("remain")) * ROOM) + BASE)


def successors(ids: DataFrame) -> DataFrame:
    """ids (doc_id, h, n), distinct, with next_id and next_h: the following row, the first one after the last.

    Rows are ordered in ranges; only the ranges' first rows meet in one task."""
    spark = ids.sparkSession
    ranges = min(RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), ids.count() // RANGE_ROWS))
    placed = cut(ids.repartitionByRange(ranges, F.col("doc_id").asc_nulls_first(), "h").withColumn("range", F.spark_partition_id()))
    firsts = placed.groupBy("range").agg(F.min(F.struct("doc_id", "h")).alias("first"))
    every = Window.partitionBy(F.lit(0)).orderBy("range")
    after = firsts.withColumn("after", F.coalesce(F.lead("first").over(every), F.first("first").over(every))).select("range", "after")
    inside = F.lead(F.struct("doc_id", "h")).over(Window.partitionBy("range").orderBy(F.col("doc_id").asc_nulls_first(), "h"))
    # One row a range, RANGES at most.
    joined = placed.withColumn("inner", inside).join(F.broadcast(after), "range").withColumn("next", F.coalesce("inner", "after"))
    return cut(joined.select("doc_id", "h", "n", F.col("next.doc_id").alias("next_id"), F.col("next.h").alias("next_h")))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every document, then how
    many digests differ from the edited and the next text, and marks of the recovered ones."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    order = successors(rows.select("doc_id", "h", F.length("text").alias("n")).distinct())
    # What each row gives to the one before it: its first characters and its digests.
    asked = order.select(F.col("next_id").alias("own_id"), F.col("next_h").alias("own_h"), F.col("doc_id").alias("to_id"), F.col("h").alias("to_h"), F.floor(F.col("n") / 2).cast("int").alias("asked"))
    base = rows.withColumn("keys", digests(F.col("text"))).join(asked, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("h") == F.col("own_h"))).drop("own_id", "own_h")
    given = base.select("to_id", "to_h", F.expr("substring(text, 1, asked)").alias("head"), F.col("keys").alias("next_keys"))
    # Equal rows give the same thing once.
    if order.count() < rows.count():
        given = given.dropDuplicates(["to_id", "to_h"])
    own = base.select("doc_id", "h", "text", "keys")
    met = own.join(given, F.col("doc_id").eqNullSafe(F.col("to_id")) & (F.col("h") == F.col("to_h")))
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.col("head"))
    texts = met.select("doc_id", F.length("text").cast("long").alias("n_chars"), "keys", "next_keys", edited.alias("edited"))
    keyed = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "keys", digests(F.col("edited")).alias("edited_keys"), "next_keys")
    keyed = stored(keyed)
    n = keyed.count()

    # Of each row, sides 0 and 1 are its own and the edited digests; pairs 0 and 1 compare its own with the edited and the next.
    both = [F.struct(F.lit(k).alias("side"), F.col(c).alias("keys")) for k, c in enumerate(("keys", "edited_keys"))]
    sides = keyed.select("row", F.explode(F.array(*both)).alias("s")).select("row", "s.*")
    both = [F.struct((F.col("row") * 2 + k).alias("pair"), F.col("keys").alias("a"), F.col(c).alias("b")) for k, c in enumerate(("edited_keys", "next_keys"))]
    pairs = keyed.select(F.explode(F.array(*both)).alias("p")).select("p.*")
    apart_pairs = differences(pairs, 2 * n).select(F.shiftright("pair", 1).alias("row"), (F.col("pair") % 2).alias("side"), "found", "mark")
    by_row = lambda df, name, values: df.groupBy(F.col("row").alias(name)).agg(*[F.max(F.when(F.col("side") == k, F.col(v))).alias(f"{v}_{k}") for v in values for k in range(2)])
    marks = by_row(fingerprints(sides, 2 * n), "of_mark", ["fingerprint"])
    apart = by_row(apart_pairs, "of", ["found", "mark"])
    sizes = {f"total_{k}": F.size("keys") + F.size(other) for k, other in enumerate(("edited_keys", "next_keys"))}
    rows = keyed.select("row", "doc_id", "n_chars", "edited_sha256", *[c.alias(n) for n, c in sizes.items()])
    rows = rows.join(marks, F.col("row") == F.col("of_mark"), "left").join(apart, F.col("row") == F.col("of"), "left")
    found = [F.coalesce(f"found_{k}", F.lit(0)) for k in range(2)]
    near = [F.when(F.col(f"total_{k}") == 0, F.lit(1.0)).otherwise(1 - found[k] / F.col(f"total_{k}")) for k in range(2)]
    mark = [F.lower(F.hex(F.coalesce(f"mark_{k}", F.lit(0)))) for k in range(2)]
    text = [F.coalesce(f"fingerprint_{k}", F.lit("0:")) for k in range(2)]
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", text[0].alias("fingerprint"), text[1].alias("edited_fingerprint"), near[0].alias("near_edited"), near[1].alias("near_next"),
        found[0].cast("long").alias("differ_edited"), found[1].cast("long").alias("differ_next"), mark[0].alias("mark_edited"), mark[1].alias("mark_next"),
    )
