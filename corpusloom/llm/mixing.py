"""Mixing sources to target weights by entropy balancing. DataFrame operations only.

Every source has a target number of words. Among all document rates between 0 and MAX_COPIES that give each source its
target, those nearest to 1 in entropy are exponential in the document's size, min(MAX_COPIES, exp(lambda x size / mean
size)). One lambda a source solves the convex dual; all are found together by safeguarded Newton steps over the counts of
(source, size). Rates become whole copies by rounding their running sums, largest documents first, in blocks of about
BLOCK rows, so a source of any size is dealt out over many tasks.

Nulls: a null text has size 0, a null source is a source of its own (the last one), null ids are rows like others. Rows of
size 0 count nothing and are copied once. Repeated rows are separate documents, which may get different copies. An empty
table gives an empty result. All sums that decide are in whole numbers, so reruns agree. The one table held in a single
task is the list of sources.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.session import cut

WORD = r"[^\x20\x09-\x0D]+"
MAX_COPIES = 3
BLOCK = 512
#: Newton steps at most, and the relative error in words at which they end.
STEPS = 40
ACCURACY = 1e-5
#: Fixed point of word sums and of rates.
WORDS_UNIT, RATE_UNIT = 1024, 1 << 20
#: Sources whose solution may be broadcast; beyond it the join is by shuffle.
BROADCAST_SOURCES = 100_000
FAR = 60.0


def size(text: str = "text") -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """sources (source, source_size, n_docs) with target: shares by weight 1, 2, 3, repeating in the order of sources,
    stopped at MAX_COPIES times the source's size, the excess shared again by weight."""
    everything = Window.partitionBy(F.lit(0))
    weighted = sources.withColumn("weight", (F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1)
    # Sources reach their limit in the order of limit / weight, as the level that all others share rises.
    limit = MAX_COPIES * F.col("source_size")
    order = everything.orderBy(F.col("limit_a_weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        weighted.withColumn("limit_a_weight", limit / F.col("weight"))
        .withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
        .withColumn("water", F.first(F.when(F.col("level") <= F.col("limit_a_weight"), F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    target = F.least(limit.cast("double"), F.col("water") * F.col("weight"))
    return levels.select("source", "source_size", "n_docs", F.coalesce(target, limit.cast("double")).alias("target"))


def _rate(lam: Column, doc_size: Column, mean: Column) -> Column:
    """min(MAX_COPIES, exp(lambda size / mean)); a null lambda is infinite."""
    return F.when(lam.isNull(), F.lit(float(MAX_COPIES))).otherwise(F.exp(F.least(lam * doc_size / mean, F.lit(math.log(MAX_COPIES)))))


def solve(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted with lambda a source. counts: (source, size, n). A source that needs all copies has a null lambda."""
    mean = F.greatest(F.col("source_size") / F.greatest(F.col("n_docs"), F.lit(1)), F.lit(1e-9))
    full = F.col("target") >= MAX_COPIES * F.col("source_size")
    less = F.col("target") < F.col("source_size")
    state = cut(
        wanted.withColumn("mean", mean)
        .withColumn("low", F.when(less, -FAR).otherwise(0.0))
        .withColumn("high", F.when(less, 0.0).otherwise(FAR))
        .withColumn("lam", F.when(full, F.lit(None).cast("double")).otherwise(F.log(F.greatest(F.col("target"), F.lit(1e-3)) / F.greatest(F.col("source_size"), F.lit(1)))))
    )
    names = ["source", "source_size", "n_docs", "target", "mean", "low", "high", "lam"]
    for _ in range(STEPS):
        open_ = state.where(F.col("lam").isNotNull())
        s, c = open_.alias("s"), counts.alias("c")
        rate = _rate(F.col("s.lam"), F.col("c.size"), F.col("s.mean"))
        words = F.col("c.n") * F.col("c.size") * rate
        slope = F.when(F.col("s.lam") * F.col("c.size") / F.col("s.mean") < math.log(MAX_COPIES), words * F.col("c.size") / F.col("s.mean")).otherwise(0.0)
        sums = (
            s.join(c, F.col("s.source").eqNullSafe(F.col("c.source")))
            .groupBy(*[F.col(f"s.{n}").alias(n) for n in names])
            .agg((F.sum(F.round(words * WORDS_UNIT).cast("long")) / WORDS_UNIT).alias("now"), (F.sum(F.round(slope * WORDS_UNIT).cast("long")) / WORDS_UNIT).alias("slope"))
        )
        over = F.col("now") - F.col("target")
        low = F.when(over <= 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(over >= 0, F.col("lam")).otherwise(F.col("high"))
        step = F.col("lam") - over / F.when(F.col("slope") > 0, F.col("slope"))
        near = F.abs(over) <= ACCURACY * F.greatest(F.col("target"), F.lit(1.0))
        next_lam = F.when(near, F.col("lam")).when((step > low) & (step < high), step).otherwise((low + high) / 2)
        moved = sums.select("source", "source_size", "n_docs", "target", "mean", low.alias("low"), high.alias("high"), next_lam.alias("lam"), near.alias("near"))
        state = cut(moved.unionByName(state.where(F.col("lam").isNull()).select(*names).withColumn("near", F.lit(True))))
        if state.where(~F.col("near")).isEmpty():
            break
        state = state.select(*names)
    return state.select("source", "source_size", "n_docs", "target", "mean", "lam")


def mixed(docs: DataFrame, columns: list[str], source: str = "source", text: str = "text") -> DataFrame:
    """Every row of docs: the named columns in a struct `doc`, its size, source_size, target and number of copies."""
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.col(source).cast("string").alias("source"), size(text).alias("size"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("at")
    )
    counts = cut(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    sources = cut(targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))))
    solution = solve(counts, sources)
    if sources.count() <= BROADCAST_SOURCES:
        solution = F.broadcast(solution)
    rate = F.round(_rate(F.col("lam"), F.col("size"), F.col("mean")) * RATE_UNIT).cast("long")
    rows = sized.alias("d").join(solution.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select("doc", "at", "d.source", "size", "source_size", "target", "n_docs", rate.alias("rate"))
    block = F.pmod(F.xxhash64("at", F.lit(1)), F.greatest(F.lit(1), F.floor(F.col("n_docs") / BLOCK)))
    upto = F.sum("rate").over(Window.partitionBy("source", "block").orderBy(F.desc("size"), "at").rowsBetween(Window.unboundedPreceding, 0))
    summed = rows.withColumn("block", block).withColumn("upto", upto + RATE_UNIT // 2)
    copies = F.floor(F.col("upto") / RATE_UNIT) - F.floor((F.col("upto") - F.col("rate")) / RATE_UNIT)
    return summed.select("doc", "size", "source_size", "target", copies.cast("long").alias("copies"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every document."""
    rows = mixed(docs.select("doc_id", "source", "text"), ["doc_id"])
    return rows.select(F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def drawn(docs: DataFrame) -> DataFrame:
    """The rows of docs with their columns, each as often as the mix takes it."""
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mixed(docs, docs.columns).where(F.col("copies") > 0).select("doc", times).select("doc.*")
