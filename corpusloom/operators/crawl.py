"""What becomes of each candidate: limits, conditional fetches, decisions, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.schemas import MAX_ARTICLES

#: The outcomes in the order in which they are tested.
DECISIONS = ("off_domain", "not_modified", "fetch_error", "unchanged", "unparsable", "duplicate", "saved")
SKIPPED = ("off_domain", "not_modified", "unchanged", "unparsable", "duplicate")


def limit_per_source(rows: DataFrame, limit: int = MAX_ARTICLES, order: str = "ord") -> DataFrame:
    """The first `limit` rows of every source. It comes before the same-domain filter, so other domains use it up too."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy("source").orderBy(order))).where(F.col("_rank") <= limit).drop("_rank")


def with_checkpoints(rows: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """rows (source, url_key, ...) with saved_etag, saved_last_modified, saved_chash; '' where nothing is saved."""
    saved = checkpoints.select("source", "url_key", *[F.col(c).alias(f"saved_{c}") for c in ("etag", "last_modified", "chash")])
    return rows.join(saved, ["source", "url_key"], "left").fillna("", ["saved_etag", "saved_last_modified", "saved_chash"])


def fetch_outcome(status: Column, html: Column, same: Column, chash: Column, saved_chash: Column) -> Column:
    """The decision before a page is parsed; null for pages that go on."""
    return (
        F.when(~same, "off_domain")
        .when(status == 304, "not_modified")
        .when((F.coalesce(html, F.lit("")) == "") | (F.coalesce(status, F.lit(0)) != 200), "fetch_error")
        .when((chash == saved_chash) & (saved_chash != ""), "unchanged")
    )


def final_decision(early: Column, parsed: Column, known: Column) -> Column:
    return F.coalesce(early, F.when(~parsed, "unparsable").when(known, "duplicate").otherwise("saved"))


def run_stats(decided: DataFrame, key: str = "country_code") -> DataFrame:
    """saved, skipped and errors of every key; rows beyond the limit are not among the decided ones."""
    return decided.groupBy(key).agg(
        F.count_if(F.col("decision") == "saved").alias("saved"), F.count_if(F.col("decision").isin(*SKIPPED)).alias("skipped"), F.count_if(F.col("decision") == "fetch_error").alias("errors")
    )


def stats_with_empty_runs(stats: DataFrame, sites: DataFrame, known: DataFrame) -> DataFrame:
    """Statistics by source; a source without candidates counts its country's known pages as skipped."""
    size = known.groupBy("country_code").agg(F.count("*").alias("n_known"))
    every = sites.select(F.col("name").alias("source"), "country_code").join(stats, "source", "left").join(size, "country_code", "left")
    none = F.col("saved").isNull()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return every.select("source", "country_code", zero("saved").alias("saved"), F.when(none, zero("n_known")).otherwise(zero("skipped")).alias("skipped"), zero("errors").alias("errors"))


def stats_by_country(stats: DataFrame, mode: str = "last", order: str = "site_ord") -> DataFrame:
    """One row a country: the last source's figures (as the summary shows them), or with mode 'sum' all sources' together."""
    names = ["saved", "skipped", "errors"]
    if mode == "sum":
        return stats.groupBy("country_code").agg(*[F.sum(n).alias(n) for n in names])
    best = stats.groupBy("country_code").agg(F.max_by(F.struct(*names), order).alias("_s"))
    return best.select("country_code", *[F.col(f"_s.{n}").alias(n) for n in names])
