"""Incremental runs as a stream: landed responses are read once each, and every micro-batch is a run of its own.

The index is the stream's memory, since keys must never be forgotten; batches commit by id, so a replay changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.url import normalise_url
from corpusloom.plans.run import run_batch

LANDED = "source string, url string, html string, etag string, last_modified string, status int, ord long"


def start(spark: SparkSession, landed: str, root: str, sites: DataFrame, scraped_at: str, max_files: int = 100, on_stats: Callable[[int, DataFrame], None] | None = None):
    """A query over the Parquet files that arrive in `landed`, until none is left (availableNow)."""
    codes = sites.select(F.col("name").alias("source"), "country_code")

    def run(batch: DataFrame, batch_id: int) -> None:
        pages = batch.dropDuplicates(["source", "url", "ord"]).join(codes, "source")
        found = pages.select("source", "country_code", normalise_url(F.col("url")).alias("norm_url"), "url", F.lit("").alias("title"), F.lit("").alias("date"), "ord")
        first = found.groupBy("source", "norm_url").agg(F.min_by(F.struct("country_code", "url", "title", "date", "ord"), "ord").alias("f")).select("source", "norm_url", "f.*")
        answers = pages.groupBy("url").agg(F.max_by(F.struct("html", "etag", "last_modified", "status"), "ord").alias("r")).select("url", "r.*")
        stats = run_batch(batch.sparkSession, root, f"{batch_id:08d}", first, answers, sites, scraped_at)
        if on_stats is not None:
            on_stats(batch_id, stats)

    stream = spark.readStream.schema(LANDED).option("maxFilesPerTrigger", max_files).parquet(landed)
    return stream.writeStream.foreachBatch(run).option("checkpointLocation", f"{root}/stream").trigger(availableNow=True).start()
