"""Incremental state: the index of saved articles, checkpoints, and the commit of a batch."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import content_hash
from corpusloom.functions.url import normalise_url
from corpusloom.operators.discover import last_wins
from corpusloom.schemas import CHECKPOINT
from corpusloom.session import exists


def usable_index(records: DataFrame, corpora: DataFrame, exact: bool = True) -> DataFrame:
    """The index keyed by (country_code, norm_url): records without URL go, the last of a key counts, and a country whose
    corpus is gone has no index. corpora: (country_code)."""
    kept = records.where(F.coalesce("url", F.lit("")) != "").join(corpora.select("country_code").distinct(), "country_code", "left_semi")
    keyed = kept.withColumn("norm_url", normalise_url(F.col("url"), exact))
    return last_wins(keyed, ["country_code", "norm_url"])


def rebuild(index: DataFrame, checkpoints: DataFrame, countries: list[str], sites: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Index and checkpoints without the named countries, so that a lost corpus comes back whole on the next run."""
    sources = sites.where(F.col("country_code").isin(countries)).select(F.col("name").alias("source"))
    return index.where(~F.col("country_code").isin(countries)), checkpoints.join(sources, "source", "left_anti")


def new_records(articles: DataFrame, index: DataFrame) -> DataFrame:
    """The articles whose key the index lacks, as index records. Existing records never change."""
    fresh = articles.join(index.select("country_code", "norm_url"), ["country_code", "norm_url"], "left_anti")
    return fresh.select("country_code", "norm_url", "url", "title", "date", "source", "scraped_at", content_hash(F.col("body")).alias("content_hash"), "unique_id")


def upserted(articles: DataFrame, index: DataFrame) -> DataFrame:
    """The index with the articles that it lacked."""
    fresh = new_records(articles, index)
    return index.select(*fresh.columns).unionByName(fresh)


def merged_checkpoints(old: DataFrame, decided: DataFrame) -> DataFrame:
    """Checkpoints after a run. decided: (source, url_key, etag, last_modified, chash, decision).

    Validators are taken over where present, for unchanged pages and for all that were parsed or failed to; the content hash
    only for the latter. Pages that were not fetched keep what they had."""
    fetched = decided.where(F.col("decision").isin("unchanged", "unparsable", "duplicate", "saved"))
    blank = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c))
    new = fetched.select("source", "url_key", blank("etag").alias("new_etag"), blank("last_modified").alias("new_last_modified"), F.when(F.col("decision") != "unchanged", F.col("chash")).alias("new_chash"))
    pick = lambda c: F.coalesce(f"new_{c}", c, F.lit("")).alias(c)
    return old.join(new, ["source", "url_key"], "full_outer").select("source", "url_key", pick("etag"), pick("last_modified"), pick("chash"))


def read_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """The stored checkpoints, or none (with a warning) where there are none. A storage fault is an error."""
    if not exists(spark, path):
        logging.getLogger("corpusloom").warning("no checkpoints at %s", path)
        return spark.createDataFrame([], CHECKPOINT)
    return spark.read.schema(CHECKPOINT).parquet(path)


def read_state(spark: SparkSession, root: str, name: str, ddl: str) -> DataFrame:
    """All committed batches of a state table; a batch counts once its marker is there."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(conf)
    markers = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/committed/*")) or []
    batches = sorted(m.getPath().getName() for m in markers)
    paths = [p for b in batches if fs.exists(jvm.org.apache.hadoop.fs.Path(p := f"{root}/{name}/batch_id={b}"))]
    return spark.read.schema(ddl).parquet(*paths) if paths else spark.createDataFrame([], ddl)


def commit_batch(spark: SparkSession, root: str, batch_id: str, tables: dict[str, DataFrame]) -> bool:
    """Writes the tables of a batch and then its marker, so that a batch counts wholly or not at all. A batch that is
    committed already is left alone; one that broke off is written anew."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    marker = jvm.org.apache.hadoop.fs.Path(f"{root}/committed/{batch_id}")
    fs = marker.getFileSystem(conf)
    if fs.exists(marker):
        return False
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")
    fs.create(marker).close()
    return True


def duplicate_bodies(index: DataFrame) -> DataFrame:
    """content_hash, n, first_url of bodies that stand under several URLs: a report only, nothing is removed."""
    return index.groupBy("content_hash").agg(F.count("*").alias("n"), F.min("url").alias("first_url")).where("n > 1")
