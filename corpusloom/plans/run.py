"""One incremental run over recorded or live responses, from candidates to committed state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.article import parse_article
from corpusloom.functions.dates import normalise_date
from corpusloom.functions.text import content_hash, detect_lang, translate, unique_id, word_count
from corpusloom.functions.url import same_domain
from corpusloom.operators import crawl, state
from corpusloom.schemas import ARTICLE, CHECKPOINT, INDEX, MIN_BODY, TITLE_LENGTH
from corpusloom.session import stored


def decide(candidates: DataFrame, responses: DataFrame, sites: DataFrame, checkpoints: DataFrame, index: DataFrame, scraped_at: str, limit: int | None = None, translator: Callable[[str], str] | None = None) -> DataFrame:
    """Every candidate (source, country_code, norm_url, url, title, date, ord) with its decision and, if parsed, its article.

    Pages are parsed only if nothing earlier decides about them."""
    rows = crawl.limit_per_source(candidates, limit) if limit else candidates
    about = sites.select(F.col("name").alias("source"), "country", "base_url", "extra_domains", "selectors")
    rows = rows.join(about, "source").withColumn("url_key", unique_id(F.col("norm_url")))
    rows = crawl.with_checkpoints(rows, checkpoints).join(responses, "url", "left").withColumn("chash", content_hash(F.col("html")))
    early = crawl.fetch_outcome(F.col("status"), F.col("html"), same_domain(F.col("url"), F.col("base_url"), F.col("extra_domains")), F.col("chash"), F.col("saved_chash"))
    rows = rows.withColumn("early", early)
    wanted = F.when(F.col("early").isNull(), F.col("html"))
    rows = rows.withColumn("article", parse_article(wanted, F.col("url"), F.struct(*[F.col(f"selectors.{k}").alias(k) for k in ("title", "date", "date_attr", "body")]), F.col("title"), F.col("date")))
    known = index.select("country_code", "norm_url").distinct().withColumn("known", F.lit(True))
    rows = rows.join(known, ["country_code", "norm_url"], "left")
    parsed = F.col("early").isNull() & (F.length(F.coalesce("article.body", F.lit(""))) >= MIN_BODY)
    decided = rows.withColumn("decision", crawl.final_decision(F.col("early"), parsed, F.coalesce("known", F.lit(False))))
    title, body = F.substring("article.title", 1, TITLE_LENGTH), F.col("article.body")
    if translator is not None:
        title, body = translate(title, detect_lang(title), translator), translate(body, detect_lang(body), translator)
    return decided.select(
        "source", "country_code", "country", "norm_url", "url", "url_key", "ord", "decision", "etag", "last_modified", "chash", title.alias("title"), normalise_date(F.col("article.date_raw")).alias("date"), body.alias("body"),
        F.lit(scraped_at).alias("scraped_at"), word_count(body).alias("word_count"), unique_id(F.col("url")).alias("unique_id"),
    )


def run_batch(spark: SparkSession, root: str, batch_id: str, candidates: DataFrame, responses: DataFrame, sites: DataFrame, scraped_at: str, limit: int | None = None, translator: Callable[[str], str] | None = None, by: str = "country_code", index: DataFrame | None = None) -> DataFrame:
    """Runs a batch against the state under root, commits it once, and returns its statistics by country (or by source)."""
    index = state.read_state(spark, root, "index", INDEX) if index is None else index
    past = state.read_state(spark, root, "checkpoints", f"{CHECKPOINT}, batch string")
    checkpoints = latest_checkpoints(past)
    fresh = candidates.join(index.select("country_code", "norm_url").distinct(), ["country_code", "norm_url"], "left_anti")
    # A table in the shared folder: a lost executor costs no second parsing.
    decided = stored(decide(fresh, responses, sites, checkpoints, index, scraped_at, limit, translator))
    saved = decided.where("decision = 'saved'")
    # Two sources of one country may find the same page: its first candidate is saved.
    saved = saved.withColumn("_o", F.struct("ord", "source"))
    saved = saved.groupBy("country_code", "norm_url").agg(F.min_by(F.struct(*[c for c in saved.columns if c not in ("country_code", "norm_url", "_o")]), "_o").alias("s")).select("country_code", "norm_url", "s.*")
    columns = [x.split()[0] for x in ARTICLE.split(", ")]
    merged = state.merged_checkpoints(checkpoints.limit(0), decided).withColumn("batch", F.lit(batch_id))
    state.commit_batch(spark, root, batch_id, {"articles": saved.select(*columns), "index": state.new_records(saved, index), "checkpoints": merged, "raw": decided.where("decision in ('saved', 'duplicate')").select(*columns)})
    return spark.createDataFrame(crawl.run_stats(decided, by).collect(), f"{by} string, saved long, skipped long, errors long")


def latest_checkpoints(past: DataFrame) -> DataFrame:
    """Each key's newest non-empty values over all batches."""
    pick = lambda c: F.coalesce(F.max_by(F.when(F.col(c) != "", F.col(c)), F.when(F.col(c) != "", F.col("batch"))), F.lit("")).alias(c)
    return past.groupBy("source", "url_key").agg(pick("etag"), pick("last_modified"), pick("chash"))
