"""Markdown corpus, JSON index, and reports as columns and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Fixed format of the report.
REPORT = """# Summary Report

**Run Date:** {run_date}

---

## Per-Country Results

| Country        | Saved | Skipped (Dedup) | Errors |
|----------------|------:|----------------:|-------:|
{table}

---

## Totals

- **New Records Saved:** {saved}
- **Duplicates Skipped:** {skipped}
- **Errors:** {errors}"""


def markdown_block(title: Column, source: Column, url: Column, date: Column, scraped_at: Column, words: Column, unique_id: Column, body: Column) -> Column:
    """One article as Markdown. A null date is written N/A, an empty one stays empty."""
    line = lambda name, value: F.concat(F.lit(f"- **{name}:** "), value, F.lit("\n"))
    return F.concat(
        F.lit("### "), title, F.lit("\n\n"), line("Source", source), line("URL", url), line("Published Date", F.coalesce(date, F.lit("N/A"))), line("Scraped Date", F.substring(F.coalesce(scraped_at, F.lit("")), 1, 10)),
        line("Word Count", words.cast("string")), line("Unique ID", F.concat(F.lit("`"), F.coalesce(unique_id, F.lit("")), F.lit("`"))), F.lit("\n#### Content:\n\n"), body, F.lit("\n\n---\n\n"),
    )


def country_header(country: Column, updated: Column) -> Column:
    """The head of a country's file."""
    return F.concat(F.lit("# Country: "), country, F.lit("\n\n*Last updated: "), updated, F.lit("*\n\n---\n\n"))


def markdown_rows(articles: DataFrame) -> DataFrame:
    """country_code, ord, text of the headers (ord -1, the latest scrape) and blocks of articles."""
    latest = F.date_format(F.to_timestamp(F.max("scraped_at")), "yyyy-MM-dd HH:mm 'UTC'")
    heads = articles.groupBy("country_code").agg(F.min("country").alias("country"), latest.alias("updated")).select("country_code", F.lit(-1).cast("long").alias("ord"), country_header(F.col("country"), F.col("updated")).alias("text"))
    block = markdown_block(*[F.col(c) for c in ("title", "source", "url", "date", "scraped_at", "word_count", "unique_id", "body")])
    return heads.unionByName(articles.select("country_code", F.col("ord").cast("long").alias("ord"), block.alias("text")))


def write_markdown(articles: DataFrame, path: str) -> None:
    """Appends text files, by country, blocks in order within each file."""
    rows = markdown_rows(articles)
    # Every text ends with a line break, which the writer adds.
    lines = rows.repartitionByRange("country_code", "ord").sortWithinPartitions("country_code", "ord").select("country_code", F.regexp_replace("text", r"\n\z", "").alias("text"))
    lines.write.mode("append").partitionBy("country_code").text(path)


def sorted_index(index: DataFrame, order: str = "ord") -> DataFrame:
    """The index by country, latest date first as text, blank dates last, otherwise as it was."""
    return index.orderBy("country_code", F.coalesce("date", F.lit("")).desc(), order)


def write_index(index: DataFrame, path: str, order: str = "ord") -> None:
    sorted_index(index, order).drop(order).write.mode("overwrite").partitionBy("country_code").json(path)


def append_raw(articles: DataFrame, path: str) -> None:
    """Adds the articles to the raw backup."""
    articles.write.mode("append").partitionBy("country_code").json(path)


def summary_lines(stats: DataFrame) -> DataFrame:
    """line of the summary table: one row a country and one of totals, in order of `ord`."""
    row = lambda code, s: F.format_string("| %-14s | %5d | %15d | %6d |", F.upper(code), F.col(f"{s}saved"), F.col(f"{s}skipped"), F.col(f"{s}errors"))
    each = stats.select(F.col("country_code"), F.lit(0).alias("ord"), row(F.col("country_code"), "").alias("line"), (F.col("errors") > 0).alias("flag"))
    names = ["saved", "skipped", "errors"]
    total = stats.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).select(F.lit("TOTAL").alias("country_code"), F.lit(1).alias("ord"), row(F.lit("TOTAL"), "").alias("line"), (F.col("errors") > 0).alias("flag"))
    return each.unionByName(total)


def summary_report(stats: DataFrame, run_date: str) -> str:
    """The Markdown report. Its length is that of the list of countries."""
    lines = summary_lines(stats).orderBy("ord", "country_code").collect()
    saved, skipped, errors = (int(x) for x in lines[-1].line.strip("| ").split("|")[1:])
    return REPORT.format(run_date=run_date, table="\n".join(r.line for r in lines[:-1]), saved=saved, skipped=skipped, errors=errors)


def console_summary(stats: DataFrame, elapsed: float) -> str:
    """The summary as it is shown at the end of a run: the table, a mark at countries with errors, and the time."""
    lines = summary_lines(stats).orderBy("ord", "country_code").collect()
    return "\n".join([*(r.line + (" ⚠" if r.flag and r.ord == 0 else "") for r in lines), f"Elapsed: {elapsed:.0f}s"])
