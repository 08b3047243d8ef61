"""robots.txt rules as a join and one Arrow function."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.url import authority
from corpusloom.schemas import USER_AGENT


def robots_origin(url: Column) -> Column:
    """Where a URL's rules stand: its scheme and its host with www."""
    host = F.lower(authority(url))
    return F.concat(F.lower(F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*)://", 1)), F.lit("://"), F.when(host.startswith("www.") | (host == ""), host).otherwise(F.concat(F.lit("www."), host)))


@F.pandas_udf(T.BooleanType())
def _allowed(urls: pd.Series, rules: pd.Series) -> pd.Series:
    parsers: dict[str, RobotFileParser] = {}

    def one(url: str, text: str) -> bool:
        if text not in parsers:
            parsers[text] = RobotFileParser()
            parsers[text].parse(text.splitlines())
        return parsers[text].can_fetch(USER_AGENT, url)

    return pd.Series([None if t is None else one(u, t) for u, t in zip(urls, rules)], dtype=object)


_ROBOTS = "origin string, robots_txt string"


def read_robots(rows: DataFrame, getter: Callable, partitions: int = 64) -> DataFrame:
    """(origin, robots_txt) of the URLs' origins, each asked once. A refusal (401, 403) forbids everything, another client
    error permits everything, any other failure leaves a null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for origin in batch["origin"]:
                html, _, _, status = getter(f"{origin}/robots.txt")
                found.append(html or "" if status == 200 else "User-agent: *\nDisallow: /" if status in (401, 403) else "" if 400 <= status < 500 else None)
            yield pd.DataFrame({"origin": batch["origin"], "robots_txt": found})

    return rows.select(robots_origin(F.col("url")).alias("origin")).where("origin <> ''").distinct().repartition(partitions, "origin").mapInPandas(run, _ROBOTS)


def with_permission(rows: DataFrame, robots: DataFrame, on_error: str = "deny") -> DataFrame:
    """rows with `allowed`. robots: (origin, robots_txt), null text where it could not be read; then, and where nothing is
    known of an origin, on_error decides ('deny' or 'allow')."""
    keyed = rows.withColumn("origin", robots_origin(F.col("url"))).join(robots, "origin", "left")
    return keyed.withColumn("allowed", F.coalesce(_allowed(F.col("url"), F.col("robots_txt")), F.lit(on_error == "allow"))).drop("origin", "robots_txt")
