"""python -m corpusloom --sites sites.json --state DIR --out DIR: one run over the catalog's live sites."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from corpusloom.log import get_logger
from corpusloom.plans.full import run_all
from corpusloom.sources import http, robots
from corpusloom.sources.sites import read_sites


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="corpusloom", description=__doc__)
    parser.add_argument("--sites", required=True, help="JSON catalog of sites")
    parser.add_argument("--state", required=True, help="folder of index, checkpoints and batches")
    parser.add_argument("--out", required=True, help="folder of Markdown, index and raw backup")
    parser.add_argument("--limit", type=int, help="articles a source at most")
    parser.add_argument("--archive-site", default="", help="site whose monthly archives are read")
    parser.add_argument("--sum", action="store_true", help="add up the figures of a country's sources")
    parser.add_argument("--log", help="log file")
    a = parser.parse_args(arguments)
    get_logger(path=a.log)
    spark = SparkSession.builder.appName("corpusloom").getOrCreate()
    now = datetime.now(timezone.utc)
    sites = read_sites(spark, a.sites)
    if sites.isEmpty():
        return
    run_all(
        spark, a.state, a.out, now.strftime("%Y%m%dT%H%M%S"), sites, http.fetch, now.isoformat(timespec="seconds"), robots=lambda rows: robots.read_robots(rows, http.get),
        mode="sum" if a.sum else "last", limit=a.limit, archive_site=a.archive_site,
    )


if __name__ == "__main__":
    main()
