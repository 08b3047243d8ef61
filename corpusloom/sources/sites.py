"""Site catalog."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.schemas import SITES
from corpusloom.session import exists


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """The catalog with site_ord, its place in the file. A missing file gives no rows and a warning; a file that can't be read
    is an error. A missing pagination stays null."""
    if not exists(spark, path):
        logging.getLogger("corpusloom").warning("no site catalog at %s", path)
        return spark.createDataFrame([], SITES).withColumn("site_ord", F.lit(0).cast("long"))
    rows = spark.read.schema(SITES).option("multiLine", True).json(path)
    return rows.withColumn("site_ord", F.monotonically_increasing_id())
