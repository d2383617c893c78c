from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agoralake.schemas import LISTING


def read_listing(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Raw listing records as a collector leaves them: one per line or row, at any folder depth."""
    reader = spark.read.schema(LISTING).option("recursiveFileLookup", True)
    return reader.format(fmt).load(path)
