from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from agoralake.config import DATABASE


def query_to_dataframe(
    spark: SparkSession,
    query: str,
    database: str = DATABASE,
    args: dict[str, Any] | None = None,
) -> DataFrame:
    """A query whose unqualified names are looked up in `database`, after temporary views.

    Values go in as named arguments (`:name`), never as text. The result stays a lazy DataFrame.
    """
    current = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(f"`{database}`")
    try:
        return spark.sql(query, args=args)
    finally:
        spark.catalog.setCurrentDatabase(f"`{current}`")
