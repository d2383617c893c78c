"""Projections behind the catalogue's post tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agoralake.functions import iso_to_timestamp
from agoralake.schemas import BRONZE_POSTS_TABLE, SILVER_POSTS_TABLE


def _permalink(df: DataFrame):
    present = "permalink" in df.columns
    return (F.col("permalink") if present else F.lit(None)).cast("string").alias("permalink")


def bronze_posts(posts: DataFrame, *extra: str) -> DataFrame:
    """Unnested bronze posts as the bronze table shows them, with any `extra` columns after."""
    day = iso_to_timestamp(F.col("extracted_at")).cast("date").cast("string")
    return posts.select(
        "id",
        "title",
        "score",
        "author",
        F.col("created_utc").try_cast("bigint").alias("created_utc"),
        "num_comments",
        _permalink(posts),
        "url",
        "selftext",
        "subreddit",
        day.alias("ingestion_date"),
        *extra,
    ).select(*BRONZE_POSTS_TABLE.fieldNames(), *extra)


def silver_posts(silver: DataFrame, *extra: str) -> DataFrame:
    """Clean posts as the silver table shows them, with any `extra` columns after."""
    return silver.select(
        "id",
        "title",
        "score",
        "author",
        F.col("date").alias("created_date"),
        "num_comments",
        _permalink(silver),
        "url",
        "selftext",
        "subreddit",
        F.col("selftext").alias("cleaned_text"),
        F.col("selftext_length").alias("post_length"),
        F.to_date("extracted_at").alias("ingestion_date"),
        *extra,
    ).select(*SILVER_POSTS_TABLE.fieldNames(), *extra)
