"""Bronze documents to clean posts: projections only, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agoralake.functions import epoch_to_timestamp, iso_to_timestamp, strip, text_length
from agoralake.schemas import SILVER


def unnest_posts(documents: DataFrame) -> DataFrame:
    """One row per post with its document's source, community and run time."""
    return documents.select(
        "source",
        "subreddit",
        iso_to_timestamp(F.col("extracted_at")).alias("run_ts"),
        F.inline("posts"),
    )


def clean_posts(posts: DataFrame) -> DataFrame:
    """Typed times, stripped text, filled gaps and length features, in silver column order.

    `posts` are unnested bronze posts: the twelve stored fields, subreddit and run_ts.
    """
    typed = posts.select(
        "id",
        strip("title").alias("title"),
        "score",
        "num_comments",
        F.coalesce(strip("selftext"), F.lit("")).alias("selftext"),
        "upvote_ratio",
        "url",
        F.coalesce("author", F.lit("deleted")).alias("author"),
        "is_original_content",
        "is_self",
        iso_to_timestamp(F.col("extracted_at")).alias("extracted_at"),
        epoch_to_timestamp(F.col("created_utc")).alias("created_at"),
        "subreddit",
        "run_ts",
    )
    return (
        typed.withColumn("date", F.to_date("created_at"))
        .withColumn("title_length", text_length(F.col("title")))
        .withColumn("selftext_length", text_length(F.col("selftext")))
        .withColumn("has_selftext", F.col("selftext_length") > 0)
        .select(*SILVER.fieldNames())
    )


def bad_posts(posts: DataFrame) -> DataFrame:
    """Unnested posts with a value that was lost: a time that does not parse, or a misfit.

    Silver keeps them with NULL in its place; this is the list to repair them from.
    """
    return posts.where(is_bad_post(posts))


def is_bad_post(posts: DataFrame) -> Column:
    text = F.col("extracted_at")
    untimed = text.isNotNull() & iso_to_timestamp(text).isNull()
    return untimed | F.coalesce("misfit", F.lit(False)) if "misfit" in posts.columns else untimed
