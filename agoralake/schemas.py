"""Explicit schemas of every layer; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# One raw listing record, before the per-community bound. Score and text may be missing.
LISTING = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("num_comments", T.LongType()),
        T.StructField("created_utc", T.DoubleType()),
        T.StructField("selftext", T.StringType()),
        T.StructField("upvote_ratio", T.DoubleType()),
        T.StructField("url", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("is_original_content", T.BooleanType()),
        T.StructField("is_self", T.BooleanType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("listing_rank", T.LongType()),
    ]
)

# The twelve fields of a stored post.
POST = T.StructType(
    [f for f in LISTING.fields if f.name not in ("subreddit", "source", "listing_rank")]
    + [T.StructField("extracted_at", T.StringType())]
)

ENVELOPE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("extracted_at", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("posts", T.ArrayType(POST)),
    ]
)

# Column order of the cleaned posts; subreddit and run_ts are carried along.
SILVER = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("num_comments", T.LongType()),
        T.StructField("selftext", T.StringType()),
        T.StructField("upvote_ratio", T.DoubleType()),
        T.StructField("url", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("is_original_content", T.BooleanType()),
        T.StructField("is_self", T.BooleanType()),
        T.StructField("extracted_at", T.TimestampNTZType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("date", T.DateType()),
        T.StructField("title_length", T.LongType()),
        T.StructField("selftext_length", T.LongType()),
        T.StructField("has_selftext", T.BooleanType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("run_ts", T.TimestampNTZType()),
    ]
)

DAILY_STATS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("id_count", T.LongType()),
        T.StructField("score_mean", T.DoubleType()),
        T.StructField("score_max", T.LongType()),
        T.StructField("score_sum", T.LongType()),
        T.StructField("num_comments_mean", T.DoubleType()),
        T.StructField("num_comments_max", T.LongType()),
        T.StructField("num_comments_sum", T.LongType()),
        T.StructField("title_length_mean", T.DoubleType()),
        T.StructField("selftext_length_mean", T.DoubleType()),
        T.StructField("upvote_ratio_mean", T.DoubleType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("run_ts", T.TimestampNTZType()),
    ]
)

# What a stream keeps per batch to build daily statistics from.
DAILY_PARTIALS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("id_count", T.LongType()),
        T.StructField("score_max", T.LongType()),
        T.StructField("num_comments_max", T.LongType()),
        T.StructField("score_sum", T.LongType()),
        T.StructField("num_comments_sum", T.LongType()),
        T.StructField("title_length_sum", T.LongType()),
        T.StructField("selftext_length_sum", T.LongType()),
        T.StructField("upvote_ratio_sum", T.DoubleType()),
        T.StructField("score_count", T.LongType()),
        T.StructField("num_comments_count", T.LongType()),
        T.StructField("title_length_count", T.LongType()),
        T.StructField("selftext_length_count", T.LongType()),
        T.StructField("upvote_ratio_count", T.LongType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("run_ts", T.TimestampNTZType()),
    ]
)

# Fixed values, like POST and SILVER: the column lists of the tables above and below.
GOLD = {"daily_stats": DAILY_STATS, "top_posts": SILVER, "top_commented": SILVER}

BRONZE_POSTS_TABLE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("author", T.StringType()),
        T.StructField("created_utc", T.LongType()),
        T.StructField("num_comments", T.LongType()),
        T.StructField("permalink", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("selftext", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("ingestion_date", T.StringType()),
    ]
)

SILVER_POSTS_TABLE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("author", T.StringType()),
        T.StructField("created_date", T.DateType()),
        T.StructField("num_comments", T.LongType()),
        T.StructField("permalink", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("selftext", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("cleaned_text", T.StringType()),
        T.StructField("post_length", T.LongType()),
        T.StructField("ingestion_date", T.DateType()),
    ]
)

SUBREDDIT_STATS_TABLE = T.StructType(
    [
        T.StructField("subreddit", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("post_count", T.LongType()),
        T.StructField("avg_score", T.DoubleType()),
        T.StructField("total_comments", T.LongType()),
        T.StructField("avg_post_length", T.DoubleType()),
    ]
)

# Hive-style partition columns of the stored layers. The run comes first: one run is one prefix,
# so loading it lists nothing else, however many runs and communities the lake holds.
BRONZE_PARTITIONS = ("run_date", "run_hour", "run_id", "community")
RUN_PARTITIONS = ("run_date", "run_id", "subreddit")

PARTITION_TYPES = {
    "community": T.StringType(),
    "subreddit": T.StringType(),
    "run_date": T.DateType(),
    "run_hour": T.StringType(),
    "run_id": T.StringType(),
}


def with_partitions(schema: T.StructType, partitions: tuple[str, ...]) -> T.StructType:
    """`schema` with the partition columns moved to the end, as a partitioned scan returns them."""
    body = [f for f in schema.fields if f.name not in partitions]
    return T.StructType(body + [T.StructField(p, PARTITION_TYPES[p]) for p in partitions])
