"""Clean posts to the three gold datasets, for every run and community at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agoralake.config import TOP_K
from agoralake.operators.topk import top_k_per_group
from agoralake.schemas import DAILY_PARTIALS, DAILY_STATS, SUBREDDIT_STATS_TABLE

RUN_KEYS = ("run_ts", "subreddit")
AVERAGED = ("score", "num_comments", "title_length", "selftext_length", "upvote_ratio")


def daily_stats(silver: DataFrame) -> DataFrame:
    """Counts, means, maxima and sums per run, community and day; posts without a day are left out.

    Fixed-width buffers only: the map side combines in a hash table, so a hot community reaches the
    shuffle as one row per task and day.
    """

    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0))

    return (
        silver.where(F.col("date").isNotNull())
        .groupBy(*RUN_KEYS, "date")
        .agg(
            F.count("id").alias("id_count"),
            F.avg("score").alias("score_mean"),
            F.max("score").alias("score_max"),
            total("score").alias("score_sum"),
            F.avg("num_comments").alias("num_comments_mean"),
            F.max("num_comments").alias("num_comments_max"),
            total("num_comments").alias("num_comments_sum"),
            F.avg("title_length").alias("title_length_mean"),
            F.avg("selftext_length").alias("selftext_length_mean"),
            F.avg("upvote_ratio").alias("upvote_ratio_mean"),
        )
        .select(*DAILY_STATS.fieldNames())
    )


def daily_partials(silver: DataFrame) -> DataFrame:
    """Daily statistics of a part of the posts, in a form that merges with other parts."""
    sums = [F.sum(m).alias(f"{m}_sum") for m in AVERAGED]
    counts = [F.count(m).alias(f"{m}_count") for m in AVERAGED]
    return (
        silver.where(F.col("date").isNotNull())
        .groupBy(*RUN_KEYS, "date")
        .agg(
            F.count("id").alias("id_count"),
            F.max("score").alias("score_max"),
            F.max("num_comments").alias("num_comments_max"),
            *sums,
            *counts,
        )
        .select(*DAILY_PARTIALS.fieldNames())
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """Daily statistics out of the partial ones of all parts."""
    means = [
        F.try_divide(F.sum(f"{m}_sum"), F.sum(f"{m}_count")).alias(f"{m}_mean") for m in AVERAGED
    ]
    sums = [
        F.coalesce(F.sum(f"{m}_sum"), F.lit(0)).alias(f"{m}_sum") for m in ("score", "num_comments")
    ]
    return (
        partials.groupBy(*RUN_KEYS, "date")
        .agg(
            F.sum("id_count").alias("id_count"),
            F.max("score_max").alias("score_max"),
            F.max("num_comments_max").alias("num_comments_max"),
            *means,
            *sums,
        )
        .select(*DAILY_STATS.fieldNames())
    )


def finish_partials(merged: DataFrame) -> DataFrame:
    """Daily statistics out of partial ones that are merged already, a row a run, community and day."""
    means = [F.try_divide(f"{m}_sum", f"{m}_count").alias(f"{m}_mean") for m in AVERAGED]
    sums = [F.coalesce(f"{m}_sum", F.lit(0)).alias(f"{m}_sum") for m in ("score", "num_comments")]
    kept = (*RUN_KEYS, "date", "id_count", "score_max", "num_comments_max")
    return merged.select(*kept, *means, *sums).select(*DAILY_STATS.fieldNames())


def top_posts(silver: DataFrame, k: int = TOP_K) -> DataFrame:
    """The `k` best scored posts of every run and community, ties by id."""
    return _top(silver, "score", k)


def top_commented(silver: DataFrame, k: int = TOP_K) -> DataFrame:
    """The `k` most discussed posts of every run and community, ties by id."""
    return _top(silver, "num_comments", k)


def _top(silver: DataFrame, metric: str, k: int) -> DataFrame:
    return top_k_per_group(silver, RUN_KEYS, [F.desc_nulls_last(metric), F.asc_nulls_last("id")], k)


def subreddit_stats(daily: DataFrame, *extra: str) -> DataFrame:
    """Daily statistics as the catalogue's short table has them, with any `extra` columns after."""
    return daily.select(
        "subreddit",
        "date",
        F.col("id_count").alias("post_count"),
        F.col("score_mean").alias("avg_score"),
        F.col("num_comments_sum").alias("total_comments"),
        F.col("selftext_length_mean").alias("avg_post_length"),
        *extra,
    ).select(*SUBREDDIT_STATS_TABLE.fieldNames(), *extra)
