"""The four parameterised reports, over the serving views' DataFrames.

They read gold, so a filter selects among the kept top rows; it does not rank anew.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agoralake.config import PREVIEW_LIMIT, QUERY_LIMIT
from agoralake.functions import pearson, post_filter

Day = date | str | None

# Result columns of the reports.
POST_COLUMNS = (
    "id",
    "title",
    "score",
    "num_comments",
    "author",
    "date",
    "upvote_ratio",
    "url",
    "subreddit",
)
PREVIEW_COLUMNS = ("title", "score", "num_comments", "author")

# What the analysis of lengths reads of the two post lists.
LENGTH_COLUMNS = (
    "title_length",
    "selftext_length",
    "score",
    "num_comments",
    "upvote_ratio",
    "subreddit",
)


def engagement_metrics(daily: DataFrame) -> DataFrame:
    """The engagement view: daily statistics under their serving names."""
    return daily.select(
        "date",
        "subreddit",
        F.col("id_count").alias("post_count"),
        F.col("score_mean").alias("avg_score"),
        F.col("score_sum").alias("total_score"),
        F.col("num_comments_mean").alias("avg_comments"),
        F.col("num_comments_sum").alias("total_comments"),
        F.col("upvote_ratio_mean").alias("avg_upvote_ratio"),
    )


def engagement_by_date(
    metrics: DataFrame, subreddit: str | None = None, start_date: Day = None, end_date: Day = None
) -> DataFrame:
    """Engagement per day and community, newest day first."""
    return metrics.where(post_filter(subreddit, start_date, end_date)).orderBy(
        F.desc("date"), F.asc_nulls_last("subreddit")
    )


def _best(
    posts: DataFrame, metric: str, subreddit: str | None, start: Day, end: Day, limit: int
) -> DataFrame:
    return (
        posts.where(post_filter(subreddit, start, end))
        .select(*POST_COLUMNS)
        .orderBy(F.desc_nulls_last(metric), F.asc_nulls_last("id"))
        .limit(limit)
    )


def best_posts(
    top_posts: DataFrame,
    subreddit: str | None = None,
    start_date: Day = None,
    end_date: Day = None,
    limit: int = QUERY_LIMIT,
) -> DataFrame:
    """The `limit` best scored posts among the kept top posts."""
    return _best(top_posts, "score", subreddit, start_date, end_date, limit)


def active_discussions(
    top_commented: DataFrame,
    subreddit: str | None = None,
    start_date: Day = None,
    end_date: Day = None,
    limit: int = QUERY_LIMIT,
) -> DataFrame:
    """The `limit` most commented posts among the kept top discussions."""
    return _best(top_commented, "num_comments", subreddit, start_date, end_date, limit)


def length_vs_engagement(
    top_posts: DataFrame, top_commented: DataFrame, subreddit: str | None = None
) -> DataFrame:
    """Mean lengths and engagement per community and how they correlate.

    A post in both lists counts twice.
    """
    both = top_posts.select(*LENGTH_COLUMNS).unionByName(top_commented.select(*LENGTH_COLUMNS))
    return (
        both.where(post_filter(subreddit))
        .groupBy("subreddit")
        .agg(
            F.avg("title_length").alias("avg_title_length"),
            F.avg("selftext_length").alias("avg_selftext_length"),
            F.avg("score").alias("avg_score"),
            F.avg("num_comments").alias("avg_comments"),
            F.avg("upvote_ratio").alias("avg_upvote_ratio"),
            pearson("title_length", "score").alias("title_score_correlation"),
            pearson("selftext_length", "score").alias("content_score_correlation"),
            pearson("title_length", "num_comments").alias("title_comments_correlation"),
            pearson("selftext_length", "num_comments").alias("content_comments_correlation"),
        )
        .orderBy(F.desc_nulls_last("avg_score"), F.asc_nulls_last("subreddit"))
    )


def community_report(
    metrics: DataFrame, top_posts: DataFrame, top_commented: DataFrame, subreddit: str
) -> dict[str, DataFrame]:
    """All four reports of one community, lazily."""
    return {
        "engagement": engagement_by_date(metrics, subreddit),
        "top_posts": best_posts(top_posts, subreddit, limit=PREVIEW_LIMIT),
        "discussions": active_discussions(top_commented, subreddit, limit=PREVIEW_LIMIT),
        "analysis": length_vs_engagement(top_posts, top_commented, subreddit),
    }


def preview(report: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What is shown of a community report: five rows, and of the post lists four columns."""
    return {
        "engagement": report["engagement"].limit(PREVIEW_LIMIT),
        "top_posts": report["top_posts"].select(*PREVIEW_COLUMNS).limit(PREVIEW_LIMIT),
        "discussions": report["discussions"].select(*PREVIEW_COLUMNS).limit(PREVIEW_LIMIT),
        "analysis": report["analysis"],
    }
