"""The reports over a lake's serving views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agoralake.config import (
    DAILY_COMMUNITIES,
    DATABASE,
    ENGAGEMENT_VIEW,
    QUERY_LIMIT,
    TOP_COMMENTED_VIEW,
    TOP_POSTS_VIEW,
)
from agoralake.operators import analytics as A


class Reports:
    """Lazy reports; community and date filters prune the gold tables below the views."""

    def __init__(self, spark: SparkSession, database: str = DATABASE):
        self._spark = spark
        self._database = database

    def _view(self, name: str) -> DataFrame:
        return self._spark.table(f"`{self._database}`.`{name}`")

    def engagement_by_date(
        self, subreddit: str | None = None, start_date: A.Day = None, end_date: A.Day = None
    ) -> DataFrame:
        metrics = self._view(ENGAGEMENT_VIEW)
        return A.engagement_by_date(metrics, subreddit, start_date, end_date)

    def top_posts(
        self,
        subreddit: str | None = None,
        start_date: A.Day = None,
        end_date: A.Day = None,
        limit: int = QUERY_LIMIT,
    ) -> DataFrame:
        return A.best_posts(self._view(TOP_POSTS_VIEW), subreddit, start_date, end_date, limit)

    def active_discussions(
        self,
        subreddit: str | None = None,
        start_date: A.Day = None,
        end_date: A.Day = None,
        limit: int = QUERY_LIMIT,
    ) -> DataFrame:
        posts = self._view(TOP_COMMENTED_VIEW)
        return A.active_discussions(posts, subreddit, start_date, end_date, limit)

    def length_vs_engagement(self, subreddit: str | None = None) -> DataFrame:
        tops = self._view(TOP_POSTS_VIEW), self._view(TOP_COMMENTED_VIEW)
        return A.length_vs_engagement(*tops, subreddit)

    def community(self, subreddit: str = DAILY_COMMUNITIES[0]) -> dict[str, DataFrame]:
        """All four reports of one community."""
        views = (ENGAGEMENT_VIEW, TOP_POSTS_VIEW, TOP_COMMENTED_VIEW)
        return A.community_report(*[self._view(v) for v in views], subreddit)

    def preview(self, subreddit: str = DAILY_COMMUNITIES[0]) -> dict[str, DataFrame]:
        """The same, cut to what is shown."""
        return A.preview(self.community(subreddit))
