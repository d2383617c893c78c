"""Where a lake lives and the fixed names other tools rely on."""

from __future__ import annotations

from dataclasses import dataclass

# Names users of the tables and views already query.
SOURCE = "reddit"
DATABASE = "reddit_analytics"
AGGREGATES = "reddit_aggregates"
ENGAGEMENT_VIEW = "reddit_engagement_metrics"
TOP_POSTS_VIEW = "reddit_top_posts"
TOP_COMMENTED_VIEW = "reddit_top_commented"
DAILY_COMMUNITIES = ("datascience", "machinelearning", "python")

# Sizes of the reports and of one listing.
POST_LIMIT = 100
TOP_K = 20
QUERY_LIMIT = 10
PREVIEW_LIMIT = 5

# A document holds at most so many posts, and its texts no more bytes than this and one post.
MAX_POSTS_PER_DOCUMENT = 1000
MAX_TEXT_PER_DOCUMENT = 8 * 1024 * 1024
# A community with this many full documents for each task is folded where its posts lie.
FULL_PER_TASK = 2
# Most bytes of text that a task holds of documents it has not filled yet.
MAX_TEXT_PER_TASK = 256 * 1024 * 1024
# Groups of rows that are stored without a shuffle, at most; others are shuffled.
LARGE_GROUPS = 1000
# Rows of a community for each task from which silver is written where it lies.
SILVER_ROWS_PER_TASK = 500
# Documents of a compressed file, which one task reads as a whole.
DOCUMENTS_PER_FILE = 64
# Listing bound from which top lists are cut from a shortlist of a run's posts.
SHORTLIST_ABOVE = 1000
# Fan-out of one hot group in the first step of a top-k.
TOP_K_SALTS = 256
# A listing bound above this is cut by ranges of places, not by sorting a community's first records.
SORTED_LIMIT = 10_000
# Ranges that a community's places are cut into, and how often the range of the bound is cut again.
PLACE_RANGES = 4096
PLACE_ROUNDS = 2

GOLD_DATASETS = ("daily_stats", "top_posts", "top_commented")


@dataclass(frozen=True)
class Lake:
    """A base URI on any Hadoop filesystem plus the database that serves it."""

    base: str
    database: str = DATABASE

    @property
    def bronze(self) -> str:
        return f"{self.base}/bronze/{SOURCE}"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver/{SOURCE}"

    @property
    def quarantine(self) -> str:
        return f"{self.base}/quarantine"

    def gold(self, dataset: str) -> str:
        return f"{self.base}/gold/{AGGREGATES}/{dataset}"

    def table(self, name: str) -> str:
        return f"{self.base}/tables/{name}"

    def checkpoint(self, stream: str) -> str:
        return f"{self.base}/checkpoints/{stream}"
