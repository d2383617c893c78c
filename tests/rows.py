"""Hand-made posts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import types as T

from agoralake.schemas import ENVELOPE, LISTING, POST

RUN = datetime(2024, 1, 31, 2)
NOON = 1704110400.0  # 2024-01-01 12:00:00

POSTS = T.StructType(
    POST.fields
    + [T.StructField("subreddit", T.StringType()), T.StructField("run_ts", T.TimestampNTZType())]
)


def post(id="a", **fields):
    base = {
        "id": id,
        "title": "Title",
        "score": 1,
        "num_comments": 1,
        "created_utc": NOON,
        "selftext": "body",
        "upvote_ratio": 0.5,
        "url": f"https://example.org/{id}",
        "author": "ann",
        "is_original_content": False,
        "is_self": True,
        "extracted_at": "2024-01-31T02:00:00",
    }
    return {**base, **fields}


def unnested(spark, *posts):
    """Unnested bronze posts of community `x`."""
    rows = [{"subreddit": "x", "run_ts": RUN, **p} for p in posts]
    return spark.createDataFrame([tuple(r[f.name] for f in POSTS.fields) for r in rows], POSTS)


def listing(spark, *posts):
    rows = []
    for place, p in enumerate(posts):
        record = {"subreddit": "x", "source": "forum", "listing_rank": place, **p}
        rows.append(tuple(record[f.name] for f in LISTING.fields))
    return spark.createDataFrame(rows, LISTING)


def envelope(subreddit, posts, extracted_at="2024-01-31T02:00:00"):
    return {
        "source": "forum",
        "subreddit": subreddit,
        "extracted_at": extracted_at,
        "record_count": len(posts),
        "posts": posts,
    }


def envelopes(spark, *documents):
    return spark.createDataFrame(documents, ENVELOPE)
