"""Raw listing records out of the `events` and `documents` tables, one post per event."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_TS = "2024-01-31T02:00:00"
# Posts, with their texts, that one task of the join makes.
POSTS_PER_TASK = 60_000


def listing_from_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Every event with the text of document `event_id mod (number of documents)`.

    All documents and all events take part. Both sides grow with the data, and file sizes say little
    about text in memory, so the join shuffles and merges instead of guessing at a broadcast. A document
    is the text of many posts, which its shuffled bytes do not tell, so the tasks of a large join are as
    many as the posts ask for, and what sorts or holds posts next has about `POSTS_PER_TASK` of them: enough
    for full documents of several communities, also when only a part of the posts is stored. Titles
    are cut out before the join and padded, bodies are partly missing, blank or padded with Unicode
    whitespace, authors partly missing, and the two ISO forms of the extraction time mix. Some posts
    have no title, score, comments or time, and one community's scores are all the same. Ratios are
    64ths: their sums are exact, so a mean does not depend on the order in which tasks finish.
    """
    events = spark.read.parquet(f"{folder}/events.parquet")
    documents = spark.read.parquet(f"{folder}/documents.parquet").select(
        "doc_id",
        "text",
        F.concat(F.lit("  "), F.substring_index("text", "\n", 1), F.lit("\t")).alias("title"),
    )
    doc_count = documents.agg(F.count(F.lit(1))).scalar()
    tasks = 1 + events.count() // POSTS_PER_TASK
    event = F.col("event_id")
    events = events.withColumn("_document", event % doc_count)
    if tasks > spark.sparkContext.defaultParallelism:
        events, documents = events.repartition(tasks, "_document"), documents.repartition(tasks, "doc_id")
    seconds = (F.col("ts") - F.lit("1970-01-01").cast("timestamp_ntz")).cast("interval second")
    body = (
        F.when(event % 7 == 0, F.lit(None))
        .when(event % 7 == 1, F.lit("   "))
        .when(event % 7 == 2, F.concat(F.lit("\u3000"), "text", F.lit("\u00a0\n")))
        .otherwise(F.col("text"))
    )
    same = F.col("_document") == F.col("doc_id")
    return events.join(documents.hint("merge"), same, "left").select(
        event.cast("string").alias("id"),
        F.when(event % 41 != 3, F.col("title")).alias("title"),
        F.when(F.col("event_type") == "error", F.lit(7))
        .when(event % 43 != 4, F.floor(F.col("value") * 10))
        .cast("bigint")
        .alias("score"),
        F.when(event % 47 != 5, F.get_json_object("props", "$.k").cast("bigint")).alias(
            "num_comments"
        ),
        F.when(event % 53 != 6, seconds.cast("bigint").cast("double")).alias("created_utc"),
        body.alias("selftext"),
        ((event % 33 + 32) / F.lit(64.0)).cast("double").alias("upvote_ratio"),
        F.concat(F.lit("https://example.org/"), "event_type", F.lit("/"), event).alias("url"),
        F.when(event % 11 != 0, F.concat(F.lit("user_"), "user_id")).alias("author"),
        (event % 5 == 0).alias("is_original_content"),
        (event % 7 != 0).alias("is_self"),
        F.when(event % 2 == 0, F.lit(RUN_TS))
        .otherwise(F.lit(f"{RUN_TS}.250000"))
        .alias("extracted_at"),
        F.col("event_type").alias("subreddit"),
        F.lit("forum").alias("source"),
        event.alias("listing_rank"),
    )
