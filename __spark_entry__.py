"""

All queries read whole `events` and `documents` tables as one forum listing (a post per event).
Queries that store data do so in a fresh folder below the session's shared checkpoint folder.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from agoralake.config import (
    ENGAGEMENT_VIEW,
    GOLD_DATASETS,
    SOURCE,
    TOP_COMMENTED_VIEW,
    TOP_POSTS_VIEW,
    Lake,
)
from agoralake.functions import run_partition
from agoralake.operators import analytics as A
from agoralake.operators import gold as G
from agoralake.operators import layers as L
from agoralake.operators.listing import build_documents, stamp_posts, take_listing
from agoralake.operators.silver import clean_posts, unnest_posts
from agoralake.plans import load as runs
from agoralake.plans.catalog import (
    create_database,
    list_databases,
    refresh_tables,
    register_temp_views,
    setup,
)
from agoralake.plans.quality import layer_report
from agoralake.schemas import POST
from agoralake.session import release_shuffles, scratch_folder
from agoralake.sinks import remove_path, write_documents, write_silver
from agoralake.sources import (
    good_documents,
    path_community,
    query_to_dataframe,
    read_documents,
    read_gold,
    read_silver,
)
from agoralake.sources.event_posts import RUN_TS, listing_from_tables
from agoralake.streaming import stream_gold, stream_layers, stream_silver

# The training-data operators are an optional part: without their folder, or a module that only they
# need, the rest works alone.
try:
    import corpus_pipeline
    from agoralake.llm import queries as llm
except ModuleNotFoundError:
    llm = None

RUN = datetime.fromisoformat(RUN_TS)
SECOND_RUN = datetime(2024, 1, 31, 3)
COMMUNITY = "click"
GONE = "view"
# A listing bound above a document's posts.
LARGE_LIMIT, DOCUMENT_POSTS = 2500, 1000
# A listing bound above what one task sorts, and how often a post stands in that listing.
HUGE_LIMIT, TIMES = 20_000, 6
CHECK_DATABASE = "agora_check"
START, END = "2024-01-10", "2024-01-20"
SPLIT_DAY = "2024-01-16"


def _rounded(df: DataFrame) -> DataFrame:
    """Means and correlations to six places, as the twins have them."""
    return df.select(
        *[
            F.round(f.name, 6).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name
            for f in df.schema.fields
        ]
    )


def _posts(spark: SparkSession, folder: str) -> DataFrame:
    """All unnested bronze posts, without storing them."""
    stamped = stamp_posts(take_listing(listing_from_tables(spark, folder), None), RUN)
    return stamped.withColumn("run_ts", F.lit(RUN_TS).cast("timestamp_ntz"))


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return clean_posts(_posts(spark, folder))


def _lake(spark: SparkSession) -> Lake:
    release_shuffles(spark)
    return Lake(scratch_folder(spark), CHECK_DATABASE)


def _loaded(spark: SparkSession, folder: str) -> Lake:
    """A lake holding one run over the whole listing."""
    lake = _lake(spark)
    runs.run(spark, listing_from_tables(spark, folder), lake, RUN, post_limit=None)
    return lake


# --- bronze ---------------------------------------------------------------------------------


def bronze_bounded_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return stamp_posts(take_listing(listing_from_tables(spark, folder)), RUN)


def bronze_envelope(spark: SparkSession, folder: str) -> DataFrame:
    documents = build_documents(bronze_bounded_ingest(spark, folder), RUN, together=True)
    stamp = F.col("extracted_at").cast("timestamp_ntz")
    return documents.select(
        "source",
        "subreddit",
        "extracted_at",
        "record_count",
        F.element_at("posts", 1)["id"].alias("first_id"),
        F.element_at("posts", -1)["id"].alias("last_id"),
        *[run_partition(p, stamp).alias(p) for p in ("run_date", "run_hour", "run_id")],
    )


def bronze_large_bound(spark: SparkSession, folder: str) -> DataFrame:
    """What a bound that no task sorts keeps of a listing in which one community has most posts.

    Posts stand at several places, which others share; some have no place.
    """
    rank = F.col("listing_rank")
    listing = listing_from_tables(spark, folder).select(
        "id",
        F.when(rank % 7 != 0, F.lit("everything")).otherwise(F.col("subreddit")).alias("subreddit"),
        rank,
        F.explode(F.sequence(F.lit(0), F.lit(TIMES - 1))).alias("again"),
    )
    place = F.when(rank % 97 != 3, rank + F.col("again") * 1000).alias("listing_rank")
    return take_listing(listing.select("id", "subreddit", place), HUGE_LIMIT)


def bronze_small_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every post's place in a listing bound above the documents' own, told by its document."""
    posts = stamp_posts(take_listing(listing_from_tables(spark, folder), LARGE_LIMIT), RUN)
    documents = build_documents(posts, RUN, DOCUMENT_POSTS, together=True)
    return documents.select(
        "subreddit",
        F.size("posts").cast("bigint").alias("record_count"),
        F.posexplode("posts").alias("place", "post"),
    ).select("subreddit", "record_count", F.col("place").cast("bigint"), F.col("post.id").alias("id"))


def _stored_documents(spark: SparkSession, folder: str) -> DataFrame:
    lake = _lake(spark)
    posts = stamp_posts(listing_from_tables(spark, folder), RUN)
    write_documents(build_documents(posts, RUN), lake.bronze)
    return read_documents(spark, lake.bronze)


def bronze_json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    posts = unnest_posts(good_documents(_stored_documents(spark, folder)))
    return posts.select("source", "subreddit", "run_ts", *POST.fieldNames())


def path_community_counts(spark: SparkSession, folder: str) -> DataFrame:
    documents = _stored_documents(spark, folder)
    return (
        documents.select(path_community().alias("subreddit"), "record_count")
        .groupBy("subreddit")
        .agg(F.sum("record_count").alias("post_count"))
    )


# --- silver and the layer tables ------------------------------------------------------------


def silver_parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    lake = _lake(spark)
    write_silver(_silver(spark, folder), lake.silver, rebalance=True)
    return read_silver(spark, lake.silver)


def layer_bronze_posts(spark: SparkSession, folder: str) -> DataFrame:
    return L.bronze_posts(_posts(spark, folder))


def layer_silver_posts(spark: SparkSession, folder: str) -> DataFrame:
    return L.silver_posts(_silver(spark, folder))


def layer_gold_subreddit_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(G.subreddit_stats(G.daily_stats(_silver(spark, folder))))


# --- gold -----------------------------------------------------------------------------------


def gold_daily_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(G.daily_stats(_silver(spark, folder)))


def gold_top_posts(spark: SparkSession, folder: str) -> DataFrame:
    return G.top_posts(_silver(spark, folder))


def gold_top_commented(spark: SparkSession, folder: str) -> DataFrame:
    return G.top_commented(_silver(spark, folder))


def gold_parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    lake = _lake(spark)
    write_silver(_silver(spark, folder), lake.silver, rebalance=True)
    silver = read_silver(spark, lake.silver)
    runs.load(spark, lake, silver)
    daily = read_gold(spark, lake.gold("daily_stats"), "daily_stats")
    stacked = daily.select(
        F.lit("daily_stats").alias("dataset"), "subreddit", "run_date", "score_sum"
    )
    for dataset in GOLD_DATASETS[1:]:
        kept = read_gold(spark, lake.gold(dataset), dataset)
        stacked = stacked.unionByName(
            kept.select(
                F.lit(dataset).alias("dataset"),
                "subreddit",
                "run_date",
                F.col("score").alias("score_sum"),
            )
        )
    return stacked.groupBy("dataset", "subreddit", "run_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("score_sum").alias("score_sum")
    )


# --- analytics ------------------------------------------------------------------------------


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    return A.engagement_metrics(G.daily_stats(_silver(spark, folder)))


def engagement_all(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(A.engagement_by_date(_metrics(spark, folder)))


def engagement_one(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(A.engagement_by_date(_metrics(spark, folder), COMMUNITY))


def engagement_range(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(A.engagement_by_date(_metrics(spark, folder), "", START, END))


def top_posts_n(spark: SparkSession, folder: str) -> DataFrame:
    return A.best_posts(gold_top_posts(spark, folder))


def top_posts_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return A.best_posts(gold_top_posts(spark, folder), COMMUNITY, START, END, 5)


def discussions_n(spark: SparkSession, folder: str) -> DataFrame:
    return A.active_discussions(gold_top_commented(spark, folder))


def discussions_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return A.active_discussions(gold_top_commented(spark, folder), COMMUNITY, START, END, 5)


def length_vs_engagement(spark: SparkSession, folder: str) -> DataFrame:
    silver = _silver(spark, folder)
    return _rounded(A.length_vs_engagement(G.top_posts(silver), G.top_commented(silver)))


def length_vs_engagement_one(spark: SparkSession, folder: str) -> DataFrame:
    silver = _silver(spark, folder)
    tops = G.top_posts(silver), G.top_commented(silver)
    return _rounded(A.length_vs_engagement(*tops, COMMUNITY))


def demo_preview(spark: SparkSession, folder: str) -> DataFrame:
    silver = _silver(spark, folder)
    tops = G.top_posts(silver), G.top_commented(silver)
    metrics = A.engagement_metrics(G.daily_stats(silver))
    shown = A.preview(A.community_report(metrics, *tops, COMMUNITY))
    named = {
        "engagement": ("date", "post_count", "total_score", "avg_comments"),
        "top_posts": ("title", "score", "num_comments", None),
        "discussions": ("title", "score", "num_comments", None),
        "analysis": ("subreddit", "avg_title_length", "avg_score", "title_score_correlation"),
    }
    parts = [
        _rounded(shown[report]).select(
            F.lit(report).alias("report"),
            F.col(label).cast("string").alias("label"),
            *[
                (F.lit(None) if c is None else F.col(c)).cast("double").alias(f"value_{k}")
                for k, c in enumerate(columns)
            ],
        )
        for report, (label, *columns) in named.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def sql_to_dataframe(spark: SparkSession, folder: str) -> DataFrame:
    silver = _silver(spark, folder)
    register_temp_views(G.daily_stats(silver), G.top_posts(silver), G.top_commented(silver))
    text = f"""
        SELECT subreddit, max(total_score) AS best_day_score, sum(post_count) AS post_count
        FROM {ENGAGEMENT_VIEW} WHERE date >= :start AND subreddit <> :other GROUP BY subreddit
    """
    arguments = {"start": datetime.fromisoformat(START).date(), "other": "' OR 1=1 --"}
    try:
        return query_to_dataframe(spark, text, "default", arguments)
    finally:  # the plan is bound to the views; the session need not keep them
        for view in (ENGAGEMENT_VIEW, TOP_POSTS_VIEW, TOP_COMMENTED_VIEW):
            spark.catalog.dropTempView(view)


# --- catalogue, health, runs ----------------------------------------------------------------


def register_external_tables(spark: SparkSession, folder: str) -> DataFrame:
    """What all tables and views give, as rows and sums of their numbers, and that they are set up."""
    spark.sql(f"DROP DATABASE IF EXISTS {CHECK_DATABASE} CASCADE")
    lake = _loaded(spark, folder)
    create_database(spark, lake.database, lake.table("database"))
    if lake.database not in list_databases(spark):
        raise RuntimeError("the new database is not listed")
    status = setup(spark, lake)
    refresh_tables(spark, lake)
    values = " UNION ALL ".join(
        f"SELECT '{name}' AS table, count(*) AS row_count, "
        f"CAST(sum({total}) AS BIGINT) AS total, count(DISTINCT {key}) AS keys FROM {name}"
        for name, (_, total, key) in TABLE_SUMS.items()
    )
    return query_to_dataframe(spark, values, lake.database).join(
        status.select("table", "ok"), "table", "left"
    )


# Per table or view: the rows it shows in the SQL twins, a number to sum and a column to count.
TABLE_SUMS = {
    "bronze_posts": ("posts", "score", "title"),
    "silver_posts": ("silver", "length(cleaned_text) + post_length", "author"),
    "gold_subreddit_stats": ("daily", "post_count * 1000 + total_comments", "date"),
    "daily_stats": ("daily", "score_sum", "date"),
    "top_posts": ("tops", "selftext_length", "id"),
    "top_commented": ("commented", "num_comments", "id"),
    ENGAGEMENT_VIEW: ("daily", "total_score + post_count", "date"),
    TOP_POSTS_VIEW: ("tops", "score", "id"),
    TOP_COMMENTED_VIEW: ("commented", "num_comments", "url"),
}


def _health(spark: SparkSession, lake: Lake, name: str, day: date | None = None) -> DataFrame:
    report = layer_report(spark, lake, day)
    columns = ["layer", "exists", "record_count", "newest_record", "status"]
    return report.select(
        F.lit(name).alias("lake"), *columns, (F.col("file_count") > 0).alias("has_files")
    )


def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    """Health of a whole lake, of a day without runs, and of a lake without gold.

    The first lake goes when its reports are stored, so that there is one at a time.
    """
    lake, place = _loaded(spark, folder), f"{scratch_folder(spark)}/health"
    reports = _health(spark, lake, "whole").union(_health(spark, lake, "idle day", date(2024, 2, 1)))
    reports.write.parquet(place)
    remove_path(spark, lake.base)
    part = _lake(spark)
    documents = build_documents(stamp_posts(listing_from_tables(spark, folder), RUN), RUN)
    write_documents(documents, part.bronze)
    runs.transform(read_documents(spark, part.bronze), part, "part")
    return spark.read.schema(reports.schema).parquet(place).union(_health(spark, part, "no gold"))


def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    listing = listing_from_tables(spark, folder)
    return runs.run(spark, listing, _lake(spark), RUN, post_limit=None)


def run_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """A run, repeated with one community gone and the posts of one day gone from the others."""
    lake, listing = _lake(spark), listing_from_tables(spark, folder)
    runs.run(spark, listing, lake, RUN, post_limit=None)
    left = listing.where((F.col("subreddit") != GONE) & (F.col("listing_rank") % 3 != 0))
    summary = runs.run(spark, left, lake, RUN, post_limit=None)
    silver = read_silver(spark, lake.silver).groupBy("subreddit").agg(F.sum("score").alias("scores"))
    return summary.join(silver, "subreddit", "full")


def run_with_broken_document(spark: SparkSession, folder: str) -> DataFrame:
    """A run whose bronze then gets a document that does not parse: only its community is not ok."""
    lake, listing = _lake(spark), listing_from_tables(spark, folder)
    runs.run(spark, listing, lake, RUN, post_limit=None)
    place = f"{lake.bronze}/{runs.run_prefix(RUN, bronze=True)}"
    broken = spark.createDataFrame([('{"source": "forum", "posts": [{"id": ',)], "value string")
    broken.write.mode("append").text(f"{place}/community={COMMUNITY}")
    bronze = read_documents(spark, lake.bronze, runs.run_prefix(RUN, bronze=True))
    runs.transform(bronze, lake, runs.run_id(RUN))
    return runs.run_summary(spark, lake, RUN)


def run_daily(spark: SparkSession, folder: str) -> DataFrame:
    """The daily round over three communities, one of which has no posts."""
    spark.sql(f"DROP DATABASE IF EXISTS {CHECK_DATABASE} CASCADE")
    lake, listing = _lake(spark), listing_from_tables(spark, folder)
    done = runs.run_daily(spark, listing, lake, RUN, 50, [COMMUNITY, GONE, "nobody"])
    counts = query_to_dataframe(
        spark,
        f"SELECT 'rows of {TOP_POSTS_VIEW}' AS what, count(*) AS n FROM {TOP_POSTS_VIEW}",
        lake.database,
    )
    parts = [
        done["extractions"].select(
            F.concat(F.lit("loaded "), "subreddit").alias("what"),
            F.when(F.col("ok"), F.col("silver_rows")).otherwise(-1).alias("n"),
        ),
        done["setup"].groupBy(F.lit("objects ready").alias("what")).agg(F.count_if("ok").alias("n")),
        done["monitoring"].select(
            F.concat_ws(" ", F.lit("records"), "layer", "status").alias("what"),
            F.col("record_count").alias("n"),
        ),
        counts,
    ]
    return reduce(DataFrame.unionByName, parts)


def foreign_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The whole listing as indented documents of others, in folders named by community; scores are text.

    Every fifth post has a score that is no whole number, which costs the score and not the post. A
    document has up to 1,000 posts; one of more than `FOREIGN_SPLIT` bytes is read by several tasks.
    """
    lake, place = _lake(spark), f"{scratch_folder(spark)}/{SOURCE}"
    documents = build_documents(stamp_posts(listing_from_tables(spark, folder), RUN), RUN)

    def with_text_score(post: Column) -> Column:
        own = post["score"].cast("string")
        score = F.when(post["id"].cast("bigint") % 5 == 0, F.lit("12.5")).otherwise(own)
        return F.struct(*[(score if f == "score" else post[f]).alias(f) for f in POST.fieldNames()])

    posts = F.transform("posts", with_text_score).alias("posts")
    envelope = F.struct("source", F.lit(RUN_TS).alias("extracted_at"), "record_count", posts)
    written = documents.select("subreddit", F.to_json(envelope, {"pretty": "true"}).alias("value"))
    written = written.withColumnRenamed("subreddit", "community")
    written.write.option("maxRecordsPerFile", 1).partitionBy("community").text(place)
    runs.run_foreign(spark, place, lake, glob="*.txt", split_above=FOREIGN_SPLIT)
    silver = read_silver(spark, lake.silver)
    aside = spark.read.schema(POST).json(f"{lake.quarantine}/posts").select("id", F.lit(True).alias("aside"))
    return silver.select("id", "subreddit", "score", "title", "date").join(aside, "id", "left").select(
        "*", F.coalesce("aside", F.lit(False)).alias("set_aside")
    ).drop("aside")


# Bytes above which the query's documents are read by several tasks, so that some are.
FOREIGN_SPLIT = 1 << 20


# --- streams --------------------------------------------------------------------------------


def _streamed(spark: SparkSession, folder: str, with_gold: bool) -> Lake:
    """Two extractions of the listing by date, the streams after each, and once more for nothing."""
    lake = _lake(spark)
    listing = listing_from_tables(spark, folder)
    split = (datetime.fromisoformat(SPLIT_DAY) - datetime(1970, 1, 1)).total_seconds()
    early = F.coalesce(F.col("created_utc") < split, F.lit(False))

    def refresh() -> None:
        stream_silver(spark, lake).awaitTermination()
        if with_gold:
            stream_gold(spark, lake, max_files=1).awaitTermination()

    for part, run_ts in ((early, RUN), (~early, SECOND_RUN)):
        posts = stamp_posts(listing.where(part), run_ts)
        write_documents(build_documents(posts, run_ts), lake.bronze)
        refresh()
    refresh()
    return lake


def stream_incremental_silver(spark: SparkSession, folder: str) -> DataFrame:
    silver = read_silver(spark, _streamed(spark, folder, with_gold=False).silver)
    return silver.select("id", "subreddit", "run_ts", "created_at", "title", "selftext_length")


def stream_gold_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Gold by batches of one silver file: daily statistics, and both top lists."""
    lake = _streamed(spark, folder, with_gold=True)
    daily = _rounded(read_gold(spark, lake.gold("daily_stats"), "daily_stats"))
    parts = [
        daily.select(
            F.lit("daily_stats").alias("dataset"), "subreddit", "run_ts",
            F.col("date").cast("string").alias("key"), F.col("id_count").alias("n"),
            "score_mean", "upvote_ratio_mean",
        )
    ]
    for dataset in GOLD_DATASETS[1:]:
        rows = read_gold(spark, lake.gold(dataset), dataset)
        parts.append(
            rows.select(
                F.lit(dataset).alias("dataset"), "subreddit", "run_ts", F.col("id").alias("key"),
                F.col("num_comments").alias("n"), F.col("score").cast("double").alias("score_mean"),
                F.col("upvote_ratio").alias("upvote_ratio_mean"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """What the streams make of a document that does not parse and of posts without a readable time."""
    lake = _lake(spark)
    listing = listing_from_tables(spark, folder)
    stamp = F.when(F.col("listing_rank") % 10 == 1, F.lit("soon")).otherwise(F.col("extracted_at"))
    posts = stamp_posts(listing.withColumn("extracted_at", stamp), RUN)
    write_documents(build_documents(posts, RUN), lake.bronze)
    place = f"{lake.bronze}/{runs.run_prefix(RUN, bronze=True)}"
    broken = spark.createDataFrame([('{"source": "forum", "posts": [{"id": ',)], "value string")
    broken.write.mode("append").text(f"{place}/community={COMMUNITY}")
    for _ in range(2):
        stream_layers(spark, lake)
    silver = read_silver(spark, lake.silver).groupBy("subreddit").agg(
        F.count(F.lit(1)).alias("posts"), F.count("extracted_at").alias("timed")
    )
    lost = spark.read.schema("file_path string").json(f"{lake.quarantine}/documents")
    lost = lost.groupBy(path_community(F.col("file_path")).alias("subreddit")).agg(
        F.count(F.lit(1)).alias("documents_aside")
    )
    aside = spark.read.schema("subreddit string").json(f"{lake.quarantine}/posts")
    aside = aside.groupBy("subreddit").agg(F.count(F.lit(1)).alias("posts_aside"))
    return silver.join(lost, "subreddit", "left").join(aside, "subreddit", "left").fillna(
        0, ["documents_aside", "posts_aside"]
    )


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: engagement by date, from raw listing to report."""
    return engagement_all(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm is None:
        return lake_queries()
    return lake_queries() | llm.QUERIES | {"pipeline": corpus_pipeline.run}


def lake_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "bronze_bounded_ingest": bronze_bounded_ingest,
        "bronze_envelope": bronze_envelope,
        "bronze_json_roundtrip": bronze_json_roundtrip,
        "bronze_large_bound": bronze_large_bound,
        "bronze_small_documents": bronze_small_documents,
        "foreign_documents": foreign_documents,
        "path_community": path_community_counts,
        "silver_posts_clean": _silver,
        "silver_parquet_roundtrip": silver_parquet_roundtrip,
        "layer_bronze_posts": layer_bronze_posts,
        "layer_silver_posts": layer_silver_posts,
        "layer_gold_subreddit_stats": layer_gold_subreddit_stats,
        "gold_daily_stats": gold_daily_stats,
        "gold_top_posts": gold_top_posts,
        "gold_top_commented": gold_top_commented,
        "gold_parquet_roundtrip": gold_parquet_roundtrip,
        "engagement_all": engagement_all,
        "engagement_one": engagement_one,
        "engagement_range": engagement_range,
        "top_posts_n": top_posts_n,
        "top_posts_filtered": top_posts_filtered,
        "discussions_n": discussions_n,
        "discussions_filtered": discussions_filtered,
        "length_vs_engagement": length_vs_engagement,
        "length_vs_engagement_one": length_vs_engagement_one,
        "demo_preview": demo_preview,
        "sql_to_dataframe": sql_to_dataframe,
        "register_external_tables": register_external_tables,
        "quality_report": quality_report,
        "run_summary": run_summary,
        "run_repeated": run_repeated,
        "run_with_broken_document": run_with_broken_document,
        "run_daily": run_daily,
        "stream_quarantine": stream_quarantine,
        "stream_incremental_silver": stream_incremental_silver,
        "stream_gold_refresh": stream_gold_refresh,
    }


# --- SQL twins ------------------------------------------------------------------------------

_POSTS = """
posts AS (
  SELECT CAST(e.event_id AS VARCHAR) AS id,
         CASE WHEN e.event_id % 41 <> 3
              THEN '  ' || split_part(d.text, chr(10), 1) || chr(9) END AS title,
         CASE WHEN e.event_type = 'error' THEN 7
              WHEN e.event_id % 43 <> 4 THEN CAST(floor(e.value * 10) AS BIGINT) END AS score,
         CASE WHEN e.event_id % 47 <> 5
              THEN CAST(json_extract_string(e.props, '$.k') AS BIGINT) END AS num_comments,
         CASE WHEN e.event_id % 53 <> 6 THEN floor(epoch(e.ts)) END AS created_utc,
         CASE WHEN e.event_id % 7 = 0 THEN NULL
              WHEN e.event_id % 7 = 1 THEN '   '
              WHEN e.event_id % 7 = 2 THEN chr(12288) || d.text || chr(160) || chr(10)
              ELSE d.text END AS selftext,
         CAST((e.event_id % 33 + 32) / 64.0 AS DOUBLE) AS upvote_ratio,
         'https://example.org/' || e.event_type || '/' || e.event_id AS url,
         CASE WHEN e.event_id % 11 <> 0 THEN 'user_' || e.user_id END AS author,
         e.event_id % 5 = 0 AS is_original_content,
         e.event_id % 7 <> 0 AS is_self,
         CASE WHEN e.event_id % 2 = 0 THEN '2024-01-31T02:00:00'
              ELSE '2024-01-31T02:00:00.250000' END AS extracted_at,
         e.event_type AS subreddit,
         'forum' AS source,
         e.event_id AS listing_rank,
         TIMESTAMP '2024-01-31 02:00:00' AS run_ts
  FROM events e
  LEFT JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
)"""
_WHITE = r"[\s\v\x{1c}-\x{1f}\x{85}\p{Z}]"


def _strip_sql(column: str) -> str:
    return f"regexp_replace({column}, '^{_WHITE}+|{_WHITE}+$', '', 'g')"


_SILVER = f"""
stripped AS (
  SELECT * REPLACE ({_strip_sql("title")} AS title,
                    coalesce({_strip_sql("selftext")}, '') AS selftext),
         TIMESTAMP '1970-01-01' + to_seconds(created_utc) AS created_at
  FROM posts
),
silver AS (
  SELECT id, title, score, num_comments, selftext, upvote_ratio, url,
         coalesce(author, 'deleted') AS author, is_original_content, is_self,
         CAST(extracted_at AS TIMESTAMP) AS extracted_at, created_at,
         CAST(created_at AS DATE) AS date,
         length(title) AS title_length, length(selftext) AS selftext_length,
         length(selftext) > 0 AS has_selftext, subreddit, run_ts
  FROM stripped
)"""
_STATS = """
  SELECT date, count(id) AS id_count,
         round(avg(score), 6) AS score_mean, max(score) AS score_max,
         CAST(coalesce(sum(score), 0) AS BIGINT) AS score_sum,
         round(avg(num_comments), 6) AS num_comments_mean,
         max(num_comments) AS num_comments_max,
         CAST(coalesce(sum(num_comments), 0) AS BIGINT) AS num_comments_sum,
         round(avg(title_length), 6) AS title_length_mean,
         round(avg(selftext_length), 6) AS selftext_length_mean,
         round(avg(upvote_ratio), 6) AS upvote_ratio_mean, subreddit, run_ts
  FROM {source} WHERE date IS NOT NULL GROUP BY run_ts, subreddit, date"""
_TOP = """
  SELECT * FROM silver
  QUALIFY row_number() OVER (PARTITION BY run_ts, subreddit
                             ORDER BY {metric} DESC NULLS LAST, id) <= 20"""
_GOLD = f"""
daily AS ({_STATS.format(source="silver")}),
tops AS ({_TOP.format(metric="score")}),
commented AS ({_TOP.format(metric="num_comments")})"""

_P = f"WITH {_POSTS}"
_S = f"WITH {_POSTS}, {_SILVER}"
_ALL = f"WITH {_POSTS}, {_SILVER}, {_GOLD}"
_RANGE = f"date >= DATE '{START}' AND date <= DATE '{END}'"
_CORR = (
    "round(CASE WHEN stddev_pop({0}) > 0 AND stddev_pop({1}) > 0 THEN corr({0}, {1}) END, 6) AS {2}"
)


def _engagement_sql(condition: str) -> str:
    return f"""{_ALL}
SELECT date, subreddit, id_count AS post_count, score_mean AS avg_score,
       score_sum AS total_score, num_comments_mean AS avg_comments,
       num_comments_sum AS total_comments, upvote_ratio_mean AS avg_upvote_ratio
FROM daily WHERE {condition} ORDER BY date DESC, subreddit"""


def _best_sql(source: str, metric: str, condition: str, limit: int) -> str:
    return f"""{_ALL}
SELECT id, title, score, num_comments, author, date, upvote_ratio, url, subreddit
FROM {source} WHERE {condition} ORDER BY {metric} DESC NULLS LAST, id LIMIT {limit}"""


def _length_sql(condition: str) -> str:
    pairs = (
        ("title_length", "score", "title_score_correlation"),
        ("selftext_length", "score", "content_score_correlation"),
        ("title_length", "num_comments", "title_comments_correlation"),
        ("selftext_length", "num_comments", "content_comments_correlation"),
    )
    return f"""{_ALL}, both_lists AS (
  SELECT title_length, selftext_length, score, num_comments, upvote_ratio, subreddit FROM tops
  UNION ALL
  SELECT title_length, selftext_length, score, num_comments, upvote_ratio, subreddit
  FROM commented
)
SELECT subreddit, round(avg(title_length), 6) AS avg_title_length,
       round(avg(selftext_length), 6) AS avg_selftext_length,
       round(avg(score), 6) AS avg_score, round(avg(num_comments), 6) AS avg_comments,
       round(avg(upvote_ratio), 6) AS avg_upvote_ratio,
       {", ".join(_CORR.format(*pair) for pair in pairs)}
FROM both_lists WHERE {condition} GROUP BY subreddit"""


def _counts_sql() -> str:
    # The columns of the tables in terms of the twins' own.
    names = {
        "length(cleaned_text) + post_length": "2 * length(selftext)",
        "post_count * 1000 + total_comments": "id_count * 1000 + num_comments_sum",
        "total_score + post_count": "score_sum + id_count",
    }
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS row_count, "
        f"CAST(sum({names.get(total, total)}) AS BIGINT) AS total, count(DISTINCT {key}) AS keys, "
        f"true AS ok FROM {source}"
        for name, (source, total, key) in TABLE_SUMS.items()
    )
    return f"{_ALL} {rows}"


def oracle_sql() -> dict[str, str]:
    if llm is None:
        return lake_sql()
    whole = corpus_pipeline.ORACLE_SQL
    return lake_sql() | llm.ORACLES | ({"pipeline": whole} if whole else {})


def lake_sql() -> dict[str, str]:
    post = ", ".join(POST.fieldNames())
    community = f"subreddit = '{COMMUNITY}'"
    listed = f"""listed AS (
  SELECT {post}, subreddit, source, listing_rank FROM posts
  QUALIFY row_number() OVER (PARTITION BY subreddit ORDER BY listing_rank, id) <= 100
)"""
    two_runs = f"""two_runs AS (
  SELECT * REPLACE (CASE WHEN created_at < TIMESTAMP '{SPLIT_DAY}'
                         THEN run_ts ELSE run_ts + INTERVAL 1 HOUR END AS run_ts)
  FROM silver
)"""
    def summary_sql(kept: str, ok: str, aside: str, more: str = "") -> str:
        own = _SILVER.replace("FROM posts", f"FROM posts WHERE {kept}", 1)
        return f"""WITH {_POSTS}, {own}, {_GOLD}
SELECT subreddit, count(*) AS bronze_rows, count(*) AS silver_rows,
       (SELECT count(*) FROM daily d WHERE d.subreddit = s.subreddit) AS daily_rows,
       (SELECT count(*) FROM tops t WHERE t.subreddit = s.subreddit) AS top_rows,
       (SELECT count(*) FROM commented c WHERE c.subreddit = s.subreddit) AS commented_rows,
       {aside} AS quarantined, {ok} AS ok{more}
FROM silver s GROUP BY subreddit"""

    def values(report: str, label: str, *columns: str) -> str:
        casts = [f"CAST({c} AS DOUBLE) AS value_{k}" for k, c in enumerate(columns)]
        return f"SELECT '{report}' AS report, CAST({label} AS VARCHAR) AS label, {', '.join(casts)}"

    analysis = _length_sql(community).replace(f"{_ALL}, ", "")
    preview_sql = f"""{_ALL},
{analysis.replace("SELECT subreddit, round", ", analysis AS (SELECT subreddit, round", 1)}),
days AS (SELECT * FROM daily WHERE {community} ORDER BY date DESC LIMIT 5),
best AS (SELECT * FROM tops WHERE {community} ORDER BY score DESC NULLS LAST, id LIMIT 5),
talked AS (
  SELECT * FROM commented WHERE {community} ORDER BY num_comments DESC NULLS LAST, id LIMIT 5)
{values("engagement", "date", "id_count", "score_sum", "num_comments_mean")} FROM days
UNION ALL {values("top_posts", "title", "score", "num_comments", "NULL")} FROM best
UNION ALL {values("discussions", "title", "score", "num_comments", "NULL")} FROM talked
UNION ALL {values("analysis", "subreddit", "avg_title_length", "avg_score",
                  "title_score_correlation")} FROM analysis"""
    gold_rows = " UNION ALL ".join(
        f"""SELECT '{dataset}' AS dataset, subreddit, CAST(run_ts AS DATE) AS run_date,
       count(*) AS row_count, CAST(sum({column}) AS BIGINT) AS score_sum
FROM {source} GROUP BY ALL"""
        for dataset, source, column in (
            ("daily_stats", "daily", "score_sum"),
            ("top_posts", "tops", "score"),
            ("top_commented", "commented", "score"),
        )
    )
    return {
        "bronze_bounded_ingest": f"{_P}, {listed} SELECT * FROM listed",
        "bronze_envelope": f"""{_P}, {listed}
SELECT source, subreddit, '2024-01-31T02:00:00' AS extracted_at, count(*) AS record_count,
       arg_min(id, listing_rank) AS first_id, arg_max(id, listing_rank) AS last_id,
       DATE '2024-01-31' AS run_date, '02' AS run_hour, '20240131_020000' AS run_id
FROM listed GROUP BY source, subreddit""",
        "bronze_json_roundtrip": f"{_P} SELECT source, subreddit, run_ts, {post} FROM posts",
        "path_community": f"""{_P}
SELECT subreddit, count(*) AS post_count FROM posts GROUP BY subreddit""",
        "silver_posts_clean": f"{_S} SELECT * FROM silver",
        "silver_parquet_roundtrip": f"""{_S}
SELECT *, DATE '2024-01-31' AS run_date, '20240131_020000' AS run_id FROM silver""",
        "layer_bronze_posts": f"""{_P}
SELECT id, title, score, author, CAST(created_utc AS BIGINT) AS created_utc, num_comments,
       CAST(NULL AS VARCHAR) AS permalink, url, selftext, subreddit,
       CAST(CAST(CAST(extracted_at AS TIMESTAMP) AS DATE) AS VARCHAR) AS ingestion_date
FROM posts""",
        "layer_silver_posts": f"""{_S}
SELECT id, title, score, author, date AS created_date, num_comments,
       CAST(NULL AS VARCHAR) AS permalink, url, selftext, subreddit, selftext AS cleaned_text,
       selftext_length AS post_length, CAST(extracted_at AS DATE) AS ingestion_date
FROM silver""",
        "layer_gold_subreddit_stats": f"""{_ALL}
SELECT subreddit, date, id_count AS post_count, score_mean AS avg_score,
       num_comments_sum AS total_comments, selftext_length_mean AS avg_post_length FROM daily""",
        "gold_daily_stats": f"{_ALL} SELECT * FROM daily",
        "gold_top_posts": f"{_ALL} SELECT * FROM tops",
        "gold_top_commented": f"{_ALL} SELECT * FROM commented",
        "gold_parquet_roundtrip": f"{_ALL} {gold_rows}",
        "engagement_all": _engagement_sql("true"),
        "engagement_one": _engagement_sql(community),
        "engagement_range": _engagement_sql(_RANGE),
        "top_posts_n": _best_sql("tops", "score", "true", 10),
        "top_posts_filtered": _best_sql("tops", "score", f"{community} AND {_RANGE}", 5),
        "discussions_n": _best_sql("commented", "num_comments", "true", 10),
        "discussions_filtered": _best_sql(
            "commented", "num_comments", f"{community} AND {_RANGE}", 5
        ),
        "length_vs_engagement": _length_sql("true"),
        "length_vs_engagement_one": _length_sql(community),
        "demo_preview": preview_sql,
        "sql_to_dataframe": f"""{_ALL}
SELECT subreddit, max(score_sum) AS best_day_score, CAST(sum(id_count) AS BIGINT) AS post_count
FROM daily WHERE date >= DATE '{START}' GROUP BY subreddit""",
        "register_external_tables": _counts_sql(),
        "quality_report": f"""{_ALL},
sizes AS (
  SELECT 'bronze' AS layer, count(*) AS n, max(run_ts) AS newest FROM posts
  UNION ALL SELECT 'silver', count(*), max(extracted_at) FROM silver
  UNION ALL SELECT 'gold', (SELECT count(*) FROM daily) + (SELECT count(*) FROM tops)
                           + (SELECT count(*) FROM commented), (SELECT max(run_ts) FROM daily))
SELECT 'whole' AS lake, layer, true AS "exists", n AS record_count, newest AS newest_record,
       'success' AS status, true AS has_files FROM sizes
UNION ALL SELECT 'idle day', layer, true, 0, NULL, 'warning', false FROM sizes
UNION ALL SELECT 'no gold', layer, layer <> 'gold', CASE WHEN layer = 'gold' THEN 0 ELSE n END,
       CASE WHEN layer <> 'gold' THEN newest END, 'failure', layer <> 'gold' FROM sizes""",
        "run_summary": summary_sql("true", "true", "0"),
        "run_repeated": summary_sql(
            f"subreddit <> '{GONE}' AND listing_rank % 3 <> 0", "true", "0",
            ", CAST(sum(score) AS BIGINT) AS scores",
        ),
        "run_with_broken_document": summary_sql(
            "true", f"subreddit <> '{COMMUNITY}'", f"CASE WHEN {community} THEN 1 ELSE 0 END"
        ),
        "run_daily": f"""{_P},
taken AS (
  SELECT * FROM posts WHERE subreddit IN ('{COMMUNITY}', '{GONE}')
  QUALIFY row_number() OVER (PARTITION BY subreddit ORDER BY listing_rank, id) <= 50),
days AS (
  SELECT DISTINCT subreddit, CAST(TIMESTAMP '1970-01-01' + to_seconds(created_utc) AS DATE) AS d
  FROM taken WHERE created_utc IS NOT NULL)
SELECT 'loaded ' || subreddit AS what, count(*) AS n FROM taken GROUP BY subreddit
UNION ALL SELECT 'loaded nobody', -1
UNION ALL SELECT 'objects ready', 9
UNION ALL SELECT 'records ' || layer || ' success', count(*)
FROM taken, (VALUES ('bronze'), ('silver')) AS l(layer) GROUP BY layer
UNION ALL SELECT 'records gold success', (SELECT count(*) FROM days) + 2 * 2 * 20
UNION ALL SELECT 'rows of {TOP_POSTS_VIEW}', 2 * 20""",
        "foreign_documents": f"""{_S}
SELECT id, subreddit,
       CASE WHEN CAST(id AS BIGINT) % 5 <> 0 THEN score END AS score, title, date,
       CAST(id AS BIGINT) % 5 = 0 AS set_aside
FROM silver""",
        "bronze_large_bound": f"""
SELECT CAST(event_id AS VARCHAR) AS id,
       CASE WHEN event_id % 7 <> 0 THEN 'everything' ELSE event_type END AS subreddit,
       CASE WHEN event_id % 97 <> 3 THEN event_id + again * 1000 END AS listing_rank
FROM events, range({TIMES}) AS r(again)
QUALIFY row_number() OVER (PARTITION BY subreddit ORDER BY listing_rank NULLS LAST, id) <= {HUGE_LIMIT}""",
        "bronze_small_documents": f"""{_P},
listed AS (
  SELECT subreddit, id,
         row_number() OVER (PARTITION BY subreddit ORDER BY listing_rank, id) - 1 AS r
  FROM posts QUALIFY r < {LARGE_LIMIT})
SELECT subreddit, count(*) OVER (PARTITION BY subreddit, r // {DOCUMENT_POSTS}) AS record_count,
       r % {DOCUMENT_POSTS} AS place, id FROM listed""",
        "stream_quarantine": f"""{_P}
SELECT subreddit, count(*) AS posts, count(*) FILTER (listing_rank % 10 <> 1) AS timed,
       CASE WHEN {community} THEN 1 ELSE 0 END AS documents_aside,
       count(*) FILTER (listing_rank % 10 = 1) AS posts_aside
FROM posts GROUP BY subreddit""",
        "stream_incremental_silver": f"""{_S}, {two_runs}
SELECT id, subreddit, run_ts, created_at, title, selftext_length FROM two_runs""",
        "stream_gold_refresh": f"""{_S}, {two_runs},
daily AS ({_STATS.format(source="two_runs")}),
tops AS ({_TOP.format(metric="score").replace("FROM silver", "FROM two_runs")}),
commented AS ({_TOP.format(metric="num_comments").replace("FROM silver", "FROM two_runs")})
SELECT 'daily_stats' AS dataset, subreddit, run_ts, CAST(date AS VARCHAR) AS "key", id_count AS n,
       score_mean, upvote_ratio_mean FROM daily
UNION ALL SELECT 'top_posts', subreddit, run_ts, id, num_comments, CAST(score AS DOUBLE),
       upvote_ratio FROM tops
UNION ALL SELECT 'top_commented', subreddit, run_ts, id, num_comments, CAST(score AS DOUBLE),
       upvote_ratio FROM commented""",
    }
