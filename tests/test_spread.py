"""Large communities are stored where their posts lie; others are shuffled once."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from agoralake.config import FULL_PER_TASK, MAX_POSTS_PER_DOCUMENT, SILVER_ROWS_PER_TASK
from agoralake.operators.listing import build_documents, stamp_posts
from agoralake.operators.spread import large_groups
from agoralake.schemas import POST
from agoralake.session import release_shuffles
from agoralake.sinks import write_documents, write_partitions
from agoralake.sources import event_posts

from rows import listing, post

RUN = datetime(2024, 1, 31, 2)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def posts_of(spark, *counts, tasks=3):
    rows = [
        post(f"{name}{i:04d}", subreddit=name, listing_rank=i, selftext="t" * (i % 5))
        for name, count in counts
        for i in range(count)
    ]
    return stamp_posts(listing(spark, *rows).repartition(tasks), RUN)


def test_documents_are_shuffled_once(spark):
    posts = posts_of(spark, ("x", 20))
    # the listing's own repartition is replaced by the one that brings communities together
    assert exchanges(posts) == exchanges(build_documents(posts, RUN)) == 1


@pytest.mark.parametrize("none", [False, True])
def test_a_large_community_is_cut_in_its_tasks(spark, none):
    posts = posts_of(spark, ("x", 400), ("y", 5))
    if none:
        posts = posts.withColumn("subreddit", F.nullif("subreddit", F.lit("x")))
    documents = build_documents(posts, RUN, max_posts=20).collect()
    large = [d for d in documents if d.subreddit == (None if none else "x")]
    assert all(d.record_count == len(d.posts) <= 20 for d in documents)
    ids = [[p.id for p in d.posts] for d in large]
    assert all(i == sorted(i) for i in ids) and len(ids) <= 20 + 3
    assert sorted(i for d in ids for i in d) == [f"x{i:04d}" for i in range(400)]
    assert [[p.id for p in d.posts] for d in documents if d.subreddit == "y"] == [[f"y{i:04d}" for i in range(5)]]
    back = sorted((p for d in large for p in d.posts), key=lambda p: p.id)
    want = posts.where(F.col("id").startswith("x")).orderBy("id").select(*POST.fieldNames()).collect()
    assert back == want


def test_only_groups_with_enough_rows_for_each_task_are_large(spark):
    posts = posts_of(spark, ("x", 60), ("y", 5))
    assert large_groups(posts, ["source", "subreddit"], 21) is None
    large = large_groups(posts, ["source", "subreddit"], 20)
    assert {r.subreddit for r in posts.where(large).collect()} == {"x"}


def test_silver_of_some_hundred_posts_a_task_stays_where_it_is(spark):
    posts = spark.range(0, 2400, 1, 3).select(F.lit("x").alias("subreddit"), "id")
    large = large_groups(posts, ["subreddit"], SILVER_ROWS_PER_TASK)
    assert large is not None and posts.where(large).count() == 2400


def test_the_tasks_of_a_listing_are_as_many_as_its_posts_ask_for(spark, monkeypatch):
    monkeypatch.setattr(event_posts, "POSTS_PER_TASK", 40)
    posts = event_posts.listing_from_tables(spark, "/root/testdata/sf0.001")
    sizes = posts.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 1000 and len(sizes) >= 20
    assert max(r["count"] for r in sizes) <= 4 * 40


def test_half_of_a_listing_of_five_communities_need_not_be_shuffled():
    """The streams load a listing in two halves; a task's posts of a community fill its documents in each."""
    of_a_community = event_posts.POSTS_PER_TASK // 5 // 2
    assert of_a_community >= 2 * FULL_PER_TASK * MAX_POSTS_PER_DOCUMENT


def test_documents_are_stored_compressed(spark, lake):
    write_documents(build_documents(posts_of(spark, ("x", 20)), RUN), lake.bronze)
    assert all(f.endswith(".json.gz") for f in spark.read.text(lake.bronze).inputFiles())


def test_texts_are_compressed_by_large_pages(spark, lake):
    """Each of 150 texts comes again after some 300 KB of others, in a column without few values."""
    words = F.transform(F.sequence(F.lit(0), F.lit(30)), lambda i: F.sha2((F.col("id") % 150 * 100 + i).cast("string"), 256))
    rows = spark.range(0, 3000, 1, 1).select("id", F.concat_ws(" ", "id", words).alias("text"), F.lit("x").alias("p"))
    write_partitions(rows, f"{lake.base}/packed", ["p"])
    rows.write.option("compression", "zstd").parquet(f"{lake.base}/plain")
    size = {n: sum(f.stat().st_size for f in Path(f"{lake.base}/{n}").rglob("*.parquet")) for n in ("packed", "plain")}
    assert size["packed"] < 0.7 * size["plain"], size
    assert spark.read.parquet(f"{lake.base}/packed").exceptAll(rows).count() == 0


def test_a_finished_write_leaves_no_shuffle_files(spark, lake):
    """They would lie beside the layers of a run until the driver collects its garbage."""
    release_shuffles(spark)
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        names = (Path(f).name for f in blocks.getAllFiles().mkString("\n").split("\n"))
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffles()
    spark.range(1000).repartition(7, "id").write.parquet(f"{lake.base}/rows")
    assert not shuffles() - before
