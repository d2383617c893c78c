from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from agoralake.config import GOLD_DATASETS, Lake
from agoralake.operators import gold as G
from agoralake.operators.listing import build_documents, stamp_posts
from agoralake.plans.load import load
from agoralake.plans import load as load_module
from agoralake.sinks import remove_path, write_documents
from agoralake.sources import read_gold, read_silver
from agoralake.plans.quality import layer_report
from agoralake.streaming import (
    stream_gold,
    stream_layers,
    stream_quarantine,
    stream_silver,
)
from agoralake.streaming.gold_state import _of_task
from rows import RUN, listing, post

NEXT = RUN.replace(hour=4)


def arrive(spark, lake, run_ts, posts, slices=1):
    documents = build_documents(stamp_posts(listing(spark, *posts), run_ts), run_ts, 2)
    write_documents(documents.repartition(slices), lake.bronze)


def posts(community, count):
    return [post(f"{community}{i:02d}", subreddit=community, score=i) for i in range(count)]


def silver_ids(spark, lake):
    return sorted((r.subreddit, r.id, r.run_ts) for r in read_silver(spark, lake.silver).collect())


def gold_rows(spark, lake):
    return {
        d: sorted(map(str, read_gold(spark, lake.gold(d), d).collect())) for d in GOLD_DATASETS
    }


def test_each_file_reaches_silver_once(spark, lake):
    arrive(spark, lake, RUN, posts("x", 5))
    stream_silver(spark, lake).awaitTermination()
    first = silver_ids(spark, lake)
    assert [r[1] for r in first] == [f"x{i:02d}" for i in range(5)]
    stream_silver(spark, lake).awaitTermination()
    assert silver_ids(spark, lake) == first
    arrive(spark, lake, NEXT, posts("x", 2) + posts("y", 1))
    stream_silver(spark, lake).awaitTermination()
    assert len(silver_ids(spark, lake)) == 8


def test_broken_documents_do_not_stop_the_stream(spark, lake, tmp_path):
    arrive(spark, lake, RUN, posts("x", 2))
    folder = tmp_path / "lake/bronze/reddit/run_date=2024-01-31/run_hour=02/run_id=b/community=y"
    folder.mkdir(parents=True)
    (folder / "part.json").write_text('{"source": "forum", "subreddit": "y", "posts": [{"id": \n')
    stream_silver(spark, lake).awaitTermination()
    assert [r[:2] for r in silver_ids(spark, lake)] == [("x", "x00"), ("x", "x01")]
    for _ in range(2):
        stream_quarantine(spark, lake).awaitTermination()
    (bad,) = spark.read.json(f"{lake.quarantine}/documents").collect()
    assert bad.reason == "broken document" and "community=y" in bad.file_path


def test_posts_without_a_readable_time_are_set_aside(spark, lake):
    own = F.when(F.col("id") == "a", "noon").otherwise("2024-01-31T02:00:00")
    raw = listing(spark, post("a"), post("b")).withColumn("extracted_at", own)
    write_documents(build_documents(stamp_posts(raw, RUN), RUN), lake.bronze)
    for _ in range(2):
        stream_layers(spark, lake)
    assert [r.id for r in spark.read.json(f"{lake.quarantine}/posts").collect()] == ["a"]
    silver = {r.id: r.extracted_at for r in read_silver(spark, lake.silver).collect()}
    assert silver["a"] is None and silver["b"] is not None


def test_a_day_counts_only_files_of_the_log(spark, lake, tmp_path):
    arrive(spark, lake, RUN, posts("x", 2))
    stream_layers(spark, lake)
    folder = next((tmp_path / "lake/silver/reddit").glob("run_date=*/run_id=*/subreddit=x"))
    file = next(folder.glob("part-*.parquet"))
    (folder / "part-stray.parquet").write_bytes(file.read_bytes())
    for day in (None, RUN.date()):
        report = {r.layer: r for r in layer_report(spark, lake, day).collect()}
        assert (report["silver"].record_count, report["silver"].file_count) == (2, 1)
    assert read_silver(spark, lake.silver, f"run_date={RUN:%Y-%m-%d}").count() == 2


def test_a_task_sends_a_day_and_list_posts_only(spark, lake):
    arrive(spark, lake, RUN, posts("x", 60) + posts("y", 3))
    stream_silver(spark, lake).awaitTermination()
    silver = read_silver(spark, lake.silver).coalesce(1)
    sent = _of_task(silver, 5).groupBy("subreddit", "dataset").count().collect()
    assert {(r.subreddit, r.dataset): r["count"] for r in sent} == {
        ("x", "daily_stats"): 1,
        ("x", "top_posts"): 5,
        ("x", "top_commented"): 5,
        ("y", "daily_stats"): 1,
        ("y", "top_posts"): 3,
        ("y", "top_commented"): 3,
    }


def test_streamed_gold_keeps_odd_values(spark, lake, tmp_path):
    """Nulls, ties, undated posts, large numbers, and two run times within one second."""
    odd = [
        post("n", subreddit="x", score=None, num_comments=None, created_utc=None),
        post("big", subreddit="x", score=2**53 + 1, num_comments=-5),
        post("neg", subreddit="x", score=-(2**53) - 1),
        post("t\u00e9\u2028", subreddit="x", score=7, title=None, selftext='q"\\\n'),
        post("a", subreddit="x", score=7),
        post("a", subreddit="x", score=7),
    ]
    for micros in (0, 250_000):
        arrive(spark, lake, RUN.replace(microsecond=micros), odd + posts("x", 25), slices=3)
    stream_silver(spark, lake, max_files=1).awaitTermination()
    stream_gold(spark, lake, max_files=1).awaitTermination()
    whole = Lake(str(tmp_path / "whole"))
    load(spark, whole, read_silver(spark, lake.silver), large=False)
    assert gold_rows(spark, lake) == gold_rows(spark, whole)


def test_gold_of_a_run_split_over_batches_equals_the_batch_load(spark, lake, tmp_path):
    arrive(spark, lake, RUN, posts("x", 30) + posts("y", 3), slices=6)
    stream_silver(spark, lake, max_files=1).awaitTermination()
    query = stream_gold(spark, lake, max_files=2)
    query.awaitTermination()
    assert query.lastProgress["batchId"] > 0
    streamed = gold_rows(spark, lake)
    assert len(streamed["top_posts"]) == 23
    whole = Lake(str(tmp_path / "whole"))
    load(spark, whole, read_silver(spark, lake.silver), large=False)
    assert streamed == gold_rows(spark, whole)


def test_a_replayed_batch_changes_nothing(spark, lake, tmp_path):
    arrive(spark, lake, RUN, posts("x", 4))
    arrive(spark, lake, NEXT, posts("x", 3))
    stream_silver(spark, lake).awaitTermination()
    stream_gold(spark, lake).awaitTermination()
    before = gold_rows(spark, lake)
    assert {d: len(rows) for d, rows in before.items()} == {
        "daily_stats": 2,
        "top_posts": 7,
        "top_commented": 7,
    }
    # the batch's commit is lost after its gold was written, and its gold partly
    commits = tmp_path / "lake/checkpoints/gold_state/commits"
    for file in commits.glob("*0*"):
        file.rename(tmp_path / file.name)
    remove_path(spark, f"{lake.gold('top_posts')}/run_date={RUN:%Y-%m-%d}")
    stream_gold(spark, lake).awaitTermination()
    assert (commits / "0").exists()
    assert gold_rows(spark, lake) == before


def test_a_batch_leaves_other_partitions_alone(spark, lake):
    arrive(spark, lake, RUN, posts("x", 4))
    stream_silver(spark, lake).awaitTermination()
    stream_gold(spark, lake).awaitTermination()
    files = set(read_gold(spark, lake.gold("top_posts"), "top_posts").inputFiles())
    arrive(spark, lake, NEXT, posts("y", 2))
    stream_silver(spark, lake).awaitTermination()
    stream_gold(spark, lake).awaitTermination()
    assert files < set(read_gold(spark, lake.gold("top_posts"), "top_posts").inputFiles())


@pytest.mark.parametrize("limit", [0, 100])
def test_partition_lists_too_long_to_broadcast(spark, lake, monkeypatch, limit):
    monkeypatch.setattr(load_module, "BROADCAST_ROWS", limit)
    arrive(spark, lake, RUN, posts("x", 4) + posts("y", 2))
    stream_silver(spark, lake).awaitTermination()
    silver = read_silver(spark, lake.silver)
    only_x = load_module.in_partitions_of(silver.where("subreddit = 'x'"))(silver)
    assert only_x.columns == silver.columns
    assert {r.subreddit for r in only_x.collect()} == {"x"}
    assert load_module.in_partitions_of(silver.limit(0))(silver).count() == 0


def test_the_state_of_gold_is_cut_by_its_keys(spark, lake):
    """Each partition of the state costs every batch a task and a commit."""
    own = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        arrive(spark, lake, RUN, posts("x", 3) + posts("y", 2))
        stream_silver(spark, lake).awaitTermination()
        stream_gold(spark, lake).awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "24"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", own)
    states = spark._jvm.java.io.File(f"{lake.checkpoint('gold_state')}/state/0").list()
    assert len([s for s in states if s.isdigit()]) == 8
    assert read_gold(spark, lake.gold("top_posts"), "top_posts").count() == 5


def test_tasks_of_the_silver_stream_read_many_files(spark, lake):
    """A task leaves a file a community, whatever a session reads at a time; its own settings stay."""
    arrive(spark, lake, RUN, [p for c in "xy" for p in posts(c, 64)], slices=32)
    read, own = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(read, "1k")
    try:
        stream_silver(spark, lake).awaitTermination()
        assert spark.conf.get(read) == "1k"
    finally:
        spark.conf.set(read, own)
    silver = read_silver(spark, lake.silver)
    assert silver.count() == 128
    bronze = {f for f in spark.read.text(lake.bronze).inputFiles()}
    assert len(silver.inputFiles()) < len(bronze) / 2


def test_statistics_that_are_merged_are_finished_alike(spark, lake):
    arrive(spark, lake, RUN, posts("x", 9) + [post("n", subreddit="x", score=None, num_comments=None)])
    stream_silver(spark, lake).awaitTermination()
    partials = G.daily_partials(read_silver(spark, lake.silver))
    finished = G.finish_partials(partials)
    assert finished.collect() == G.merge_partials(partials).collect() and finished.count() == 1
