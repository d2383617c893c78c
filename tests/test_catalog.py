from __future__ import annotations

import re

import pytest

from agoralake.config import GOLD_DATASETS, Lake
from agoralake.operators.analytics import engagement_by_date
from agoralake.plans.catalog import (
    create_database,
    create_table_from_parquet,
    create_views,
    discover_partitions,
    list_databases,
    register_temp_views,
    setup,
)
from agoralake.plans.load import load, run
from agoralake.plans.reports import Reports
from agoralake.sources import read_gold
from rows import RUN, listing, post


@pytest.fixture
def loaded(spark, lake):
    posts = [post(f"{c}{i}", subreddit=c, score=i) for c in ("x", "y") for i in range(3)]
    run(spark, listing(spark, *posts), lake, RUN)
    return lake


def test_database(spark, lake):
    assert lake.database not in list_databases(spark)
    assert create_database(spark, lake.database, lake.table("db"))
    assert create_database(spark, lake.database, lake.table("db"))
    assert lake.database in list_databases(spark)


PARTITIONS = [
    {"name": "run_date", "type": "date"},
    {"name": "run_id", "type": "string"},
    {"name": "subreddit", "type": "string"},
]


def test_table_kinds(spark, loaded):
    def register(name, dataset):
        place = loaded.gold(dataset)
        return create_table_from_parquet(spark, name, place, loaded.database, PARTITIONS)

    assert register("my_daily_stats", "daily_stats")
    assert register("top_posts_2024", "top_posts")
    assert register("all_top_commented", "top_commented")
    assert not register("something_else", "daily_stats")
    table = spark.table(f"{loaded.database}.my_daily_stats")
    assert len(table.columns) == 12 + 2
    assert table.count() == 2
    assert spark.table(f"{loaded.database}.top_posts_2024").count() == 6


def test_unpartitioned_table(spark, lake, tmp_path):
    place = str(tmp_path / "plain")
    df = spark.sql(
        "SELECT date'2024-01-01' AS date, 5L AS id_count, 2.5D AS score_mean, 'x' AS subreddit"
    )
    df.write.parquet(place)
    assert create_table_from_parquet(spark, "daily_stats", place, lake.database)
    row = spark.table(f"{lake.database}.daily_stats").first()
    assert (row.id_count, row.subreddit, row.score_max) == (5, "x", None)


def test_partitions_are_discovered(spark, loaded):
    create_table_from_parquet(
        spark, "daily_stats", loaded.gold("daily_stats"), loaded.database, PARTITIONS
    )
    run(spark, listing(spark, post()), loaded, RUN.replace(hour=5))
    table = f"{loaded.database}.daily_stats"
    assert spark.table(table).count() == 2
    discover_partitions(spark, loaded.database, "daily_stats")
    assert spark.table(table).count() == 3


def test_setup_before_any_data(spark, lake):
    first = {r.table: r.ok for r in setup(spark, lake).collect()}
    assert len(first) == 9 and all(first.values())
    assert spark.table(f"{lake.database}.bronze_posts").count() == 0
    again = setup(spark, lake)
    assert all(r.ok for r in again.collect())


def test_one_failure_does_not_stop_setup(spark, loaded):
    create_database(spark, loaded.database, loaded.table("db"))
    spark.sql(f"CREATE VIEW {loaded.database}.top_posts AS SELECT 1 AS one")
    rows = {r.table: r for r in setup(spark, loaded).collect()}
    assert not rows["reddit_top_posts"].ok and rows["reddit_top_posts"].message
    assert rows["reddit_top_commented"].ok and rows["bronze_posts"].ok


def test_views(spark, loaded):
    setup(spark, loaded)
    create_views(spark, loaded.database)
    view = spark.table(f"{loaded.database}.reddit_engagement_metrics")
    assert view.columns == [
        "date",
        "subreddit",
        "post_count",
        "avg_score",
        "total_score",
        "avg_comments",
        "total_comments",
        "avg_upvote_ratio",
    ]
    assert [(r.subreddit, r.total_score) for r in engagement_by_date(view).collect()] == [
        ("x", 3),
        ("y", 3),
    ]
    frames = [read_gold(spark, loaded.gold(d), d) for d in GOLD_DATASETS]
    register_temp_views(*frames)
    assert spark.table("reddit_engagement_metrics").columns == view.columns
    assert spark.table("reddit_top_posts").count() == 6
    for name in ("reddit_engagement_metrics", "reddit_top_posts", "reddit_top_commented"):
        spark.catalog.dropTempView(name)


def test_reports(spark, loaded):
    setup(spark, loaded)
    reports = Reports(spark, loaded.database)
    assert [r.subreddit for r in reports.engagement_by_date().collect()] == ["x", "y"]
    assert [r.id for r in reports.top_posts("x", limit=2).collect()] == ["x2", "x1"]
    assert reports.active_discussions("y", "2024-01-02").count() == 0
    assert reports.length_vs_engagement().count() == 2
    assert reports.community("y")["top_posts"].count() == 3
    assert reports.preview()["discussions"].collect() == []
    text = reports.top_posts("x")._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: .*subreddit.* = x", text)


def test_names_and_paths_are_quoted(spark, tmp_path):
    lake = Lake(str(tmp_path / "it's here"), "t_select")
    run(spark, listing(spark, post()), lake, RUN)
    load(spark, lake)
    assert all(r.ok for r in setup(spark, lake).collect())
    assert spark.table("t_select.top_posts").count() == 1
