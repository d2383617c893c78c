"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from agoralake import Lake
from agoralake.config import GOLD_DATASETS
from agoralake.operators import analytics as A
from agoralake.operators import gold as G
from agoralake.operators.listing import build_documents, stamp_posts, take_listing
from agoralake.operators.silver import clean_posts, unnest_posts
from agoralake.plans.load import run, run_prefix
from agoralake.sources import good_documents, read_documents, read_gold, read_silver
from agoralake.sources.event_posts import listing_from_tables
from rows import RUN

FOLDER = "/root/testdata/sf0.001"
TEXTS = ("title:", "selftext:", "url:")


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def tree(df) -> str:
    return plan(df).split("\n\n\n")[0]


def scans(df) -> list[str]:
    return re.findall(r"ReadSchema: (.*)", plan(df))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("plans") / "lake"))
    run(spark, listing_from_tables(spark, FOLDER), lake, RUN, post_limit=None)
    return lake


def test_bronze_to_silver_does_not_shuffle(spark, stored):
    documents = read_documents(spark, stored.bronze)
    text = tree(clean_posts(unnest_posts(good_documents(documents))))
    assert "Exchange" not in text


def test_a_run_reads_its_own_prefix(spark, stored):
    text = plan(read_silver(spark, stored.silver, run_prefix(RUN)))
    assert re.search(r"Location: .*run_date=2024-01-31/run_id=20240131_020000\]", text)


def test_daily_stats_scan_numbers_only_and_combine_before_the_shuffle(spark, stored):
    df = G.daily_stats(read_silver(spark, stored.silver))
    text = tree(df)
    assert text.count("Exchange") == 1
    assert text.count("HashAggregate") == 2 and "Sort" not in text
    assert not any(t in s for s in scans(df) for t in TEXTS)
    assert "IsNotNull(date)" in plan(df)


@pytest.mark.parametrize("build", [G.top_posts, G.top_commented])
def test_top_lists_cut_before_each_shuffle(spark, stored, build):
    text = plan(build(read_silver(spark, stored.silver)))
    limits = re.findall(r"row_number\(\), 20, (\w+)", text)
    assert sorted(limits) == ["Final", "Final", "Partial", "Partial"]


def test_bounded_documents_reuse_the_listing_shuffle(spark):
    posts = stamp_posts(take_listing(listing_from_tables(spark, FOLDER)), RUN)
    bounded, folded = tree(posts), tree(build_documents(posts, RUN, together=True))
    assert folded.count("Exchange") == bounded.count("Exchange")


def test_filters_reach_the_gold_scan(spark, stored):
    metrics = A.engagement_metrics(
        read_gold(spark, stored.gold("daily_stats"), "daily_stats")
    )
    text = plan(A.engagement_by_date(metrics, "click", "2024-01-10", "2024-01-20"))
    assert re.search(r"PartitionFilters: .*subreddit.* = click", text)
    assert "GreaterThanOrEqual(date,2024-01-10)" in text
    assert "LessThanOrEqual(date,2024-01-20)" in text


def test_best_posts_is_a_top_n_without_bodies(spark, stored):
    df = A.best_posts(read_gold(spark, stored.gold("top_posts"), "top_posts"))
    assert "TakeOrderedAndProject" in tree(df) and "Exchange" not in tree(df)
    assert "selftext" not in scans(df)[0]


def test_length_report_reads_lengths_not_texts(spark, stored):
    tops = [read_gold(spark, stored.gold(d), d) for d in GOLD_DATASETS[1:]]
    df = A.length_vs_engagement(*tops, "click")
    assert len(scans(df)) == 2
    assert not any(t in s for s in scans(df) for t in TEXTS)
    assert len(re.findall(r"PartitionFilters: .*subreddit.* = click", plan(df))) == 2
