from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from agoralake.operators import listing as listing_module
from agoralake.operators.listing import take_listing
from agoralake.operators.topk import first_by_place, place_bounds
from agoralake.plans.load import extract
from agoralake.sources import good_documents, read_documents
from rows import RUN, listing, post

SCHEMA = "community string, place bigint, id string"


def in_order(row):
    return (row[1] is None, row[1] or 0, row[2])


def expected(rows, k):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    return sorted(
        (r for g in groups.values() for r in sorted(g, key=in_order)[:k]),
        key=lambda r: (r[0] or "", in_order(r)),
    )


def made(seed):
    """Communities with places in a row, far apart, below zero, shared by many, and missing."""
    draw = random.Random(seed)
    rows = [("hot", i, f"h{i}") for i in range(600)]
    rows += [("far", draw.randrange(-(2**62), 2**62), f"f{i}") for i in range(200)]
    rows += [("same", draw.choice([-5, 7, 7, 7, 8]), f"s{i}") for i in range(200)]
    rows += [("none", None, f"n{i}") for i in range(80)]
    rows += [("some", draw.choice([None, i]), f"m{i}") for i in range(120)]
    rows += [(None, draw.randrange(50), f"u{i}") for i in range(90)]
    rows += [("ends", x, f"e{i}") for i, x in enumerate([-(2**63), 2**63 - 1, 0, 1, None] * 9)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("k", [40, 80, 599])
def test_first_by_place_is_exact(spark, k, ranges=8):
    rows = made(k)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = first_by_place(df, ["community"], "place", ["id"], k, ranges).collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0] or "", in_order(r))) == expected(rows, k)


def test_no_rows_and_no_bound(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert first_by_place(empty, ["community"], "place", ["id"], 5).count() == 0
    one = spark.createDataFrame([("x", 1, "a")], SCHEMA)
    assert first_by_place(one, ["community"], "place", ["id"], 0).count() == 0


def test_the_ranked_range_does_not_grow_with_the_bound(spark):
    """Of a listing of any length only one range is ranked: here of 200,000 posts at most one."""
    df = spark.range(200_000).select(
        F.lit("hot").alias("community"), F.col("id").alias("place"), F.col("id").cast("string")
    )
    for k in (20_000, 150_000):
        (bound,) = place_bounds(df, ["community"], "place", k).collect()
        assert bound["_before"] == bound["_lo"] == bound["_hi"] == k - 1
        (once,) = place_bounds(df, ["community"], "place", k, rounds=1).collect()
        assert once["_hi"] - once["_lo"] < 200_000 // 4096 + 1
        assert once["_before"] < k <= once["_before"] + once["_hi"] - once["_lo"] + 1


def test_kept_posts_are_not_sorted(spark):
    """What stands before the range reaches the result by a filter; windows see the range alone."""
    df = spark.range(5000).selectExpr("'x' AS community", "id AS place", "CAST(id AS STRING) AS id")
    kept = first_by_place(df, ["community"], "place", ["id"], 3000)
    lines = kept._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert lines[0].startswith("Union")
    cut = next(i for i, line in enumerate(lines) if line.startswith("+- "))
    ranks = [i for i, line in enumerate(lines) if "row_number" in line]
    assert ranks and min(ranks) > cut


def test_a_run_with_a_large_bound(spark, lake, monkeypatch):
    posts = [post(f"x{i:03d}", subreddit="x") for i in range(60)]
    posts += [post(f"y{i}", subreddit="y") for i in range(3)]
    monkeypatch.setattr(listing_module, "SORTED_LIMIT", 20)
    df = listing(spark, *posts).repartition(4)
    assert sorted(r.id for r in take_listing(df, 50).collect()) == [
        *[f"x{i:03d}" for i in range(50)], "y0", "y1", "y2"
    ]
    extract(df, lake, RUN, 50, max_posts=7)
    documents = good_documents(read_documents(spark, lake.bronze)).collect()
    assert max(len(d.posts) for d in documents) <= 7
    kept = sorted(p.id for d in documents for p in d.posts if d.subreddit == "x")
    assert kept == [f"x{i:03d}" for i in range(50)]
