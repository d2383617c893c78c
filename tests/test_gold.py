from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from agoralake.operators import gold as G
from agoralake.operators.silver import clean_posts
from agoralake.operators.topk import above_bounds, tie_bounds, top_k_bounds, top_k_per_group
from rows import NOON, post, unnested

DAY = 86400.0


def silver(spark, *posts):
    return clean_posts(unnested(spark, *posts))


def test_daily_stats(spark):
    rows = G.daily_stats(
        silver(
            spark,
            post("a", score=1, num_comments=2, title="ab", upvote_ratio=0.25),
            post("b", score=4, num_comments=None, title=None, upvote_ratio=0.75),
            post(None, score=1, num_comments=4, title="abcd", upvote_ratio=None),
            post("d", created_utc=NOON + DAY, score=7),
            post("e", created_utc=None, score=100),
        )
    ).orderBy("date")
    first, second = rows.collect()
    assert (first.date, first.id_count, first.subreddit) == (date(2024, 1, 1), 2, "x")
    assert (first.score_mean, first.score_max, first.score_sum) == (2.0, 4, 6)
    assert (first.num_comments_mean, first.num_comments_max, first.num_comments_sum) == (3.0, 4, 6)
    assert (first.title_length_mean, first.selftext_length_mean) == (3.0, 4.0)
    assert first.upvote_ratio_mean == 0.5
    assert (second.date, second.id_count, second.score_sum) == (date(2024, 1, 2), 1, 7)


def test_merged_partials_equal_the_whole(spark):
    chance = random.Random(5)
    posts = [
        post(
            str(i),
            subreddit=chance.choice("xxxy"),
            score=chance.choice([None, i]),
            num_comments=None if i % 4 else i,
            created_utc=NOON + DAY * (i % 5),
            title=chance.choice([None, "t" * i]),
            upvote_ratio=i / 64,
        )
        for i in range(60)
    ]
    parts = [G.daily_partials(silver(spark, *posts[i::3])) for i in range(3)]
    merged = G.merge_partials(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    whole = G.daily_stats(silver(spark, *posts))
    assert merged.dtypes == whole.dtypes
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))


def test_day_without_numbers(spark):
    row = G.daily_stats(silver(spark, post(score=None, num_comments=None))).first()
    assert (row.score_sum, row.score_max, row.score_mean) == (0, None, None)
    assert (row.num_comments_sum, row.num_comments_max, row.num_comments_mean) == (0, None, None)


def test_runs_and_communities_stay_apart(spark):
    later = datetime(2024, 2, 1)
    posts = silver(spark, post(), post(subreddit="y"), post(run_ts=later))
    keys = {(r.subreddit, r.run_ts, r.id_count) for r in G.daily_stats(posts).collect()}
    assert len(keys) == 3 and {k[2] for k in keys} == {1}
    assert G.top_posts(posts, 1).count() == 3


def test_top_ties_and_nulls(spark):
    posts = silver(
        spark,
        post("c", score=5),
        post("b", score=5),
        post("a", score=None),
        post("d", score=9),
        post("e", score=-1),
    )
    ids = [[r.id for r in G.top_posts(posts, k).orderBy(
        F.desc_nulls_last("score"), "id").collect()] for k in (2, 4, 9)]
    assert ids == [["d", "b"], ["d", "b", "c", "e"], ["d", "b", "c", "e", "a"]]
    assert G.top_posts(posts, 0).count() == 0


def test_subreddit_stats(spark):
    row = G.subreddit_stats(G.daily_stats(silver(spark, post(score=3, num_comments=2)))).first()
    assert row.asDict() == {
        "subreddit": "x",
        "date": date(2024, 1, 1),
        "post_count": 1,
        "avg_score": 3.0,
        "total_comments": 2,
        "avg_post_length": 4.0,
    }


@pytest.mark.parametrize("salts", [1, 3, 256])
@pytest.mark.parametrize("k", [1, 7, 50])
def test_top_k_with_one_hot_group_equals_brute_force(spark, salts, k):
    chance = random.Random(7)
    rows = [
        ("hot" if chance.random() < 0.7 else f"g{chance.randrange(40)}", chance.randrange(30), i)
        for i in range(4000)
    ]
    df = spark.createDataFrame(rows, "g string, v bigint, id bigint").repartition(13)
    got = top_k_per_group(df, ["g"], [F.desc("v"), F.asc("id")], k, salts)
    want = defaultdict(list)
    for row in sorted(rows, key=lambda r: (-r[1], r[2])):
        if len(want[row[0]]) < k:
            want[row[0]].append(row)
    assert got.columns == ["g", "v", "id"]
    assert sorted(map(tuple, got.collect())) == sorted(r for kept in want.values() for r in kept)


@pytest.mark.parametrize("k", [1, 5, 20])
def test_shortlist_loses_no_top_row(spark, k):
    chance = random.Random(k)
    rows = []
    for i in range(6000):
        group = None if i % 50 == 0 else "hot" if chance.random() < 0.7 else f"g{i % 60}"
        score = None if chance.random() < 0.1 or group == "g7" else chance.randrange(10**6)
        rows.append((group, score, chance.randrange(5), str(i % 5500)))
    df = spark.createDataFrame(rows, "g string, score bigint, few bigint, id string")
    kept = above_bounds(
        df, top_k_bounds(df, ["g"], ["score", "few"], k), ["g"], ["score", "few"]
    )
    assert kept.columns == df.columns
    for metric in ("score", "few"):
        order = [F.desc_nulls_last(metric), F.asc("id"), F.asc("score"), F.asc("few")]
        want = top_k_per_group(df, ["g"], order, k).collect()
        assert sorted(map(str, top_k_per_group(kept, ["g"], order, k).collect())) == sorted(
            map(str, want)
        )
    by_score = above_bounds(df, top_k_bounds(df, ["g"], ["score"], k), ["g"], ["score"])
    assert by_score.where("g = 'hot'").count() < 4 * k + 20


@pytest.mark.parametrize("k", [1, 5, 20])
def test_shortlist_holds_few_of_many_equal_rows(spark, k):
    chance = random.Random(k)
    rows = []
    for i in range(6000):
        group = chance.choice([None, "same", "few", "mixed"])
        score = {"same": 7, "few": chance.randrange(3), None: chance.randrange(2)}.get(group, chance.randrange(10**6))
        rows.append((group, score, None if i % 9 == 0 else i % 4, f"{i % 5500:04d}"))
    rows += [("small", 1, 1, None), ("small", 1, 1, "x"), ("small", None, 2, "y")]
    df, metrics = spark.createDataFrame(rows, "g string, score bigint, few bigint, id string"), ["score", "few"]
    bounds = tie_bounds(df, top_k_bounds(df, ["g"], metrics, k), ["g"], metrics, k)
    kept = above_bounds(df, bounds, ["g"], metrics)
    assert kept.columns == df.columns
    assert kept.where("g is null or g in ('same', 'few')").count() <= 3 * 2 * (2 * k + 20)
    for metric in metrics:
        order = [F.desc_nulls_last(metric), F.asc_nulls_last("id"), F.asc("score"), F.asc("few")]
        want, got = (sorted(map(str, top_k_per_group(d, ["g"], order, k).collect())) for d in (df, kept))
        assert got == want


def test_no_left_out_post_outranks_a_kept_one(spark):
    chance = random.Random(3)
    posts = silver(spark, *[post(str(i), score=chance.randrange(9)) for i in range(200)])
    kept = {(r.score, r.id) for r in G.top_posts(posts).collect()}
    left = {(r.score, r.id) for r in posts.collect()} - kept
    assert len(kept) == 20
    worst = min(kept, key=lambda p: (p[0], [-ord(c) for c in p[1]]))
    assert all((s, i) == worst or s < worst[0] or (s == worst[0] and i > worst[1]) for s, i in left)
    stats = G.daily_stats(posts).agg(F.sum("id_count")).first()[0]
    assert stats == 200
