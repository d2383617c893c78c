from __future__ import annotations

import json
from datetime import datetime

import pytest

from agoralake.config import GOLD_DATASETS
from agoralake.plans import load as load_module
from agoralake.sinks import publish as publish_module
from agoralake.sinks import publish_pending
from agoralake.plans.load import run, run_daily, run_foreign, run_summary, transform
from agoralake.sources import (
    query_to_dataframe,
    read_documents,
    read_gold,
    read_listing,
    read_silver,
)
from rows import NOON, RUN, envelope, listing, post

LATER = datetime(2024, 1, 31, 3, 30)


def raw(spark, **counts):
    posts = []
    for community, count in counts.items():
        posts += [
            post(f"{community}{i}", subreddit=community, score=i, created_utc=NOON + i * 7200)
            for i in range(count)
        ]
    return listing(spark, *posts)


def summary(df):
    return {r.subreddit: (*tuple(r)[1:6], r.ok) for r in df.collect()}


def test_run(spark, lake):
    got = summary(run(spark, raw(spark, x=30, y=2), lake, RUN, 25))
    assert got == {"x": (25, 25, 3, 20, 20, True), "y": (2, 2, 1, 2, 2, True)}


@pytest.mark.parametrize("limit", [0, 100])
def test_unbounded_run(spark, lake, monkeypatch, limit):
    """Whole listings go through the shortlist, or past it with too many communities."""
    monkeypatch.setattr(load_module, "BROADCAST_ROWS", limit)
    got = summary(run(spark, raw(spark, x=300, y=2), lake, RUN, None))
    assert got == {"x": (300, 300, 26, 20, 20, True), "y": (2, 2, 1, 2, 2, True)}
    top = read_gold(spark, lake.gold("top_posts"), "top_posts").where("subreddit = 'x'")
    assert sorted(r.score for r in top.collect()) == list(range(280, 300))


def test_communities_match_as_given_and_absent_ones_show(spark, lake):
    got = summary(run(spark, raw(spark, x=3, X=2, y=2), lake, RUN, communities=["x", "nobody"]))
    assert got == {"x": (3, 3, 1, 3, 3, True), "nobody": (0, 0, 0, 0, 0, False)}


def test_nothing_to_load(spark, lake):
    got = summary(run(spark, raw(spark, x=1), lake, RUN, communities=["nobody"]))
    assert got == {"nobody": (0, 0, 0, 0, 0, False)}


def test_runs_add_up_and_a_repeated_run_does_not(spark, lake):
    run(spark, raw(spark, x=3), lake, RUN)
    run(spark, raw(spark, x=4), lake, LATER)
    again = run(spark, raw(spark, x=3), lake, "2024-01-31T02:00:00")
    assert summary(again) == {"x": (3, 3, 1, 3, 3, True)}
    assert summary(run_summary(spark, lake, LATER)) == {"x": (4, 4, 1, 4, 4, True)}
    silver = read_silver(spark, lake.silver)
    assert sorted((r.id, r.run_ts) for r in silver.where("id = 'x0'").collect()) == [
        ("x0", RUN),
        ("x0", LATER),
    ]
    daily = read_gold(spark, lake.gold("daily_stats"), "daily_stats")
    assert sorted((r.run_ts, r.id_count) for r in daily.collect()) == [(RUN, 3), (LATER, 4)]


def test_a_repeated_run_leaves_nothing_that_is_gone(spark, lake):
    run(spark, raw(spark, x=3, y=2, z=1), lake, RUN)
    run(spark, raw(spark, y=4), lake, LATER)
    again = run(spark, raw(spark, x=3).union(raw(spark, y=1).where("score > 5")), lake, RUN)
    assert summary(again) == {"x": (3, 3, 1, 3, 3, True)}
    assert summary(run_summary(spark, lake, LATER)) == {"y": (4, 4, 1, 4, 4, True)}
    for dataset in GOLD_DATASETS:
        rows = read_gold(spark, lake.gold(dataset), dataset).where(f"run_ts = '{RUN}'")
        assert {r.subreddit for r in rows.collect()} == {"x"}


def test_a_repeated_run_of_some_communities_keeps_the_others(spark, lake):
    run(spark, raw(spark, x=3, **{"a b/c=%": 2}), lake, RUN)
    got = run(spark, raw(spark, x=1), lake, RUN, communities=["x", "a b/c=%"])
    assert summary(got) == {"x": (1, 1, 1, 1, 1, True), "a b/c=%": (0, 0, 0, 0, 0, False)}
    run(spark, raw(spark, y=2), lake, RUN, communities=["y"])
    assert set(summary(run_summary(spark, lake, RUN))) == {"x", "y"}


def _state(spark, lake):
    tables = [read_silver(spark, lake.silver).select("id", "score", "run_ts")]
    tables += [read_gold(spark, lake.gold(d), d) for d in GOLD_DATASETS]
    documents = read_documents(spark, lake.bronze).select("community", "record_count")
    return [sorted(map(str, t.collect())) for t in (documents, *tables)]


@pytest.mark.parametrize("step", ["extract", "transform", "load"])
@pytest.mark.parametrize("communities", [None, ["x"]])
def test_a_run_that_fails_leaves_the_one_before(spark, lake, monkeypatch, step, communities):
    run(spark, raw(spark, x=5, y=2), lake, RUN)
    before = _state(spark, lake)
    real = getattr(load_module, step)

    def failing(*args, **options):
        real(*args, **options)
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(load_module, step, failing)
        with pytest.raises(RuntimeError, match="stopped"):
            run(spark, raw(spark, x=3, y=1), lake, RUN, communities=communities)
    assert _state(spark, lake) == before
    assert publish_pending(spark, lake.base) == []
    again = run(spark, raw(spark, x=3, y=1), lake, RUN, communities=communities)
    assert summary(again)["x"] == (3, 3, 1, 3, 3, True)
    y = summary(run_summary(spark, lake, RUN))["y"]
    assert y == ((2, 2, 1, 2, 2, True) if communities else (1, 1, 1, 1, 1, True))


@pytest.mark.parametrize("after", [0, 1, 3, 6])
def test_publishing_that_is_cut_short_is_finished(spark, lake, monkeypatch, after):
    run(spark, raw(spark, x=5, y=2), lake, RUN)
    real, calls = publish_module._move, []

    def failing(session, source, target):
        if not source.endswith(".part"):
            calls.append(target)
            if len(calls) > after:
                raise OSError("stopped")
        real(session, source, target)

    with monkeypatch.context() as patch:
        patch.setattr(publish_module, "_move", failing)
        with pytest.raises(OSError, match="stopped"):
            run(spark, raw(spark, x=3), lake, RUN)
    assert publish_pending(spark, lake.base) == ["20240131_020000"]
    assert summary(run_summary(spark, lake, RUN)) == {"x": (3, 3, 1, 3, 3, True)}
    finished = _state(spark, lake)
    run(spark, raw(spark, x=3), lake, RUN)
    assert _state(spark, lake) == finished and publish_pending(spark, lake.base) == []


def test_a_lost_document_is_not_ok(spark, lake, tmp_path):
    run(spark, raw(spark, x=3, y=1), lake, RUN)
    (folder,) = (tmp_path / "lake/bronze/reddit").glob("*/*/*/community=x")
    text = json.dumps(envelope("x", [post(f"b{k}") for k in range(50)]))
    (folder / "part-broken.json").write_text(text[:300] + "\n")
    documents = read_documents(spark, lake.bronze)
    transform(documents, lake, "20240131_020000")
    rows = {r.subreddit: r for r in run_summary(spark, lake, RUN).collect()}
    assert (rows["x"].bronze_rows, rows["x"].silver_rows, rows["x"].quarantined) == (3, 3, 1)
    assert not rows["x"].ok and rows["y"].ok
    assert summary(run(spark, raw(spark, x=3, y=1), lake, RUN))["x"][-1]


def test_foreign_documents_that_become_empty_leave_nothing(spark, lake, tmp_path):
    place = tmp_path / "in" / "reddit" / "x"
    place.mkdir(parents=True)
    for posts in ([post("a"), post("b")], []):
        (place / "posts.json").write_text(json.dumps(envelope("x", posts), indent=2))
        run_foreign(spark, str(tmp_path / "in"), lake)
        assert read_silver(spark, lake.silver).count() == len(posts)
        for dataset in GOLD_DATASETS:
            assert read_gold(spark, lake.gold(dataset), dataset).count() <= len(posts)


def test_a_bad_field_costs_the_field(spark, lake, tmp_path):
    place = tmp_path / "in" / "reddit" / "x"
    place.mkdir(parents=True)
    posts = [post("a"), post("b", score=12.5), post("c", is_self="maybe", title=7), post("d", score="9")]
    (place / "posts.json").write_text(json.dumps(envelope("x", posts), indent=2))
    run_foreign(spark, str(tmp_path / "in"), lake)
    silver = {r.id: r for r in read_silver(spark, lake.silver).collect()}
    assert {i: r.score for i, r in silver.items()} == {"a": 1, "b": None, "c": 1, "d": 9}
    assert silver["c"].is_self is None and silver["c"].title == "7"
    aside = spark.read.json(f"{lake.quarantine}/posts").collect()
    assert sorted(r.id for r in aside) == ["b", "c"]


def test_scratch_is_removed(spark, lake, tmp_path, monkeypatch):
    used = []

    def folder(spark):
        used.append(tmp_path / f"scratch-{len(used)}")
        return str(used[-1])

    monkeypatch.setattr(load_module, "scratch_folder", folder)
    run(spark, raw(spark, x=30), lake, RUN, None)
    assert used and not any(place.exists() for place in used)


def test_lost_posts_show(spark, lake):
    run(spark, raw(spark, x=3, y=1), lake, RUN)
    document = read_documents(spark, lake.bronze).where("community = 'x'").drop("_corrupt")
    more = document.selectExpr("*").replace(3, 4, "record_count").collect()
    spark.createDataFrame(more, document.schema).write.mode("append").partitionBy(
        "run_date", "run_hour", "run_id", "community"
    ).json(lake.bronze)
    got = summary(run_summary(spark, lake, RUN))
    assert (got["x"][0], got["x"][-1], got["y"][-1]) == (7, False, True)


def test_broken_documents_do_not_stop_the_others(spark, lake, tmp_path):
    def put(community, text):
        folder = tmp_path / "in" / "reddit" / community
        folder.mkdir(parents=True)
        (folder / "posts.json").write_text(text)

    good = json.dumps(envelope("x", [post("a"), post("b", extracted_at="soon")]), indent=2)
    put("x", good)
    put("y", good[:200])
    put("z", json.dumps(envelope("z", [])))
    for _ in range(2):
        run_foreign(spark, str(tmp_path / "in"), lake)
    assert sorted(r.id for r in read_silver(spark, lake.silver).collect()) == ["a", "b"]
    for dataset in GOLD_DATASETS:
        gold = read_gold(spark, lake.gold(dataset), dataset)
        assert {r.subreddit for r in gold.collect()} == {"x"}
    documents = spark.read.json(f"{lake.quarantine}/documents").collect()
    assert [(r.reason, "/reddit/y/" in r.file_path) for r in documents] == [
        ("broken document", True)
    ]
    posts = spark.read.json(f"{lake.quarantine}/posts").collect()
    assert [(r.id, r.extracted_at) for r in posts] == [("b", "soon")]


def test_daily_round(spark, lake):
    listed = raw(spark, python=3, datascience=2, other=5)
    done = run_daily(spark, listed, lake, RUN)
    assert {s: row[-1] for s, row in summary(done["extractions"]).items()} == {
        "python": True,
        "datascience": True,
        "machinelearning": False,
    }
    assert {r.table: r.ok for r in done["setup"].collect()} == {
        "bronze_posts": True,
        "silver_posts": True,
        "gold_subreddit_stats": True,
        "daily_stats": True,
        "top_posts": True,
        "top_commented": True,
        "reddit_engagement_metrics": True,
        "reddit_top_posts": True,
        "reddit_top_commented": True,
    }
    assert {r.status for r in done["monitoring"].collect()} == {"success"}
    sql = "SELECT count(*) AS n FROM {}"

    def count(table):
        return query_to_dataframe(spark, sql.format(table), lake.database).first().n

    tables = ("bronze_posts", "silver_posts", "gold_subreddit_stats", "reddit_top_posts")
    assert [count(t) for t in tables] == [5, 5, 2, 5]
    run_daily(spark, listed, lake, LATER)
    assert [count(t) for t in tables] == [10, 10, 4, 10]


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_from_collected_files(spark, lake, tmp_path, fmt):
    for day in (1, 2):
        raw(spark, x=2).write.format(fmt).save(str(tmp_path / "raw" / str(day)))
    got = run(spark, read_listing(spark, str(tmp_path / "raw"), fmt), lake, RUN, 3)
    assert summary(got) == {"x": (3, 3, 1, 3, 3, True)}


def test_unreadable_storage_raises(spark, lake, tmp_path):
    (tmp_path / "lake").write_text("a file where the lake should be")
    with pytest.raises(Exception):
        run(spark, raw(spark, x=1), lake, RUN)
