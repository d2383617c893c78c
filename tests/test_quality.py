from __future__ import annotations

from datetime import datetime

import pytest

from agoralake.config import GOLD_DATASETS
from agoralake.operators import gold as G
from agoralake.operators.silver import clean_posts
from agoralake.plans.load import run
from agoralake.plans.quality import layer_report
from agoralake.sinks import write_documents, write_gold, write_silver
from rows import RUN, envelope, envelopes, listing, post, unnested


def report(spark, lake, **options):
    return {r.layer: r for r in layer_report(spark, lake, **options).collect()}


def test_missing_layers(spark, lake):
    write_silver(clean_posts(unnested(spark, post())), lake.silver)
    rows = report(spark, lake)
    assert {n: (r.exists, r.record_count, r.file_count) for n, r in rows.items()} == {
        "bronze": (False, 0, 0),
        "silver": (True, 1, 1),
        "gold": (False, 0, 0),
    }
    assert {r.status for r in rows.values()} == {"failure"}
    assert rows["bronze"].newest_record is None


def test_an_empty_layer_warns(spark, lake):
    posts = clean_posts(unnested(spark, post()))
    write_documents(envelopes(spark, envelope("x", [post()])), lake.bronze)
    write_silver(posts.limit(0), lake.silver)
    for dataset in GOLD_DATASETS:
        build = {"daily_stats": G.daily_stats, "top_posts": G.top_posts}.get(
            dataset, G.top_commented
        )
        write_gold(build(posts), lake.gold(dataset))
    rows = report(spark, lake)
    assert (rows["silver"].exists, rows["silver"].record_count) == (True, 0)
    assert {r.status for r in rows.values()} == {"warning"}


def test_file_counts_equal_the_storage(spark, lake, tmp_path):
    posts = [post(f"{c}{k}", subreddit=c) for c in ("x", "y", "z") for k in range(9)]
    run(spark, listing(spark, *posts).repartition(5), lake, RUN, max_posts=4)
    root = tmp_path / "lake"
    stored = {
        layer: sum(1 for f in (root / layer).rglob("part-*") if f.is_file())
        for layer in ("bronze", "silver", "gold")
    }
    rows = report(spark, lake)
    assert {layer: r.file_count for layer, r in rows.items()} == stored
    assert rows["bronze"].record_count == rows["silver"].record_count == 27
    assert not (root / "_staging").exists() or not list((root / "_staging").iterdir())


def test_one_missing_gold_dataset_is_a_failure(spark, lake):
    posts = clean_posts(unnested(spark, post()))
    write_documents(envelopes(spark, envelope("x", [post()])), lake.bronze)
    write_silver(posts, lake.silver)
    write_gold(G.daily_stats(posts), lake.gold("daily_stats"))
    rows = report(spark, lake)
    assert (rows["gold"].exists, rows["gold"].record_count) == (False, 1)
    assert {r.status for r in rows.values()} == {"failure"}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_broken_documents_count_as_files_without_records(spark, lake, tmp_path, ansi):
    write_documents(envelopes(spark, envelope("x", [post()])), lake.bronze)
    folder = tmp_path / "lake/bronze/reddit/run_date=2024-01-31/run_hour=02/run_id=b/community=y"
    folder.mkdir(parents=True)
    (folder / "part.json").write_text("{broken")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        bronze = report(spark, lake)["bronze"]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert (bronze.record_count, bronze.file_count) == (1, 2)


def test_healthy_lake(spark, lake):
    start = datetime.now()
    posts = [post(f"{c}{i}", subreddit=c) for c in ("x", "y") for i in range(30)]
    run(spark, listing(spark, *posts), lake, RUN)
    run(spark, listing(spark, post()), lake, RUN.replace(day=30))
    rows = report(spark, lake, report_ts="2024-02-01T00:00:00")
    assert {n: (r.exists, r.record_count, r.file_count) for n, r in rows.items()} == {
        "bronze": (True, 61, 3),
        "silver": (True, 61, 3),
        "gold": (True, 3 + 41 + 41, 9),
    }
    assert {r.status for r in rows.values()} == {"success"}
    assert {r.newest_record for r in rows.values()} == {RUN}
    assert {r.report_ts for r in rows.values()} == {datetime(2024, 2, 1)}
    assert all((r.newest_file - start).total_seconds() > -2 for r in rows.values())
    day = report(spark, lake, run_date=RUN.date().replace(day=30))
    assert {n: r.record_count for n, r in day.items()} == {"bronze": 1, "silver": 1, "gold": 3}
    idle = report(spark, lake, run_date=RUN.date().replace(day=29))
    assert {(r.exists, r.record_count, r.status) for r in idle.values()} == {(True, 0, "warning")}
