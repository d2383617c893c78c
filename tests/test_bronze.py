from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from agoralake.operators.listing import build_documents, stamp_posts, take_listing
from agoralake.operators.silver import unnest_posts
from agoralake.plans.load import extract
from agoralake.schemas import ENVELOPE, POST
from agoralake.sinks import write_documents
from agoralake.sources import large_documents
from agoralake.sources import (
    good_documents,
    path_community,
    quarantined_documents,
    read_documents,
    read_foreign_documents,
)
from rows import RUN, envelope, listing, post


def raw(spark, *per_community):
    posts = []
    for community, count in per_community:
        posts += [post(f"{community}{i:03d}", subreddit=community) for i in range(count)]
    return listing(spark, *posts)


def test_listing_is_bounded_per_community_in_listing_order(spark):
    df = take_listing(raw(spark, ("x", 30), ("y", 3)), 5)
    ids = sorted(r.id for r in df.collect())
    assert ids == [f"x{i:03d}" for i in range(5)] + [f"y{i:03d}" for i in range(3)]
    assert take_listing(raw(spark, ("x", 3)), 0).count() == 0
    assert take_listing(raw(spark, ("x", 300))).count() == 100
    assert take_listing(raw(spark, ("x", 300)), None).count() == 300


def test_stamp(spark):
    df = stamp_posts(raw(spark, ("x", 1)).withColumn("author", F.lit(None)), RUN)
    row = df.first()
    assert df.columns == [*POST.fieldNames(), "subreddit", "source", "listing_rank"]
    assert (row.extracted_at, row.author, row.source) == ("2024-01-31T02:00:00", None, "forum")
    unnamed = stamp_posts(raw(spark, ("x", 1)).drop("source"), RUN).first()
    assert unnamed.source == "reddit"


def test_author_objects_become_names(spark):
    account = F.struct(F.lit("ann").alias("name"), F.lit(7).alias("karma"))
    person = F.when(F.col("id") == "x000", account)
    posts = stamp_posts(raw(spark, ("x", 2)).withColumn("author", person), RUN)
    assert {r.id: r.author for r in posts.collect()} == {"x000": "ann", "x001": None}


def test_one_document_per_community(spark):
    posts = stamp_posts(raw(spark, ("x", 12), ("y", 2)).repartition(5), RUN)
    documents = build_documents(posts, RUN)
    assert documents.columns == ENVELOPE.fieldNames()
    rows = {r.subreddit: r for r in documents.collect()}
    assert {s: r.record_count for s, r in rows.items()} == {"x": 12, "y": 2}
    assert [p.id for p in rows["x"].posts] == [f"x{i:03d}" for i in range(12)]


def test_unbounded_documents_stay_small_and_whole(spark):
    posts = stamp_posts(raw(spark, ("x", 95), ("y", 2)).repartition(3), RUN)
    documents = build_documents(posts, RUN, max_posts=10).collect()
    assert max(d.record_count for d in documents) == 10
    assert all(d.record_count == len(d.posts) for d in documents)
    ids = sorted(p.id for d in documents for p in d.posts)
    assert ids == sorted([f"x{i:03d}" for i in range(95)] + ["y000", "y001"])


@pytest.mark.parametrize("limit", [None, 1000, 1001, 3000])
def test_the_listing_bound_does_not_change_what_a_document_is(spark, lake, limit):
    extract(raw(spark, ("x", 2500), ("y", 3)), lake, RUN, limit, max_posts=800)
    rows = read_documents(spark, lake.bronze).select("community", "record_count", "posts.id").collect()
    sizes = sorted(r.record_count for r in rows if r.community == "x")
    total = min(limit or 2500, 2500)
    assert sum(sizes) == total and max(sizes) <= 800 and len(sizes) == -(-total // 800)
    places = sorted(r.id for r in rows if r.community == "x")
    assert [i for ids in places for i in ids] == sorted(f"x{i:03d}" for i in range(total)) or total > 1000


def test_communities_that_arrive_in_pieces_are_gathered(spark, lake):
    names = [f"c{k:03d}" for k in range(100)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        posts = raw(spark, *[(name, 20) for name in names]).repartition(16)
        extract(posts, lake, RUN, None)
        documents = read_documents(spark, lake.bronze)
        assert documents.count() == 100 and len(documents.inputFiles()) == 100
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_long_texts_make_more_documents(spark):
    posts = [post(f"p{i:02d}", title="", selftext="\u00fc" * 50 * (i % 4)) for i in range(40)]
    stamped = stamp_posts(listing(spark, *posts).coalesce(1), RUN)
    documents = build_documents(stamped, RUN, max_text=1000).collect()
    sizes = [[len(p.selftext.encode()) for p in d.posts] for d in documents]
    assert sum(map(len, sizes)) == 40 and len(documents) > 4
    assert all(sum(size[:-1]) < 1000 for size in sizes)


def test_json_round_trip(spark, lake):
    posts = stamp_posts(
        listing(
            spark,
            post("a", title='quote " back \\ line\n tab\t', selftext="\U0001f600\u3000", author=None),
            post("b", subreddit="c++ & co/1", score=None, created_utc=1.5e9),
        ),
        RUN,
    )
    write_documents(build_documents(posts, RUN), lake.bronze)
    documents = read_documents(spark, lake.bronze)
    back = unnest_posts(good_documents(documents)).orderBy("id")
    want = posts.orderBy("id").select(*POST.fieldNames(), "subreddit").collect()
    assert back.select(*POST.fieldNames(), "subreddit").collect() == want
    row = documents.where("community = 'x'").first()
    assert (str(row.run_date), row.run_hour, row.run_id) == ("2024-01-31", "02", "20240131_020000")
    assert quarantined_documents(documents).count() == 0


def test_a_repeated_write_replaces_its_run_only(spark, lake):
    def write(count, run_ts):
        posts = stamp_posts(raw(spark, ("x", count)), run_ts)
        write_documents(build_documents(posts, run_ts), lake.bronze)

    write(5, RUN)
    write(3, RUN.replace(hour=3))
    write(4, RUN)
    counts = read_documents(spark, lake.bronze).select("run_id", "record_count").collect()
    assert sorted(map(tuple, counts)) == [("20240131_020000", 4), ("20240131_030000", 3)]


@pytest.fixture
def foreign(tmp_path):
    """Indented documents in another writer's layout, one of them cut off."""

    def put(community, text, name="posts"):
        folder = tmp_path / "foreign" / "reddit" / community / "2024" / "01" / "31" / "02"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}_20240131_020000.json").write_text(text)

    good = json.dumps(envelope("x", [post("a"), post("b")]), indent=2)
    put("x", good)
    put("x", json.dumps(envelope("x", [post("c")], "not a time"), indent=2), "untimed")
    put("y", good[: len(good) // 2])
    put("z", json.dumps(envelope("z", []), indent=2))
    put("data science", json.dumps(envelope(None, [post("d")]), indent=2))
    return str(tmp_path / "foreign")


@pytest.mark.parametrize("above", [1 << 26, 0])
def test_foreign_documents(spark, foreign, above):
    documents = read_foreign_documents(spark, foreign, split_above=above)
    posts = unnest_posts(good_documents(documents))
    assert sorted((r.subreddit, r.id) for r in posts.collect()) == [
        ("data science", "d"),
        ("x", "a"),
        ("x", "b"),
    ]
    bad = {r.reason: r for r in quarantined_documents(documents).collect()}
    assert set(bad) == {"broken document", "no run time"}
    assert "/reddit/y/" in bad["broken document"].file_path
    assert '"source": "forum"' in bad["broken document"].document
    assert '"id":"c"' in bad["no run time"].document


def test_large_documents_equal_whole_ones(spark, tmp_path):
    """Splits cut anywhere; strings hold whatever looks like structure; other values nest."""
    odd = ['}, {"posts": [', 'a\\', '\\"', '"', "\n\u2028\t{[", "posts", "", "\\\\\"}]", "\u00e9\U0001f600"]
    rows = [post(f"p{i}", title=odd[i % 9], selftext=odd[i * 5 % 9] * (i % 7)) for i in range(2300)]
    for row in rows[::50]:
        row["meta"] = {"deep": [{"posts": [1, {"id": "no"}]}]}
    base = envelope("x", rows)
    meta = {"posts": [{"id": "inner"}], "list": [[1], [{"a": {}}]]}
    ahead = {"note": 'say "posts": [', "meta": meta, **base, "after": [{"id": "later"}, 3]}
    texts = {
        "two": json.dumps(base, indent=2),
        "none": json.dumps(base),
        "tabs": json.dumps(ahead, indent="\t"),
        "close": json.dumps(ahead, indent=1).replace("},\n  {\n", "}, {\n").replace('"posts": [\n  {', '"posts" : [ {'),
        "empty": json.dumps({**base, "posts": []}, indent=2),
        "absent": json.dumps({"source": "forum", "extracted_at": "2024-01-31T02:00:00", "subreddit": "x"}, indent=2),
        "cut": json.dumps(base, indent=2)[:-30],
        "garbled": json.dumps(base, indent=2).replace('"id": "p1700",', '"id" "p1700",'),
        "numbers": json.dumps({**base, "posts": [1, 2]}, indent=2),
    }
    for name, text in texts.items():
        folder = tmp_path / "in" / "reddit" / "x" / name
        folder.mkdir(parents=True)
        (folder / "d.json").write_text(text, encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    whole = read_foreign_documents(spark, str(tmp_path / "in"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        split = read_foreign_documents(spark, str(tmp_path / "in"), split_above=0)
        got, want = (
            sorted(
                (r.file_path.split("/")[-2], json.dumps(r.p.asDict() if r.p else None))
                for r in good_documents(d).select("file_path", F.explode_outer("posts").alias("p")).collect()
            )
            for d in (split, whole)
        )
        pieces = {r.n for r in good_documents(split).select(F.size("posts").alias("n")).collect()}
        lost, lost_whole = (
            sorted((r.file_path.split("/")[-2], r.reason) for r in quarantined_documents(d).collect())
            for d in (split, whole)
        )
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == want and len(got) > 4 * 2300 and pieces >= {1000, 300}
    assert lost == lost_whole and {r[0] for r in lost} == {"cut", "garbled", "numbers"}


def put_large(path, count, **fields):
    rows = [post(f"p{i}", title='}, {"posts": [', selftext="\\" * (i % 3), **fields) for i in range(count)]
    path.mkdir(parents=True)
    (path / "d.json").write_text(json.dumps(envelope("x", rows), indent=2), encoding="utf-8")


def shuffled(plan):
    return "Exchange" in plan.replace("BroadcastExchange", "")


@pytest.mark.parametrize("split", ["20000", "128m"])
def test_large_documents_are_read_alike_with_stored_steps(spark, tmp_path, split):
    for name, count in (("a", 1300), ("b", 1), ("c", 0)):
        put_large(tmp_path / "in" / "reddit" / "x" / name, count)
    (tmp_path / "in" / "reddit" / "x" / "d").mkdir()
    text = (tmp_path / "in" / "reddit" / "x" / "a" / "d.json").read_text()
    (tmp_path / "in" / "reddit" / "x" / "d" / "d.json").write_text(text.replace('"id": "p7"', '"id" "p7"'))
    whole = read_foreign_documents(spark, str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        folder = tmp_path / "scratch"
        stored = read_foreign_documents(spark, str(tmp_path / "in"), split_above=0, folder=str(folder))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [p.name for p in folder.iterdir()] == ["documents"]
    got, want = (
        sorted((r.file_path, str(r.p)) for r in good_documents(d).select("file_path", F.explode_outer("posts").alias("p")).collect())
        for d in (stored, whole)
    )
    assert got == want and len(got) == 1302
    sizes = sorted(r.n for r in good_documents(stored).select(F.size("posts").alias("n")).collect())
    assert sizes == [0, 1, 300, 1000]
    (lost,) = quarantined_documents(stored).collect()
    assert lost.reason == "broken document" and "/x/d/" in lost.file_path


def test_posts_inside_a_split_are_not_shuffled(spark, tmp_path):
    """Only what a split's ends may cut is gathered from several tasks."""
    put_large(tmp_path / "in" / "a", 2500)
    lines = large_documents._lines(spark, str(tmp_path / "in"), "*.json", 0)
    rows = lines.crossJoin(F.broadcast(spark.range(1).select(*[F.lit(0).alias(c) for c in ("base", "sections", "records")])))
    parts = large_documents._parts(large_documents._tokens(rows).drop("line", "pos"))
    assert not shuffled(parts._jdf.queryExecution().executedPlan().toString())
    kept = [(r.whole, r.n) for r in parts.where("piece IS NOT NULL").select("whole", F.size("texts").alias("n")).collect()]
    assert sorted(kept) == [(True, 500), (True, 1000), (True, 1000)]


@pytest.mark.parametrize(
    "path, community",
    [
        ("s3a://b/silver/reddit/python/2024/01/31/f.parquet", "python"),
        ("file:/l/bronze/reddit/data%20science/2024/f.json", "data science"),
        ("file:/l/bronze/reddit/c++/2024/f.json", "c++"),
        ("file:/l/silver/reddit/run_date=2024-01-31/run_id=1/subreddit=python/f.parquet", "python"),
        ("file:/l/bronze/reddit/run_date=2024-01-31/community=python/f.json", "python"),
        ("file:/l/gold/other/python/f.parquet", None),
    ],
)
def test_path_community(spark, path, community):
    assert spark.range(1).select(path_community(F.lit(path))).first()[0] == community
