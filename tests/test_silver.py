from __future__ import annotations

from datetime import date, datetime

from agoralake.operators.silver import bad_posts, clean_posts, unnest_posts
from agoralake.schemas import POST, SILVER
from rows import RUN, envelope, envelopes, post, unnested


def clean(spark, **fields):
    return clean_posts(unnested(spark, post(**fields))).first()


def test_columns_and_types(spark):
    df = clean_posts(unnested(spark, post()))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SILVER]


def test_null_title_stays(spark):
    row = clean(spark, title=None)
    assert (row.title, row.title_length) == (None, None)


def test_bodies(spark):
    blank = clean(spark, selftext="  \n")
    assert (blank.selftext, blank.selftext_length, blank.has_selftext) == ("", 0, False)
    missing = clean(spark, selftext=None)
    assert (missing.selftext, missing.selftext_length, missing.has_selftext) == ("", 0, False)
    padded = clean(spark, selftext="\u3000a b\u00a0\n")
    assert (padded.selftext, padded.selftext_length, padded.has_selftext) == ("a b", 3, True)


def test_author(spark):
    assert clean(spark, author=None).author == "deleted"
    assert clean(spark, author="None").author == "None"


def test_times(spark):
    row = clean(spark, created_utc=1704070800.0, extracted_at="2024-01-31T02:00:00.25")
    assert row.created_at == datetime(2024, 1, 1, 1)
    assert row.date == date(2024, 1, 1)
    assert row.extracted_at == datetime(2024, 1, 31, 2, 0, 0, 250000)
    missing = clean(spark, created_utc=None)
    assert (missing.created_at, missing.date) == (None, None)


def test_bad_extraction_time_is_kept_and_listed(spark):
    posts = unnested(spark, post("a", extracted_at="soon"), post("b", extracted_at=None), post("c"))
    assert {r.id: r.extracted_at for r in clean_posts(posts).collect()} == {
        "a": None,
        "b": None,
        "c": RUN,
    }
    assert [r.id for r in bad_posts(posts).collect()] == ["a"]


def test_unnest(spark):
    documents = envelopes(
        spark, envelope("x", [post("a"), post("b")]), envelope("y", []), envelope("z", None or [])
    )
    rows = unnest_posts(documents)
    assert rows.columns == ["source", "subreddit", "run_ts", *POST.fieldNames()]
    assert sorted((r.subreddit, r.id, r.run_ts) for r in rows.collect()) == [
        ("x", "a", RUN),
        ("x", "b", RUN),
    ]
