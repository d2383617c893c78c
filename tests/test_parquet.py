from __future__ import annotations

from datetime import date, datetime

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from agoralake.operators import gold as G
from agoralake.operators.silver import clean_posts
from agoralake.schemas import SILVER
from agoralake.sinks import write_gold, write_silver
from agoralake.sources import read_foreign_silver, read_gold, read_silver
from rows import RUN, post, unnested


@pytest.mark.parametrize("rebalance", [False, True])
def test_silver_round_trip(spark, lake, rebalance):
    posts = clean_posts(
        unnested(spark, post("a", subreddit="007"), post("b", title=None, created_utc=None))
    )
    write_silver(posts, lake.silver, rebalance)
    back = read_silver(spark, lake.silver)
    names = SILVER.fieldNames()
    assert back.orderBy("id").select(*names).collect() == posts.orderBy("id").collect()
    row = back.where("subreddit = '007'").first()
    assert (row.run_date, row.run_id) == (date(2024, 1, 31), "20240131_020000")


def test_a_run_without_files_is_empty(spark, lake):
    write_silver(clean_posts(unnested(spark, post())), lake.silver)
    assert read_silver(spark, lake.silver, "run_date=2024-01-31").count() == 1
    other = read_silver(spark, lake.silver, "run_date=2024-02-01")
    assert other.count() == 0 and other.columns == read_silver(spark, lake.silver).columns


def test_gold_round_trip(spark, lake):
    daily = G.daily_stats(clean_posts(unnested(spark, post(), post("b", subreddit="y"))))
    write_gold(daily, lake.gold("daily_stats"))
    back = read_gold(spark, lake.gold("daily_stats"), "daily_stats").select(*daily.columns)
    assert back.orderBy("subreddit").collect() == daily.orderBy("subreddit").collect()


@pytest.mark.parametrize("unit", ["us", "ns"])
def test_foreign_silver(spark, tmp_path, unit):
    """Files as pandas writes them: 64-bit counts, no community, nanosecond times."""
    folder = tmp_path / "silver" / "reddit" / "python" / "2024" / "01" / "31"
    folder.mkdir(parents=True)
    frame = pd.DataFrame(
        {
            "id": ["a"],
            "title": ["Title"],
            "score": [5],
            "num_comments": [2],
            "selftext": [""],
            "upvote_ratio": [0.5],
            "url": ["u"],
            "author": ["ann"],
            "is_original_content": [False],
            "is_self": [True],
            "extracted_at": pd.to_datetime(["2024-01-31 02:00:00.25"]),
            "created_at": pd.to_datetime(["2024-03-10 02:30:00"]),
            "date": [date(2024, 3, 10)],
            "title_length": [5],
            "selftext_length": [0],
            "has_selftext": [False],
        }
    )
    for name in ("extracted_at", "created_at"):
        frame[name] = frame[name].astype(f"datetime64[{unit}]")
    table = pa.Table.from_pandas(frame)
    pq.write_table(table, folder / "reddit_python_20240131_020001.parquet", version="2.6")
    df = read_foreign_silver(spark, str(tmp_path / "silver"), nanos=unit == "ns")
    row = df.first()
    assert df.columns == SILVER.fieldNames()
    assert row.created_at == datetime(2024, 3, 10, 2, 30)
    assert row.extracted_at == datetime(2024, 1, 31, 2, 0, 0, 250000)
    assert (row.subreddit, row.run_ts, row.score) == ("python", RUN.replace(second=1), 5)
    assert G.top_posts(df).count() == 1
    assert spark.conf.get("spark.sql.legacy.parquet.nanosAsLong") == "false"
