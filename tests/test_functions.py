from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from agoralake.functions import (
    WHITESPACE,
    epoch_to_timestamp,
    iso_to_timestamp,
    pearson,
    post_filter,
    run_partition,
    strip,
    text_length,
)


def column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


def results(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def test_whitespace_is_what_python_strips():
    assert sorted(WHITESPACE) == sorted(chr(i) for i in range(0x110000) if chr(i).isspace())


def test_strip_equals_python_for_every_code_point_around_a_letter(spark):
    texts = [f"{chr(i)}a{chr(i)}" for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000]
    got = results(column(spark, texts, "string"), strip("c"))
    assert got == [t.strip() for t in texts]


@pytest.mark.parametrize(
    "text", ["", "   ", "a", " a b ", "\u3000\ta b\u00a0\n", "a\u200b", "\u2028\U0001f600 ", None]
)
def test_strip(spark, text):
    want = None if text is None else text.strip()
    assert results(column(spark, [text], "string"), strip("c")) == [want]


def test_length_counts_code_points(spark):
    df = column(spark, ["a\U0001f600\u00e9", "", None], "string").select(
        text_length(F.col("c")).alias("n")
    )
    assert df.schema["n"].dataType.simpleString() == "bigint"
    assert [r.n for r in df.collect()] == [3, 0, None]


@pytest.mark.parametrize("zone", ["America/New_York", "UTC", "Asia/Kolkata"])
def test_epoch_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        values = [1704070800.0, 1710037800.0, 0.5, -1.0, None, float("nan"), 1e300]
        got = results(column(spark, values, "double"), epoch_to_timestamp(F.col("c")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [
        datetime(2024, 1, 1, 1),
        datetime(2024, 3, 10, 2, 30),  # inside New York's DST gap
        datetime(1970, 1, 1, 0, 0, 0, 500000),
        datetime(1969, 12, 31, 23, 59, 59),
        None,
        None,
        None,
    ]


def test_iso_takes_both_fraction_forms(spark):
    values = ["2024-01-31T02:00:00", "2024-01-31T02:00:00.250000", "soon", "", None]
    got = results(column(spark, values, "string"), iso_to_timestamp(F.col("c")))
    whole = datetime(2024, 1, 31, 2)
    assert got == [whole, whole.replace(microsecond=250000), None, None, None]


def test_run_partitions_inside_a_dst_gap(spark):
    stamp = F.lit("2024-03-10T02:30:05.5").cast("timestamp_ntz")
    row = spark.range(1).select(
        *[run_partition(p, stamp).alias(p) for p in ("run_date", "run_hour", "run_id")]
    )
    assert tuple(row.first()) == (date(2024, 3, 10), "02", "20240310_023005")


def correlation(spark, pairs):
    df = spark.createDataFrame(pairs, "x bigint, y bigint")
    return df.agg(pearson("x", "y").alias("r")).first().r


def test_pearson(spark):
    assert correlation(spark, [(1, 1), (2, 2), (3, 5)]) == pytest.approx(0.9607689228305228)
    assert correlation(spark, [(1, 3), (2, 2), (3, 1)]) == pytest.approx(-1.0)


def test_pearson_without_spread_is_null(spark):
    assert correlation(spark, [(1, 1), (1, 2), (1, 5)]) is None
    assert correlation(spark, [(1, 1)]) is None
    assert correlation(spark, [(None, 1), (2, None)]) is None


def test_pearson_uses_pairs_only(spark):
    pairs = [(1, 1), (2, 2), (3, 5)]
    spoiled = [*pairs, (100, None), (None, -100)]
    assert correlation(spark, spoiled) == pytest.approx(correlation(spark, pairs))


def days(spark, **conditions):
    rows = [("x", date(2024, 1, d)) for d in (1, 2, 3)] + [("y", date(2024, 1, 2)), ("x", None)]
    df = spark.createDataFrame(rows, "subreddit string, date date")
    return sorted(
        (r.subreddit, r.date and r.date.day) for r in df.where(post_filter(**conditions)).collect()
        if r.date
    )


def test_filter(spark):
    everything = [("x", 1), ("x", 2), ("x", 3), ("y", 2)]
    assert days(spark) == everything
    assert days(spark, subreddit="", start_date="", end_date=None) == everything
    assert days(spark, subreddit="y") == [("y", 2)]
    assert days(spark, start_date="2024-01-02", end_date="2024-01-02") == [("x", 2), ("y", 2)]
    assert days(spark, start_date=date(2024, 1, 3)) == [("x", 3)]


def test_filter_takes_values_not_sql(spark):
    assert days(spark, subreddit="x' OR '1'='1") == []
    with pytest.raises(ValueError):
        post_filter(start_date="2024-01-01' OR 1=1")


def test_offsets_are_taken_off_and_dates_have_to_be_whole(spark):
    values = {
        "2024-01-31T02:00:00+05:00": "2024-01-30 21:00:00",
        "2024-01-31T22:30:00.5-0230": "2024-02-01 01:00:00.5",
        "2024-01-31T02:00:00Z": "2024-01-31 02:00:00",
        "2024-01-31": "2024-01-31 00:00:00",
        "2024": None,
        "2024-01": None,
        "02:00:00": None,
    }
    got = results(column(spark, list(values), "string"), iso_to_timestamp(F.col("c")).cast("string"))
    assert got == list(values.values())
