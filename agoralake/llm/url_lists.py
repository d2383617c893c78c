"""URL filters: dated list entries become validity intervals, joined as of every capture's time.

A list is a log of entries (key, verdict, listed_at): a host or domain (`example.org`, which covers
its subdomains) or a path below one (`example.org/ads/`), with the verdict `block`, `allow` or
`remove` from that time on. An entry holds until the next one for its key. A capture asks all keys it
falls under, from its domain to its deepest folder, and the entry that is active at its fetch time
and most specific decides.

Intervals are cut at the edges of months and join captures by key and month, so that a key with a
long history or a third of all captures spreads over its months, and what is left of one month's key
is a sort-merge join that AQE can split. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agoralake.llm.common import plain

# Fixed value: an interval without an end ends here.
FOREVER = "9999-12-01"


def url_host(url: Column) -> Column:
    """Lower-case host without user, port and final dot; null where a URL has none."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#]*@)?([^/?#:@]+)", 1))
    host = F.rtrim(host, F.lit("."))
    return F.when(host != "", host)


def url_folders(url: Column) -> Column:
    """The path's folders, from `/a/` to `/a/b/`, without what follows the last slash."""
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*/)", 1)
    parts = F.split(F.trim(path, F.lit("/")), "/")
    deep = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda k: F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, k), "/"), F.lit("/")),
    )
    return F.when(F.length(path) > 1, deep).otherwise(F.array().cast("array<string>"))


def capture_keys(url: Column) -> Column:
    """Every list key a URL falls under: its host's suffixes, and its folders on each of them."""
    labels = F.reverse(F.split(url_host(url), r"\."))
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.reverse(F.slice(labels, 1, k)), "."),
    )
    whole = F.array_distinct(F.concat(hosts, F.array(url_host(url))))
    paths = F.flatten(
        F.transform(whole, lambda h: F.transform(url_folders(url), lambda p: F.concat(h, p)))
    )
    return F.when(url_host(url).isNotNull(), F.concat(whole, paths))


def intervals(entries: DataFrame) -> DataFrame:
    """(key, verdict, valid_from, valid_to) of a dated log; entries without key or time are no entries.

    An entry holds from its time until its key's next one; of two at the same time the one with the
    greater verdict (`remove`, `block`, `allow`) holds. `remove` only ends what was there. Hosts are
    equal in any case of letters, folders only in the same.
    """
    key = F.concat(F.lower(F.substring_index("key", "/", 1)), F.regexp_extract("key", "(?s)/.*", 0))
    good = entries.select(key.alias("key"), "verdict", "listed_at").where(
        "key IS NOT NULL AND listed_at IS NOT NULL AND verdict IN ('block', 'allow', 'remove')"
    )
    once = good.groupBy("key", "listed_at").agg(
        F.max_by("verdict", F.expr("array_position(array('allow', 'block', 'remove'), verdict)")).alias(
            "verdict"
        )
    )
    until = F.expr("lead(listed_at) OVER (PARTITION BY key ORDER BY listed_at)")
    held = once.withColumn("valid_from", F.col("listed_at").cast("timestamp_ntz")).withColumn(
        "valid_to", F.coalesce(until.cast("timestamp_ntz"), F.lit(FOREVER).cast("timestamp_ntz"))
    )
    return held.where("verdict <> 'remove'").select("key", "verdict", "valid_from", "valid_to")


def filter_urls(
    captures: DataFrame,
    entries: DataFrame,
    *,
    ident: str,
    url: str = "url",
    fetched: str = "fetched_at",
) -> DataFrame:
    """All captures and their columns, and `verdict`, `list_key` and `listed_since` of what decides.

    The longest key wins, which is the most specific one, and of equally long ones the greater. A capture that no active entry covers, and
    one without a URL, host or time, has nulls there and is to be kept. Rows with equal ids are each
    evaluated: a row is told apart by id, URL and time. Taken names get underscores. An empty table
    of captures gives an empty one, an empty list decides nothing.
    """
    names = [plain(n, captures.columns) for n in ("verdict", "list_key", "listed_since")]
    when = F.col(fetched).cast("timestamp_ntz")
    asked = captures.select(
        F.col(ident).alias("__id"), F.col(url).alias("__url"), when.alias("__at")
    ).where("__url IS NOT NULL AND __at IS NOT NULL").distinct()
    months = asked.select(F.trunc("__at", "month").alias("__month"))
    cut = (
        intervals(entries)
        .withColumn("__low", months.agg(F.min("__month")).scalar())
        .withColumn("__high", months.agg(F.max("__month")).scalar())
        .where((F.col("valid_from") < F.add_months("__high", 1)) & (F.col("valid_to") > F.col("__low")))
        .withColumn(
            "__month",
            F.explode(
                F.sequence(
                    F.greatest(F.trunc("valid_from", "month"), F.col("__low")),
                    F.least(F.trunc("valid_to", "month"), F.col("__high")),
                    F.expr("INTERVAL 1 MONTH"),
                )
            ),
        )
        .select("key", "verdict", "valid_from", "valid_to", "__month")
    )
    cut = cut.withColumnRenamed("__month", "__in")
    asked = asked.select(
        "*",
        F.explode(capture_keys(F.col("__url"))).alias("__key"),
        F.trunc("__at", "month").alias("__month"),
    )
    active = asked.join(
        cut,
        (F.col("__key") == F.col("key"))
        & (F.col("__month") == F.col("__in"))
        & (F.col("__at") >= F.col("valid_from"))
        & (F.col("__at") < F.col("valid_to")),
    )
    best = active.groupBy("__id", "__url", "__at").agg(
        F.max(F.struct(F.length("key"), "key", "verdict", "valid_from")).alias("__best")
    )
    rows = captures.withColumn("__when", when)
    joined = rows.join(
        best,
        F.col(ident).eqNullSafe(F.col("__id"))
        & (F.col(url) == F.col("__url"))
        & (F.col("__when") == F.col("__at")),
        "left",
    )
    return joined.select(
        *captures.columns,
        F.col("__best.verdict").alias(names[0]),
        F.col("__best.key").alias(names[1]),
        F.col("__best.valid_from").alias(names[2]),
    )
