"""Packing: length buckets with the least padding, and batches of a token budget inside each.

Documents are cut into pieces of at most `max_len` words. One histogram over all pieces, of at most
max_len + 1 rows whatever the input, goes to the driver, where dynamic programming finds the bucket
boundaries with the least padding in total. Inside a bucket of boundary b a batch holds as many rows
as fit the budget, budget div b, and rows are numbered in the order of a digest, or by a given place
first. Only ids and lengths shuffle, never texts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agoralake.llm.common import WORD, plain, ranked, stored, work_folder

MAX_LEN, BUCKETS, BUDGET = 2048, 8, 16384


def pieces(docs: DataFrame, text: str, max_len: int = MAX_LEN) -> DataFrame:
    """A row per piece, `__piece` from 0 and `__len`; a text without words is one piece of length 0."""
    return _cut(docs.withColumn("__words", _words(text)), max_len)


def _words(text: str) -> F.Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def _cut(counted: DataFrame, max_len: int) -> DataFrame:
    cut = counted.withColumn(
        "__piece", F.explode(F.expr(f"sequence(0L, greatest(__words - 1, 0L) DIV {max_len})"))
    )
    return cut.withColumn("__len", F.expr(f"least(__words - __piece * {max_len}, {max_len}L)"))


def best_boundaries(counts: np.ndarray, buckets: int) -> list[int]:
    """Boundaries, the last one the greatest length, that minimise the sum of boundary - length.

    counts[k] is how many pieces have length k. Among equals the smallest boundary wins, from the top
    down. There are fewer boundaries than `buckets` where fewer lengths occur.
    """
    used = np.flatnonzero(counts)
    if not len(used):
        return []
    n, m = counts[used].astype(object), len(used)
    many = np.array([0, *np.cumsum(n)], dtype=np.int64)
    mass = np.array([0, *np.cumsum(n * used)], dtype=np.int64)
    # best[j]: least padding of the first j lengths; the last of their buckets ends at used[j - 1].
    reach = np.arange(1, m + 1)
    best = used * many[reach] - mass[reach]
    split = [np.zeros(m, np.int64)]
    for _ in range(min(buckets, m) - 1):
        now, at = best.copy(), np.full(m, -1)
        for j in range(1, m):
            i = np.arange(1, j + 1)
            cost = best[i - 1] + used[j] * (many[j + 1] - many[i]) - (mass[j + 1] - mass[i])
            k = int(np.argmin(cost))
            if cost[k] < now[j]:
                now[j], at[j] = cost[k], k + 1
        split.append(at)
        best = now
    out, j = [], m
    for at in reversed(split):
        if at[j - 1] < 0:
            continue
        out.append(int(used[j - 1]))
        j = int(at[j - 1])
        if j == 0:
            break
    return out[::-1]


def pack(
    docs: DataFrame,
    *,
    ident: str = "doc_id",
    text: str = "text",
    max_len: int = MAX_LEN,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    place: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """A row per piece: id, piece, start (first word), n_tokens, bucket_len, batch, row, padding.

    Batches are numbered within their bucket; all are full but a bucket's last one. Every word of
    every document is in one piece; a document without words is one piece of length 0, in the bucket
    of the shortest lengths. A repeated row is packed as often as it occurs; rows with a null id are
    packed like others. Input columns other than the id are left out. An empty table gives an empty
    table. `budget` has to be `max_len` at least.

    `place` gives the documents, without their texts, a last column of whole numbers from 0. Rows are
    then numbered by it within their bucket, and by digest only where it is the same.
    """
    if budget < max_len:
        raise ValueError("a batch has to hold one piece of the greatest length")
    if place is None:
        cut = pieces(docs.select(F.col(ident).alias("__id"), text), text, max_len)
        cut = cut.select("__id", "__piece", "__len")
    else:
        placed = place(docs.withColumn("__words", _words(text)).drop(text))
        cut = placed.select(F.col(ident).alias("__id"), "__words", F.col(placed.columns[-1]).alias("__place"))
        cut = _cut(cut, max_len).select("__id", "__piece", "__len", "__place")
        cut = stored(cut, work_folder(docs.sparkSession), "pieces")
    histogram = cut.groupBy("__len").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(max_len + 1, np.int64)
    for row in histogram:
        counts[row["__len"]] = row["n"]
    ends = best_boundaries(counts, buckets) or [max_len]
    bucket = F.coalesce(*[F.when(F.col("__len") <= e, F.lit(e)) for e in ends]).cast("long")
    rows = cut.withColumn("bucket_len", bucket).withColumn(
        "__per", F.expr(f"{budget}L DIV greatest(bucket_len, 1L)")
    )
    key = F.concat_ws("/", F.col("__id").cast("string"), F.col("__piece").cast("string"))
    placed = ranked(rows, "bucket_len", "__rank", key, None if place is None else "__place")
    name = plain(ident, ("piece", "start", "n_tokens", "bucket_len", "batch", "row", "padding"))
    return placed.select(
        F.col("__id").alias(name),
        F.col("__piece").alias("piece"),
        (F.col("__piece") * max_len).alias("start"),
        F.col("__len").alias("n_tokens"),
        "bucket_len",
        F.expr("__rank DIV __per").alias("batch"),
        F.expr("__rank % __per").alias("row"),
        (F.col("bucket_len") - F.col("__len")).alias("padding"),
    )
