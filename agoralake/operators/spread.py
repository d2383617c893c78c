"""Groups of rows that are large enough to be stored by every task that holds some of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agoralake.config import LARGE_GROUPS


def large_groups(df: DataFrame, keys: Sequence[str], rows: int) -> Column | None:
    """Which rows are of a group with at least so many rows for each task; None if no group is.

    Rows of such groups need not be shuffled to come out in pieces of a fair size. Only keys are read
    to count them. Tasks are those that hold the group here, or as many as a shuffle may have. At
    most `LARGE_GROUPS` names come to the driver; the condition names groups and no places, so it holds
    whichever task a row is in later.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = df.groupBy(*keys, F.spark_partition_id().alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    groups = held.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_tasks"))
    large = groups.where(F.col("_n") >= rows * F.greatest("_tasks", F.lit(tasks)))
    named = large.orderBy(F.desc("_n"), *keys).limit(LARGE_GROUPS).select(*keys).collect()
    if not named:
        return None
    *outer, last = keys
    lists: dict[tuple, list] = {}
    for row in named:
        lists.setdefault(tuple(row[k] for k in outer), []).append(row[last])

    def of(values: tuple, names: list) -> Column:
        same = [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(outer, values, strict=True)]
        there = [name for name in names if name is not None]
        among = F.coalesce(F.col(last).isin(there), F.lit(False))
        return reduce(and_, [*same, among | F.col(last).isNull() if None in names else among])

    return reduce(or_, [of(values, names) for values, names in lists.items()])
