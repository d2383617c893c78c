from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agoralake.config import PLACE_RANGES, PLACE_ROUNDS, TOP_K_SALTS


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    salts: int = TOP_K_SALTS,
) -> DataFrame:
    """The first `k` rows of every group, exact for any skew.

    Each map task keeps its own first `k` rows per group before the shuffle (WindowGroupLimit). With
    one dominant group that still leaves tasks x k rows for one reducer, so a first step spreads
    them over `salts` reducers and a second one sees at most salts x k rows per group. The salt is
    the map task's number: every task feeds one salt per group, so the spread adds no shuffled
    rows. Which salt a row takes cannot change the result.
    """
    ranked = df
    for keys in ([*group, "_salt"], list(group)):
        if "_salt" in keys:
            ranked = ranked.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        window = Window.partitionBy(*keys).orderBy(*order)
        ranked = ranked.withColumn("_rank", F.row_number().over(window)).where(
            F.col("_rank") <= k
        )
        ranked = ranked.drop("_rank", "_salt")
    return ranked


def _same_group(group: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"r.{g}").eqNullSafe(F.col(f"b.{g}")) for g in group])


def _between() -> Column:
    """Whether a row's place is in the range of its group's bound; rows without a place are a range."""
    nowhere = F.col("_lo").isNull() & F.col("_place").isNull()
    return nowhere | F.coalesce(F.col("_place").between(F.col("_lo"), F.col("_hi")), F.lit(False))


def place_bounds(
    df: DataFrame,
    group: Sequence[str],
    place: str,
    k: int,
    ranges: int = PLACE_RANGES,
    rounds: int = PLACE_ROUNDS,
) -> DataFrame:
    """Per group of more than `k` rows the range of places (_lo to _hi) that its `k`-th row is in, and how
    many rows stand _before that range.

    Each round counts rows per range of a whole number, a hash aggregation over the group and the
    place that combines before the shuffle, and adds the counts up: at most `ranges` + 2 rows a group.
    The next round cuts the range it finds, so that after two of them places in a row of any length
    below `ranges` ** 2 are told apart. Rows without a place stand last, as a range of their own.
    """
    rows = df.select(*group, F.col(place).cast("bigint").alias("_place"))
    n = F.count(F.lit(1)).alias("_n")
    sizes = rows.groupBy(*group).agg(n, F.min("_place").alias("_lo"), F.max("_place").alias("_hi"))
    zero = F.lit(0).cast("bigint").alias("_before")
    bounds = sizes.where(F.col("_n") > k).select(*group, "_lo", "_hi", zero)
    step = F.expr(f"_place DIV (_hi DIV {ranges} - _lo DIV {ranges} + 1)")
    for turn in range(rounds):
        joined = rows.alias("r").join(bounds.alias("b"), _same_group(group))
        inside = joined if turn == 0 else joined.where(_between())
        counts = inside.groupBy(
            *[F.col(f"r.{g}").alias(g) for g in group], "_before", step.alias("_range")
        ).agg(n, F.min("_place").alias("_lo"), F.max("_place").alias("_hi"))
        order = Window.partitionBy(*group).orderBy(F.asc_nulls_last("_range"))
        upto = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0))
        counts = counts.withColumn("_upto", F.col("_before") + upto)
        last = (F.col("_upto") >= k) & (F.col("_upto") - F.col("_n") < k)
        bounds = counts.where(last).select(
            *group, "_lo", "_hi", (F.col("_upto") - F.col("_n")).alias("_before")
        )
    return bounds


def first_by_place(
    df: DataFrame,
    group: Sequence[str],
    place: str,
    ties: Sequence[str],
    k: int,
    ranges: int = PLACE_RANGES,
    rounds: int = PLACE_ROUNDS,
) -> DataFrame:
    """The first `k` rows of every group by a whole number, then by `ties`, nulls last; for large `k`.

    No task sorts or holds `k` rows: whatever stands before the bound's range (`place_bounds`) is kept
    where it is, without a shuffle of its own, and only that range is ranked. Where very many rows share
    one place, that range is cut in each task first, as `top_k_per_group` does.
    """
    if k <= 0:
        return df.limit(0)
    bounds = place_bounds(df, group, place, k, ranges, rounds)
    number = F.col(f"r.{place}").cast("bigint")
    rows = df.alias("r").join(bounds.alias("b"), _same_group(group), "left")
    rows = rows.select("r.*", number.alias("_place"), "_lo", "_hi", "_before")
    early = F.col("_lo").isNull() | (F.col("_place") < F.col("_lo"))
    whole = F.col("_before").isNull() | (F.col("_place").isNotNull() & early)
    order = [F.asc_nulls_last(c) for c in (place, *ties)]
    edge = rows.where(F.col("_before").isNotNull() & _between())
    edge = top_k_per_group(edge, group, order, k)
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    edge = edge.withColumn("_rank", rank).where(F.col("_rank") + F.col("_before") <= k)
    return rows.where(whole).select(*df.columns).unionByName(edge.select(*df.columns))


def top_k_bounds(
    df: DataFrame, group: Sequence[str], metrics: Sequence[str], k: int, spread: str = "id"
) -> DataFrame:
    """Per group and metric a value its `k`-th largest row cannot be below; NULL where unknown.

    Rows are hashed into 4k buckets per group. The bucket maxima belong to different rows, so at
    least `k` rows reach the `k`-th largest of them. This is a hash aggregation over a few narrow
    columns: it combines before the shuffle and never sorts the input. The list it collects has 4k
    numbers at most.
    """
    bucket = F.pmod(F.xxhash64(F.lit("top_k_bounds"), spread), F.lit(4 * k))
    maxima = df.groupBy(*group, bucket.alias("_bucket")).agg(*[F.max(m).alias(m) for m in metrics])

    def bound(metric: str) -> Column:
        ranked = F.sort_array(F.collect_list(metric), asc=False)
        return F.try_element_at(ranked, F.lit(k)).alias(f"{metric}_bound")

    return maxima.groupBy(*group).agg(*[bound(m) for m in metrics])


def tie_bounds(
    df: DataFrame, bounds: DataFrame, group: Sequence[str], metrics: Sequence[str], k: int, ties: str = "id"
) -> DataFrame:
    """The bounds with, per metric, the `k`-th of the `ties` among the rows that stand at the bound.

    Counts and ratings take few values, so a bound may be shared by a large part of a group, of which a
    list ordered by `ties` holds `k` rows at most. NULL where fewer stand there. Only narrow columns of
    the rows at a bound are ranked.
    """
    joined = df.alias("r").join(bounds.alias("b"), _same_group(group))
    at = [F.when(F.col(f"r.{m}") == F.col(f"b.{m}_bound"), F.lit(m)) for m in metrics]
    names = [F.col(f"r.{c}").alias(c) for c in (*group, ties)]
    rows = joined.select(*names, F.explode(F.array_compact(F.array(*at))).alias("_metric"))
    first = top_k_per_group(rows, [*group, "_metric"], [F.asc_nulls_last(ties)], k)

    def last(metric: str) -> Column:
        held = F.when(F.col("_metric") == metric, F.col(ties))
        return F.when(F.count(held) >= k, F.max(held)).alias(f"{metric}_last")

    found = first.groupBy(*group).agg(*[last(m) for m in metrics])
    lasts = [f"f.{m}_last" for m in metrics]
    same = reduce(and_, [F.col(f"b.{g}").eqNullSafe(F.col(f"f.{g}")) for g in group])
    return bounds.alias("b").join(found.alias("f"), same, "left").select("b.*", *lasts)


def above_bounds(
    df: DataFrame, bounds: DataFrame, group: Sequence[str], metrics: Sequence[str], ties: str = "id"
) -> DataFrame:
    """The rows that can be among the `k` largest of their group by any of the metrics.

    Keeps all rows of groups without a bound, and ties with one: all of them, or, if the bounds come
    from `tie_bounds`, the first by `ties`.
    """

    def reached(metric: str) -> Column:
        value, bound = F.col(f"r.{metric}"), F.col(f"b.{metric}_bound")
        if f"{metric}_last" not in bounds.columns:
            return bound.isNull() | (value >= bound)
        last = F.col(f"b.{metric}_last")
        early = last.isNull() | (F.col(f"r.{ties}") <= last)
        return bound.isNull() | (value > bound) | ((value == bound) & early)

    joined = df.alias("r").join(bounds.alias("b"), _same_group(group), "left")
    return joined.where(reduce(or_, [reached(m) for m in metrics])).select("r.*")
