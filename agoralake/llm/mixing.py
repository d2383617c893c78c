"""Mixing sources to target weights: Pfair scheduling of source blocks, in DataFrame operations.

Documents of a source are put in the order of a digest of their id and cut into blocks. Weights are
brought to their least common denominator: source s has an integer weight p of a cycle of Q slots (Q is
the sum of all weights), so its block j may run from slot floor(j Q / p) and has to by slot ceil((j + 1) Q / p). In every slot the released block with the
earliest deadline runs. As all weights add up to the whole cycle, every block meets its window, which
keeps a source within less than one block of its weight at any slot. Windows repeat with the cycle:
one cycle is scheduled, and block j of a source runs in cycle j div p at the slot of its turn j mod p.

When a source has no blocks left its slots stay empty and the rest keep their proportions. Sources of
weight 0 have no part in the cycle; their blocks take turns behind the last cycle that holds a block.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agoralake.llm.common import Apart, ranked

#: Documents of a block, and the slots of the longest cycle: weights that need more are rounded to it.
BLOCK, PARTS = 64, 20_000
#: Weights are this power of a source's number of documents, in whole numbers, where none are given.
TEMPER = 0.5


def _name(column: str) -> F.Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def whole_weights(weights: Mapping[str, float], parts: int = PARTS) -> dict[str, int]:
    """The weights times the least number that makes all of them whole.

    A weight is read as the fraction with a denominator of at most `parts` that is nearest to it,
    or as it stands if that is nothing.
    """
    if any(w < 0 or not math.isfinite(w) for w in weights.values()):
        raise ValueError("weights are finite and not negative")
    exact = {k: Fraction(w).limit_denominator(parts) or Fraction(w) for k, w in weights.items()}
    common = math.lcm(*(x.denominator for x in exact.values())) if exact else 1
    whole = {k: int(x * common) for k, x in exact.items()}
    shared = math.gcd(*whole.values()) or 1
    whole = {k: x // shared for k, x in whole.items()}
    # Beyond what 64 bits hold, 40 bits a weight are far finer than a cycle.
    over = max(0, max(whole.values(), default=0).bit_length() - 40)
    return {k: max(x >> over, min(x, 1)) for k, x in whole.items()}


def target_weights(
    docs: DataFrame, source: str, weights: Mapping[str, float] | None, parts: int = PARTS
) -> DataFrame:
    """(__source, __n, __p): a source's rows and its slots of a cycle, 0 for those of weight 0.

    Slots are the whole weights themselves. Only if the weights of the sources that occur add up to
    more than `parts` are they rounded to that many, where the smallest keep one slot.
    """
    sizes = docs.groupBy(_name(source).alias("__source")).agg(F.count(F.lit(1)).alias("__n"))
    if weights is None:
        raw = F.greatest(F.round(F.pow(F.col("__n"), F.lit(TEMPER))).cast("long"), F.lit(1))
    else:
        pairs = [F.lit(x) for k, w in whole_weights(weights, parts).items() for x in (f"={k}", w)]
        named = F.create_map(*pairs).cast("map<string, bigint>")
        raw = F.coalesce(F.try_element_at(named, "__source"), F.lit(0))
    shares = sizes.withColumn("__raw", raw)
    total = shares.agg(F.greatest(F.sum(F.col("__raw").cast("decimal(38,0)")), F.lit(1))).scalar()
    rounded = F.expr(f"CAST((__raw * CAST({parts} AS DECIMAL(10,0)) + __all DIV 2) DIV __all AS BIGINT)")
    slots = F.when(F.col("__all") <= parts, F.col("__raw")).otherwise(F.greatest(rounded, F.lit(1)))
    return shares.withColumn("__all", total).select(
        "__source", "__n", F.when(F.col("__raw") > 0, slots).otherwise(0).cast("long").alias("__p")
    )


def without_weight(shares: DataFrame, block: int) -> DataFrame:
    """(__source, __turn, __slot, __cycle) of sources of weight 0: turns of a block, behind all cycles."""
    runs = F.expr(f"((__n - 1) DIV {block}) DIV greatest(__p, 1L) + 1")
    cycles = F.max(F.when(F.col("__p") > 0, runs)) * F.sum("__p")
    behind = shares.agg(F.coalesce(cycles, F.lit(0)).cast("long")).scalar()
    names = F.sort_array(F.collect_list(F.when(F.col("__p") == 0, F.col("__source"))))
    rows = shares.agg(names.alias("s")).selectExpr("size(s) AS q", "posexplode(s) AS (k, __source)")
    return rows.withColumn("__behind", behind).selectExpr(
        "__source", "0L AS __turn", "__behind + k AS __slot", "CAST(q AS BIGINT) AS __cycle"
    )


def cycle(weights: DataFrame) -> DataFrame:
    """(__source, __p, __turn, __slot, __cycle): one cycle, earliest deadline first.

    The schedule is a fold over the cycle's slots; its state is how many blocks every source has run.
    It holds one number a source and one a slot, whatever the number of documents.
    """
    order = F.sort_array(F.collect_list(F.when(F.col("__p") > 0, F.struct("__source", "__p"))))
    one = weights.agg(order.alias("s")).where(F.size("s") > 0)
    one = one.withColumn("q", F.expr("aggregate(s, 0L, (a, x) -> a + x.__p)"))
    pick = """
      array_min(transform(s, (x, i) -> CASE
        WHEN (acc.done[i] * q) DIV x.__p <= t
        THEN struct(((acc.done[i] + 1) * q + x.__p - 1) DIV x.__p AS due, i AS i) END)).i
    """
    folded = f"""
      aggregate(
        sequence(0L, q - 1),
        struct(transform(s, x -> 0L) AS done, CAST(array() AS array<int>) AS picks),
        (acc, t) -> transform(array({pick}), k -> struct(
          transform(acc.done, (d, i) -> IF(i = k, d + 1, d)) AS done,
          concat(acc.picks, array(k)) AS picks))[0],
        acc -> acc.picks)
    """
    slots = one.selectExpr("s", "q", f"{folded} AS picks")
    slots = slots.selectExpr("s", "q", "posexplode(picks) AS (__slot, k)")
    return slots.selectExpr(
        "s[k].__source AS __source",
        "s[k].__p AS __p",
        "row_number() OVER (PARTITION BY k ORDER BY __slot) - 1 AS __turn",
        "CAST(__slot AS BIGINT) AS __slot",
        "q AS __cycle",
    )


def mix_sources(
    docs: DataFrame,
    *,
    weights: Mapping[str, float] | None = None,
    ident: str = "doc_id",
    source: str = "source",
    block: int = BLOCK,
    parts: int = PARTS,
) -> DataFrame:
    """All rows and columns, and `block` (number within the source) and `slot` (when it runs).

    Sorting by slot gives the mixed order; names that are taken get an underscore, columns named like
    the operator's own are kept as they are. Rows without a source are one source of their own. Sources
    without a weight, or of weight 0, run behind all others: no row is dropped. Without any weights a
    source's is the root of its number of documents. Equal ids keep any order between them. An empty
    table gives an empty table.
    """
    apart = Apart(docs)
    rows = apart.rows.withColumn("__source", _name(apart[source]))
    rows = ranked(rows, "__source", "__rank", F.col(apart[ident]))
    rows = rows.withColumn("__block", F.expr(f"__rank DIV {block}"))
    share = target_weights(apart.rows, apart[source], weights, parts)
    # Both tables have a row a source, and a row a slot: at most `parts` and one more a source.
    plan = cycle(share).drop("__p").unionByName(without_weight(share, block))
    period = share.select("__source", F.greatest("__p", F.lit(1)).alias("__p"))
    rows = rows.join(period, "__source").withColumn("__turn", F.expr("__block % __p"))
    placed = rows.join(plan, ["__source", "__turn"])
    due = F.expr("(__block DIV __p) * __cycle + __slot")
    return apart.back(placed.select(*apart.rows.columns, "__block", due), "block", "slot")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents in their mixed order, with their own columns."""
    marked = mix_sources(docs, **options)
    ident = options.get("ident", "doc_id")
    slot = marked.columns[-1]
    return marked.orderBy(slot, F.md5(F.coalesce(F.col(ident).cast("string"), F.lit("")))).select(
        *docs.columns
    )
