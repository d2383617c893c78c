"""Embedding near-dedup: NN-descent over the centres of tight balls, then links by cosine.

Vectors within half of the threshold's angle of a centre form a ball, all of whose pairs are linked; so large groups of near copies are never listed pair by pair. NN-descent runs over the balls'
centres: lists start from neighbours in several random-hyperplane orders, then neighbours of a node
are introduced to each other, round by round, and every node keeps its best. A list whose last entry
could still be a link is saturated and doubles, up to a bound. What the descent found is audited against
brute force, for a sample of vectors of every group; if too much is missing, more orders are added and
the descent goes on. Balls whose list is still saturated at the end, and groups that miss the audit after
all starts, are linked exactly: blocks of their vectors meet all blocks of the group.
Two balls are linked as a whole, not at all, or, where their radii leave that open, vector by vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.group_ops import PandasCogroupedOps
from pyspark.sql.pandas.types import to_arrow_type

from agoralake.llm.common import components, plain, stored, work_folder

THRESHOLD = 0.93
#: Neighbours a node starts with, orders of one start, and how far a node looks in an order.
LIST, ORDERS, LOOK = 8, 12, 4
#: Most rounds of one descent, the share of new entries that ends it, and most starts.
ROUNDS, SETTLED, STARTS = 6, 0.002, 4
#: Codes by which vectors look for a centre, and the hyperplanes of these and of the orders' codes.
BALL_CODES, BALL_BITS, ORDER_BITS = 6, 16, 48
#: Longest list; a longer one is slower than the exact way, which takes the nodes that need it.
MOST = 128
#: Audited vectors of a group, with and without a neighbour, and the share of links to be found.
AUDIT, RECALL = 16, 0.98
#: Vectors of a block of the exact way, about.
BLOCK = 1024
_EDGE = 1e-7


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as rows."""
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _codes(vectors: np.ndarray, bits: int, seed: int) -> np.ndarray:
    planes = np.random.default_rng([seed, vectors.shape[1]]).standard_normal((vectors.shape[1], bits))
    return (vectors @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64)[::-1])


def _by_dim(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    sizes = np.asarray(pc.list_value_length(batch.column(column)))
    for size in np.unique(sizes):
        yield batch.filter(pa.array(sizes == size))


def _units(vectors: DataFrame, ident: str, vector: str, label: str) -> DataFrame:
    """(node, grp, unit) of every vector that can link; a group has one label and one dimension."""

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_dim(batch, "v"):
                rows = _matrix(part.column("v"))
                peak = np.abs(rows).max(axis=1, initial=0.0)
                good = np.isfinite(rows).all(axis=1) & (peak > 0)
                rows = rows[good] / peak[good, None]
                rows /= np.linalg.norm(rows, axis=1)[:, None]
                keep = part.filter(pa.array(good))
                yield pa.RecordBatch.from_arrays(
                    [keep.column("node"), keep.column("grp"), pa.array(list(rows), pa.list_(pa.float64()))],
                    ["node", "grp", "unit"],
                )

    rows = vectors.select(
        F.col(ident).alias("node"), F.col(label).alias("l"), F.col(vector).cast("array<double>").alias("v")
    )
    rows = rows.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct("l", "v")).alias("r"))
    rows = rows.select("node", "r.l", "r.v").where(
        "l IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND NOT exists(v, x -> x IS NULL)"
    )
    rows = rows.select("node", F.xxhash64("l", F.size("v")).alias("grp"), "v")
    kind = vectors.schema[ident].dataType.simpleString()
    return rows.mapInArrow(scale, f"node {kind}, grp bigint, unit array<double>")


def _coded(df: DataFrame, bits: int, seeds: list[int]) -> DataFrame:
    """Every row once a seed, with `turn` and its code by that seed's hyperplanes."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_dim(batch, "unit"):
                rows = _matrix(part.column("unit"))
                for seed in seeds:
                    turn = pa.array(np.full(len(rows), seed), pa.int32())
                    codes = pa.array(_codes(rows, bits, seed), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, turn, codes], [*part.schema.names, "turn", "code"]
                    )

    fields = [T.StructField("turn", T.IntegerType()), T.StructField("code", T.LongType())]
    return df.mapInArrow(code, T.StructType([*df.schema.fields, *fields]))


_DOT = "aggregate(zip_with({}, {}, (x, y) -> x * y), 0D, (s, x) -> s + x)"


def _balls(units: DataFrame, angle: float, folder: str) -> DataFrame:
    """(node, grp, unit, centre, gap): each vector's ball and its angle to the centre.

    By several codes, every vector looks at the smallest node of its bucket; of those within the angle
    the smallest is its centre. A centre may itself be in another ball: what counts is that a ball's
    members are all near one vector. A vector alone in its ball is its own centre.
    """
    codes = _coded(units, BALL_BITS, [1000 + k for k in range(BALL_CODES)]).drop("unit")
    leaders = codes.groupBy("grp", "turn", "code").agg(F.min("node").alias("lead"))
    pairs = codes.join(leaders, ["grp", "turn", "code"]).where("node <> lead")
    pairs = stored(pairs.select("node", "lead").distinct(), folder, "leaders")
    near = (
        pairs.join(units.selectExpr("node AS lead", "unit AS other"), "lead")
        .join(units.select("node", "unit"), "node")
        .selectExpr("node", "lead", f"{_DOT.format('unit', 'other')} AS cosine")
        .where(F.col("cosine") >= math.cos(angle))
        .groupBy("node")
        .agg(F.min(F.struct("lead", "cosine")).alias("best"))
        .selectExpr("node", "best.lead AS centre", "acos(least(1D, best.cosine)) AS gap")
    )
    near = stored(near, folder, "near")
    # Who has company: others of the same centre, or the centre itself, if that looks at no other one.
    own = units.select("node").join(near.select("node"), "node", "left_anti")
    many = near.select("centre").union(own.select("node")).groupBy("centre").count()
    many = many.where("count > 1").select("centre")
    near = near.join(many, "centre", "left_semi")
    return units.join(near, "node", "left").selectExpr(
        "node", "grp", "unit", "coalesce(centre, node) AS centre", "coalesce(gap, 0D) AS gap"
    )


def _start(centres: DataFrame, seeds: list[int]) -> DataFrame:
    """(a, b, cosine) of nodes close to each other in an order by code; both directions."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node")
            group = np.asarray(batch.column("grp"))
            turn = np.asarray(batch.column("turn"))
            cuts = np.flatnonzero(np.diff(group) | np.diff(turn)) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(group)], strict=True):
                n = int(end - begin)
                if n < 2:
                    continue
                rows = _matrix(batch.column("unit").slice(begin, n))
                shifts = range(1, min(LOOK, n - 1) + 1)
                cosine = np.full((len(shifts), n), -2.0)
                for k, shift in enumerate(shifts):
                    cosine[k, : n - shift] = np.einsum("ij,ij->i", rows[:-shift], rows[shift:])
                for rank in np.argsort(-cosine, axis=0)[:2]:
                    at = np.flatnonzero(cosine[rank, np.arange(n)] > -2)
                    left, right = at, at + rank[at] + 1
                    value = cosine[rank[at], at]
                    a = node.take(pa.array(np.concatenate([left, right]) + begin))
                    b = node.take(pa.array(np.concatenate([right, left]) + begin))
                    yield pa.RecordBatch.from_arrays(
                        [a, b, pa.array(np.concatenate([value, value]))], ["a", "b", "cosine"]
                    )

    kind = centres.schema["node"].dataType.simpleString()
    coded = _coded(centres.select("node", "grp", "unit"), ORDER_BITS, seeds)
    order = ["turn", "grp", "code", "node"]
    parts = int(centres.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = coded.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return spread.mapInArrow(look, f"a {kind}, b {kind}, cosine double")


def _best(edges: DataFrame, info: DataFrame) -> DataFrame:
    """Each node's `room` best neighbours; of equal ones the smaller."""
    once = edges.groupBy("a", "b").agg(F.max("cosine").alias("cosine"), F.min("new").alias("new"))
    sized = once.join(info.selectExpr("node AS a", "room"), "a")
    return sized.selectExpr(
        "*", "row_number() OVER (PARTITION BY a ORDER BY cosine DESC, b) AS place"
    ).where("place <= room")


def _introduce(graph: DataFrame, info: DataFrame) -> DataFrame:
    """(a, b, cosine) of nodes that share a neighbour and improve one of the two lists."""
    both = graph.select("a", "b", "cosine", "new", "room").union(
        graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine", "new", "room")
    )
    both = both.groupBy("a", "b").agg(
        F.max("cosine").alias("cosine"), F.max("new").alias("new"), F.max("room").alias("room")
    )
    # Forward and reverse neighbours together are at most twice a list, the best of them.
    near = both.selectExpr(
        "*", "row_number() OVER (PARTITION BY a ORDER BY cosine DESC, b) AS place"
    ).where("place <= 2 * room")
    worst = graph.groupBy("a").agg(
        F.min("cosine").alias("low"), F.count(F.lit(1)).alias("n"), F.max("room").alias("room")
    )
    worst = worst.selectExpr("a AS b", "CASE WHEN n < room THEN -2D ELSE low END AS worst")
    known = info.selectExpr("node AS b", "unit").join(worst, "b")
    lists = (
        near.select("a", "b", "new").join(known, "b")
        .groupBy("a").agg(F.collect_list(F.struct("b", "new", "worst", "unit")).alias("l"))
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column("l"):
                part = row.values
                rows = _matrix(part.field("unit"))
                if len(rows) < 2:
                    continue
                cosine = rows @ rows.T
                worst = np.asarray(part.field("worst"))
                new = np.asarray(part.field("new"))
                good = (cosine > worst[:, None]) & (new[:, None] | new[None, :]).astype(bool)
                np.fill_diagonal(good, False)
                x, y = np.nonzero(good)
                if len(x):
                    nodes = part.field("b")
                    yield pa.RecordBatch.from_arrays(
                        [nodes.take(pa.array(x)), nodes.take(pa.array(y)), pa.array(cosine[x, y])],
                        ["a", "b", "cosine"],
                    )

    kind = info.schema["node"].dataType.simpleString()
    return lists.select("l").mapInArrow(meet, f"a {kind}, b {kind}, cosine double")


def _saturated(graph: DataFrame, centres: DataFrame, theta: float) -> DataFrame:
    """(node, room) of every full list whose last entry could be a link: it may lack others."""
    full = graph.where("place = room").selectExpr("a AS node", "cosine", "room")
    full = full.join(centres.select("node", "radius", "top"), "node")
    full = full.where(f"acos(least(1D, cosine)) <= {theta + _EDGE} + radius + top")
    return full.select("node", "room")


def _descend(
    edges: DataFrame, centres: DataFrame, theta: float, folder: str, name: str
) -> tuple[DataFrame, DataFrame]:
    """The graph (a, b, cosine, new, room, place) when it has settled, and its nodes."""
    info = centres
    total = max(1, centres.count())
    graph = stored(_best(edges.selectExpr("*", "1 AS new"), info), folder, f"{name}-0")
    for turn in range(1, ROUNDS + 1):
        full = _saturated(graph, info, theta).where(f"room < {MOST}")
        info = info.join(full.selectExpr("node", "true AS more"), "node", "left").selectExpr(
            "node", "grp", "unit", "radius", "top", "IF(more, 2 * room, room) AS room"
        )
        info = stored(info, folder, f"{name}-{turn}-nodes")
        met = _introduce(graph, info).selectExpr("*", "1 AS new")
        old = graph.selectExpr("a", "b", "cosine", "0 AS new")
        graph = stored(_best(old.union(met), info), folder, f"{name}-{turn}")
        found = graph.agg(F.sum("new")).first()[0] or 0
        more = _saturated(graph, info, theta).where(f"room < {MOST}").limit(1).count()
        if found <= SETTLED * LIST * total and not more:
            break
    return graph, info


def _meetings(some: DataFrame, every: DataFrame, folder: str, name: str) -> PandasCogroupedOps:
    """The rows of `some` and `every` by group and pair of blocks: each two of a group meet once."""
    sizes = every.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).join(
        some.groupBy("grp").agg(F.count(F.lit(1)).alias("m")), "grp"
    )
    sizes = sizes.selectExpr("grp", f"(m - 1) DIV {BLOCK} + 1 AS lefts", f"(n - 1) DIV {BLOCK} + 1 AS rights")
    sizes = stored(sizes, folder, f"{name}-sizes")
    keys = ["grp", "l", "r"]
    own, others = "pmod(xxhash64(node), {}) AS {}", "explode(sequence(0L, {} - 1)) AS {}"
    left = some.join(sizes, "grp").selectExpr(
        *(f"{c} AS {c}" for c in some.columns), own.format("lefts", "l"), others.format("rights", "r")
    )
    right = every.join(sizes, "grp").selectExpr(
        *(f"{c} AS {c}" for c in every.columns), own.format("rights", "r"), others.format("lefts", "l")
    )
    return left.groupBy(*keys).cogroup(right.groupBy(*keys))


def _met(left: pa.Table, right: pa.Table, threshold: float) -> np.ndarray:
    """Which rows of the two tables link, other than inside one ball."""
    x, y = (_matrix(t.column("unit").combine_chunks()) for t in (left, right))
    ball = pa.concat_arrays([t.column("centre").combine_chunks() for t in (left, right)])
    ball = np.asarray(ball.dictionary_encode().indices)
    return (x @ y.T >= threshold) & (ball[: len(x), None] != ball[None, len(x) :])


def _audit(
    graph: DataFrame, free: DataFrame, centres: DataFrame, theta: float, folder: str, name: str
) -> DataFrame:
    """(grp, links, found): links between balls of a sample of vectors, by brute force, and the graph's.

    The sample has vectors of every group, of balls with a near neighbour in the graph and of others.
    """
    threshold = math.cos(theta)
    best = graph.where("place = 1").selectExpr("a AS node", "cosine")
    reach = f"acos(least(1D, greatest(-1D, cosine))) <= {theta + _EDGE} + radius + top"
    flags = centres.join(best, "node", "left").selectExpr("node AS centre", f"coalesce({reach}, false) AS close")
    sample = free.join(flags, "centre").selectExpr(
        "*", "row_number() OVER (PARTITION BY grp, close ORDER BY xxhash64(node), node) AS turn"
    )
    sample = stored(sample.where(f"turn <= {AUDIT}").select(*free.columns), folder, f"{name}-sample")

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (len(left) and len(right)):
            return pa.table([pa.array([], t) for t in types], names=["grp", "a", "b"])
        x, y = np.nonzero(_met(left, right, threshold))
        return pa.table(
            [left.column("grp").take(pa.array(x)), left.column("centre").take(pa.array(x)),
             right.column("centre").take(pa.array(y))],
            names=["grp", "a", "b"],
        )

    kind = centres.schema["node"].dataType
    types = [pa.int64(), to_arrow_type(kind), to_arrow_type(kind)]
    true = _meetings(sample, free, folder, name).applyInArrow(
        look, f"grp bigint, a {kind.simpleString()}, b {kind.simpleString()}"
    )
    links = graph.select("a", "b").union(graph.select("b", "a")).distinct().withColumn("found", F.lit(1))
    held = true.join(links, ["a", "b"], "left").groupBy("grp")
    held = held.agg(F.count(F.lit(1)).alias("links"), F.count("found").alias("found"))
    return stored(held, folder, f"{name}-audit")


def _exact(hard: DataFrame, every: DataFrame, threshold: float, folder: str) -> DataFrame:
    """(node, n, centre, lead): links of the vectors of `hard` to all of their group, by brute force.

    n is the node's links to other balls in one pair of blocks; for vectors that are not hard, those to
    hard ones. Pairs are not listed: lead is the centre of one hard vector to which links lead.
    """

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["node", "n", "centre", "lead"]
        if not (len(left) and len(right)):
            return pa.table([pa.array([], t) for t in types], names=names)
        linked = _met(left, right, threshold)
        x, y = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
        linked = linked[np.ix_(x, y)]
        # Each row's smallest row that is reached over links in this pair of blocks.
        low, before = np.arange(len(x)), None
        while len(x) and (before is None or (low != before).any()):
            before = low
            below = np.where(linked, low[:, None], len(x)).min(axis=0)
            low = np.minimum(low, np.where(linked, below[None, :], len(x)).min(axis=1))
            low = low[low]
        if not len(x):
            below = low
        counted = ~np.asarray(right.column("hard").combine_chunks().to_numpy(zero_copy_only=False))[y]
        centre = left.column("centre").combine_chunks()
        rows = [left.take(pa.array(x)), right.take(pa.array(y))]
        many = np.concatenate([linked.sum(axis=1), linked.sum(axis=0) * counted]).astype(np.int64)
        return pa.table(
            [pa.concat_arrays([t.column("node").combine_chunks() for t in rows]), pa.array(many),
             pa.concat_arrays([t.column("centre").combine_chunks() for t in rows]),
             centre.take(pa.array(x[np.concatenate([low, below])]))],
            names=names,
        )

    kind = every.schema["node"].dataType
    types = [to_arrow_type(kind), pa.int64(), to_arrow_type(kind), to_arrow_type(kind)]
    marked = every.join(hard.withColumn("hard", F.lit(True)), "centre", "left").selectExpr(
        "node", "grp", "unit", "centre", "coalesce(hard, false) AS hard"
    )
    marked = stored(marked, folder, "marked")
    name = kind.simpleString()
    met = _meetings(marked.where("hard").drop("hard"), marked, folder, "exact")
    return stored(
        met.applyInArrow(look, f"node {name}, n bigint, centre {name}, lead {name}"), folder, "exact"
    )


def near_vectors(
    vectors: DataFrame,
    *,
    ident: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector.

    Only vectors of one label and one dimension are compared, by cosine in double precision. A vector
    that is null, empty or all zeros, or holds a null or a number that is not finite, and one without
    a label, links with nothing and is its own component. Rows with equal ids are one vector, the
    smallest by label and components. Rows without an id give one row, without a component, that is
    not kept. Other columns are left out. An empty table gives an empty table.
    """
    spark = vectors.sparkSession
    folder = work_folder(spark)
    theta = math.acos(threshold)
    units = stored(_units(vectors, ident, vector, label), folder, "units")
    balls = stored(_balls(units, theta / 2 - _EDGE, folder), folder, "balls")
    inside = balls.groupBy("centre").agg(
        F.max(F.when(F.col("gap") > 0, F.col("gap") + _EDGE).otherwise(0.0)).alias("radius"),
        F.count(F.lit(1)).alias("members"),
    )
    top = inside.agg(F.coalesce(F.max("radius"), F.lit(0.0))).scalar()
    centres = units.join(inside.withColumnRenamed("centre", "node"), "node")
    centres = stored(
        centres.withColumn("top", top).withColumn("room", F.lit(LIST)), folder, "centres"
    )
    nodes = centres.drop("members")
    edges = _start(nodes, list(range(ORDERS)))
    every_one = balls.select("node", "grp", "unit", "centre")
    for start in range(STARTS):
        graph, info = _descend(edges, nodes, theta, folder, f"graph-{start}")
        crowded = stored(_saturated(graph, info, theta).selectExpr("node AS centre"), folder, f"crowded-{start}")
        free = every_one.join(crowded, "centre", "left_anti").select(*every_one.columns)
        audit = _audit(graph, free, centres, theta, folder, f"audit-{start}")
        links, found = audit.agg(F.sum("links"), F.sum("found")).first()
        if not links or found >= RECALL * links:
            break
        seeds = list(range((start + 1) * ORDERS, (start + 2) * ORDERS))
        edges = graph.select("a", "b", "cosine").union(_start(nodes, seeds))
        nodes = info
    missed = audit.where(F.col("found") < RECALL * F.col("links")).select("grp")
    missed = centres.join(missed, "grp", "left_semi").selectExpr("node AS centre")
    hard = stored(crowded.union(missed).distinct(), folder, "hard")
    for side in "ab":
        graph = graph.join(hard.withColumnRenamed("centre", side), side, "left_anti")
    pairs = graph.selectExpr("greatest(a, b) AS a", "least(a, b) AS b", "cosine").groupBy("a", "b").agg(
        F.max("cosine").alias("cosine")
    )
    size = centres.select("node", "radius", "members")
    for side in "ab":
        named = size.select(
            F.col("node").alias(side), F.col("radius").alias(f"r{side}"), F.col("members").alias(f"m{side}")
        )
        pairs = pairs.join(named, side)
    gap, wide = "acos(least(1D, greatest(-1D, cosine)))", "(ra + rb)"
    pairs = pairs.selectExpr(
        "a", "b", "ma", "mb",
        f"CASE WHEN ra = 0 AND rb = 0 THEN cosine >= {threshold!r}D "
        f"WHEN {gap} + {wide} <= {theta!r}D - {_EDGE} THEN true "
        f"WHEN {gap} - {wide} > {theta!r}D + {_EDGE} THEN false END AS linked",
    ).where("linked OR linked IS NULL")
    pairs = stored(pairs, folder, "pairs")
    some = balls.selectExpr("centre", "node", "unit")
    single = (
        pairs.where("linked IS NULL").select("a", "b")
        .join(some.selectExpr("centre AS a", "node AS x", "unit AS u"), "a")
        .join(some.selectExpr("centre AS b", "node AS y", "unit AS w"), "b")
        .where(F.expr(_DOT.format("u", "w")) >= threshold)
        .select("a", "b", "x", "y")
    )
    single = stored(single, folder, "single")
    linked = pairs.where("linked").select("a", "b").union(single.select("a", "b").distinct())
    exact = None
    if hard.limit(1).count():
        exact = _exact(hard, every_one, threshold, folder)
        linked = linked.union(exact.where("centre <> lead").selectExpr("centre AS a", "lead AS b").distinct())
    joined = components(linked, folder)
    sure = pairs.where("linked")
    by_ball = sure.selectExpr("a AS centre", "mb AS n").union(sure.selectExpr("b AS centre", "ma AS n"))
    by_ball = by_ball.groupBy("centre").agg(F.sum("n").alias("by_ball"))
    by_node = single.selectExpr("x AS node", "1L AS n").union(single.selectExpr("y AS node", "1L AS n"))
    if exact is not None:
        by_node = by_node.union(exact.select("node", "n"))
    by_node = by_node.groupBy("node").agg(F.sum("n").alias("by_node"))
    every = (
        balls.select("node", "centre")
        .join(size.selectExpr("node AS centre", "members"), "centre")
        .join(by_ball, "centre", "left")
        .join(joined.selectExpr("node AS centre", "component"), "centre", "left")
        .join(by_node, "node", "left")
        .selectExpr(
            "node",
            "members - 1 + coalesce(by_ball, 0) + coalesce(by_node, 0) AS n_links",
            "coalesce(component, centre) AS component",
        )
    )
    names = every.groupBy("component").agg(F.min("node").alias("component_id"))
    every = every.join(names, "component").select("node", "n_links", "component_id")
    ids = vectors.select(F.col(ident).alias("__id")).distinct()
    out = ids.join(every, F.col("__id") == F.col("node"), "left")
    component = F.coalesce("component_id", "__id")
    return out.select(
        F.col("__id").alias(plain(ident, ("n_links", "component_id", "kept"))),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("__id") == component, F.lit(False)).alias("kept"),
    )
