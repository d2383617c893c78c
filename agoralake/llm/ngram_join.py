"""N-gram Jaccard join: adaptive multi-match prefixes, exact verification, components of links.

Every document is the set of its word n-grams. All sets are sorted by one order, rare n-grams first.
Two sets that reach the threshold share at least l n-grams of their l-prefixes, for any l; an l-prefix
is l - 1 longer than the shortest one. Each document takes the l at which its cost is least: scanning
the lists of its prefix, and verifying at most an l-th of what they hold. A pair is matched at the
smaller l of its two documents.

That is done twice. First the order only begins with the n-grams whose hash is low (about a quarter),
by their exact number of documents, and goes on by hash: a prefix needs no more, and one row for each
low one is all that shuffles. N-grams of a single document come first and pair with nothing, they only
count; a document with a prefix of nothing else is done. Among those that are left, all n-grams are
counted and ordered, which tells a group's members apart by what is their own.

Equal sets are one class from the start. A list of an n-gram pairs its members with its first one
only, which joins large groups of near copies without listing their pairs; then lists that still
hold more than one component pair what is in different ones. What is left out is therefore only
pairs that are connected already. Candidates are verified on their whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agoralake.llm.common import (
    Apart,
    Members,
    components,
    plain,
    stored,
    window_hashes,
    word_hashes,
    work_folder,
)

#: Greatest l, and what verifying a candidate costs in scanned list entries.
MAX_MATCH, VERIFY_COST = 8, 8.0
#: The share of low n-grams is this times the share of a set that a shortest prefix takes.
LOW_SHARE = 1.7


def shingles(body: bytes | None, words: int) -> np.ndarray:
    """The sorted distinct hashes of a text's n-grams; of a shorter text, of all its words."""
    hashes = word_hashes((body or b"").lower().split())
    if 0 < len(hashes) < words:
        return window_hashes(hashes, len(hashes)) ^ np.uint64(len(hashes))
    return np.unique(window_hashes(hashes, words))


def needed(size: int, percent: int) -> int:
    """What a set of `size` shares with any set that reaches the threshold: ceil(percent% of it)."""
    return -(-percent * size // 100)


def ordered(
    grams: np.ndarray, percent: int, share: float | None = None
) -> tuple[int, np.ndarray, np.ndarray]:
    """Of a sorted set: how many low n-grams it has, and all that a prefix may need, with places.

    Low n-grams have place 0, as only their document counts order them. Where they are too few for
    the longest prefix, others follow by hash, and have their place in the whole order.
    """
    share = min(1.0, LOW_SHARE * (100 - percent) / 100) if share is None else share
    low = int(np.searchsorted(grams, np.uint64(min(share * 2.0**64, 2.0**64 - 2048)), "right"))
    most = min(len(grams), len(grams) - needed(len(grams), percent) + MAX_MATCH)
    places = np.arange(1, max(low, most) + 1)
    places[:low] = 0
    return low, grams[: len(places)], places


def _sets(docs: DataFrame, ident: str, text: str, words: int, percent: int) -> DataFrame:
    """(id, node, size, low) of every document; a node stands for all with an equal set."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, lows = [], [], []
            for body in batch.column(1):
                grams = shingles(body.as_py(), words)
                nodes.append(_node(grams) if len(grams) else None)
                sizes.append(len(grams))
                lows.append(ordered(grams, percent)[0])
            columns = [pa.array(c, pa.int64()) for c in (nodes, sizes, lows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "node", "size", "low"])

    kind = docs.schema[ident].dataType.simpleString()
    rows = docs.select(F.col(ident).alias("id"), F.col(text).cast("binary").alias("body"))
    return rows.mapInArrow(compute, f"id {kind}, node bigint, size bigint, low bigint")


def _node(grams: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)


def _grams(
    bodies: DataFrame, words: int, percent: int, share: float | None = None
) -> DataFrame:
    """(gram, node, place) of what prefixes may need, once for equal sets of a task."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def rows() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "node", "place"])

        for body in (x for batch in batches for x in batch.column(0)):
            grams = shingles(body.as_py(), words)
            if len(grams) and (node := _node(grams)) not in seen:
                seen.add(node)
                _, own, places = ordered(grams, percent, share)
                parts.append((own.view(np.int64), np.full(len(own), node), places.astype(np.int32)))
                if len(parts) >= 500 or len(own) > 200_000:
                    yield rows()
        if parts:
            yield rows()

    bodies = bodies.select("body").where("body IS NOT NULL")
    return bodies.mapInArrow(emit, "gram bigint, node bigint, place int")


def _prefixes(sets: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """(gram, node, size, match, place, own) of each prefix's n-grams that other documents have too.

    place is an n-gram's place in the document's order, match the l the document takes, and own the
    share of its low n-grams that no other document has.
    """
    # Counts combine before they shuffle, and the join spreads a very common n-gram over many tasks.
    counts = grams.groupBy("gram").agg(
        F.min("node").alias("a"), F.max("node").alias("b"), F.count(F.lit(1)).alias("df")
    )
    counts = counts.where("a <> b").select("gram", "df")
    shared = grams.join(counts, "gram").select("gram", "node", "place", "df").distinct()
    classes = sets.where("node IS NOT NULL").groupBy("node").agg(
        F.first("size").alias("size"), F.first("low").alias("low")
    )
    ranked = shared.join(classes, "node").selectExpr(
        "*",
        # Low n-grams of no other document come before those that are shared.
        "IF(place > 0, place, low - count_if(place = 0) OVER (PARTITION BY node) + row_number() OVER "
        "(PARTITION BY node ORDER BY IF(place > 0, 1, 0), df, gram)) AS rank",
        f"size - ({percent} * size + 99) DIV 100 + 1 AS least",
        # What the shortest prefix is for a partner of the same size; costs are estimated for that.
        f"size - (2 * {percent} * size + {99 + percent}) DIV {100 + percent} + 1 AS tight",
        "1 - count_if(place = 0) OVER (PARTITION BY node) / greatest(low, 1) AS own",
    )
    levels = ranked.selectExpr(
        "*",
        "CAST(greatest(1, rank - least + 1) AS INT) AS level",
        "CAST(greatest(1, rank - tight + 1) AS INT) AS same",
        "min(rank) OVER (PARTITION BY node) AS front",
        "sum(df) OVER (PARTITION BY node ORDER BY rank) AS scan",
    ).where(f"front <= least AND level <= {MAX_MATCH}")
    costs = levels.selectExpr(
        "*",
        f"max(scan) OVER (PARTITION BY node, same) * (1 + {VERIFY_COST}D / same) AS cost",
    )
    chosen = costs.selectExpr(
        "*",
        f"min(IF(same <= {MAX_MATCH}, struct(cost, same), NULL)) OVER (PARTITION BY node) AS best",
        "min(same) OVER (PARTITION BY node) AS nearest",
    ).withColumn("match", F.expr("IF(nearest > 1, 1, best.same)"))
    return chosen.where("level <= match").selectExpr(
        "gram", "node", "size", "match", "rank AS place", "own"
    )


def _matching(texts: DataFrame, words: int) -> DataFrame:
    """The texts of their node, where several have one id."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = (_node(shingles(body.as_py(), words)) for body in batch.column(1))
            same = [a == b for a, b in zip(nodes, batch.column(0).to_pylist(), strict=True)]
            yield batch.filter(pa.array(same, pa.bool_()))

    return texts.mapInArrow(choose, texts.schema)


def _compared(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(a, b, both, any): how many n-grams two sets share and have, counted on their whole texts."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            both, every = [], []
            for a, b, left, right in zip(*batch.columns, strict=True):
                sets = []
                for node, body in ((a.as_py(), left), (b.as_py(), right)):
                    if node not in known:
                        if len(known) > 256:
                            known.clear()
                        known[node] = shingles(body.as_py(), words)
                    sets.append(known[node])
                x, y = sets
                both.append(len(np.intersect1d(x, y, assume_unique=True)))
                every.append(len(x) + len(y) - both[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(both, pa.int64()), pa.array(every, pa.int64())],
                ["a", "b", "both", "any"],
            )

    left = texts.select(F.col("node").alias("a"), F.col("body").alias("__a"))
    right = texts.select(F.col("node").alias("b"), F.col("body").alias("__b"))
    whole = pairs.join(left, "a").join(right, "b").select("a", "b", "__a", "__b")
    return whole.mapInArrow(compare, "a bigint, b bigint, both bigint, any bigint")


def ngram_components(
    docs: DataFrame,
    *,
    ident: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """(id, n_shingles, component_id) of every row of docs.

    component_id is the smallest id that links reach, the row's own id included. Words are split at
    ASCII white space, A-Z lower-cased. A null text, or one without words, has 0 shingles and links
    with nothing; one with fewer than `words` words is a set of one. Rows with equal ids each count as
    a text of that id. A row without an id is in the component of rows with an equal set, gives it no
    name and links no further. An
    empty table gives an empty table. Sets are told apart by 64-bit hashes of their n-grams.
    """
    spark = docs.sparkSession
    folder = work_folder(spark)
    rows = stored(_sets(docs, ident, text, words, percent), folder, "sets")
    whole = docs.select(F.col(ident).alias("id"), F.col(text).cast("binary").alias("body"))
    grams = stored(_grams(whole, words, percent), folder, "low-grams")
    coarse = _prefixes(rows, grams, percent)
    coarse = stored(coarse.select("gram", "node"), folder, "coarse")
    lists = coarse.groupBy("gram").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    some = coarse.join(lists.where("a <> b").select("gram"), "gram").select("node").distinct()
    some = stored(some, folder, "some")
    # The texts of the classes left, each once; among them all n-grams are counted and ordered.
    bodies = rows.select("id", "node", "size").join(some, "node", "left_semi")
    bodies = bodies.groupBy("node").agg(F.min("id").alias("id"), F.first("size").alias("size"))
    bodies = stored(bodies, folder, "left")
    texts = Members.of(bodies.select("id")).keep(whole, "id").join(bodies, "id")
    texts = _matching(texts.select("node", "body"), words).dropDuplicates(["node"])
    texts = stored(texts, folder, "texts")
    every = bodies.selectExpr("node", "size", "size AS low")
    grams = stored(_grams(texts, words, percent, 1.0), folder, "all-grams")
    entries = stored(_prefixes(every, grams, percent), folder, "entries")
    # The member with the fewest n-grams of its own is the likeliest origin of the others.
    heads = entries.groupBy("gram").agg(
        F.min(F.struct("own", "node", "size")).alias("head"), F.count(F.lit(1)).alias("held")
    )
    heads = heads.where("held > 1").drop("held")
    lists = stored(entries.drop("own").join(heads, "gram"), folder, "lists")
    def fit(a: str, b: str) -> str:
        return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"

    linked = f"100 * both >= {percent} * any"
    first = lists.where("node <> head.node").where(fit("size", "head.size"))
    first = first.selectExpr("node AS a", "head.node AS b").distinct()
    first = stored(_compared(first, texts, words), folder, "first")
    near = first.where(linked).select("a", "b")
    joined = components(near, folder, "joined").withColumnRenamed("node", "__node")
    rest = lists.join(joined, F.col("node") == F.col("__node"), "left").selectExpr(
        "gram", "node", "size", "match", "place", "coalesce(component, node) AS component"
    )
    rest = stored(rest, folder, "members")
    mixed = rest.groupBy("gram").agg(F.min("component").alias("a"), F.max("component").alias("b"))
    rest = stored(rest.join(mixed.where("a <> b").select("gram"), "gram"), folder, "rest")
    x, y = rest.alias("x"), rest.alias("y")
    # A pair of known sizes has to share so much, and its prefixes are that much shorter.
    overlap = f"(({percent} * (x.size + y.size) + {99 + percent}) DIV {100 + percent})"
    x, y = rest.alias("x"), rest.alias("y")
    shared = x.join(
        y,
        F.expr(
            "x.gram = y.gram AND x.node > y.node AND x.component <> y.component AND "
            f"x.place <= x.size - {overlap} + least(x.match, y.match) AND "
            f"y.place <= y.size - {overlap} + least(x.match, y.match) AND " + fit("x.size", "y.size")
        ),
    ).selectExpr("x.node AS a", "y.node AS b", "least(x.match, y.match) AS match")
    second = shared.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.first("match").alias("match"))
    second = second.where("n >= match").select("a", "b")
    known = first.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    second = second.join(known, ["a", "b"], "left_anti")
    far = stored(_compared(second, texts, words), folder, "second").where(linked).select("a", "b")
    whole = components(near.union(far), folder, "whole").withColumnRenamed("node", "__node")
    named = rows.select("id", "size", "node").join(whole, F.col("node") == F.col("__node"), "left")
    named = named.withColumn("component", F.coalesce("component", "node")).drop("node", "__node")
    names = named.groupBy("component").agg(F.min("id").alias("__name"))
    named = named.join(names.withColumnRenamed("component", "__of"), F.col("component") == F.col("__of"), "left")
    return named.select(
        F.col("id").alias(ident),
        F.col("size").alias(plain("n_shingles", [ident])),
        F.when(F.col("size") > 0, F.col("__name")).otherwise(F.col("id")).alias(
            plain("component_id", [ident])
        ),
    )


def one_of_each(docs: DataFrame, *, ident: str = "doc_id", **options) -> DataFrame:
    """The documents that name their group, with their own columns; other members go.

    Rows without an id stay, and so do rows that repeat a document's id with a text of its group.
    """
    apart = Apart(docs)
    text = apart[options.pop("text", "text")]
    texts = apart.rows.select(F.col(apart[ident]).alias("id"), F.col(text).alias("text"))
    found = ngram_components(texts, ident="id", **options)
    gone = found.where("component_id <> id").select(F.col("id").alias("__gone")).distinct()
    kept = apart.rows.join(gone, F.col(apart[ident]) == F.col("__gone"), "left_anti")
    return apart.back(kept)
