"""Phrase collocations from a weighted de Bruijn graph of word sequences, per language.

Nodes are phrases of three words, an edge is a phrase of four that leads from its first three words to
its last three, weighted by its occurrences. All else follows from the edges:

- The flow out of a node, plus what ends a piece there, is the node's count. The same step again
  gives the counts of two words and of one, so text is counted once, by its longest phrases.
- A position whose longest phrase certainly stays below `min_count` counts as ending sooner: it is a
  correction of the longest of its phrases that may reach it. The flows of all phrases that do are
  the same, and rare phrases, nearly all there are, never shuffle as words. Which ones may reach it is
  told by a count of their hashes first: exact sums over ranges of the hash, of which only those
  that reach `min_count` set bits of a filter of fixed size. Collisions let a phrase more through.
- A node that one edge enters and one leaves is the inside of a unary path. Paths are compacted by
  doubling: each edge knows the edge 1, 2, 4, ... steps before it, each round a written table. The inner
  nodes' best longer phrases are then read off the path; only branching nodes are grouped.

Arithmetic on counts is in decimals of 38 digits. Null texts are empty, a null language is `und`.
Only the two named columns are read, so others may have any name; repeated rows count as often
as they occur; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agoralake.llm.common import Members, mixed_hash, stored, word_hashes, work_folder
from agoralake.llm.words import Words, chained, filter_hash, summed

#: Words of the longest phrase, the graph's edges.
LONGEST = 4
MIN_COUNT, PERCENT, TOP = 30, 80, 2000
# What separates words, and what ends a piece.
SPACES, ENDS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
#: Hashes, or distinct phrases, that a task holds before it hands them on.
HELD_HASHES, HELD_PHRASES = 1 << 20, 1 << 18
#: Edges of a row of a compacted path.
STRETCH = 1024


def _hashed(words: Words, langs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 2 words, 3, ...: the positions that have so many words left in their piece, and hashes there."""
    word = words.hashes()[words.code]
    lang = word_hashes(langs)
    place = np.arange(len(word))
    now = chained(mixed_hash(lang)[words.row], word) if len(word) else word
    for k in range(2, LONGEST + 1):
        place = place[place + k <= len(word)]
        place = place[words.piece[place] == words.piece[place + k - 1]]
        full = np.zeros(len(word), np.uint64)
        full[place] = chained(now[place], word[place + k - 1])
        now = full
        yield place, now[place]


def _batch(batch: pa.RecordBatch) -> tuple[Words, list[bytes]]:
    return Words.of(batch.column("text"), SPACES, ENDS), batch.column("lang").to_pylist()


def _suspects(docs: DataFrame, min_count: int) -> DataFrame:
    """(h): hashes of phrases of 2 words and more whose occurrences add up to `min_count`.

    Tasks send sorted hashes and their counts by ranges of the hash, some bytes a phrase; ranges
    follow the number of shuffle partitions, so that each fits in a task.
    """
    spark = docs.sparkSession
    bits = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")).bit_length() + 3)
    low = np.uint64(64 - bits)

    def packed(hashes: list[np.ndarray]) -> pa.RecordBatch:
        all_, n = np.unique(np.concatenate(hashes), return_counts=True)
        n = np.minimum(n, min_count).astype(np.uint8)
        cut = np.flatnonzero(np.diff(all_ >> low)) + 1
        rows = [
            (int(h[0] >> low), _planes((h << np.uint64(bits)) >> np.uint64(32)), c.tobytes())
            for h, c in zip(np.split(all_, cut), np.split(n, cut), strict=True)
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2))],
            ["stretch", "hashes", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, hashes in _hashed(*_batch(batch)):
                held.append(hashes)
                size += len(hashes)
            if size > HELD_HASHES:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for stretch, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if stretch != now and held:
                    yield _heavy(now, held, min_count, bits)
                    held = []
                now = stretch
                held.append((_unplaned(row[0]), np.frombuffer(row[1], np.uint8)))
        if held:
            yield _heavy(now, held, min_count, bits)

    parts = docs.mapInArrow(count, "stretch int, hashes binary, counts binary")
    return parts.repartition("stretch").sortWithinPartitions("stretch").mapInArrow(add, "h bigint")


def _planes(values: np.ndarray) -> bytes:
    """Steps between sorted 32-bit values, high bytes first, which shuffle compression shortens."""
    step = np.diff(values, prepend=np.uint64(0)).astype(">u4")
    return np.ascontiguousarray(step.view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplaned(body: bytes) -> np.ndarray:
    step = np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(4, -1).T).view(">u4")
    return np.cumsum(step.ravel(), dtype=np.uint64)


def _heavy(stretch: int, held: list, min_count: int, bits: int) -> pa.RecordBatch:
    values, group = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
    n = np.bincount(group, np.concatenate([c for _, c in held]))
    found = values[n >= min_count] | (np.uint64(stretch) << np.uint64(32))
    return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["h"])


def _edges(docs: DataFrame, min_count: int) -> DataFrame:
    """(lang, gram, n): each position's longest phrase that may reach `min_count`, counted exactly."""
    bits = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")).bit_length() + 3)
    members = Members.of(_suspects(docs, min_count))
    held, probe, schema = members.filled, Members._bits, "lang binary, gram binary, n bigint"
    arrow = pa.schema([("lang", pa.binary()), ("gram", pa.binary()), ("n", pa.int64())])

    def may(hashes: np.ndarray, filled: np.ndarray) -> np.ndarray:
        # the bits of _suspects: the range, then the 32 bits below it
        key = hashes >> np.uint64(32 - bits)
        asked = probe(filter_hash(key).view(np.int64))
        byte = filled[asked >> np.uint64(3)] >> (asked & np.uint64(7)).astype("u1")
        return (byte & 1).all(axis=1)

    def longest(batch: pa.RecordBatch, filled: np.ndarray) -> pa.Table:
        words, langs = _batch(batch)
        size = np.ones(len(words.code), np.int8)
        for k, (place, hashes) in enumerate(_hashed(words, langs), 2):
            ask = size[place] == k - 1
            place, hashes = place[ask], hashes[ask]
            size[place[may(hashes, filled)]] = k
        langs = pa.array(langs, pa.binary()).dictionary_encode()
        named, tables = np.asarray(langs.indices), []
        for k in range(1, LONGEST + 1):
            place = np.flatnonzero(size == k)
            columns = {"lang": named[words.row[place]]} | {f"w{j}": words.code[place + j] for j in range(k)}
            sums = pa.table(columns).group_by(list(columns), use_threads=False).aggregate([([], "count_all")])
            gram = pc.binary_join_element_wise(*(words.values.take(sums[f"w{j}"]) for j in range(k)), b" ")
            tables.append(pa.table([langs.dictionary.take(sums["lang"]), gram, sums["count_all"]], schema=arrow))
        return pa.concat_tables(tables)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.frombuffer(held.value, "u1")
        yield from summed((longest(batch, filled) for batch in batches), ["lang", "gram"], HELD_PHRASES)

    found = docs.mapInArrow(emit, schema)
    found = found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return found.select(F.col("lang").cast("string"), F.col("gram").cast("string"), "n")


def _size(gram: Column) -> Column:
    return (F.length(gram) - F.length(F.replace(gram, F.lit(" "), F.lit(""))) + 1).alias("k")


def node_flows(edges: DataFrame) -> DataFrame:
    """(lang, gram, k, n): counts of all phrases that edges or corrections go through, by their flow."""
    now = edges.withColumn("k", _size(F.col("gram")))
    out, upper = [now.where(F.col("k") == LONGEST)], now.where(F.col("k") == LONGEST)
    for k in range(LONGEST - 1, 0, -1):
        below = now.where(F.col("k") == k).unionByName(upper)
        upper = (
            below.groupBy("lang", F.substring_index("gram", " ", k).alias("gram"))
            .agg(F.sum("n").alias("n"))
            .withColumn("k", F.lit(k))
        )
        out.append(upper)
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole.select("lang", "gram", F.col("k").cast("int").alias("k"), "n")


def _ends(edges: DataFrame, *more: str) -> DataFrame:
    """Every edge twice: with the node that it leaves (out) and with the one that it enters."""
    start = F.substring_index("gram", " ", LONGEST - 1)
    end = F.substring_index("gram", " ", 1 - LONGEST)
    both = F.array(
        F.struct(start.alias("node"), F.lit(True).alias("out")),
        F.struct(end.alias("node"), F.lit(False).alias("out")),
    )
    return edges.select("lang", "gram", "n", *more, F.explode(both).alias("e")).select(
        "lang", "gram", "n", *more, "e.node", "e.out"
    )


def _heads(links: DataFrame, folder: str, name: str) -> tuple[DataFrame, DataFrame | None]:
    """Path head and distance of every edge of (lang, gram, n, up), and the edges on circles if any.

    An open edge knows the edge `hops` steps before it and the least of those passed over. Along a path a
    round always closes some, so when none is closed all open ones are on circles; once the steps
    exceed their number, `least` is the least edge of the circle.
    """
    closed = F.col("up").isNull()
    now = links.select(
        "lang",
        "gram",
        "n",
        "up",
        F.col("up").alias("least"),
        F.when(closed, 0).otherwise(1).cast("long").alias("hops"),
        F.when(closed, F.col("gram")).alias("head"),
    )
    n_open, turn = now.where("head IS NULL").count(), 0
    while n_open:
        turn += 1
        before = now.selectExpr(
            "lang", "gram AS up", "up AS up2", "least AS least2", "hops AS hops2", "head AS head2"
        )
        moved = now.where("head IS NULL").join(before, ["lang", "up"]).selectExpr(
            "lang",
            "gram",
            "n",
            "up2 AS up",
            "least(least, least2) AS least",
            "hops + hops2 AS hops",
            "head2 AS head",
        )
        now = stored(now.where("head IS NOT NULL").unionByName(moved), folder, f"{name}-{turn}")
        was, n_open = n_open, now.where("head IS NULL").count()
        if n_open == was and 1 << turn >= n_open:
            break
    headed = now.where("head IS NOT NULL").select("lang", "gram", "n", "hops", "head")
    circles = now.where("head IS NULL").select("lang", "gram", "least") if n_open else None
    return headed, circles


def unary_paths(edges: DataFrame, folder: str) -> DataFrame:
    """(lang, head, part, gram, weights): edges (lang, gram, n) compacted along unary nodes.

    A path is named by its first edge and cut into parts of at most STRETCH edges; `gram` holds a
    part's words and `weights` its edges' counts in order. Every edge is in one part of one path. A
    circle of unary nodes starts at its least edge.
    """
    enters, leaves = F.when(~F.col("out"), F.col("gram")), F.when(F.col("out"), F.col("gram"))
    links = (
        _ends(edges)
        .groupBy("lang", "node")
        .agg(
            F.count(enters).alias("i"),
            F.count(leaves).alias("o"),
            F.min(enters).alias("up"),
            F.min(leaves).alias("gram"),
        )
        .where("i = 1 AND o = 1")
        .select("lang", "gram", "up")
    )
    todo, turn, state = edges.join(links, ["lang", "gram"], "left").select("lang", "gram", "n", "up"), 0, None
    while True:
        todo = stored(todo, folder, f"links-{turn}")
        headed, circles = _heads(todo, folder, f"paths-{turn}")
        state = headed if state is None else state.unionByName(headed)
        if circles is None:
            break
        todo = todo.join(circles, ["lang", "gram"]).withColumn("up", F.expr("if(least = gram, NULL, up)"))
        todo, turn = todo.drop("least"), turn + 1
    part = F.floor(F.col("hops") / STRETCH).cast("long").alias("part")
    last = F.substring_index("gram", " ", -1)
    row = F.sort_array(F.collect_list(F.struct("hops", "gram", "n", last.alias("last"))))
    parts = state.groupBy("lang", "head", part).agg(row.alias("e"))
    return parts.select(
        "lang",
        "head",
        "part",
        F.concat_ws(" ", F.col("e")[0]["gram"], F.slice(F.col("e.last"), F.lit(2), F.size("e"))).alias("gram"),
        F.col("e.n").alias("weights"),
    )


def _longer(flows: DataFrame, paths: DataFrame) -> DataFrame:
    """(lang, gram, best): the highest count of a phrase one word longer around each phrase.

    A still longer phrase never counts more, so one word is enough. Nodes inside a part of a path
    have no other edges than the path's; all other nodes are grouped.
    """
    words = F.split("gram", " ")
    inner = paths.where(F.size("weights") > 1).select(
        "lang",
        words.alias("w"),
        "weights",
        F.explode(F.sequence(F.lit(1), F.size("weights") - 1)).alias("j"),
    )
    inner = inner.select(
        "lang",
        F.concat_ws(" ", F.slice("w", F.col("j") + 1, LONGEST - 1)).alias("gram"),
        F.expr("greatest(weights[j - 1], weights[j])").alias("best"),
    )
    at = F.size("weights") - 1
    outer = paths.select(
        "lang",
        F.explode(
            F.array(
                F.struct(F.substring_index("gram", " ", LONGEST - 1).alias("gram"), F.col("weights")[0].alias("best")),
                F.struct(F.substring_index("gram", " ", 1 - LONGEST).alias("gram"), F.col("weights")[at].alias("best")),
            )
        ).alias("e"),
    ).select("lang", "e.gram", "e.best")
    shorter = flows.where(f"k BETWEEN 3 AND {LONGEST - 1}").select(
        "lang",
        F.explode(
            F.array(
                F.expr("substring_index(gram, ' ', k - 1)"), F.expr("substring_index(gram, ' ', 1 - k)")
            )
        ).alias("gram"),
        F.col("n").alias("best"),
    )
    return inner.unionByName(outer.unionByName(shorter).groupBy("lang", "gram").agg(F.max("best").alias("best")))


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    percent: int = PERCENT,
    top: int = TOP,
    folder: str | None = None,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases of 2 to 4 words.

    A phrase occurs `a` times, `min_count` at least; its weakest cut into two parts, which occur l and r
    times, gives floor(2000000 a / (l + r)). A phrase inside a longer one that occurs in `percent` of
    its places or more is left out. Ranked by score, a (both falling) and phrase.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark)
    docs = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).cast("binary").alias("lang"),
        F.col(text).cast("binary").alias("text"),
    )
    edges = stored(_edges(docs, min_count), folder, "edges")
    flows = stored(node_flows(edges).where(F.col("n") >= min_count), folder, "flows")
    paths = stored(unary_paths(flows.where(F.col("k") == LONGEST).drop("k"), folder), folder, "paths")
    longer = _longer(flows, paths)
    kept = flows.where("k > 1").join(longer, ["lang", "gram"], "left")
    kept = kept.where(F.col("best").isNull() | (100 * _wide("best") < percent * _wide("n")))
    cuts = kept.select("lang", "gram", "k", F.col("n").alias("a"), F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    cuts = cuts.withColumns(
        {
            "left": F.expr("substring_index(gram, ' ', cut)"),
            "right": F.expr("substring_index(gram, ' ', cut - k)"),
        }
    )
    part = flows.select("lang", F.col("gram").alias("left"), F.col("n").alias("l"))
    cuts = cuts.join(part, ["lang", "left"])
    part = flows.select("lang", F.col("gram").alias("right"), F.col("n").alias("r"))
    cuts = cuts.join(part, ["lang", "right"])
    score = F.expr("(2000000 * CAST(a AS DECIMAL(30,0))) DIV (CAST(l AS DECIMAL(19,0)) + r)")
    weakest = F.min(F.struct(score.alias("score"), "cut", "l", "r"))
    scored = cuts.groupBy("lang", "gram", "a").agg(weakest.alias("x"))
    scored = scored.select("lang", F.col("gram").alias("phrase"), "a", "x.l", "x.r", "x.score")
    ranked = scored.withColumn(
        "rank", F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)")
    ).where(F.col("rank") <= top)
    total = edges.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
