"""Substring dedup: recompression names every text alike, shared symbols reveal long repeats.

A round of recompression replaces runs of equal symbols (first round) and then pairs of neighbours
whose sides, by a digest of the symbol, are left and right. Names are digests of what they replace,
so all tasks give equal strings equal names without a dictionary. What a symbol is depends only on
its own words, but for a bounded stretch at both ends of a string; so two equal windows have the same
symbols inside, level by level. After a few rounds a symbol covers several words, and most symbols
occur once in the corpus: a window with such a symbol inside is unique, as is, for all others, decided
by an exact count of the windows that are left.

Spark shuffles one row a symbol (a sixth of the words), then one row a suspected window; what repeats
within a chunk of texts is told on the spot, so nothing common meets in one task. Texts only
shuffle where a fixed-size filter says that they have shared symbols or something to remove.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agoralake.llm.common import (
    Apart,
    Members,
    mixed_hash,
    stored,
    window_hashes,
    word_hashes,
    work_folder,
)

# Fixed value: what stands between words.
SPACES = r"[\x20\x09-\x0D]+"
WIDTH = 35
#: Words parsed at once; a longer text is parsed alone.
CHUNK_WORDS = 400_000
_PAIR = np.uint64(0xD6E8FEB86659FD93)


def rounds_for(width: int) -> int:
    """Rounds after which a window still has about three symbols inside; each shrinks by a quarter."""
    return max(1, round(np.log(max(width, 2) / 6) / np.log(4 / 3)))


def parse(
    words: np.ndarray, first: np.ndarray, low: np.ndarray, high: np.ndarray, rounds: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after some rounds, the texts' first symbols, and the windows' insides as ranges.

    `first` marks the first word of each text, [low, high) are windows. Of a window's inside, a round
    takes off the run at either end, which may go on outside, then a symbol whose partner may be
    outside. An inside of nothing has low >= high.
    """
    symbol = words
    for turn in range(rounds):
        if turn == 0:
            fresh = np.concatenate([[True], (symbol[1:] != symbol[:-1]) | first[1:]])
            at, group = np.flatnonzero(fresh), np.cumsum(fresh) - 1
            length = np.diff(np.append(at, len(symbol))).astype(np.uint64)
            low, high = group[low] + 1, group[high - 1]
            symbol = np.where(length > 1, mixed_hash(symbol[at] * _PAIR + length), symbol[at])
            first = first[at]
        side = (mixed_hash(symbol ^ np.uint64(turn + 1)) & np.uint64(1)).astype(bool)
        joins = np.concatenate([[False], ~side[:-1] & side[1:] & ~first[1:]])
        at, group = np.flatnonzero(~joins), np.cumsum(~joins) - 1
        void = low >= high
        last = len(symbol) - 1
        begin, end = np.minimum(low, last), np.clip(high - 1, 0, last)
        low = np.where(side[begin], group[np.minimum(begin + 1, last)], group[begin])
        high = np.where(side[end], group[end] + 1, group[end])
        high = np.where(void, low, high)
        pair = np.append(joins[1:], False)[at]
        name = symbol[at].copy()
        left = at[pair]
        name[pair] = mixed_hash(symbol[left] * _PAIR + symbol[left + 1] + np.uint64(turn + 1))
        symbol, first = name, first[at]
    return symbol, first, low, high


def _chunks(bodies: Iterable[bytes | None]) -> Iterator[tuple]:
    """Texts in chunks: (their places, words' hashes, number of words of each)."""
    places, hashes, sizes, total = [], [], [], 0
    for k, body in enumerate(bodies):
        got = word_hashes((body or b"").split())
        if len(got):
            if total and total + len(got) > CHUNK_WORDS:
                yield places, np.concatenate(hashes), np.array(sizes)
                places, hashes, sizes, total = [], [], [], 0
            places.append(k)
            hashes.append(got)
            sizes.append(len(got))
            total += len(got)
    if places:
        yield places, np.concatenate(hashes), np.array(sizes)


def _parsed(hashes: np.ndarray, sizes: np.ndarray, width: int) -> tuple:
    """Of a chunk: symbols, their numbers within the text, text numbers, window starts and insides."""
    ends = np.cumsum(sizes)
    begins = ends - sizes
    first = np.zeros(len(hashes), bool)
    first[begins] = True
    text = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.flatnonzero(np.arange(len(hashes)) + width <= ends[text])
    symbol, first, low, high = parse(hashes, first, starts, starts + width, rounds_for(width))
    head = np.flatnonzero(first)
    owner = np.cumsum(first) - 1
    return symbol, np.arange(len(symbol)) - head[owner], owner, starts, low, high, begins, head


def _told(
    value: np.ndarray, ref: np.ndarray, at: np.ndarray, more: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Keys to shuffle by, and which rows are known to have an equal one already.

    Rows of a chunk with an equal value are repeated for certain. The first of them still goes by the
    value, for other chunks to see; the rest go by keys of their own. So a value that is everywhere
    sends one row a chunk to its task.
    """
    full = value if more is None else mixed_hash(value * _PAIR + more)
    _, first, group, count = np.unique(full, return_index=True, return_inverse=True, return_counts=True)
    known = count[group] > 1
    rest = known.copy()
    rest[first] = False
    own = mixed_hash(ref.view(np.uint64) * _PAIR + at.astype(np.uint64))
    return np.where(rest, own, value), known


def _covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, n), -1)
    return np.cumsum(edge[:-1]) > 0


def substring_dedup(
    docs: DataFrame, *, text: str = "text", width: int = WIDTH
) -> DataFrame:
    """Remove every word in a window of `width` words that also starts anywhere else.

    All input columns stay; `text` holds the kept words joined by one space, `n_words` and `n_removed`
    are added (with underscores behind names that are taken). Windows are judged on the input. Rows
    with equal texts are copies of each other, also where their ids are equal. A null or empty text,
    or one with fewer words than a window, loses nothing; a null text becomes empty. Texts are told
    apart by 64-bit hashes, windows by 96 bits. An empty table gives an empty table.
    """
    apart = Apart(docs)
    docs, text = apart.rows, apart[text]
    spark = docs.sparkSession
    folder = work_folder(spark)
    ref = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    whole = docs.select(ref.alias("ref"), F.col(text).cast("binary").alias("body"))
    whole = whole.where("body IS NOT NULL")

    def symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            refs = batch.column(0).to_pylist()
            fresh = [k for k, r in enumerate(refs) if r not in seen and not seen.add(r)]
            refs = [refs[k] for k in fresh]
            bodies = (batch.column(1)[k].as_py() for k in fresh)
            for places, hashes, sizes in _chunks(bodies):
                own = np.array([refs[k] for k in places], np.int64)
                symbol, at, owner, starts, low, high, begins, _ = _parsed(hashes, sizes, width)
                long = np.flatnonzero(sizes[owner] >= width)
                key, known = _told(symbol[long], own[owner[long]], at[long])
                yield _rows(key, own[owner[long]], at[long], known)
                # A text with windows that have no symbol inside is looked at in any case.
                open_ = np.unique(np.searchsorted(begins, starts[low >= high], "right") - 1)
                key = mixed_hash(own[open_].view(np.uint64))
                yield _rows(key, own[open_], -1 + 0 * open_, np.ones(len(open_), bool))

    def _rows(key: np.ndarray, ref: np.ndarray, at: np.ndarray, known: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(ref), pa.array(at.astype(np.int32)), pa.array(known)],
            ["symbol", "ref", "at", "known"],
        )

    named = whole.mapInArrow(symbols, "symbol bigint, ref bigint, at int, known boolean")
    shared = named.selectExpr(
        "ref", "at", "known",
        "min(struct(ref, at)) OVER (PARTITION BY symbol) AS low",
        "max(struct(ref, at)) OVER (PARTITION BY symbol) AS high",
    ).where("low <> high OR known")
    flags = stored(
        shared.groupBy("ref").agg(F.collect_set("at").alias("at")), folder, "flags"
    )
    some = Members.of(flags.select("ref"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs = batch.column(0).to_pylist()
            for places, hashes, sizes in _chunks(x.as_py() for x in batch.column(1)):
                own = np.array([refs[k] for k in places], np.int64)
                symbol, at, owner, starts, low, high, begins, head = _parsed(hashes, sizes, width)
                once = np.ones(len(symbol) + 1, np.int64)
                once[-1] = 0
                for k, place in enumerate(places):
                    marks = np.asarray(batch.column(2)[place].values, np.int64)
                    once[head[k] + marks[marks >= 0]] = 0
                count = np.concatenate([[0], np.cumsum(once)])
                held = low < high
                single = count[np.where(held, high, 0)] - count[np.where(held, low, 0)] > 0
                suspect = starts[~(held & single)]
                if len(suspect):
                    all_ = window_hashes(hashes, width)[suspect]
                    less = window_hashes(mixed_hash(hashes ^ _PAIR), width)[suspect]
                    of = np.searchsorted(begins, suspect, "right") - 1
                    place = (suspect - begins[of]).astype(np.int64)
                    less = less & np.uint64(0xFFFFFFFF)
                    key, known = _told(all_, own[of], place, less)
                    packed = (place << 32) | less.astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(own[of]), pa.array(packed), pa.array(known)],
                        ["window", "ref", "packed", "known"],
                    )

    texts = some.keep(whole, "ref").groupBy("ref").agg(F.first("body").alias("body"))
    asked = texts.join(flags, "ref").select("ref", "body", "at")
    found = asked.mapInArrow(windows, "window bigint, ref bigint, packed bigint, known boolean")
    found = found.selectExpr(
        "window", "ref", "known",
        "CAST(packed & 4294967295 AS BIGINT) AS more", "CAST(packed >> 32 AS INT) AS at",
    )
    repeated = found.selectExpr(
        "ref", "at", "known",
        "min(struct(ref, at)) OVER (PARTITION BY window, more) AS low",
        "max(struct(ref, at)) OVER (PARTITION BY window, more) AS high",
    ).where("low <> high OR known")
    starts = repeated.groupBy("ref").agg(F.collect_set("at").alias("starts"))
    copies = whole.groupBy("ref").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = starts.join(copies, "ref", "full").select(
        F.col("ref").alias("__ref"), F.col("starts").alias("__starts"), F.col("n").isNotNull().alias("__copy")
    )
    gone = stored(gone, folder, "gone")
    changed = Members.of(gone.select("__ref"))
    total, removed = "n_words", "n_removed"

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, many, less = [], [], []
            marks, copied = batch.column("__starts"), batch.column("__copy")
            for k, body in enumerate(batch.column(text)):
                words = (body.cast(pa.binary()).as_py() or b"").split()
                kept = words
                if copied[k].as_py() and len(words) >= width:
                    kept = []
                elif marks[k].is_valid:
                    hide = _covered(len(words), np.asarray(marks[k].values, np.int64), width)
                    kept = [w for w, x in zip(words, hide, strict=True) if not x]
                texts.append(b" ".join(kept))
                many.append(len(words))
                less.append(len(words) - len(kept))
            names = [n for n in batch.schema.names if not n.startswith("__")]
            columns = [batch.column(n) for n in names]
            at = names.index(text)
            columns[at] = pa.array(texts, pa.binary()).cast(columns[at].type)
            columns += [pa.array(many, pa.int64()), pa.array(less, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, total, removed])

    rows = docs.select(*docs.columns, ref.alias("__ref"))
    # Of texts with nothing to remove only the spaces change.
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")
    clear = changed.keep(rows, "__ref", member=False).withColumn("__words", words).select(
        *[F.array_join("__words", " ").alias(c) if c == text else F.col(c) for c in rows.columns[:-1]],
        F.size("__words").cast("long").alias(total),
        F.lit(0).cast("long").alias(removed),
    )
    doubtful = changed.keep(rows, "__ref").join(gone, "__ref", "left").drop("__ref")
    out = T.StructType(
        [
            *[T.StructField(f.name, f.dataType) for f in docs.schema.fields],
            T.StructField(total, T.LongType()),
            T.StructField(removed, T.LongType()),
        ]
    )
    done = clear.union(doubtful.mapInArrow(rewrite, out))
    return apart.back(done, total, removed)
