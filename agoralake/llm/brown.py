"""Class-based bigrams: words are exchanged between classes, classes predict each other, words follow.

A word's probability is P(class | class of the word before) P(word | class). Training takes four passes
over whole texts, and every word of them is counted and gets a class:

- All words are counted. The `core`, the most frequent words up to CORE, is exchanged between CLASSES
  classes. A word's neighbours in the core are one row, gathered from counts inside tasks, so a round
  needs no shuffle: tasks get the classes and the class bigrams, tell for each word which class raises the
  likelihood most, and every second word moves. ROUNDS rounds, or until hardly any word moves.
- Each other word joins, by the counts of the classes before it, the class that gains most. As
  history they share one class; in what is predicted they count like any other word of their class.
- Transitions are smoothed towards the classes' own shares, and words that training lacks get
  the share that words seen once have of training (Good and Turing).

Sent to all tasks are at most LOCAL words of at most WIDEST bytes, with counts and classes, and class
bigrams; other words' counts and classes meet the texts by a join. The end of a text is a token with a
class of its own, and stands before the first word. Null texts are empty; without training texts only
ends have a probability. Only the two named columns are read; rows with equal ids are scored apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agoralake.llm.common import mixed_hash, stored, work_folder
from agoralake.llm.words import Words, summed

CLASSES, ROUNDS = 64, 12
#: Words that are exchanged, and words that all tasks know; bytes of the longest of these.
CORE, LOCAL, WIDEST = 1 << 15, 1 << 18, 32
#: Distinct pairs, by number, and words that a task holds before it hands their counts on.
HELD, WORDS_HELD = 1 << 19, 1 << 17
# Ranges of pairs' hashes in which pairs are added up, and of words in which their sides meet.
PAIR_RANGES, WORD_RANGES = 256, 64
#: Rounds end when fewer than one in STILL of the asked words move.
STILL = 200
#: What smoothing adds to a history's count.
PRIOR = 20.0
# Classes that no word joins: the end of a text, and, as history, all words outside the core.
END, RARE, FIRST = 0, 1, 2


@dataclass(frozen=True)
class ClassModel:
    """A trained model: `words` are those that tasks know, the end of a text first as b''."""

    words: pa.Array
    counts: np.ndarray
    classes: np.ndarray
    core: int
    rest: DataFrame
    bigrams: np.ndarray
    tokens: int
    distinct: int
    once: int

    @property
    def unseen(self) -> float:
        return (self.once + 1) / (self.tokens + 2)

    def transitions(self) -> np.ndarray:
        """log10 P(class | history), smoothed."""
        shares = self.bigrams.sum(0) + 1.0
        shares[RARE] = 0
        shares /= shares.sum()
        total = self.bigrams.sum(1, keepdims=True)
        with np.errstate(divide="ignore"):
            return np.log10((self.bigrams + PRIOR * shares) / (total + PRIOR))

    def in_class(self) -> np.ndarray:
        """log10 of a class's tokens, from which a word's count is told apart."""
        return np.log10(np.maximum(self.bigrams.sum(0), 1))


def _sequence(words: Words, known: pa.Array, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all tokens among the known words (their number if unknown), and of the ones before."""
    place = pc.fill_null(pc.index_in(words.values, value_set=known), len(known))
    ends = np.searchsorted(words.row, np.arange(texts), "right")
    now = np.insert(np.asarray(place, np.int64)[words.code], ends, END)
    return now, np.concatenate([[END], now[:-1]]) if texts else now


def _vocabulary(texts: DataFrame) -> DataFrame:
    """(word, c): all words of the texts and the ends of texts (as an empty word)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tables() -> Iterator[pa.Table]:
            for batch in batches:
                words = Words.of(batch.column(0))
                found = np.bincount(words.code, minlength=len(words.values))
                names = pa.concat_arrays([words.values, pa.array([b""], pa.binary())])
                yield pa.table({"word": names, "n": np.append(found, len(batch))})

        yield from summed(tables(), ["word"], WORDS_HELD)

    return texts.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("c"))


def _frequent(vocabulary: DataFrame, most: int) -> tuple[pa.Array, np.ndarray]:
    """At most `most` of the most frequent words with their counts, the end first.

    Counts are binned by sixteenths of a power of two; whole bins are taken while they fit.
    """
    level = F.floor(F.log2("c") * 16).cast("int")
    short = vocabulary.where(F.length("word").between(1, WIDEST)).withColumn("level", level)
    least, left = 1 << 20, most - 1
    for row in sorted(short.groupBy("level").count().collect(), reverse=True):
        if row["count"] > left:
            break
        least, left = row["level"], left - row["count"]
    found = short.where(F.col("level") >= least).select("word", "c").toArrow()
    found = found.sort_by([("c", "descending"), ("word", "ascending")]).combine_chunks()
    ends = vocabulary.where("word = X''").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    words = pa.concat_arrays([pa.array([b""], pa.binary()), *found["word"].cast(pa.binary()).chunks])
    return words, np.concatenate([[ends], found["c"].to_numpy()]).astype(np.int64)


def _packed(keys: np.ndarray, codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A row per key with its codes and counts."""
    order = np.argsort(keys, kind="stable")
    keys, codes, n = keys[order], codes[order].astype("<u4"), n[order].astype("<i8")
    cut = np.flatnonzero(np.diff(keys)) + 1
    columns = [[x.tobytes() for x in np.split(v, cut)] for v in (codes, n)]
    first = keys[np.concatenate([[0], cut])] if len(keys) else keys
    return pa.RecordBatch.from_arrays(
        [pa.array(first, pa.int32()), *(pa.array(c if len(keys) else [], pa.binary()) for c in columns)],
        ["key", "codes", "n"],
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows sorted by key, of which those with equal keys meet: distinct codes and their sums."""
    now, held, size = None, [], 0

    def met() -> tuple[np.ndarray, np.ndarray]:
        codes, at = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
        sums = np.zeros(len(codes), np.int64)
        np.add.at(sums, at, np.concatenate([n for _, n in held]))
        return codes, sums

    for batch in batches:
        for key, codes, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != now and now is not None:
                yield now, *met()
                held, size = [], 0
            now = key
            held.append((np.frombuffer(codes, "<u4"), np.frombuffer(n, "<i8")))
            size += len(held[-1][0])
            if size > 2 * HELD:
                held = [met()]
                size = len(held[0][0])
    if now is not None:
        yield now, *met()


def _neighbours(texts: DataFrame, core: pa.Array, folder: str) -> DataFrame:
    """A row per core word (and one for all others): numbers and counts of the words before and after it.

    Pairs are added up by a hash of the pair, so a frequent word is spread over all tasks; then each
    word's meet, CORE at most a side. Ranges of hashes and of words are as many whatever the number of
    tasks: the packed rows between the two steps are at most their product.
    """
    spark, size = texts.sparkSession, len(core) + 1
    held, kind = spark.sparkContext.broadcast(core), "key int, codes binary, n binary"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n_held = [], 0

        def flushed() -> pa.RecordBatch:
            codes, n = np.unique(np.concatenate(pairs), return_counts=True)
            return _packed(mixed_hash(codes.astype(np.uint64)) % np.uint64(PAIR_RANGES), codes, n)

        for batch in batches:
            now, before = _sequence(Words.of(batch.column(0)), held.value, len(batch))
            pairs.append((before * size + now).astype(np.uint32))
            n_held += len(now)
            if n_held > 2 * HELD:
                yield flushed()
                pairs, n_held = [], 0
        if n_held:
            yield flushed()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, codes, n in _added(batches):
            before, now = np.divmod(codes.astype(np.int64), size)
            both = np.concatenate([codes, (now * size + before).astype(np.uint32)])
            side = np.repeat([1, 0], len(codes)) * WORD_RANGES
            # keys of the first half hold words before, those of the second words after
            yield _packed(np.concatenate([before, now]) % WORD_RANGES + side, both, np.concatenate([n, n]))

    whole = "word int, before binary, before_n binary, after binary, after_n binary"

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: dict[int, list] = {}
        for key, codes, n in _added(batches):
            word, other = np.divmod(codes.astype(np.int64), size)
            cut = np.flatnonzero(np.diff(word)) + 1
            for w, o, c in zip(
                word[np.concatenate([[0], cut])], np.split(other.astype("<u2"), cut), np.split(n, cut), strict=True
            ):
                sides.setdefault(int(w), [b""] * 4)[2 * (key // WORD_RANGES) : 2 * (key // WORD_RANGES) + 2] = [
                    o.tobytes(),
                    c.tobytes(),
                ]
        rows = [(w, *parts) for w, parts in sides.items()]
        for k in range(0, len(rows), 64):
            columns = zip(*rows[k : k + 64], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if not j else pa.binary()) for j, c in enumerate(columns)],
                [f.split(" ")[0] for f in whole.split(", ")],
            )

    found = texts.mapInArrow(count, kind).repartition("key").sortWithinPartitions("key").mapInArrow(add, kind)
    # a round computes much on few bytes, so its tasks are not to be merged by size
    found = found.repartition(tasks, F.col("key") % WORD_RANGES).sortWithinPartitions("key").mapInArrow(join, whole)
    return stored(found, folder, "neighbours")


def _sides(batch: pa.RecordBatch) -> Iterator[tuple]:
    for word, *sides in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        yield word, *(np.frombuffer(x, "<i8" if k % 2 else "<u2") for k, x in enumerate(sides))


def _bigrams(neighbours: DataFrame, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """Counts of class after class, at most n_classes squared rows."""
    held = neighbours.sparkSession.sparkContext.broadcast(classes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((n_classes, n_classes), np.int64)
        for batch in batches:
            for word, after, n in _sides(batch):
                sums[held.value[word]] += np.bincount(held.value[after], n, n_classes).astype(np.int64)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums.ravel()[at])], ["at", "n"])

    followers = neighbours.select("word", "after", "after_n")
    rows = followers.mapInArrow(count, "at int, n bigint").groupBy("at").agg(F.sum("n")).collect()
    out = np.zeros(n_classes * n_classes, np.int64)
    for at, n in rows:
        out[at] = n
    return out.reshape(n_classes, n_classes)


def _entropy(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def gains(
    bigrams: np.ndarray, own: int, before: np.ndarray, after: np.ndarray, itself: int, whole: np.ndarray | None = None
) -> np.ndarray:
    """What the log likelihood gains when a word moves from nowhere to each class it may join.

    `before` and `after` count the classes next to it, without itself; `itself` follows itself. `whole` is
    what _entropy makes of `bigrams`, which many words share.
    """
    now = bigrams.astype(float)
    whole = _entropy(now) if whole is None else whole.copy()
    now[own] -= after
    now[:, own] -= before
    now[own, own] -= itself
    whole[own], whole[:, own] = _entropy(now[own]), _entropy(now[:, own])
    left, right = np.flatnonzero(before), np.flatnonzero(after)
    rows, columns = now[FIRST:, right], now[left, FIRST:]
    out = (_entropy(rows + after[right]) - whole[FIRST:, right]).sum(1)
    out += (_entropy(columns + before[left, None]) - whole[left, FIRST:]).sum(0)
    corner, b, a = np.diagonal(now)[FIRST:], before[FIRST:], after[FIRST:]
    out += _entropy(corner + a + b + itself) - _entropy(corner + a) - _entropy(corner + b) + _entropy(corner)
    for side, more in ((1, after.sum() + itself), (0, before.sum() + itself)):
        total = bigrams.sum(side).astype(float)
        total[own] -= more
        out -= (_entropy(total + more) - _entropy(total))[FIRST:]
    return out


def _exchanged(neighbours: DataFrame, classes: np.ndarray, bigrams: np.ndarray, turn: int) -> np.ndarray:
    """The classes after every second word has moved to where it gains most."""
    held = neighbours.sparkSession.sparkContext.broadcast((classes, bigrams))
    n_classes = len(bigrams)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, bigrams = held.value
        whole = _entropy(bigrams.astype(float))
        for batch in batches:
            to = []
            for word, before, before_n, after, after_n in _sides(batch):
                own = classes[word]
                if own < FIRST:
                    continue
                itself = int(after_n[after == word].sum())
                left = np.bincount(classes[before], before_n, n_classes)
                right = np.bincount(classes[after], after_n, n_classes)
                left[own] -= itself
                right[own] -= itself
                gain = gains(bigrams, own, left, right, itself, whole)
                best = int(gain.argmax())
                if gain[best] > gain[own - FIRST] + 1e-6:
                    to.append((word, best + FIRST))
            if to:
                word, new = (pa.array(x, pa.int32()) for x in zip(*to, strict=True))
                yield pa.RecordBatch.from_arrays([word, new], ["word", "class"])

    out = classes.copy()
    asked = neighbours.where(F.col("word") % 2 == turn % 2)
    for word, new in asked.mapInArrow(move, "word int, class int").collect():
        out[word] = new
    return out


def _rest(texts: DataFrame, core: pa.Array, classes: np.ndarray, bigrams: np.ndarray, folder: str) -> DataFrame:
    """(word, c, class, seen): words outside the core, with counts of the classes before them."""
    spark, n_classes = texts.sparkSession, len(bigrams)
    held = spark.sparkContext.broadcast((core, classes))
    targets = bigrams.sum(0)[FIRST:] + 1.0
    pull = spark.sparkContext.broadcast(np.log(bigrams[:, FIRST:] + PRIOR * targets / targets.sum()) - np.log(targets))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tables() -> Iterator[pa.Table]:
            core, classes = held.value
            for batch in batches:
                words = Words.of(batch.column(0))
                now, before = _sequence(words, core, len(batch))
                place = np.flatnonzero(now == len(core))
                is_word = np.ones(len(now), bool)
                is_word[np.searchsorted(words.row, np.arange(len(batch)), "right") + np.arange(len(batch))] = False
                code = words.code[(np.cumsum(is_word) - 1)[place]]
                pairs, n = np.unique(code.astype(np.int64) * n_classes + classes[before[place]], return_counts=True)
                names = words.values.take(pa.array(pairs // n_classes))
                yield pa.table({"word": names, "h": pa.array(pairs % n_classes, pa.int32()), "n": n})

        yield from summed(tables(), ["word", "h"], WORDS_HELD)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = batch.column("seen")
            row = np.repeat(np.arange(len(batch)), np.asarray(seen.value_lengths()))
            h, n = (np.asarray(seen.flatten().field(k)) for k in ("h", "n"))
            weights = np.zeros((len(batch), n_classes))
            np.add.at(weights, (row, h), n)
            best = (weights @ pull.value).argmax(1) + FIRST
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("c"), pa.array(best, pa.int32()), seen],
                ["word", "c", "class", "seen"],
            )

    found = texts.mapInArrow(count, "word binary, h int, n bigint")
    found = found.groupBy("word", "h").agg(F.sum("n").alias("n"))
    found = found.groupBy("word").agg(
        F.sum("n").alias("c"), F.collect_list(F.struct("h", "n")).alias("seen")
    )
    kind = "word binary, c bigint, class int, seen array<struct<h: int, n: bigint>>"
    return stored(found.mapInArrow(choose, kind), folder, "rest")


def train_classes(
    docs: DataFrame,
    text: str = "text",
    folder: str | None = None,
    n_classes: int = CLASSES,
    core: int = CORE,
    local: int = LOCAL,
    rounds: int = ROUNDS,
) -> ClassModel:
    """A model of all texts of `docs`; every distinct word of them has a count and a class."""
    if not 1 <= core <= min(local, 1 << 16) - 2:
        raise ValueError("core must be between 1 and 65534, and local greater by 2")
    folder = folder or work_folder(docs.sparkSession)
    texts = docs.select(F.col(text).cast("binary"))
    vocabulary = stored(_vocabulary(texts), folder, "vocabulary")
    tokens, distinct, once = vocabulary.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("c") == 1)
    ).first()
    words, counts = _frequent(vocabulary, local)
    first = words.slice(0, core)
    neighbours = _neighbours(texts, first, folder)
    size = n_classes + FIRST
    # by turns of frequency; then what is outside the core
    classes = np.arange(len(first) + 1) % n_classes + FIRST
    classes[0], classes[-1] = END, RARE
    for turn in range(rounds):
        moved = _exchanged(neighbours, classes, _bigrams(neighbours, classes, size), turn)
        n_moved = int((moved != classes).sum())
        classes = moved
        if n_moved * STILL < len(classes):
            break
    bigrams = _bigrams(neighbours, classes, size)
    rest = _rest(texts, first, classes, bigrams, folder)
    # what followed as an unknown word now follows as a word of its class
    bigrams[:, RARE] = 0
    sums = rest.select("class", F.inline("seen")).groupBy("class", "h").agg(F.sum("n"))
    for target, h, n in sums.collect():
        bigrams[h, target] += n
    more = words.slice(core)
    if len(more):
        least = int(counts[core:].min())
        known = rest.where((F.col("c") >= least) & (F.length("word") <= WIDEST)).select("word", "class").toArrow()
        at = np.asarray(pc.index_in(more, value_set=known["word"].combine_chunks().cast(pa.binary())))
        classes = np.concatenate([classes[:-1], known["class"].to_numpy()[at], [RARE]])
    return ClassModel(words, counts, classes, len(first), rest, bigrams, int(tokens), int(distinct), int(once))


def score_texts(docs: DataFrame, model: ClassModel, ident: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """(ident, n_tokens, n_known, train_tokens, base_score, score), log10 probabilities of whole texts.

    `base_score` is that of single words, each count raised by one; `score` the model's.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark)
    unit = np.log10(model.tokens + model.distinct + 1)
    base = np.log10(np.append(model.counts, 0) + 1) - unit
    inside, steps = model.in_class(), model.transitions()
    seen = np.log10(1 - model.unseen)
    with np.errstate(divide="ignore"):
        emitted = np.log10(model.counts) - inside[model.classes[:-1]] + seen
    emitted[0] = seen  # the end's class holds nothing else
    history = model.classes.copy()
    history[model.core :] = RARE
    held = spark.sparkContext.broadcast(
        (model.words, np.append(model.counts > 0, False), base, np.append(emitted, 0.0), model.classes, history, steps)
    )
    rare = pa.struct([("word", pa.binary()), ("h", pa.int32()), ("n", pa.int64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_, known, base, emitted, classes, history, steps = held.value
        steps = steps.copy()
        steps[:, RARE] = 0.0  # added where the word is looked up
        key, unknown = TaskContext.get().partitionId() << 33, len(words_)
        for batch in batches:
            words, size = Words.of(batch.column("text")), len(batch)
            now, before = _sequence(words, words_, size)
            ends = np.searchsorted(words.row, np.arange(size), "right") + np.arange(size)
            row = np.searchsorted(ends, np.arange(len(now)), "left")
            local = now != unknown
            known_n = np.bincount(row, known[now], size)
            base_sum = np.bincount(row, np.where(local, base[now], 0.0), size)
            model_sum = np.bincount(row, np.where(local, emitted[now] + steps[history[before], classes[now]], 0.0), size)
            is_word = np.ones(len(now), bool)
            is_word[ends] = False
            place = np.flatnonzero(~local)
            code = words.code[(np.cumsum(is_word) - 1)[place]]
            columns = {"row": row[place], "code": code, "h": history[before[place]]}
            sums = pa.table(columns).group_by(list(columns), use_threads=False).aggregate([([], "count_all")])
            sums = sums.sort_by("row").combine_chunks()
            at = np.searchsorted(sums["row"].to_numpy(), np.arange(size + 1), "left")
            found = pa.StructArray.from_arrays(
                [
                    words.values.take(pa.array(sums["code"].to_numpy())),
                    pa.array(sums["h"].to_numpy(), pa.int32()),
                    pa.array(sums["count_all"].to_numpy(), pa.int64()),
                ],
                fields=list(rare),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(key, key + size)),
                    batch.column("id"),
                    pa.array(np.bincount(row, minlength=size), pa.int64()),
                    pa.array(known_n.astype(np.int64)),
                    pa.array(base_sum),
                    pa.array(model_sum),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), found),
                ],
                ["key", "id", "n_tokens", "n_known", "base", "model", "rare"],
            )
            key += size

    ids = docs.schema[ident].dataType.simpleString()
    kind = (
        f"key bigint, id {ids}, n_tokens bigint, n_known bigint, base double, model double, "
        "rare array<struct<word: binary, h: int, n: bigint>>"
    )
    rows = docs.select(F.col(ident).alias("id"), F.col(text).cast("binary").alias("text"))
    rows = stored(rows.mapInArrow(score, kind), folder, "scored")
    rare_words = rows.select("key", F.inline("rare"))
    table = F.lit([[float(x) for x in r] for r in np.maximum(steps, -400)])
    log_class = F.lit([float(x) for x in inside])
    met = rare_words.join(model.rest.select("word", "c", "class"), "word", "left")
    step = F.get(F.get(table, F.col("h")), F.col("class")) + F.log10("c") - F.get(log_class, F.col("class")) + seen
    sums = (
        met.select(
            "key",
            F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0).alias("k"),
            (F.col("n") * (F.log10(F.coalesce("c", F.lit(0)) + 1) - float(unit))).alias("b"),
            (F.col("n") * F.coalesce(step, F.lit(float(np.log10(model.unseen))))).alias("m"),
        )
        .groupBy("key")
        .agg(F.sum("k").alias("k"), F.sum("b").alias("b"), F.sum("m").alias("m"))
    )
    zero = F.lit(0.0)
    return rows.drop("rare").join(sums, "key", "left").select(
        F.col("id").alias(ident),
        "n_tokens",
        (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", zero)).alias("base_score"),
        (F.col("model") + F.coalesce("m", zero)).alias("score"),
    )
