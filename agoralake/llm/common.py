"""What several operators share: scratch tables, columns set aside, ranks and components at scale."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what separates words, in every contract of this package.
WORD = r"[^\x20\x09-\x0D]+"
#: Digits of a hex digest that spread one hot group over 16 ** 3 ranges.
_SPREAD = 3


def work_folder(spark: SparkSession) -> str:
    """A fresh folder below `spark.checkpoint.dir`; only a local session may leave that unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="agoralake-llm-")
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send whole texts to Python this many at a time: a batch is held on both sides at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write `df` to shared scratch and read it back, which cuts its lineage for lost executors."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_fields(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    """The schema with fields set: one of the same name keeps its place and gets the new type."""
    named = {f.name: f for f in fields}
    kept = [named.pop(f.name, f) for f in schema.fields]
    return T.StructType([*kept, *named.values()])


def ranked(df: DataFrame, by: str, into: str, ident: Column, place: str | None = None) -> DataFrame:
    """Add `into`: each row's rank (from 0) within its (never null) `by`, in the order of md5(ident).

    A group of any size is ranked in 4096 ranges of the digest, each sorted by its own task, and the
    ranges are joined by their counts. Rows with equal digests are ordered by chance. With `place`, a
    column of whole numbers from 0, rows are ranked by it first, in as many ranges of it.
    """
    digest, cut, first = f"__{into}_digest", f"__{into}_range", f"__{into}_first"
    rows = df.withColumn(digest, F.md5(F.coalesce(ident.cast("string"), F.lit(""))))
    if place is None:
        rows = rows.withColumn(cut, F.substring(digest, 1, _SPREAD))
    else:
        step = df.agg(F.coalesce(F.expr(f"max(`{place}`) DIV {16**_SPREAD} + 1"), F.lit(1))).scalar()
        rows = rows.withColumn("__step", step).withColumn(cut, F.expr(f"`{place}` DIV __step")).drop("__step")
    counts = rows.groupBy(by, cut).agg(F.count(F.lit(1)).alias("__n"))
    before = (
        counts.selectExpr(
            f"`{by}` AS __by",
            f"`{cut}` AS __cut",
            f"sum(__n) OVER (PARTITION BY `{by}` ORDER BY `{cut}`) - __n AS `{first}`",
        )
    )
    joined = rows.join(before, (F.col(by) == F.col("__by")) & (F.col(cut) == F.col("__cut")))
    first_by = "" if place is None else f"`{place}`, "
    rank = F.expr(f"row_number() OVER (PARTITION BY `{by}`, `{cut}` ORDER BY {first_by}`{digest}`)")
    return joined.withColumn(into, F.col(first) + rank - 1).drop(
        digest, cut, first, "__by", "__cut"
    )


def components(edges: DataFrame, folder: str, name: str = "components") -> DataFrame:
    """(node, component) of every node of an edge table (a, b); component is its smallest node.

    Alternating large and small stars: every round hangs a node's larger neighbours, then all of its
    smaller ones, on the smallest, so that a chain halves and a hub is only ever a join key. Rounds
    end when the edges no longer change. A node's smallest neighbour is a partial aggregate and the
    join on a hub is one that AQE splits; each round is a written table.
    """
    spark = edges.sparkSession
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(now.where("a <> b").distinct(), folder, f"{name}-0")
    mark, turn = None, 0
    while True:
        turn += 1
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
        large = stored(large.where("a <> b").distinct(), folder, f"{name}-{turn}-large")
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        down = large.join(low, F.col("a") == F.col("u"))
        small = down.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
        now = stored(small.where("a <> b").distinct(), folder, f"{name}-{turn}")
        row = now.agg(
            F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a))")
        ).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = nodes.select(F.col("component").alias("node"), "component").distinct()
    return nodes.union(roots)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, the same in every task."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed_hash(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers, so that sums and products of hashes stay evenly spread."""
    with np.errstate(over="ignore"):
        v = values ^ (values >> np.uint64(31))
        v = v * np.uint64(0x9E3779B97F4A7C15)
        v ^= v >> np.uint64(29)
        v = v * np.uint64(0xBF58476D1CE4E5B9)
        return v ^ (v >> np.uint64(32))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of every run of `width` neighbours; a shorter list has none."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = mixed_hash(hashes[:n])
    with np.errstate(over="ignore"):
        for k in range(1, width):
            out = mixed_hash(out * np.uint64(0xD6E8FEB86659FD93) + hashes[k : n + k])
    return out


def plain(name: str, taken: Sequence[str]) -> str:
    """`name`, or `name` with underscores where the input already has such a column."""
    while name in taken:
        name += "_"
    return name


class Apart:
    """The input's columns under names of their own, c0 and on, that clash with none of an operator's."""

    def __init__(self, docs: DataFrame):
        self.names = docs.columns
        self.rows = docs.toDF(*[f"c{k}" for k in range(len(self.names))])

    def __getitem__(self, name: str) -> str:
        """Where a column of the input is; letters of any case name it, as in Spark."""
        if name in self.names:
            return f"c{self.names.index(name)}"
        return f"c{[x.lower() for x in self.names].index(name.lower())}"

    def back(self, out: DataFrame, *added: str) -> DataFrame:
        """The input's columns by their names, and the added ones behind them, underscored if taken."""
        return out.toDF(*self.names, *[plain(n, self.names) for n in added])


class Members:
    """A Bloom filter of fixed size over keys of any number, which keeps rows before a join.

    It lets some others through and never holds a member back, so an exact join has to follow. It is
    2 ** 26 bits (8 MB) for every input, what tasks are sent is therefore bounded; with very many keys
    it lets more through, and the join alone decides.
    """

    BITS, PROBES, SEGMENT = 1 << 26, 3, 1 << 16

    def __init__(self, spark: SparkSession, filled: bytes):
        self.filled = spark.sparkContext.broadcast(filled)

    @classmethod
    def _bits(cls, keys: np.ndarray) -> np.ndarray:
        one = mixed_hash(keys.view(np.uint64))
        two = mixed_hash(one) | np.uint64(1)
        with np.errstate(over="ignore"):
            steps = np.arange(cls.PROBES, dtype=np.uint64)
            return (one[:, None] + two[:, None] * steps) & np.uint64(cls.BITS - 1)

    @classmethod
    def of(cls, keys: DataFrame) -> Members:
        """The filter over a table of one column, of any type that xxhash64 takes."""
        keys = keys.select(F.xxhash64(keys.columns[0]))

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filled = np.zeros(cls.BITS // 8, "u1")
            for batch in batches:
                bits = cls._bits(np.asarray(batch.column(0), np.int64)).ravel()
                byte = np.left_shift(1, bits & np.uint64(7)).astype("u1")
                np.bitwise_or.at(filled, bits >> np.uint64(3), byte)
            yield from cls._parts(filled)

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filled: dict[int, np.ndarray] = {}
            for batch in batches:
                for k, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    got = np.frombuffer(zlib.decompress(part), "u1")
                    filled[k] = filled[k] | got if k in filled else got
            for k, part in filled.items():
                yield cls._row(k, part)

        kind = "segment int, part binary"
        parts = keys.mapInArrow(fill, kind).repartition("segment").mapInArrow(meet, kind)
        whole = bytearray(cls.BITS // 8)
        for k, part in parts.collect():
            whole[k * cls.SEGMENT : (k + 1) * cls.SEGMENT] = zlib.decompress(bytes(part))
        return cls(keys.sparkSession, bytes(whole))

    @classmethod
    def _parts(cls, filled: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(filled), cls.SEGMENT):
            if filled[k : k + cls.SEGMENT].any():
                yield cls._row(k // cls.SEGMENT, filled[k : k + cls.SEGMENT])

    @staticmethod
    def _row(k: int, part: np.ndarray) -> pa.RecordBatch:
        packed = zlib.compress(part.tobytes(), 1)
        return pa.RecordBatch.from_arrays(
            [pa.array([k], pa.int32()), pa.array([packed], pa.binary())], ["segment", "part"]
        )

    def keep(self, df: DataFrame, key: str, member: bool = True) -> DataFrame:
        """The rows whose key may be a member, or those whose key is certainly none."""
        held, bits = self.filled, self._bits

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filled = np.frombuffer(held.value, "u1")
            for batch in batches:
                asked = bits(np.asarray(batch.column("__member"), np.int64))
                byte = filled[asked >> np.uint64(3)] >> (asked & np.uint64(7)).astype("u1")
                good = (byte & 1).all(axis=1)
                yield batch.filter(pa.array(good if member else ~good)).drop_columns(["__member"])

        return df.withColumn("__member", F.xxhash64(key)).mapInArrow(choose, df.schema)
