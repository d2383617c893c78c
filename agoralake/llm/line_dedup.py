"""Line dedup: two Bloom filters find suspected repeats, only those shuffle for confirmation.

One pass sets, in every task, the bits of a line's key in the once-seen filter, or in the twice-seen
filter if the once-seen one already has them. Tasks' filters meet segment by segment: bits that two
tasks have seen once are seen twice. A key of two documents therefore always passes the twice-seen
filter; what else passes costs a row and is sorted out by the exact count over the key itself. The
filters have a fixed size for input of any size (`FILTER_BITS`, 16 MB); they fill up beyond some
hundred million lines, from where on more lines than the repeated ones shuffle, with equal results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agoralake.llm.common import Apart, with_fields

#: Bits of each filter, a power of two; the twice-seen one is sent to all tasks.
FILTER_BITS = 1 << 27
#: Bits that a key sets.
PROBES = 3
#: Bytes of a segment, the unit in which tasks' filters meet.
SEGMENT = 1 << 16
MIN_CHARS, MIN_DOCUMENTS = 20, 3


def line_key(line: bytes) -> bytes:
    """A line without ASCII white space at its ends, A-Z lower-cased."""
    return line.strip().lower()


def _long(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (
        len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars
    )


def _keys(body: bytes | None, min_chars: int) -> list[bytes]:
    """The distinct keys of a document that are long enough."""
    keys = {line_key(line) for line in (body or b"").split(b"\n")}
    return [k for k in keys if _long(k, min_chars)]


def _bits(keys: list[bytes], n_bits: int) -> np.ndarray:
    """One row of PROBES bit numbers a key."""
    digests = b"".join(xxhash.xxh3_128_digest(k) for k in keys)
    pair = np.frombuffer(digests, dtype="<u8").reshape(-1, 2)
    step = np.arange(PROBES, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return (pair[:, :1] + pair[:, 1:] * step) & np.uint64(n_bits - 1)


def _set(filled: np.ndarray, bits: np.ndarray) -> None:
    flat = bits.ravel()
    np.bitwise_or.at(filled, flat >> np.uint64(3), np.left_shift(1, flat & np.uint64(7)).astype("u1"))


def _has(filled: np.ndarray, bits: np.ndarray) -> np.ndarray:
    byte = filled[bits >> np.uint64(3)]
    return ((byte >> (bits & np.uint64(7)).astype("u1")) & 1).all(axis=1)


def _twice_filter(docs: DataFrame, text: str, n_bits: int, min_chars: int) -> bytes:
    """The twice-seen filter over all documents, n_bits / 8 bytes whatever the input."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(n_bits // 8, "u1"), np.zeros(n_bits // 8, "u1")
        for batch in batches:
            keys = [k for body in batch.column(0) for k in _keys(body.as_py(), min_chars)]
            if not keys:
                continue
            bits = _bits(keys, n_bits)
            _, first, count = np.unique(bits[:, 0], return_index=True, return_counts=True)
            again = np.ones(len(bits), bool)
            again[first[count == 1]] = False
            again |= _has(once, bits)
            _set(twice, bits[again])
            _set(once, bits)
        for k in range(0, n_bits // 8, SEGMENT):
            part = once[k : k + SEGMENT]
            if part.any():
                row = [[k // SEGMENT]], [[zlib.compress(x[k : k + SEGMENT], 1)] for x in (once, twice)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[0][0], pa.int32()), *(pa.array(x, pa.binary()) for x in row[1])],
                    ["segment", "once", "twice"],
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for k, *parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                once, twice = (np.frombuffer(zlib.decompress(x), "u1") for x in parts)
                if k in held:
                    held[k][1] |= twice | (held[k][0] & once)
                    held[k][0] |= once
                else:
                    held[k] = [once.copy(), twice.copy()]
        for k, (_, twice) in held.items():
            if twice.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([zlib.compress(twice, 1)], pa.binary())],
                    ["segment", "twice"],
                )

    parts = docs.select(F.col(text).cast("binary")).mapInArrow(
        fill, "segment int, once binary, twice binary"
    )
    whole = np.zeros(n_bits // 8, "u1")
    for k, twice in parts.repartition("segment").mapInArrow(meet, "segment int, twice binary").collect():
        whole[k * SEGMENT : (k + 1) * SEGMENT] = np.frombuffer(zlib.decompress(bytes(twice)), "u1")
    return whole.tobytes()


def line_dedup(
    docs: DataFrame,
    *,
    ident: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Drop repeated lines, but for those in the largest document that holds them.

    All input columns stay, with `text` rewritten; `n_lines` (before) and `n_dropped` are added, with
    underscores behind the name if the input has such columns. A null or empty text is one empty line
    and stays as it is. Rows with the same id are one document: none of them loses the kept lines.
    Rows without an id count as no document and lose nothing. An empty table gives an empty table.
    """
    apart = Apart(docs)
    docs, ident, text = apart.rows, apart[ident], apart[text]
    spark = docs.sparkSession
    filled = spark.sparkContext.broadcast(_twice_filter(docs, text, filter_bits, min_chars))
    total, dropped, hits, gone = "n_lines", "n_dropped", "__suspects", "__gone"

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(filled.value, "u1")
        for batch in batches:
            found: list[list[bytes]] = []
            for body in batch.column(text):
                keys = _keys(body.cast(pa.binary()).as_py(), min_chars)
                good = _has(seen, _bits(keys, filter_bits)) if keys else ()
                found.append([k for k, x in zip(keys, good, strict=True) if x])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(pa.binary()))], [*batch.schema.names, hits]
            )

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, less = [], [], []
            for body, keys in zip(batch.column(text), batch.column(gone), strict=True):
                raw = body.cast(pa.binary()).as_py()
                old = (raw or b"").split(b"\n")
                drop = set(keys.as_py() or ())
                new = [x for x in old if line_key(x) not in drop] if drop else old
                texts.append(raw if len(new) == len(old) else b"\n".join(new))
                lines.append(len(old))
                less.append(len(old) - len(new))
            at = batch.schema.get_field_index(text)
            columns = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != gone]
            columns[at] = pa.array(texts, pa.binary()).cast(batch.schema.field(at).type)
            columns += [pa.array(lines, pa.int64()), pa.array(less, pa.int64())]
            names = [n for n in batch.schema.names if n != gone]
            yield pa.RecordBatch.from_arrays(columns, [*names, total, dropped])

    marked_schema = with_fields(docs.schema, T.StructField(hits, T.ArrayType(T.BinaryType())))
    marked = docs.mapInArrow(suspects, marked_schema)
    held = marked.select(F.col(ident).alias("__id"), F.explode(hits).alias("__key"))
    held = held.where("__id IS NOT NULL").distinct()
    confirmed = held.groupBy("__key").agg(
        F.count(F.lit(1)).alias("__n"), F.max("__id").alias("__keeper")
    )
    losing = (
        held.join(confirmed.where(F.col("__n") >= min_documents), "__key")
        .where("__id <> __keeper")
        .groupBy("__id")
        .agg(F.collect_list("__key").alias(gone))
    )
    # Documents without a suspected line stay as they are; lines are line feeds and one.
    body = F.coalesce(text, F.lit(""))
    feeds = F.length(body) - F.length(F.replace(body, F.lit("\n"), F.lit("")))
    clear = marked.where(F.size(hits) == 0).select(
        *docs.columns, (feeds + 1).cast("long").alias(total), F.lit(0).cast("long").alias(dropped)
    )
    doubtful = marked.where(F.size(hits) > 0).join(losing, F.col(ident) == F.col("__id"), "left")
    out = T.StructType(
        [*docs.schema.fields, T.StructField(total, T.LongType()), T.StructField(dropped, T.LongType())]
    )
    done = clear.union(doubtful.select(*docs.columns, gone).mapInArrow(rewrite, out))
    return apart.back(done, total, dropped)
