"""Words of whole texts as number arrays, for operators that count them inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from agoralake.llm.common import mixed_hash, word_hashes

#: ASCII white space, space first.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Words(NamedTuple):
    """All words of a batch, A-Z lower-cased: a number of `values`, a row and a piece each.

    Rows and pieces never fall; two neighbours with the same piece stand in one row with nothing
    but spaces between them.
    """

    values: pa.Array
    code: np.ndarray
    row: np.ndarray
    piece: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, spaces: bytes = SPACES, ends: bytes = b"") -> Words:
        """`texts` is binary; null is an empty text. All of `spaces` and `ends` (ASCII) separate words,
        and `ends` end a piece."""
        body = pc.fill_null(texts, b"")
        offsets = np.frombuffer(body.buffers()[1], np.int32)[body.offset : body.offset + len(body) + 1]
        data = np.frombuffer(body.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        kind = np.zeros(256, np.uint8)
        kind[list(spaces)], kind[list(ends)] = 1, 2
        kind = kind[data]
        inner = kind == 0
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        first = inner & edge[:-1]
        first[1:] |= inner[1:] & ~inner[:-1]
        last = inner & edge[1:]
        last[:-1] |= inner[:-1] & ~inner[1:]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        at = np.zeros(len(start) + 1, np.int32)
        np.cumsum(end - start, out=at[1:])
        packed = _LOWER[data[inner]]
        words = pa.Array.from_buffers(
            pa.binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(packed)]
        ).dictionary_encode()
        row = np.searchsorted(offsets, start, "right") - 1
        piece = row + np.cumsum(kind == 2, dtype=np.int32)[start] if len(start) else row
        return cls(words.dictionary, np.asarray(words.indices), row, piece)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every distinct word, by number."""
        return word_hashes(self.values.to_pylist())


def filter_hash(values: np.ndarray) -> np.ndarray:
    """What `F.xxhash64` makes of a bigint column: XXH64 of eight bytes with seed 42."""
    one, two, three, four, five = (
        np.uint64(x)
        for x in (
            0x9E3779B185EBCA87,
            0xC2B2AE3D27D4EB4F,
            0x165667B19E3779F9,
            0x85EBCA77C2B2AE63,
            0x27D4EB2F165667C5,
        )
    )

    def turned(x: np.ndarray, n: int) -> np.ndarray:
        return (x << np.uint64(n)) | (x >> np.uint64(64 - n))

    with np.errstate(over="ignore"):
        v = turned(values.view(np.uint64) * two, 31) * one
        v ^= np.uint64(42) + five + np.uint64(8)
        v = turned(v, 27) * one + four
        v = (v ^ (v >> np.uint64(33))) * two
        v = (v ^ (v >> np.uint64(29))) * three
        return v ^ (v >> np.uint64(32))


def chained(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a sequence from that of all but its last element, and the last one's."""
    with np.errstate(over="ignore"):
        return mixed_hash(left * np.uint64(0xD6E8FEB86659FD93) + right)


def summed(
    tables: Iterator[pa.Table], keys: list[str], held: int, order: list[str] | None = None
) -> Iterator[pa.RecordBatch]:
    """Adds up column `n` by `keys`, within a task; hands on what it has beyond `held` distinct keys,
    in the order of the keys or of the columns of `order`."""
    parts, size = [], 0
    by = [(k, "ascending") for k in (keys if order is None else order)]

    def batches(table: pa.Table) -> list[pa.RecordBatch]:
        return (table.sort_by(by) if by else table.combine_chunks()).to_batches(1 << 16)

    def met() -> pa.Table:
        sums = pa.concat_tables(parts).group_by(keys, use_threads=False).aggregate([("n", "sum")])
        return sums.rename_columns({"n_sum": "n"}).select([*keys, "n"]).cast(parts[0].schema)

    for table in tables:
        parts.append(table)
        size += len(table)
        if size > 2 * held:
            parts = [met()]
            size = len(parts[0])
            if size > held:
                yield from batches(parts[0])
                parts, size = [], 0
    if size:
        yield from batches(met())
