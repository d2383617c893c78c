"""Quality rules: zstandard ratios of whole documents and of fixed chunks, within bands by length.

A ratio is compressed bytes over UTF-8 bytes. Repetitive text falls below its band and incompressible
text above it; short texts compress worse, so every length has a band of its own. Everything is per
document, in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agoralake.llm.common import plain

LEVEL = 3
#: (bytes from which it holds, least ratio, greatest ratio). Shorter texts have no band.
BANDS = (
    (64, 0.40, 1.20),
    (128, 0.45, 1.05),
    (256, 0.45, 0.90),
    (512, 0.44, 0.82),
    (1024, 0.42, 0.78),
    (2048, 0.41, 0.76),
    (4096, 0.39, 0.75),
    (8192, 0.375, 0.74),
    (16384, 0.365, 0.74),
    (32768, 0.355, 0.74),
    (65536, 0.345, 0.74),
    (131072, 0.30, 0.74),
    (1 << 20, 0.25, 0.74),
)
#: (bytes of a text from which it holds, bytes of its chunks, least ratio, greatest ratio of a chunk).
#: Shorter texts are one chunk, which is the whole text and has its band above.
CHUNKS = ((1024, 512, 0.40, 0.80), (2048, 1024, 0.35, 0.74), (4096, 4096, 0.30, 0.74))
#: The share of chunks outside their band that rejects.
CHUNK_SHARE = 0.25

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
# Fixed value: the characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

#: What `quality_bands` adds, in order.
ADDED = {
    "n_words": T.LongType(),
    "word_chars": T.LongType(),
    "n_symbols": T.LongType(),
    "n_dup_lines": T.LongType(),
    "n_repeat_words": T.LongType(),
    "ratio": T.DoubleType(),
    "n_chunks": T.LongType(),
    "n_bad_chunks": T.LongType(),
    "base_failed": T.BooleanType(),
    "kept": T.BooleanType(),
}


def repeat_words(words: list[bytes]) -> int:
    """Words covered by windows of WINDOW words that occur twice or more in the list."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == len(words):
        return 0
    rank = ids[:n]
    for k in range(1, WINDOW):  # windows of k + 1 words, numbered densely so that nothing overflows
        rank = np.unique(rank * len(number) + ids[k : n + k], return_inverse=True)[1]
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(np.bincount(rank)[rank] > 1)
    edge[at] += 1
    edge[at + WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(edge)))


def duplicate_lines(body: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in body.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def band(size: int, bands: tuple = BANDS) -> tuple[float, float] | None:
    held = None
    for least, low, high in bands:
        if size >= least:
            held = (low, high)
    return held


def chunks(body: bytes) -> tuple[list[bytes], float, float]:
    """A text's chunks, which cover all of it, and their band: the last one ends where the text ends."""
    held = None
    for least, *rest in CHUNKS:
        if len(body) >= least:
            held = rest
    if not held:
        return [], 0.0, 0.0
    size, low, high = held
    starts = list(range(0, len(body) - size + 1, size))
    if starts[-1] + size < len(body):
        starts.append(len(body) - size)
    return [body[k : k + size] for k in starts], low, high


def measure(body: bytes | None, press: zstandard.ZstdCompressor) -> tuple:
    """The values of ADDED for one text; a null text is an empty one."""
    body = body or b""
    words = body.split()
    repeated = repeat_words(words)
    chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = len(body) - len(body.translate(None, SYMBOLS))
    ratio = len(press.compress(body)) / len(body) if body else None
    limits = band(len(body))
    inside = not limits or limits[0] <= ratio <= limits[1]
    parts, low, high = chunks(body)
    bad = sum(not low <= len(press.compress(x)) / len(x) <= high for x in parts)
    failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * len(words)
    kept = not failed and inside and bad <= CHUNK_SHARE * len(parts)
    lines = duplicate_lines(body)
    return len(words), chars, symbols, lines, repeated, ratio, len(parts), bad, failed, kept


def quality_bands(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """All input rows and columns, and those of ADDED (with underscores behind a name that is taken).

    `kept` is false where the base rules fail (under 10 words, or over 20 % of the words in repeated
    windows), where the whole text's ratio leaves the band of its length, or where more than a quarter
    of its chunks leave theirs. Chunks cover the whole text; the last one overlaps the one before. A null or empty text has no words, a null ratio and is not kept.
    Repeated rows get equal values; an empty table gives an empty table. A long text is one value of
    one task, which holds it a few times over.
    """
    names = [plain(n, docs.columns) for n in ADDED]
    fields = [T.StructField(n, kind) for n, kind in zip(names, ADDED.values(), strict=True)]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        types = [pa.int64()] * 5 + [pa.float64()] + [pa.int64()] * 2 + [pa.bool_()] * 2
        for batch in batches:
            rows = [measure(x.cast(pa.binary()).as_py(), press) for x in batch.column(text)]
            columns = zip(*rows, strict=True) if rows else [[]] * len(types)
            added = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added], [*batch.schema.names, *names]
            )

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, *fields]))


def kept_documents(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """The documents that pass, with their own columns."""
    flag = plain("kept", docs.columns)
    return quality_bands(docs, text=text).where(F.col(flag)).select(*docs.columns)
