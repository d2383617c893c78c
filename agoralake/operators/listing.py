"""Raw listing records: bound per community, project, stamp, and fold into documents."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agoralake.config import (
    FULL_PER_TASK,
    MAX_POSTS_PER_DOCUMENT,
    MAX_TEXT_PER_DOCUMENT,
    MAX_TEXT_PER_TASK,
    POST_LIMIT,
    SORTED_LIMIT,
    SOURCE,
)
from agoralake.operators.spread import large_groups
from agoralake.operators.topk import first_by_place, top_k_per_group
from agoralake.schemas import ENVELOPE, POST

LISTING_ORDER = ("listing_rank", "id")
# Functions that run in tasks travel by value: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def take_listing(raw: DataFrame, post_limit: int | None = POST_LIMIT) -> DataFrame:
    """The first `post_limit` records of every community in listing order; None keeps all.

    Bounds above `SORTED_LIMIT` are found by counting ranges of places, and then a community's records
    stay spread over tasks.
    """
    if post_limit is None:
        return raw
    if post_limit > SORTED_LIMIT:
        place, *ties = LISTING_ORDER
        return first_by_place(raw, ["subreddit"], place, ties, post_limit)
    order = [F.asc_nulls_last(c) for c in LISTING_ORDER]
    return top_k_per_group(raw, ["subreddit"], order, post_limit)


def stamp_posts(records: DataFrame, run_ts: datetime, source: str = SOURCE) -> DataFrame:
    """The stored post fields plus source, community and place in the listing.

    A record that carries its own extraction time keeps it. An author given as an object becomes its
    name; a missing one stays NULL here.
    """
    stamp = F.lit(run_ts.isoformat())
    given = F.col("extracted_at") if "extracted_at" in records.columns else F.lit(None)
    author = records.schema["author"].dataType
    named = isinstance(author, T.StructType) and "name" in author.fieldNames()
    derived = {
        "extracted_at": F.coalesce(given.cast("string"), stamp),
        "author": F.col("author.name" if named else "author"),
    }
    fields = [
        derived.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in POST.fields
    ]
    origin = F.col("source") if "source" in records.columns else F.lit(source)
    return records.select(
        *fields,
        F.col("subreddit").cast("string").alias("subreddit"),
        origin.alias("source"),
        F.col("listing_rank").cast("bigint").alias("listing_rank"),
    )


def build_documents(
    posts: DataFrame,
    run_ts: datetime,
    max_posts: int = MAX_POSTS_PER_DOCUMENT,
    max_text: int = MAX_TEXT_PER_DOCUMENT,
    together: bool = False,
) -> DataFrame:
    """Fold posts into bronze documents, posts in listing order.

    The fold holds one document in memory, so every document is bounded: by `max_posts` posts, and by
    `max_text` bytes of text, which one post may exceed. A community is first brought together, and
    AQE splits one that is too large for a task; documents are then cut within a task's rows. So no
    community, however large, is sorted or collected as a whole, and a community within the bounds is
    one document. A community that fills `FULL_PER_TASK` documents of every task is not shuffled at
    all: each task cuts its own posts of it. `record_count` is the document's own, a community's total
    is their sum. `together` says that each community's posts are in one partition already, as a
    bounded listing leaves them.
    """
    if together:
        return _fold_together(posts, run_ts, max_posts, max_text)
    keys = ["source", "subreddit"]
    bounds = run_ts.isoformat(), max_posts, max_text
    large = large_groups(posts, keys, FULL_PER_TASK * max_posts)
    rest = posts if large is None else posts.where(~large)
    # Rebalanced and sorted within tasks only: a window would shuffle what AQE has split again.
    gathered = rest.hint("rebalance", *keys).sortWithinPartitions(*keys, *LISTING_ORDER)
    documents = _fold_in_tasks(gathered, *bounds, in_order=True)
    if large is None:
        return documents
    return _fold_in_tasks(posts.where(large), *bounds, in_order=False).union(documents)


class _Unfilled:
    """Posts of one community that a task holds until they fill a document."""

    def __init__(self) -> None:
        self.parts: list[pa.Table] = []
        self.posts = self.text = 0

    def room(self, text: np.ndarray, max_posts: int, max_text: int) -> int:
        """How many of the next posts, of so many bytes each, still belong to this document."""
        over = np.searchsorted(self.text + np.cumsum(text), max_text) + 1
        return int(min(over, max_posts - self.posts))

    def take(self, part: pa.Table, text: int) -> None:
        self.parts.append(part)
        self.posts += len(part)
        self.text += text


def _document(parts: list[pa.Table], stamp: str) -> pa.RecordBatch:
    table = pa.concat_tables(parts)
    order = [(name, "ascending") for name in LISTING_ORDER]
    table = table.take(pc.sort_indices(table, order, null_placement="at_start")).combine_chunks()
    fields = POST.fieldNames()
    columns = [pa.concat_arrays(table[name].chunks) for name in fields]
    posts = pa.StructArray.from_arrays(columns, fields)
    return pa.RecordBatch.from_pydict(
        {
            "source": pa.array([table["source"][0].as_py()], pa.string()),
            "subreddit": pa.array([table["subreddit"][0].as_py()], pa.string()),
            "extracted_at": pa.array([stamp], pa.string()),
            "record_count": pa.array([len(table)], pa.int64()),
            "posts": pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), posts),
        }
    )


def _fold_in_tasks(
    posts: DataFrame, stamp: str, max_posts: int, max_text: int, in_order: bool
) -> DataFrame:
    """Documents out of each task's posts. `in_order` says that communities come one after another.

    Otherwise a task holds an unfilled document of each; above `MAX_TEXT_PER_TASK` the fullest go.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unfilled: dict[tuple, _Unfilled] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            size = np.zeros(len(table), np.int64)
            for name in ("title", "selftext"):
                size += np.asarray(pc.fill_null(pc.binary_length(table[name]), 0))
            group = np.zeros(len(table), np.int64)
            for name in ("source", "subreddit"):
                codes = pc.fill_null(table[name].combine_chunks().dictionary_encode().indices, -1)
                group = group * (len(table) + 1) + np.asarray(codes) + 1
            order = np.argsort(group, kind="stable")
            starts = np.flatnonzero(np.diff(group[order])) + 1
            for rows in np.split(order, starts):
                part, text = table.take(pa.array(rows)), size[rows]
                key = part["source"][0].as_py(), part["subreddit"][0].as_py()
                while len(part):
                    held = unfilled.setdefault(key, _Unfilled())
                    n = held.room(text, max_posts, max_text)
                    held.take(part.slice(0, n), int(text[:n].sum()))
                    part, text = part.slice(n), text[n:]
                    if held.posts >= max_posts or held.text >= max_text:
                        yield _document(unfilled.pop(key).parts, stamp)
            if in_order:
                last = tuple(table[name][-1].as_py() for name in ("source", "subreddit"))
                for key in [key for key in unfilled if key != last]:
                    yield _document(unfilled.pop(key).parts, stamp)
            bulk = sum(held.text for held in unfilled.values())
            while bulk > MAX_TEXT_PER_TASK:
                key = max(unfilled, key=lambda k: unfilled[k].text)
                bulk -= unfilled[key].text
                yield _document(unfilled.pop(key).parts, stamp)
        for held in unfilled.values():
            yield _document(held.parts, stamp)

    columns = ["source", "subreddit", "listing_rank", *POST.fieldNames()]
    return posts.select(*columns).mapInArrow(fold, ENVELOPE)


def _fold_together(posts: DataFrame, run_ts: datetime, max_posts: int, max_text: int) -> DataFrame:
    keys = ["source", "subreddit"]
    posts = posts.withColumn("_slice", F.spark_partition_id())
    window = Window.partitionBy(*keys, "_slice").orderBy(*LISTING_ORDER)
    text = F.octet_length(F.concat_ws("", "title", "selftext")).cast("bigint")
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    posts = posts.withColumns(
        {
            "_part": F.floor((F.row_number().over(window) - 1) / F.lit(max_posts)),
            "_bulk": F.floor(F.coalesce(F.sum(text).over(before), F.lit(0)) / F.lit(max_text)),
        }
    )
    ordered = F.sort_array(
        F.collect_list(F.struct(*LISTING_ORDER, F.struct(*POST.fieldNames()).alias("post")))
    )
    return (
        posts.groupBy(*keys, "_slice", "_part", "_bulk")
        .agg(F.count(F.lit(1)).alias("record_count"), ordered.alias("_ordered"))
        .select(
            "source",
            "subreddit",
            F.lit(run_ts.isoformat()).alias("extracted_at"),
            "record_count",
            F.col("_ordered.post").alias("posts"),
        )
        .select(*ENVELOPE.fieldNames())
    )
