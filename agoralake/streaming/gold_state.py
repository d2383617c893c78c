"""What a gold stream keeps of every run and community, in Spark's state store.

A task first cuts its own posts to what a list can hold and to one partial row a day, so that a
community of any size reaches its key as a few rows a file. The key's state is the merged days and
the two lists; what a batch changes comes out whole, so that writing it again changes nothing.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from agoralake.config import TOP_K
from agoralake.operators.gold import AVERAGED
from agoralake.schemas import DAILY_PARTIALS, RUN_PARTITIONS, SILVER, with_partitions

# Functions that run in tasks travel by value: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
#: The top lists and what they are ordered by.
LISTS = {"top_posts": "score", "top_commented": "num_comments"}
DAILY = "daily_stats"
_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_COUNTED = [f.name for f in DAILY_PARTIALS.fields if f.name.endswith(("_sum", "_count", "_max"))]
_POSTS = with_partitions(SILVER, RUN_PARTITIONS)


def _of_task(posts: DataFrame, k: int) -> DataFrame:
    """Per task: (dataset, posts' columns, partial statistics) of a row a day and of `k` posts a list."""
    keys = list(RUN_PARTITIONS)
    keys = [*keys, "run_ts"]
    days = [*keys, "date"]
    sums = [(m, how) for m in AVERAGED for how in ("sum", "count")]
    sums += [(m, "max") for m in ("score", "num_comments")] + [("id", "count")]

    def daily(rows: pa.Table) -> pa.Table:
        dated = rows.filter(rows["date"].is_valid())
        return dated.group_by(days, use_threads=False).aggregate(sums)

    def merged(parts: list[pa.Table]) -> pa.Table:
        again = [(f"{m}_{how}", "max" if how == "max" else "sum") for m, how in sums]
        table = pa.concat_tables(parts).group_by(days, use_threads=False).aggregate(again)
        return table.rename_columns({f"{c}_{how}": c for c, how in again})

    def first(rows: pa.Table, metric: str) -> pa.Table:
        order = [(c, "ascending") for c in keys] + [(metric, "descending"), ("id", "ascending")]
        rows = rows.take(pc.sort_indices(rows.select([*keys, metric, "id"]), order))
        codes = [np.asarray(rows[c].combine_chunks().dictionary_encode().indices) for c in keys]
        new = np.ones(len(rows), bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in codes], axis=0) if len(rows) else True
        start = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
        return rows.take(pa.array(np.flatnonzero(np.arange(len(rows)) - start < k)))

    schema = T.StructType(
        [T.StructField("dataset", T.StringType()), *_POSTS.fields]
        + [f for f in DAILY_PARTIALS.fields if f.name in _COUNTED]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, lists, arrow = [], {name: [] for name in LISTS}, None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            arrow = rows.schema
            parts = [merged([*parts, daily(rows)])]
            for name, metric in LISTS.items():
                lists[name] = [first(pa.concat_tables([*lists[name], rows]), metric)]
        if arrow is None:
            return
        kinds = {T.LongType(): pa.int64(), T.DoubleType(): pa.float64()}
        counted = {f.name: kinds[f.dataType] for f in schema.fields if f.name in _COUNTED}
        for name, table in {DAILY: parts[0], **{n: t[0] for n, t in lists.items()}}.items():
            n = len(table)
            columns = {"dataset": pa.array([name] * n, pa.string())}
            for field in arrow:
                there = field.name in table.column_names
                columns[field.name] = table[field.name] if there else pa.nulls(n, field.type)
            for c, kind in counted.items():
                columns[c] = table[c].cast(kind) if c in table.column_names else pa.nulls(n, kind)
            yield from pa.table(columns).to_batches()

    return posts.select(*_POSTS.fieldNames()).mapInArrow(cut, schema)


def _json(columns: Iterable[str]) -> Column:
    return F.to_json(F.struct(*columns), _TIMES)


def _first(posts: list[list], k: int) -> list[list]:
    """The first of (metric, id, row): metric falling, ids rising, nulls last."""
    posts.sort(key=lambda p: (p[0] is None, -(p[0] or 0), p[1] is None, p[1] or ""))
    return posts[:k]


def _merged(days: dict[str, dict], row: dict) -> None:
    old = days.setdefault(f"{row['run_ts']} {row['date']}", {"run_ts": row["run_ts"], "date": row["date"]})
    for name in _COUNTED:
        if name in row:
            now = row[name]
            if name in old:
                now = max(old[name], now) if name.endswith("_max") else old[name] + now
            old[name] = now


def changed_gold(posts: DataFrame, k: int = TOP_K) -> DataFrame:
    """(dataset, run's partition columns, row): gold of all keys that a stream's batch brings posts of.

    `row` is JSON: the merged partial statistics of a day, or a post of a list.
    """

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {"days": {}, **{n: {} for n in LISTS}}
        for part in parts:
            columns = (part[c] for c in ("dataset", "run_ts", "metric", "id", "row"))
            for dataset, run_ts, metric, ident, row in zip(*columns, strict=True):
                if dataset == DAILY:
                    _merged(held["days"], json.loads(row))
                else:
                    number = None if metric is None else int(metric)
                    held[dataset].setdefault(run_ts, []).append([number, ident, row])
        out = []
        for name in LISTS:
            held[name] = {run_ts: _first(posts, k) for run_ts, posts in held[name].items()}
            out += [(name, row) for posts in held[name].values() for _, _, row in posts]
        state.update((json.dumps(held),))
        out += [(DAILY, json.dumps(day)) for day in held["days"].values()]
        rows = pd.DataFrame(out, columns=["dataset", "row"])
        for name, value in zip(("run_date", "run_id", "subreddit"), key, strict=True):
            rows[name] = value
        yield rows

    metric = F.coalesce(
        *[F.when(F.col("dataset") == name, F.col(m).cast("string")) for name, m in LISTS.items()]
    )
    partial = _json(["run_ts", "date", *_COUNTED])
    narrow = _of_task(posts, k).select(
        "dataset",
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in RUN_PARTITIONS],
        F.col("run_ts").cast("string").alias("run_ts"),
        metric.alias("metric"),
        "id",
        F.when(F.col("dataset") == DAILY, partial).otherwise(_json(SILVER.fieldNames())).alias("row"),
    )
    kind = "dataset string, row string, run_date string, run_id string, subreddit string"
    return narrow.groupBy(*RUN_PARTITIONS).applyInPandasWithState(
        update, kind, "held string", "update", GroupStateTimeout.NoTimeout
    )


def gold_rows(changed: DataFrame, dataset: str) -> DataFrame:
    """The rows of one dataset in what `changed_gold` gives: posts, or partial statistics."""
    rows = changed.where(F.col("dataset") == dataset)
    schema = DAILY_PARTIALS if dataset == DAILY else SILVER
    stored = [F.col(f"r.{c}") for c in schema.fieldNames() if c != "subreddit"]
    return rows.select(F.from_json("row", schema, _TIMES).alias("r"), *RUN_PARTITIONS).select(
        *stored, F.col("run_date").cast("date").alias("run_date"), "run_id", "subreddit"
    )
