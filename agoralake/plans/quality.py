"""Health of a lake: one row per layer."""

from __future__ import annotations

from datetime import date, datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agoralake.config import GOLD_DATASETS, Lake
from agoralake.functions import iso_to_timestamp, run_time
from agoralake.sources import path_exists, read_documents, read_gold, read_silver

_FILE = "layer string, record_count bigint, file_count bigint, newest_record timestamp_ntz, "
EMPTY = _FILE + "newest_file timestamp"


def _read_gold(dataset: str, spark: SparkSession, path: str, run: str) -> DataFrame:
    return read_gold(spark, path, dataset, run)


def _files(df: DataFrame, layer: str, records: Column, newest: Column) -> DataFrame:
    """Records, files and newest times of a dataset: summed per file first, then over files."""
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.sum(records).alias("records"),
        F.max(newest).alias("newest"),
        F.max("_metadata.file_modification_time").alias("written"),
    )
    return per_file.agg(
        F.lit(layer).alias("layer"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("record_count"),
        F.count(F.lit(1)).alias("file_count"),
        F.max("newest").alias("newest_record"),
        F.max("written").alias("newest_file"),
    )


def layer_report(
    spark: SparkSession,
    lake: Lake,
    run_date: date | None = None,
    report_ts: datetime | str | None = None,
) -> DataFrame:
    """Existence, rows, files, freshness and status of bronze, silver and gold.

    A layer is there if all its datasets are. The overall status, the same in every row, is
    `success` if all layers have records, `warning` if all are there but one is empty, `failure`
    otherwise. `run_date` lists and reads that day's partitions only: a daily check of a large lake.
    """
    day = f"run_date={run_date}" if run_date else ""
    one = F.lit(1).cast("bigint")
    # Documents say how many posts they hold, which spares building them to count.
    posts = F.coalesce("record_count", F.lit(0))
    made, run_ts = iso_to_timestamp(F.col("extracted_at")), F.col("run_ts")
    datasets = [
        ("bronze", lake.bronze, read_documents, posts, made),
        ("silver", lake.silver, read_silver, one, F.col("extracted_at")),
        *[
            ("gold", lake.gold(d), partial(_read_gold, d), one, run_ts)
            for d in GOLD_DATASETS
        ],
    ]
    parts, absent = [], set()
    for layer, path, read, records, newest in datasets:
        parts.append(spark.createDataFrame([(layer, 0, 0, None, None)], EMPTY))
        if not path_exists(spark, path):
            absent.add(layer)
        elif not day or path_exists(spark, f"{path}/{day}"):
            parts.append(_files(read(spark, path, day), layer, records, newest))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    there = ~F.col("layer").isin(list(absent))
    per_layer = stacked.groupBy("layer").agg(
        there.alias("exists"),
        F.sum("record_count").alias("record_count"),
        F.sum("file_count").alias("file_count"),
        F.max("newest_record").alias("newest_record"),
        F.max("newest_file").alias("newest_file"),
    )
    # Three rows, one per layer: the window holds the whole report and nothing else.
    report = Window.partitionBy(F.lit(1))
    overall = (
        F.when(~F.bool_and("exists").over(report), "failure")
        .when(F.bool_and(F.col("record_count") > 0).over(report), "success")
        .otherwise("warning")
    )
    stamp = F.lit(run_time(report_ts).isoformat()).cast("timestamp_ntz")
    return per_layer.withColumn("status", overall).withColumn("report_ts", stamp)
