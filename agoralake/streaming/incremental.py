"""Bronze files to silver once each, and gold kept up to date behind it.

A streamed lake has one writer per layer: the file sink's log decides which silver files count, so
batch loads belong in a lake of their own. What cannot be read goes to the same quarantine as theirs.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from agoralake.config import Lake
from agoralake.operators import gold
from agoralake.operators.silver import bad_posts, clean_posts, unnest_posts
from agoralake.schemas import RUN_PARTITIONS, SILVER, with_partitions
from agoralake.session import together
from agoralake.sinks import add_run_partitions, write_gold
from agoralake.sinks.layers import COMPRESSION, PACKING
from agoralake.sources import path_exists, read_silver
from agoralake.sources.bronze import (
    CORRUPT,
    DOCUMENT_SCHEMA,
    good_documents,
    quarantined_documents,
)
from agoralake.streaming.gold_state import LISTS, changed_gold, gold_rows

SHUFFLES = "spark.sql.shuffle.partitions"
# Partitions that a gold stream's state has at least, for the runs to come.
LEAST_STATE_TASKS = 8
READ, WRITERS = "spark.sql.files.maxPartitionBytes", "spark.sql.maxConcurrentOutputFileWriters"
# Bytes of bronze that a task of the silver stream reads at most, if all cores have a task, and the files it
# writes at a time; a task with more runs and communities sorts its posts by them.
SILVER_READ, SILVER_WRITERS = 512 * 1024 * 1024, 16


def _silver_session(spark: SparkSession) -> SparkSession:
    """A copy of the session for a silver stream, which reads and writes files as its session says."""
    own = type(spark)(spark.sparkContext, spark._jsparkSession.cloneSession())
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    own.conf.set(READ, str(max(size(own.conf.get(READ)), SILVER_READ)))
    own.conf.set(WRITERS, str(SILVER_WRITERS))
    for key, value in PACKING["parquet"].items():  # a file sink has no options of its own for these
        if key != "compression":
            own.conf.set(key, value)
    return own


def _new_documents(spark: SparkSession, lake: Lake, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(DOCUMENT_SCHEMA).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(lake.bronze)


def stream_silver(
    spark: SparkSession, lake: Lake, max_files: int | None = None
) -> StreamingQuery:
    """Clean every bronze document that arrived since the last call, then stop.

    A task leaves a file for each run and community it reads, and readers downstream pay for every file,
    so tasks of a large batch read up to `SILVER_READ` bytes each. The query runs in a copy of the session.
    """
    own = _silver_session(spark)
    posts = unnest_posts(good_documents(_new_documents(own, lake, max_files)))
    return (
        add_run_partitions(clean_posts(posts))
        .writeStream.format("parquet")
        .option("compression", COMPRESSION["parquet"])
        .partitionBy(*RUN_PARTITIONS)
        .option("path", lake.silver)
        .option("checkpointLocation", lake.checkpoint("silver"))
        .trigger(availableNow=True)
        .start()
    )


def stream_quarantine(
    spark: SparkSession, lake: Lake, max_files: int | None = None
) -> StreamingQuery:
    """Set aside what `stream_silver` skips or loses a value of, then stop.

    Documents and posts go where a batch load puts them, under the number of the stream's batch; a
    replayed batch overwrites its own.
    """

    def set_aside(documents: DataFrame, batch: int) -> None:
        posts = unnest_posts(good_documents(documents))
        for kind, rows in (
            ("documents", quarantined_documents(documents)), ("posts", bad_posts(posts))
        ):
            place = f"{lake.quarantine}/{kind}/batch=stream-{batch}"
            rows.write.mode("overwrite").json(place, compression=COMPRESSION["json"])

    arrived = _new_documents(spark, lake, max_files)
    return (
        arrived.withColumn("file_path", F.col("_metadata.file_path"))
        .writeStream.foreachBatch(set_aside)
        .option("checkpointLocation", lake.checkpoint("quarantine"))
        .trigger(availableNow=True)
        .start()
    )


def stream_layers(spark: SparkSession, lake: Lake, max_files: int | None = None) -> None:
    """All that has arrived: silver and quarantine side by side, then gold."""
    queries = [stream(spark, lake, max_files) for stream in (stream_silver, stream_quarantine)]
    for query in queries:
        query.awaitTermination()
    stream_gold(spark, lake, max_files).awaitTermination()


def _state_tasks(spark: SparkSession, lake: Lake) -> int:
    most = int(spark.conf.get(SHUFFLES))
    if not path_exists(spark, lake.silver) or path_exists(spark, lake.checkpoint("gold_state")):
        return most
    keys = read_silver(spark, lake.silver).select(*RUN_PARTITIONS).distinct().count()
    return min(most, max(2 * keys, LEAST_STATE_TASKS))


def stream_gold(
    spark: SparkSession,
    lake: Lake,
    max_files: int | None = None,
    state_tasks: int | None = None,
) -> StreamingQuery:
    """Bring gold up to date with the silver files that arrived since the last call, then stop.

    Each run and community has a state in Spark's state store (`gold_state`). A batch changes the
    state of those it brings posts of and overwrites their gold partitions with what the state now
    gives; a replayed batch starts from the state before it and overwrites with the same. Every batch
    costs a task and a commit for each partition of the state, whether it has rows for it or not, so
    there are as many as the keys at the first start call for, at most those of a shuffle. Their number
    holds for the stream's life; `state_tasks` gives another.
    """
    reader = spark.readStream.schema(with_partitions(SILVER, RUN_PARTITIONS))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = (
        changed_gold(reader.parquet(lake.silver))
        .writeStream.outputMode("update")
        .foreachBatch(partial(write_changed, lake))
        .option("checkpointLocation", lake.checkpoint("gold_state"))
        .trigger(availableNow=True)
    )
    tasks, own = state_tasks or _state_tasks(spark, lake), spark.conf.get(SHUFFLES)
    spark.conf.set(SHUFFLES, str(tasks))  # a stream takes the session's settings when it starts
    try:
        return stream.start()
    finally:
        spark.conf.set(SHUFFLES, own)


def write_changed(lake: Lake, changed: DataFrame, batch: int) -> None:
    """Overwrite the gold partitions that a batch has changed.

    The changed rows, a few days and list posts a key, are held while the three datasets are
    written; what a lost executor held is made again from the state before the batch.
    """
    changed = changed.persist()
    try:
        daily = gold_rows(changed, "daily_stats")
        finished = {"daily_stats": add_run_partitions(gold.finish_partials(daily))}
        finished |= {name: gold_rows(changed, name) for name in LISTS}
        steps = [partial(write_gold, rows, lake.gold(name)) for name, rows in finished.items()]
        together(changed.sparkSession, *steps)
    finally:
        changed.unpersist()
