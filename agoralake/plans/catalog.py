"""Database, external tables over the stored layers, and the serving views."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from agoralake.config import (
    DATABASE,
    ENGAGEMENT_VIEW,
    GOLD_DATASETS,
    TOP_COMMENTED_VIEW,
    TOP_POSTS_VIEW,
    Lake,
)
from agoralake.operators.analytics import engagement_metrics
from agoralake.operators.layers import bronze_posts
from agoralake.operators.silver import unnest_posts
from agoralake.schemas import (
    BRONZE_POSTS_TABLE,
    DAILY_STATS,
    PARTITION_TYPES,
    RUN_PARTITIONS,
    SILVER,
)
from agoralake.sinks import add_run_partitions, remove_path, write_partitions
from agoralake.sources import (
    good_documents,
    path_exists,
    read_documents,
)

log = logging.getLogger(__name__)

# The layer tables keep their column list and add the run's date and id.
LAYER_PARTITIONS = ("run_date", "run_id")
# The table over the stored silver layer, which the silver posts are a view of.
SILVER_LAYER = "silver_layer"
SILVER_POSTS_SQL = """
  id, title, score, author, date AS created_date, num_comments, CAST(NULL AS STRING) AS permalink,
  url, selftext, subreddit, selftext AS cleaned_text, selftext_length AS post_length,
  CAST(extracted_at AS DATE) AS ingestion_date, run_date, run_id"""
SUBREDDIT_STATS_SQL = """
  subreddit, date, id_count AS post_count, score_mean AS avg_score,
  num_comments_sum AS total_comments, selftext_length_mean AS avg_post_length, run_date, run_id"""


def _name(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(fields: Iterable[T.StructField]) -> str:
    return ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in fields)


def list_databases(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def create_database(
    spark: SparkSession, database: str = DATABASE, location: str | None = None
) -> bool:
    """Create the database if it is absent; true once it exists."""
    if not spark.catalog.databaseExists(_name(database)):
        place = f" LOCATION {_text(location)}" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)}{place}")
    return spark.catalog.databaseExists(_name(database))


def create_external_table(
    spark: SparkSession,
    database: str,
    table: str,
    schema: T.StructType,
    location: str,
    partitions: Sequence[T.StructField] = (),
) -> None:
    """An external Parquet table with fixed columns; a new one finds what is stored already."""
    if spark.catalog.tableExists(_name(database, table)):
        return
    inside = {p.name for p in partitions}
    ddl = (
        f"CREATE TABLE IF NOT EXISTS {_name(database, table)} "
        f"({_columns(f for f in schema.fields if f.name not in inside)}) USING parquet"
    )
    if partitions:
        ddl += f" PARTITIONED BY ({_columns(partitions)})"
    spark.sql(f"{ddl} LOCATION {_text(location)}")
    if partitions and path_exists(spark, location):
        discover_partitions(spark, database, table)


def discover_partitions(spark: SparkSession, database: str, table: str) -> None:
    """Bring the catalogue's partitions in line with storage; lists the whole table."""
    spark.sql(f"MSCK REPAIR TABLE {_name(database, table)} SYNC PARTITIONS")


def _stored_partitions(spark: SparkSession, path: str, depth: int) -> list[str]:
    """The partition folders `depth` levels below `path`, as `name=value/..` with escaped values."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    level = [("", place)]
    for _ in range(depth):
        level = [
            (f"{name}/{child.getPath().getName()}", child.getPath())
            for name, folder in level
            for child in files.listStatus(folder)
            if child.isDirectory() and "=" in child.getPath().getName()
        ]
    return [name[1:] for name, _ in level]


def sync_day(
    spark: SparkSession,
    database: str,
    table: str,
    location: str,
    partitions: Sequence[str],
    day: date,
    chunk: int = 500,
) -> None:
    """Add one day's partitions by name and drop those that are gone; lists that day only."""
    head = f"run_date={day}"
    inner = _stored_partitions(spark, f"{location}/{head}", len(partitions) - 1)
    there = {f"{head}/{name}" for name in inner}
    full = _name(database, table)
    shown = spark.sql(f"SHOW PARTITIONS {full} PARTITION (run_date = {_text(str(day))})")
    known = {row.partition for row in shown.collect()}
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName

    def spec(name: str) -> str:
        pairs = [part.split("=", 1) for part in name.split("/")]
        return ", ".join(f"{_name(p)} = {_text(unescape(value))}" for p, value in pairs)

    for verb, comma, names in (
        ("ADD IF NOT EXISTS", " ", there - known),
        ("DROP IF EXISTS", ", ", known - there),
    ):
        ordered = sorted(names)
        for k in range(0, len(ordered), chunk):
            specs = comma.join(f"PARTITION ({spec(n)})" for n in ordered[k : k + chunk])
            spark.sql(f"ALTER TABLE {full} {verb} {specs}")
    spark.catalog.refreshTable(full)


def _without_run(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != "run_ts"])


def create_table_from_parquet(
    spark: SparkSession,
    table: str,
    location: str,
    database: str = DATABASE,
    partition_fields: Sequence[dict[str, str]] | None = None,
) -> bool:
    """Register Parquet files as a table whose kind is told by its name; false if it is unknown.

    `partition_fields` is a list of `{"name": .., "type": ..}`.
    """
    if "daily_stats" in table:
        schema = DAILY_STATS
    elif "top_posts" in table or "top_commented" in table:
        schema = SILVER
    else:
        log.error("unknown kind of table: %s", table)
        return False
    partitions = [
        T.StructField(f["name"], T.DataType.fromDDL(f["type"]))
        for f in partition_fields or []
    ]
    create_database(spark, database)
    create_external_table(spark, database, table, _without_run(schema), location, partitions)
    return True


def _project(spark: SparkSession, database: str, view: str, table: str, columns: str) -> None:
    spark.sql(
        f"CREATE OR REPLACE VIEW {_name(database, view)} AS "
        f"SELECT {columns} FROM {_name(database, table)}"
    )


def create_views(spark: SparkSession, database: str = DATABASE) -> None:
    """The three serving views over the gold tables."""
    for view, build in _views(spark, database).items():
        build(view)


def _views(spark: SparkSession, database: str) -> dict[str, Callable[[str], None]]:
    renamed = ", ".join(
        f"{source} AS {target}" if target else source
        for source, target in (
            ("date", None),
            ("subreddit", None),
            ("id_count", "post_count"),
            ("score_mean", "avg_score"),
            ("score_sum", "total_score"),
            ("num_comments_mean", "avg_comments"),
            ("num_comments_sum", "total_comments"),
            ("upvote_ratio_mean", "avg_upvote_ratio"),
        )
    )
    columns = ", ".join(_without_run(SILVER).fieldNames())

    def creator(select: str, table: str) -> Callable[[str], None]:
        return lambda view: _project(spark, database, view, table, select)

    return {
        ENGAGEMENT_VIEW: creator(renamed, "daily_stats"),
        TOP_POSTS_VIEW: creator(columns, "top_posts"),
        TOP_COMMENTED_VIEW: creator(columns, "top_commented"),
    }


def register_temp_views(daily: DataFrame, top_posts: DataFrame, top_commented: DataFrame) -> None:
    """The same three views for this session only, over DataFrames instead of tables."""
    engagement_metrics(daily).createOrReplaceTempView(ENGAGEMENT_VIEW)
    top_posts.createOrReplaceTempView(TOP_POSTS_VIEW)
    top_commented.createOrReplaceTempView(TOP_COMMENTED_VIEW)


def setup(spark: SparkSession, lake: Lake) -> DataFrame:
    """Create the database, the tables of every layer and the views: one result row for each.

    Silver posts and community statistics are views, of the stored layer and of the gold table.
    A failing object does not stop the others; a failing database does.
    """
    create_database(spark, lake.database, lake.table(""))

    def fields(names: Sequence[str]) -> list[T.StructField]:
        return [T.StructField(p, PARTITION_TYPES[p]) for p in names]

    def bronze_table(name: str) -> None:
        create_external_table(
            spark, lake.database, name, BRONZE_POSTS_TABLE, lake.table(name), fields(LAYER_PARTITIONS)
        )

    def silver_view(name: str) -> None:
        create_external_table(
            spark, lake.database, SILVER_LAYER, SILVER, lake.silver, fields(RUN_PARTITIONS)
        )
        _project(spark, lake.database, name, SILVER_LAYER, SILVER_POSTS_SQL)

    def stats_view(name: str) -> None:
        _project(spark, lake.database, name, "daily_stats", SUBREDDIT_STATS_SQL)

    def gold_table(name: str) -> None:
        named = [
            {"name": p, "type": PARTITION_TYPES[p].simpleString()} for p in RUN_PARTITIONS
        ]
        create_table_from_parquet(spark, name, lake.gold(name), lake.database, named)

    steps = {"bronze_posts": bronze_table, "silver_posts": silver_view}
    steps |= {name: gold_table for name in GOLD_DATASETS}
    steps |= {"gold_subreddit_stats": stats_view}
    steps |= _views(spark, lake.database)
    results = []
    for name, create in steps.items():
        try:
            create(name)
            results.append((name, True, "ready"))
        except Exception as error:  # the row carries it; the other objects go on
            log.error("cannot create %s: %s", name, error)
            results.append((name, False, str(error).splitlines()[0]))
    return spark.createDataFrame(results, "table string, ok boolean, message string")


def refresh_tables(spark: SparkSession, lake: Lake, run_date: date | None = None) -> None:
    """Bring the tables up to date with one day's runs, or with all of them.

    Only bronze posts are stored again, as columns instead of documents. The other tables lie over
    the layers themselves and learn about partitions: a day's by name, all by listing the table.
    """
    day = f"run_date={run_date}" if run_date else ""
    documents = good_documents(read_documents(spark, lake.bronze, day))
    raw = add_run_partitions(unnest_posts(documents), LAYER_PARTITIONS)
    place = lake.table("bronze_posts")
    remove_path(spark, f"{place}/{day}" if day else place)
    write_partitions(bronze_posts(raw, *LAYER_PARTITIONS), place, LAYER_PARTITIONS)
    tables = {"bronze_posts": (place, LAYER_PARTITIONS), SILVER_LAYER: (lake.silver, RUN_PARTITIONS)}
    tables |= {name: (lake.gold(name), RUN_PARTITIONS) for name in GOLD_DATASETS}
    for name, (location, partitions) in tables.items():
        if not spark.catalog.tableExists(_name(lake.database, name)):
            continue
        if run_date:
            sync_day(spark, lake.database, name, location, partitions, run_date)
        else:
            discover_partitions(spark, lake.database, name)
