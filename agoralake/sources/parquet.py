"""Parquet layers: ours by partition, foreign ones by path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agoralake.config import SOURCE
from agoralake.schemas import GOLD, RUN_PARTITIONS, SILVER, with_partitions

NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"
TIMES = ("extracted_at", "created_at")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored at `path`, on whichever filesystem it names."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return place.getFileSystem(conf).exists(place)


def read_layer(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    run: str = "",
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """A partitioned layer, or the one run of it below the given prefix; none there means empty.

    Of a layer that a stream writes, the sink's log says which files count. Spark reads that log at
    the layer's root only, so there a run is a filter on the partitions.
    """
    place = f"{path}/{run}" if run else path
    if run and not path_exists(spark, place):
        return spark.createDataFrame([], schema)
    reader = spark.read.format(fmt).schema(schema).options(**options)
    if run and path_exists(spark, f"{path}/_spark_metadata"):
        layer = reader.load(path)
        for part in run.split("/"):
            name, value = part.split("=", 1)
            layer = layer.where(F.col(name) == F.lit(value).cast(layer.schema[name].dataType))
        return layer
    return reader.option("basePath", path).load(place)


def read_silver(spark: SparkSession, path: str, run: str = "") -> DataFrame:
    """The silver layer with its partition columns, so filters on them prune files."""
    return read_layer(spark, path, with_partitions(SILVER, RUN_PARTITIONS), run)


def read_gold(spark: SparkSession, path: str, dataset: str, run: str = "") -> DataFrame:
    """One gold dataset with its partition columns."""
    return read_layer(spark, path, with_partitions(GOLD[dataset], RUN_PARTITIONS), run)


def path_community(path: Column | None = None) -> Column:
    """The community a file belongs to, by its path; NULL if the path names none.

    It is the segment after the source's segment, or our layout's `subreddit=` or `community=`.
    """
    path = F.col("_metadata.file_path") if path is None else path
    named = F.regexp_extract(path, f"/{SOURCE}/(?:.*/)?(?:subreddit|community)=([^/]+)/", 1)
    plain = F.regexp_extract(path, f"/{SOURCE}/([^/=]+)/", 1)
    segment = F.coalesce(F.nullif(named, F.lit("")), F.nullif(plain, F.lit("")))
    # File paths come URL-encoded; a plus sign in them is a plus sign.
    return F.try_url_decode(F.replace(segment, F.lit("+"), F.lit("%2B")))


def path_run_time(path: Column | None = None) -> Column:
    """The run a file belongs to: the `yyyyMMdd_HHmmss` at the end of its name, else NULL."""
    path = F.col("_metadata.file_path") if path is None else path
    digits = r"^.*_(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})(\d{2})\.\w+$"
    return F.regexp_replace(path, digits, "$1-$2-$3T$4:$5:$6").try_cast("timestamp_ntz")


def read_foreign_silver(spark: SparkSession, path: str, nanos: bool = False) -> DataFrame:
    """Clean posts of other writers, at any depth below `path`, in silver column order.

    Their files hold neither community nor run: both come from the path. `nanos` reads files with
    nanosecond times, which Spark otherwise refuses; times are cut to microseconds.
    """
    session = spark
    fields = [f for f in SILVER.fields if f.name not in ("subreddit", "run_ts")]
    if nanos:
        # A session of its own keeps the legacy switch away from the caller's other reads.
        session = spark.newSession()
        session.conf.set(NANOS_AS_LONG, "true")
        fields = [T.StructField(f.name, T.LongType()) if f.name in TIMES else f for f in fields]
    reader = session.read.schema(T.StructType(fields)).option("recursiveFileLookup", True)
    posts = reader.option("pathGlobFilter", "*.parquet").parquet(path)
    posts = posts.withColumns({"subreddit": path_community(), "run_ts": path_run_time()})
    if nanos:
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        for name in TIMES:
            micros = F.expr(f"{name} div 1000")
            posts = posts.withColumn(name, F.timestamp_add("MICROSECOND", micros, epoch))
    return posts.select(*SILVER.fieldNames())
