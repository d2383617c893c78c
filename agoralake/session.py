"""A session with the settings the library is tuned for, and scratch space on shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

MB = 1024 * 1024
# Whether the shuffle files of a finished write go at once.
RELEASED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def sizing(input_bytes: int) -> dict[str, str]:
    """Shuffle and scan sizes for an input: partitions near 512 MB, at most 400,000 scan tasks.

    AQE joins shuffle partitions that turn out small, so a generous number costs little.
    """
    scan_mb = min(max(input_bytes // 400_000 // MB, 128), 512)
    shuffles = min(max(input_bytes // (512 * MB), 200), 100_000)
    return {
        "spark.sql.files.maxPartitionBytes": f"{scan_mb}MB",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffles),
    }


def build_session(
    app: str = "agoralake", input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """Settings for large inputs; any of them can be overridden by keyword.

    `input_bytes` is what the largest job reads. AQE brings shuffle partitions to about 128 MB. A
    listing bound above the default threshold still cuts before the shuffle.
    """
    builder = SparkSession.builder.appName(app)
    settings = {
        **(sizing(input_bytes) if input_bytes else {}),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
        "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
        RELEASED: "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def release_shuffles(spark: SparkSession) -> None:
    """From now on a write's shuffle files go when it ends, not when the driver next collects its garbage."""
    spark.conf.set(RELEASED, "true")


def together(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Run independent Spark actions at the same time, so that one's last tasks idle no executors.

    All of them end before the first failure is raised.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for step in running:
        step.result()


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    A session on one machine that names none gets a temp directory; a cluster has to name one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/agoralake-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    return tempfile.mkdtemp(prefix="agoralake-")
