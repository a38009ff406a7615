"""Session settings every job in this package relies on."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# ANSI keeps the strict money cast loud; UTC keeps calendar-day arithmetic the same on every
# executor; AQE picks broadcast sides by measured size and splits skewed join partitions.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # ids shrink to a tenth in a shuffle, and a task sorts several inputs: so much there is some 500 MB of memory
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # shuffle files go with the query that made them, not when the driver happens to collect its garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

CONCURRENT_JOBS = 4  # independent tables share the cluster instead of queueing


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def side_by_side(work: Callable[[str], object], names: Iterable[str], alone: Collection[str] = ()) -> list:
    """The results in order. What is ``alone`` runs first, one after another: jobs that fill the cluster by themselves,
    of which only one at a time is to have its rows in shuffle files."""
    names = list(names)
    done = {name: work(name) for name in names if name in alone}
    with ThreadPoolExecutor(CONCURRENT_JOBS) as pool:
        done.update(zip(rest := [n for n in names if n not in done], pool.map(work, rest), strict=True))
    return [done[name] for name in names]


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that every executor can reach; it goes when the session's JVM ends.

    It lies below ``spark.checkpoint.dir`` or, where the session names none, below its warehouse,
    which all executors write their tables to.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    folder = f"{base.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder
