"""Session settings and the shared folder that written intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time, also where that costs one more exchange above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffle files go when their job has ended, not when the driver's garbage is collected next.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # The JVM does not compile a method of more than 8000 bytes; a plan over wide rows that would need one runs in smaller pieces.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Stored times are whole microseconds; the older form has no minima and maxima and takes longer to write.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings every plan of this package is written for."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("orderloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def run_together(jobs: Iterable[Callable[[], object]], at_once: int = 4) -> list:
    """Run independent Spark jobs side by side, so that the tail of one overlaps the next.

    Results come in the order of the jobs; the first error is raised once all have ended.
    """
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        running = [pool.submit(job) for job in jobs]
    return [r.result() for r in running]


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    On one machine an unset folder is replaced by a new temporary one. On a cluster a
    machine-local folder would lose data with its executor, so an unset folder is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="orderloom-")
    return _local_folders[app]


_local_folders: dict[str, str] = {}


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/orderloom/{name}-{uuid.uuid4().hex[:12]}"


def file_system(spark: SparkSession, path: str):
    """The file system that a path belongs to, and the path as it names it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that has been read to the end."""
    files, place = file_system(spark, path)
    files.delete(place, True)
