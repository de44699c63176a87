"""Session settings the jobs rely on, and the shared folder for stored intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows that lie by (order) also serve a join on (order, line): only the narrow side moves again
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
}

#: Bytes of an Arrow batch of texts.
ARROW_BATCH = "4m"

#: Spark's setting that removes the shuffle files of a query when it ends.
RELEASE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# For the session builder: no call-site capture per column expression, which
# doubles the time a wide model takes to build.
AT_START = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A wide model's generated method is beyond the 8,000 bytes up to which the JVM compiles
    # methods by default, and would be interpreted: ten times slower.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def configure(spark: SparkSession) -> SparkSession:
    """Switch on the run-time re-planning that hot keys need; sizes stay the cluster's."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


def limit_batches(spark: SparkSession) -> None:
    """Limit the Arrow batches that go to Python workers by bytes: by rows alone, 10,000 texts go at once.

    Such a batch is held several times, in the executor's JVM and its worker, for every task that runs.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder that driver and executors share.

    ``spark.checkpoint.dir`` names it; a session without that setting uses a
    folder beside its tables, in the warehouse.  The application owns the path: whatever is
    there when it ends, however its queries ended, is removed.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate"
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    place, files = _file_system(spark, path)
    files.deleteOnExit(place)
    return path


@contextmanager
def own_folders(spark: SparkSession) -> Iterator[Callable[[str], str]]:
    """Names of fresh shared folders for a piece of work; all are removed when it ends, also by an error.

    Only for work whose result does not read from them any more.
    """
    made: list[str] = []

    def folder(purpose: str) -> str:
        made.append(shared_folder(spark, purpose))
        return made[-1]

    try:
        yield folder
    finally:
        for path in made:
            remove_folder(spark, path)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query planned and run inside go when it ends.

    Without it they stay until the driver happens to collect its garbage, so that those of
    all layers built before lie beside those of the last query.
    """
    before = spark.conf.get(RELEASE_SHUFFLES, None)
    spark.conf.set(RELEASE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE_SHUFFLES)
        else:
            spark.conf.set(RELEASE_SHUFFLES, before)


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the library's own making in whatever file system holds it."""
    place, files = _file_system(spark, path)
    files.delete(place, True)


def file_state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and modification times of a table's files; changes when the table does."""
    place, files = _file_system(spark, path)
    if not files.exists(place):
        return ()
    found, listing = [], files.listFiles(place, True)
    while listing.hasNext():
        status = listing.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))
