"""Spark settings the analyses count on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution merges small shuffle partitions and splits skewed ones. The number
# of shuffle partitions is thus only an upper bound: set it for the largest shuffle,
# about one per 200 MB, and leave it to Spark to merge them for the smaller ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def builder(app: str, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """A session builder; the master and the memory come from ``spark-submit``."""
    made = SparkSession.builder.appName(app).config(map=SETTINGS)
    if shuffle_partitions:
        made = made.config("spark.sql.shuffle.partitions", shuffle_partitions)
    return made


#: Whether a query's shuffle files are deleted when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Work folders by the scope they were made in, the innermost last.
_scopes: list[list[str]] = []


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors share, for intermediate tables.

    It lies in ``spark.checkpoint.dir``, which is taken at its word: a cluster may mount a
    shared folder at a local path. Where that is unset it lies in the catalog's warehouse, and
    one of this machine alone is refused unless the session is local. The folder is deleted when
    the driver ends, or before by ``scratch`` or ``discard``.
    """
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        place = spark.conf.get("spark.sql.warehouse.dir")
        alone = place.startswith(("file:", "/"))
        if alone and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"{place.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a work folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside go at the end, but those to keep; so they must be all that lasts."""
    _scopes.append([])
    try:
        yield
    finally:
        for folder in _scopes.pop():
            discard(spark, folder)


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What queries inside shuffle is deleted as they end, not when the driver next collects garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(rows: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """The rows written as Parquet to a work folder and opened again.

    This cuts the lineage, survives lost executors and gives Spark the real size. ``keep``
    lets the table outlive the innermost ``scratch``.
    """
    return stored_at(rows, name, keep)[0]


def stored_at(rows: DataFrame, name: str, keep: bool = False) -> tuple[DataFrame, str]:
    """The same, with the folder, for ``discard``."""
    folder = work_folder(rows.sparkSession, name)
    scopes = _scopes[:-1] if keep else _scopes
    if scopes:
        scopes[-1].append(folder)
    with _shuffles_go(rows.sparkSession):
        rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder), folder
