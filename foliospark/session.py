"""Session helpers."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
LISTING_SETTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def local_session(cores: int | str = 8, memory: str = "8g", app_name: str = "foliospark") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # Recording the source line of every Column takes longer than building it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Room for the generated code of many different queries in one session.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )


def find_package(spark: SparkSession) -> None:
    """Python tasks that are defined from now on find this package, wherever they run from."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all executors share, as named by the cluster."""
    return spark.conf.get(CHECKPOINT_SETTING, None)


def settle(df: DataFrame) -> DataFrame:
    """Compute an intermediate once for several uses.

    With a shared folder it is checkpointed there and outlives executors;
    otherwise it is persisted, and lost parts are computed again.
    """
    if shared_folder(df.sparkSession):
        return df.checkpoint()
    return df.persist(StorageLevel.MEMORY_AND_DISK)


@contextmanager
def listing_many_folders(spark: SparkSession) -> Iterator[None]:
    """Folders are listed in a few tasks for each core, not in one task for each folder."""
    before = spark.conf.get(LISTING_SETTING)
    spark.conf.set(LISTING_SETTING, str(spark.sparkContext.defaultParallelism * 4))
    try:
        yield
    finally:
        spark.conf.set(LISTING_SETTING, before)
