"""What several operators of this subpackage share: reading, shipping, settling and bounded broadcasts."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Separators of words: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables. Python tasks of this session then find this package."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, paths]))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def give_back() -> None:
    """Returns what a Python worker has freed to the system, as a task does at its end: the worker lives on beside other steps."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share. Only a session on one machine may do without: it gets a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="run-")


def settled(df: DataFrame) -> DataFrame:
    """Compute once for several uses: a checkpoint in the folder that all executors share."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def sample_by_id(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows, chosen by a digest of the whole row, its key first; all if there are no more. Reruns agree; nothing is sorted or shuffled."""
    count = df.count()
    if count <= rows:
        return df
    scale = 1 << 30
    columns = [F.col(key), *(F.col(f"`{c}`") for c in df.columns if c != key)]
    return df.where(F.pmod(F.xxhash64(*columns, F.lit("sample")), F.lit(scale)) < int(scale * rows / count))


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """A settled table with the broadcast hint if it has at most so many rows, else without it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def stored(df: DataFrame, *by: str) -> DataFrame:
    """Write as Parquet into the folder that all executors share, in one folder for each value of ``by``, and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
