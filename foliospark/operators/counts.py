"""File and page counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.schemas import FILE_KEY, with_known


def pages_per_document(files: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages of every file; a file without readable pages counts 0."""
    counted = with_known(pages, *FILE_KEY).groupBy(*FILE_KEY).agg(F.count("*").alias("total_pages"))
    return (
        with_known(files.select(*FILE_KEY), *FILE_KEY)
        .join(counted, FILE_KEY, "left")
        .select(*FILE_KEY, F.coalesce("total_pages", F.lit(0)).cast("long").alias("total_pages"))
    )


def folder_summary(detail: DataFrame, folders: DataFrame | list[str] | str | None = None) -> DataFrame:
    """Documents and pages per folder, plus a ``Total`` row.

    ``folders`` adds folders without files, as rows of zeros; given as a list
    or one name, only these folders are counted.
    """
    spark = detail.sparkSession
    if isinstance(folders, str):
        folders = [folders]
    if isinstance(folders, list):
        detail = detail.where(F.col("folder").isin(folders))
        folders = spark.createDataFrame([(f,) for f in folders], "folder string")
    counted = detail.select("folder", F.lit(1).alias("_files"), F.col("total_pages").alias("_pages"))
    if folders is not None:
        empty = folders.select("folder", F.lit(0).alias("_files"), F.lit(0).cast("long").alias("_pages"))
        counted = counted.unionByName(empty)
    per_folder = counted.rollup("folder").agg(
        F.sum("_files").cast("long").alias("number_of_documents"),
        F.sum("_pages").cast("long").alias("total_pages"),
        F.grouping("folder").alias("_is_total"),
    )
    folder = F.when(F.col("_is_total") == 1, F.lit("Total")).otherwise(F.col("folder"))
    return per_folder.select(
        folder.alias("folder"),
        F.coalesce("number_of_documents", F.lit(0)).cast("long").alias("number_of_documents"),
        F.coalesce("total_pages", F.lit(0)).cast("long").alias("total_pages"),
    )


def reconcile(before: DataFrame, after: DataFrame) -> DataFrame:
    """Totals of two :func:`pages_per_document` tables and their differences."""

    def totals(detail: DataFrame, name: str) -> DataFrame:
        return detail.agg(
            F.count("*").alias(f"{name}_files"),
            F.coalesce(F.sum("total_pages"), F.lit(0)).cast("long").alias(f"{name}_pages"),
        )

    # Two one-row tables side by side.
    both = totals(before, "pre").crossJoin(totals(after, "post"))
    return both.select(
        "*",
        (F.col("post_files") - F.col("pre_files")).alias("file_diff"),
        (F.col("post_pages") - F.col("pre_pages")).alias("page_diff"),
    )
