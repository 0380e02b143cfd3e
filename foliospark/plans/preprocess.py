"""Split a batch of files, account for each of them, and reconcile the counts before and after."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.config import StatementType
from foliospark.operators import counts, split
from foliospark.operators.chunks import PAGE_WIDTH
from foliospark.schemas import FILE_KEY, with_known

#: Why a file is on the manual list; the first that holds.
NO_PAGES, UNKNOWN_TYPE, UNNUMBERED, NO_START = "no pages", "unknown type", "pages without a number", "no start found"


@dataclass(frozen=True)
class PreprocessResult:
    split: split.SplitResult
    before: DataFrame
    after: DataFrame
    differences: DataFrame
    coverage: DataFrame


def preprocess(
    files: DataFrame, pages: DataFrame, stype: StatementType | None, width: int = PAGE_WIDTH, spans: DataFrame | None = None
) -> PreprocessResult:
    """Statements, page assignments, manual list, counts and coverage of one batch.

    Page matches are materialised once: they are a few bytes per page, and all
    results are computed from them without touching the text again.
    """
    result = split.split_documents(pages, stype, width, spans)
    covered = coverage(files, pages, result, stype)
    by_hand = split.with_stem(covered.where(F.col("result") == "manual"))
    before = counts.pages_per_document(files, pages)
    after = documents_after(result.assignments)
    return PreprocessResult(replace(result, manual=by_hand), before, after, counts.reconcile(before, after), covered)


def coverage(files: DataFrame, pages: DataFrame, result: split.SplitResult, stype: StatementType | None) -> DataFrame:
    """One row for each file of ``files`` or with pages: where it went (``split`` or ``manual``), why it is on the manual list,
    its documents, its pages, and those of them that a document has."""
    seen = with_known(pages.select(*FILE_KEY, "page_no"), *FILE_KEY).groupBy(*FILE_KEY).agg(
        F.count("*").alias("pages"), F.count("page_no").alias("numbered")
    )
    placed = result.assignments.groupBy(*FILE_KEY).agg(
        F.count_distinct("document_name").alias("documents"), F.count("*").alias("assigned_pages")
    )
    given = with_known(files.select(*FILE_KEY), *FILE_KEY).distinct()
    joined = given.join(seen, FILE_KEY, "full").join(placed, FILE_KEY, "left")
    reason = (
        F.when(F.col("pages").isNull(), NO_PAGES)
        .when(F.lit(stype is None), UNKNOWN_TYPE)
        .when(F.col("numbered") < F.col("pages"), UNNUMBERED)
        .otherwise(NO_START)
    )
    zero = F.lit(0).cast("long")
    return joined.select(
        *FILE_KEY,
        F.when(F.col("documents").isNull(), "manual").otherwise("split").alias("result"),
        F.when(F.col("documents").isNull(), reason).alias("reason"),
        *(F.coalesce(c, zero).alias(c) for c in ("documents", "pages", "assigned_pages")),
    )


def documents_after(assignments: DataFrame) -> DataFrame:
    """Page counts of the output documents."""
    counted = assignments.groupBy(*FILE_KEY, "document_name").agg(F.count("*").alias("total_pages"))
    return counted.select("folder", F.col("document_name").alias("file_name"), "total_pages")
