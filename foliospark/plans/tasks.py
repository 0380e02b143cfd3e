"""Named post-processing tasks, run in the order given."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.operators import postprocess as pp
from foliospark.operators.values import FULL_PAGE, ValueSearch, digits_only, extract_values
from foliospark.sinks.writers import write_processed
from foliospark.sources.readers import read_tables

log = logging.getLogger(__name__)

TableTask = Callable[[DataFrame], DataFrame]

TABLE_TASKS: dict[str, TableTask] = {"fill_missing_dates": pp.fill_missing_dates}

DOCUMENT_TASKS = ("categorise_by_value", "add_date_prefix_to_filenames", "identify_and_move_duplicates")


@dataclass(frozen=True)
class DocumentExamples:
    """Parameters of the document tasks; each task needs its own part only."""

    field_name: str = ""
    value: str = ""
    account: str = ""
    statement: str = ""
    date: str = ""
    default_year: int | None = None
    pivot_year: int = 2025
    separator: str = ""


def _known(names: Sequence[str], registry) -> list[str]:
    if not names:
        raise ValueError("no task given")
    for name in names:
        if name not in registry:
            log.info("task %r is not known here, skipping it", name)
    return [name for name in names if name in registry]


def run_table_tasks(transactions: DataFrame, names: Sequence[str]) -> DataFrame:
    """Apply table tasks one after the other; unknown names are skipped."""
    steps = [TABLE_TASKS[name] for name in _known(names, TABLE_TASKS)]
    return reduce(DataFrame.transform, steps, transactions)


def process_tables(spark: SparkSession, folder: str, names: Sequence[str], fmt: str = "parquet", csv: bool = False) -> str:
    """Read the tables of an earlier run, apply table tasks to its transactions, and write both to ``<folder>_processed``."""
    transactions, summary = read_tables(spark, folder, fmt)
    return write_processed(run_table_tasks(transactions, names), summary, folder, csv)


def run_document_tasks(
    spans: DataFrame, names: Sequence[str], examples: DocumentExamples, files: DataFrame | None = None
) -> DataFrame:
    """Apply document tasks to every folder at once; returns the manifest of all.

    Values for all tasks are found in one pass over the spans.  Each task sees
    the folder and name the tasks before it gave a file.
    """
    steps = _known(names, DOCUMENT_TASKS)
    searches: dict[str, ValueSearch] = {}
    if "categorise_by_value" in steps:
        searches["value"] = ValueSearch("value", examples.value)
    if "identify_and_move_duplicates" in steps:
        for search in pp.duplicate_searches(examples.account, examples.statement, examples.date):
            searches[search.name] = search
    if "add_date_prefix_to_filenames" in steps:
        searches["start_date"] = ValueSearch("start_date", examples.date, FULL_PAGE)

    state = pp.with_location(extract_values(spans, list(searches.values()), files))
    results = []
    for order, name in enumerate(steps):
        if name == "categorise_by_value":
            done = pp.categorise_action(state, F.col("value"), examples.field_name)
        elif name == "add_date_prefix_to_filenames":
            done = pp.date_prefix_action(state, F.col("start_date"), examples.default_year, examples.pivot_year)
        else:
            identifier = pp.combined_identifier(
                F.col("account"), digits_only(F.col("statement")), F.col("start_date"), examples.separator
            )
            done = pp.duplicate_action(state, identifier)
        entry = F.struct(F.lit(order).alias("step"), *[c for c in pp.MANIFEST if c not in ("folder", "file_name")])
        results.append(f"_entry_{order}")
        state = done.withColumn(f"_entry_{order}", entry).select(
            *[c for c in state.columns if c not in ("current_folder", "current_name")],
            F.col("target_folder").alias("current_folder"),
            F.col("target_name").alias("current_name"),
            f"_entry_{order}",
        )
    if not results:
        rows = state.select("folder", "file_name").where(F.lit(False))
        return rows.select("*", F.lit(0).alias("step"), *[F.lit("").alias(c) for c in pp.MANIFEST[2:]])
    return state.select("folder", "file_name", F.inline(F.array(*results)))
