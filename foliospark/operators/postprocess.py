"""Post-processing of transaction tables and of split documents.

Document operators report what should happen to each file as rows of a
manifest ``(folder, file_name, task, action, target_folder, target_name,
detail)``; moving bytes is left to whoever owns the storage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as tx
from foliospark.functions.dates import format_date
from foliospark.functions.names import sanitise_name
from foliospark.operators.chunks import ROW_WIDTH, last_known
from foliospark.operators.values import FULL_PAGE, ValueSearch, digits_only, extract_values
from foliospark.schemas import FILE_KEY, with_known

MANIFEST = [*FILE_KEY, "task", "action", "target_folder", "target_name", "detail"]
DUPLICATE_FOLDER = "duplicate"


def fill_missing_dates(
    transactions: DataFrame, order_col: str = "row_no", key: str = "OriginalFileName", width: int = ROW_WIDTH
) -> DataFrame:
    """Add ``Date_Processed`` right after ``Date``: the last known date of the file.

    Leading gaps stay null, and so does every row without a file name.
    """
    keys = ["folder", key] if "folder" in transactions.columns else [key]
    filled = last_known(transactions, keys, order_col, F.col("Date"), "Date_Processed", width)
    columns = list(transactions.columns)
    columns.insert(columns.index("Date") + 1, "Date_Processed")
    return filled.select(*columns)


def _manifest_row(
    found: Column, task: str, action: str, folder: Column, name: Column, detail: Column, error: Column | None = None
) -> list[Column]:
    error = F.lit(False) if error is None else error
    moved = found & ~error
    what = F.when(error, F.lit("error")).when(found, F.lit(action)).otherwise(F.lit("none"))
    return [
        F.lit(task).alias("task"),
        what.alias("action"),
        F.when(moved, folder).otherwise(F.col("current_folder")).alias("target_folder"),
        F.when(moved, name).otherwise(F.col("current_name")).alias("target_name"),
        detail.alias("detail"),
    ]


def with_location(files: DataFrame) -> DataFrame:
    """Add where each file is now and what it is called, at first unchanged."""
    if "current_name" in files.columns:
        return files
    return files.withColumns({"current_folder": F.col("folder"), "current_name": F.col("file_name")})


def categorise_action(files: DataFrame, value: Column, field_name: str) -> DataFrame:
    """Manifest columns that sort files into one folder per found value."""
    label = sanitise_name(F.lit(field_name.replace(" ", "")))
    category = F.concat_ws("-", label, sanitise_name(value))
    folder = F.concat_ws("/", "current_folder", category)
    name = F.concat_ws("-", category, "current_name")
    return files.select(
        "*", *_manifest_row(value.isNotNull(), "categorise_by_value", "move", folder, name, value)
    )


def date_prefix_action(files: DataFrame, value: Column, default_year: int | None, pivot_year: int) -> DataFrame:
    """Manifest columns that put the found date in front of file names."""
    day = format_date(value, default_year, pivot_year)
    unreadable = value.isNotNull() & day.isNull()
    name = F.concat_ws("-", day, "current_name")
    return files.select(
        "*",
        *_manifest_row(
            value.isNotNull(), "add_date_prefix_to_filenames", "rename", F.col("current_folder"), name, value, unreadable
        ),
    )


def duplicate_action(files: DataFrame, identifier: Column) -> DataFrame:
    """Manifest columns that move repeated statements of a folder aside.

    The first file by name stays.  The files to keep come from one small
    aggregate and are matched by file, not by identifier: however many copies
    share an identifier, the work spreads evenly.
    """
    known = with_known(files, *FILE_KEY).withColumn("_identifier", identifier)
    kept = (
        known.where(F.col("_identifier").isNotNull())
        .groupBy("folder", "_identifier")
        .agg(F.min("file_name").alias("file_name"))
        .select(*FILE_KEY, F.lit(True).alias("_kept"))
    )
    checked = known.join(kept, FILE_KEY, "left")
    repeated = F.col("_identifier").isNotNull() & F.col("_kept").isNull()
    folder = F.concat_ws("/", "folder", F.lit(DUPLICATE_FOLDER))
    row = _manifest_row(
        repeated, "identify_and_move_duplicates", "move", folder, F.col("current_name"), F.col("_identifier")
    )
    return checked.select(*files.columns, *row)


def combined_identifier(account: Column, number: Column, date: Column, separator: str = "") -> Column:
    """Account, statement number and date in one text, leaving out what was not found."""
    parts = [tx.null_if_empty(part) for part in (account, number, date)]
    return tx.null_if_empty(F.concat_ws(separator, *parts))


def categorise_by_value(
    spans: DataFrame, field_name: str, example: str, files: DataFrame | None = None
) -> DataFrame:
    """Manifest that files each document under the value found in its top half."""
    found = extract_values(spans, [ValueSearch("value", example)], files)
    return categorise_action(with_location(found), F.col("value"), field_name).select(*MANIFEST)


def category_sizes(manifest: DataFrame) -> DataFrame:
    """Files per target folder of a manifest."""
    moved = manifest.where(F.col("action") == "move")
    return moved.groupBy("folder", "target_folder").agg(F.count("*").alias("files"))


def date_prefix(
    spans: DataFrame,
    example: str,
    files: DataFrame | None = None,
    default_year: int | None = None,
    pivot_year: int = 2025,
) -> DataFrame:
    """Manifest that renames each document to ``yyyyMMdd-<name>``.

    A date that cannot be read gives a row with ``action='error'``.
    """
    found = extract_values(spans, [ValueSearch("value", example, FULL_PAGE)], files)
    return date_prefix_action(with_location(found), F.col("value"), default_year, pivot_year).select(*MANIFEST)


def duplicate_searches(account: str, statement: str, date: str) -> list[ValueSearch]:
    return [
        ValueSearch("account", account),
        ValueSearch("statement", statement, FULL_PAGE),
        ValueSearch("start_date", date, FULL_PAGE),
    ]


def identify_duplicates(
    spans: DataFrame,
    account_example: str,
    statement_example: str,
    date_example: str,
    files: DataFrame | None = None,
    separator: str = "",
) -> DataFrame:
    """Manifest that moves repeated statements of a folder to ``duplicate``.

    Statements are the same when account number (top half), statement number
    and start date (full page) agree; documents without any of the three are
    never duplicates.
    """
    found = extract_values(spans, duplicate_searches(account_example, statement_example, date_example), files)
    identifier = combined_identifier(
        F.col("account"), digits_only(F.col("statement")), F.col("start_date"), separator
    )
    return duplicate_action(with_location(found), identifier).select(*MANIFEST)


def duplicate_count(manifest: DataFrame) -> DataFrame:
    repeated = (F.col("task") == "identify_and_move_duplicates") & (F.col("action") == "move")
    return manifest.agg(F.count(F.when(repeated, 1)).alias("duplicates"))
