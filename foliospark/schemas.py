"""Schemas of the tables the engine reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILE_KEY = ["folder", "file_name"]


def with_known(df: DataFrame, *columns: str) -> DataFrame:
    """File keys filled in, so that no row goes; of other columns, rows that have them.

    Joins on a column make Spark filter nulls out on one side.  Having no nulls
    on both sides from the start keeps the two the same below their shuffle, so
    that Spark runs that part once and reuses it.  A file without a folder or
    a name has an empty one.
    """
    keys = [column for column in columns if column in FILE_KEY]
    df = df.withColumns({key: F.coalesce(F.col(key), F.lit("")) for key in keys}) if keys else df
    for column in columns:
        if column not in FILE_KEY:
            df = df.where(F.col(column).isNotNull())
    return df


FILES = "folder string, file_name string, stem string, path string, length bigint"

PAGES = (
    "folder string, file_name string, page_no int, text string, ocr_text string, "
    "footer_text string, footer_ocr_text string"
)

SPANS = (
    "folder string, file_name string, page_no int, block_no int, line_no int, span_no int, "
    "text string, x0 double, y0 double, x1 double, y1 double, page_height double, block_type int"
)

_FIELD = "struct<content:string,value:string,confidence:double>"
_ITEM = "struct<content:string,value:string>"

ANALYSIS = (
    "folder string, file_name string, "
    f"documents array<struct<fields:map<string,{_FIELD}>,transactions:array<map<string,{_ITEM}>>>>, "
    "tables array<struct<cells:array<struct<row_index:int,column_index:int,content:string>>>>, "
    "pages array<struct<page_no:int,lines:array<struct<content:string>>>>"
)

_SPEC = "array<struct<field_name:string,is_amount:boolean,is_date:boolean,date_format:string>>"

STATEMENT_TYPES = (
    "type_name string, env_var string, split_type string, start_pattern string, start_phrase string, "
    f"must_not_contain string, summary_fields {_SPEC}, static_fields {_SPEC}, dynamic_fields {_SPEC}"
)
