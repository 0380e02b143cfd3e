"""File-name functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def parent_folder(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def stem(file_name: Column) -> Column:
    """Name without its last suffix; a leading dot is not a suffix."""
    return F.regexp_replace(file_name, r"(?<=.)\.[^./]+$", "")


def sanitise_name(name: Column) -> Column:
    """Keep ASCII letters, digits, space and ``- _ . ( )``."""
    return F.regexp_replace(name, r"[^A-Za-z0-9._() -]", "")


def document_name(file_stem: Column, ordinal: Column) -> Column:
    return F.concat(file_stem, F.lit("_document_"), ordinal.cast("string"), F.lit(".pdf"))


def statement_name(file_stem: Column, statement_id: Column) -> Column:
    return F.concat(file_stem, F.lit("_statement_"), statement_id, F.lit(".pdf"))


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")
