"""Statement-type configuration.

A statement type says how multi-statement files of that kind are split and
which fields the extraction model labels.  It is driver-side data: a handful of
small dataclasses, loaded from a YAML file that belongs to the user.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from foliospark import schemas


@dataclass(frozen=True)
class FieldSpec:
    name: str
    is_amount: bool = False
    is_date: bool = False
    date_format: str | None = None

    @classmethod
    def from_dict(cls, raw: dict[str, Any]) -> FieldSpec:
        return cls(
            name=raw["field_name"],
            is_amount=bool(raw.get("is_amount", False)),
            is_date=bool(raw.get("is_date", False)),
            date_format=raw.get("date_format"),
        )


#: Columns that tables of transactions always have.
ENGINE_COLUMNS = {"folder", "row_no"}


@dataclass(frozen=True)
class StatementType:
    name: str
    env_var: str | None = None
    split_type: str | None = None
    start_pattern: str | None = None
    start_phrase: str | None = None
    must_not_contain: str | None = None
    summary_fields: tuple[FieldSpec, ...] = field(default=())
    static_fields: tuple[FieldSpec, ...] = field(default=())
    dynamic_fields: tuple[FieldSpec, ...] = field(default=())

    def __post_init__(self) -> None:
        taken = sorted({f.name for f in (*self.static_fields, *self.dynamic_fields)} & ENGINE_COLUMNS)
        if taken:
            raise ValueError(f"statement type {self.name!r}: field names used by the engine itself: {', '.join(taken)}")
        if self.start_pattern:
            re.compile(self.start_pattern)  # fails here, not in a task

    @classmethod
    def from_dict(cls, raw: dict[str, Any]) -> StatementType:
        def specs(key: str) -> tuple[FieldSpec, ...]:
            return tuple(FieldSpec.from_dict(f) for f in raw.get(key) or [])

        return cls(
            name=raw["type_name"],
            env_var=raw.get("env_var"),
            split_type=raw.get("split_type"),
            start_pattern=raw.get("start_pattern"),
            start_phrase=raw.get("start_phrase"),
            must_not_contain=raw.get("must_not_contain"),
            summary_fields=specs("summary_fields"),
            static_fields=specs("transaction_static_fields"),
            dynamic_fields=specs("transaction_dynamic_fields"),
        )

    @property
    def has_ranges(self) -> bool:
        """True when statements carry an explicit id and end (``start_end``)."""
        return self.split_type == "start_end"

    @property
    def pattern_has_group(self) -> bool:
        return bool(self.start_pattern) and re.compile(self.start_pattern).groups > 0

    @property
    def amount_columns(self) -> list[str]:
        specs = self.static_fields + self.dynamic_fields
        return list(dict.fromkeys(f.name for f in specs if f.is_amount))


# The known statement layouts and the text that marks the first
# page of a statement.  Field lists are labels of the user's own extraction
# models and come from the YAML file instead.
KNOWN_SPLIT_RULES: list[dict[str, Any]] = [
    {"type_name": "AMEX - Card Statement", "split_type": "page_start", "start_pattern": r"\b1 of \d+"},
    {
        "type_name": "Westpac - Bank Statement",
        "split_type": "page_start",
        "start_pattern": r"(?i)Statement\s+No\.\s+\d+\s+Page\s+1\s+of\s+\d+",
    },
    {
        "type_name": "Westpac - Bank Statement (Receipt style)",
        "split_type": "page_start",
        "start_pattern": r"STATEMENT\s+NO\.\s+\d+\s+PAGE\s+1\s+OF\s+\d+",
    },
    {
        "type_name": "Bendigo - Bank Statement",
        "split_type": "start_end",
        "start_pattern": r"Statement number\s+(\d+)",
        "must_not_contain": "Continued overleaf...",
    },
    {
        "type_name": "Bank of Melbourne - Bank Statement",
        "split_type": "page_start",
        "start_pattern": r"\(page\s+1 of \d+\)",
    },
    {"type_name": "St. George - Bank Statement", "split_type": "page_start", "start_pattern": r"\(page\s+1 of \d+\)"},
    {"type_name": "Suncorp - Bank Statement", "split_type": "page_start", "start_pattern": r"\b1 of \d+"},
    {"type_name": "Pre-Built Layout Model"},
    {"type_name": "Raw-extract"},
    {"type_name": "CBA - Bank Statement (Foreign)", "split_type": "page_start", "start_pattern": r"\b1 of \d+"},
    {"type_name": "CBA - Bank Statement (Standard)", "split_type": "page_start", "start_pattern": r"\b1 of \d+"},
    {
        "type_name": "NAB - Bank Statement",
        "split_type": "page_start",
        "start_pattern": r"(?i)page\W*[1il]\W*of\W*\d{1,3}",
    },
    {"type_name": "NAB - Transaction Listings"},
    {
        "type_name": "ANZ - Bank Statement",
        "split_type": "page_start",
        "start_phrase": "WELCOME TO YOUR ANZ ACCOUNT AT A GLANCE",
    },
    {"type_name": "ANZ - Bank Statement (Receipt style)"},
    {"type_name": "NAB - Credit Card Statement"},
]


def known_split_types() -> list[StatementType]:
    """The built-in split rules, without field lists."""
    return [StatementType.from_dict(rule) for rule in KNOWN_SPLIT_RULES]


def parse_statement_types(raw: Any) -> list[StatementType]:
    if not isinstance(raw, dict) or "statement_types" not in raw:
        raise ValueError("the configuration needs a top-level key 'statement_types'")
    return [StatementType.from_dict(item) for item in raw["statement_types"] or []]


def load_statement_types(path: str) -> list[StatementType]:
    """Read the YAML configuration (a missing file raises FileNotFoundError)."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        return parse_statement_types(yaml.safe_load(handle))


def find_statement_type(types: Iterable[StatementType], name: str) -> StatementType | None:
    """First type with exactly this name; splitting treats ``None`` as manual."""
    return next((t for t in types if t.name == name), None)


def get_statement_type(types: Iterable[StatementType], name: str | None) -> StatementType:
    """Like :func:`find_statement_type`, but extraction refuses unknown names."""
    if not name:
        raise ValueError("no statement type name given")
    found = find_statement_type(types, name)
    if found is None:
        raise ValueError(f"statement type {name!r} is not in the configuration")
    return found


def statement_types_df(spark: SparkSession, types: Iterable[StatementType]) -> DataFrame:
    """The configuration as a table, to join datasets that mix types."""

    def rows(specs: tuple[FieldSpec, ...]) -> list[tuple]:
        return [(f.name, f.is_amount, f.is_date, f.date_format) for f in specs]

    data = [
        (
            t.name,
            t.env_var,
            t.split_type,
            t.start_pattern,
            t.start_phrase,
            t.must_not_contain,
            rows(t.summary_fields),
            rows(t.static_fields),
            rows(t.dynamic_fields),
        )
        for t in types
    ]
    return spark.createDataFrame(data, schemas.STATEMENT_TYPES)
