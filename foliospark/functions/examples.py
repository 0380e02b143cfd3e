"""Patterns from example values.

The example is a query parameter, so building its pattern is driver work.
:func:`pattern_from_column` is the batch form for a table of examples.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliospark.functions.text import strip


@dataclass(frozen=True)
class ExamplePattern:
    """``regex`` is a Java regex; it always matches exactly ``length`` characters
    of text whose white-space runs have been collapsed to one space."""

    regex: str
    length: int


def _kind(char: str) -> str:
    if char.isdigit():
        return "digit"
    if char.isalpha():
        return "letter"
    if char.isspace():
        return "space"
    return "other"


def pattern_from_example(example: str) -> ExamplePattern:
    """Digits stand for that many digits, letters for that many letters, white
    space for any white space, everything else for itself."""
    parts, length = [], 0
    for kind, run in groupby(example.strip(), _kind):
        run = "".join(run)
        if kind == "digit":
            parts.append(rf"\d{{{len(run)}}}")
        elif kind == "letter":
            parts.append(f"[A-Za-z]{{{len(run)}}}")
        elif kind == "space":
            parts.append(r"\s+")
        else:
            parts.append(re.escape(run))
        length += 1 if kind == "space" else len(run)
    return ExamplePattern("(?iU)" + "".join(parts), length)


def pattern_from_column(example: Column) -> Column:
    """Column form of :func:`pattern_from_example` for a table of examples.

    Runs are tokenised with a regex and each token is rewritten on its own, so
    the text one rule emits is never rewritten by the next.
    """
    tokens = F.regexp_extract_all(strip(example), F.lit(r"(?U)(\d+|\p{L}+|\s+|[^\d\p{L}\s])"), 1)

    def rewrite(token: Column) -> Column:
        size = F.length(token).cast("string")
        return (
            F.when(token.rlike(r"(?U)^\d"), F.concat(F.lit(r"\d{"), size, F.lit("}")))
            .when(token.rlike(r"(?U)^\p{L}"), F.concat(F.lit("[A-Za-z]{"), size, F.lit("}")))
            .when(token.rlike(r"(?U)^\s"), F.lit(r"\s+"))
            .when(token.rlike(r"^[!-/:-@\[-`{-~]$"), F.concat(F.lit("\\"), token))
            .otherwise(token)
        )

    return F.concat(F.lit("(?iU)"), F.array_join(F.transform(tokens, rewrite), ""))
