"""Text functions: every one takes and returns Columns."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything Python counts as white space, so that strip() agrees with str.strip().
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for null, empty and all-white-space text."""
    return F.coalesce(strip(text), F.lit("")) == ""


def null_if_empty(text: Column) -> Column:
    return F.when(text != "", text)


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, _SPACE_RUN, " ")


def search_pattern(pattern: str) -> str:
    """A configured pattern as a Java regex: any case, Unicode classes.

    Named groups and references to them are turned into numbered ones, since
    Java's names are narrower.  A pattern that is no valid regex is refused here.
    """
    numbers = re.compile(pattern).groupindex
    pattern = re.sub(r"\(\?P<\w+>", "(", pattern)
    pattern = re.sub(r"\(\?P=(\w+)\)", lambda m: f"(?:\\{numbers[m[1]]})", pattern)
    return "(?iU)" + pattern


def _nfkc_udf():
    # Nested, so the function travels to the workers by value.
    def nfkc(texts: pd.Series) -> pd.Series:
        import unicodedata

        return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")

    return F.pandas_udf(nfkc, "string")


def compatibility_form(text: Column) -> Column:
    """Unicode NFKC.

    Spark has no built-in for it, so this is the one Python step of the engine.
    Pure ASCII text is already in that form: it is passed as null, and hence
    never leaves the JVM.
    """
    non_ascii = F.when(text.rlike(r"[^\x00-\x7F]"), text)
    return F.coalesce(_nfkc_udf()(non_ascii), text)


def tidy_markers(text: Column) -> Column:
    """Repair common misreadings of 'page 1 of n' in text already in NFKC form."""
    text = collapse_spaces(text)
    text = F.replace(text, F.lit(" 0f "), F.lit(" of "))
    return F.regexp_replace(text, r"(?iU)(?<=page)[\s\x1c-\x1f]*[|I]\b", " 1")


def normalise_text(text: Column) -> Column:
    return tidy_markers(compatibility_form(text))


def float_text(value: Column) -> Column:
    """A double in [0, 1e7) spelled with the shortest decimal form.

    Java switches to scientific notation below 1e-3; spell those out down to
    1e-4 and use ``5e-05`` style beneath.
    """
    plain = value.cast("string")
    digits = F.regexp_replace(F.regexp_extract(plain, r"^-?([\d.]+)E", 1), r"\.0$", "")
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    exponent = F.regexp_extract(plain, r"E-(\d+)$", 1)
    spelled = (
        F.when(exponent == "4", F.concat(sign, F.lit("0.000"), F.replace(digits, F.lit("."), F.lit(""))))
        .otherwise(F.concat(sign, digits, F.lit("e-"), F.lpad(exponent, 2, "0")))
    )
    return F.when((F.abs(value) >= 1e-3) | (value == 0), plain).otherwise(spelled)
