"""Amount functions."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as an amount in a text; digits of all scripts.
_AMOUNT = r"(?U)[-+]?[\d,]*\.?\d+"
_ASCII_AMOUNT = _AMOUNT.removeprefix("(?U)")
#: Decimal digits of all scripts, and what each means.
_DIGITS = {chr(c): str(unicodedata.digit(chr(c))) for c in range(128, sys.maxunicode) if unicodedata.category(chr(c)) == "Nd"}
_NUMBER = r"^\s*[-+]?((\d+\.?\d*|\.\d+)([eE][-+]?\d+)?|(?i:inf(inity)?))\s*$"


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def _number_text(text: Column) -> Column:
    """Digits of all scripts are looked for only in text that can hold them, which takes longer."""
    return F.when(_is_ascii(text), F.regexp_extract(text, _ASCII_AMOUNT, 0)).otherwise(F.regexp_extract(text, _AMOUNT, 0))


def amount_value(text: Column, sign_mode: str = "default") -> Column:
    """The first number in a text, as a double; null when there is none.

    A minus sign *anywhere* in the text negates the number that was read, the
    number's own sign included: by default ``-12.50`` gives 12.5 while
    ``-$12.50`` and ``12.50-`` give -12.5.  ``sign_mode='corrected'`` makes
    all three negative.
    """
    if sign_mode not in ("default", "corrected"):
        raise ValueError(f"unknown sign_mode {sign_mode!r}")
    found = F.replace(_number_text(text), F.lit(","), F.lit(""))
    plain = F.translate(found, "".join(_DIGITS), "".join(_DIGITS.values()))
    number = F.when(_is_ascii(found), found).otherwise(plain).try_cast("double")
    if sign_mode == "corrected":
        number = F.abs(number)
    return number * F.when(text.contains("-"), F.lit(-1.0)).otherwise(F.lit(1.0))


def amount_ok(text: Column) -> Column:
    """False only for non-empty text without a number."""
    return text.isNull() | (text == "") | (_number_text(text) != "")


def convert_amount(text: Column, sign_mode: str = "default") -> Column:
    """struct(value double, ok boolean)."""
    return F.struct(amount_value(text, sign_mode).alias("value"), amount_ok(text).alias("ok"))


def to_number(text: Column) -> Column:
    """Numeric text as a double, anything else null.

    The pattern guard keeps out spellings only the JVM reads, such as ``1d``.
    """
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def currency_text(value: Column) -> Column:
    """Display form ``$#,##0.00`` with a leading minus."""
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    return F.when(value.isNotNull(), F.concat(sign, F.lit("$"), F.format_number(F.abs(value), 2)))
