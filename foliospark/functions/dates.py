"""Lenient date reading for values found in document text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The month names that are understood, in any case.
MONTHS = [
    ("jan", "january"),
    ("feb", "february"),
    ("mar", "march"),
    ("apr", "april"),
    ("may",),
    ("jun", "june"),
    ("jul", "july"),
    ("aug", "august"),
    ("sep", "sept", "september"),
    ("oct", "october"),
    ("nov", "november"),
    ("dec", "december"),
]

_NAMES = "|".join(name for names in MONTHS for name in sorted(names, key=len, reverse=True))
_GAP = r"[\s\-/.,]*"
_SEP = r"[\s\-/.,]+"


def _month_number(name: Column) -> Column:
    initials = F.array(*[F.lit(names[0]) for names in MONTHS])
    return F.array_position(initials, F.lower(F.substring(name, 1, 3))).cast("int")


# The names of weekdays that may stand before a date.
_WEEKDAYS = "monday|mon|tuesday|tues|tue|wednesday|wed|thursday|thurs|thur|thu|friday|fri|saturday|sat|sunday|sun"
_ZONE = r"\s*(?:z|utc|gmt|[+-]\d{2}:?\d{2})?$"
_TIME = rf"(?i)(?:[T\s,]+(?:at\s+)?)\d{{1,2}}:\d{{2}}(?::\d{{2}}(?:[.,]\d+)?)?\s*(?:[ap]\.?m\.?)?{_ZONE}"
# An hour alone, which needs its half of the day; and times without colons, which follow a T.
_HOUR = rf"(?i)[\s,]+(?:at\s+)?\d{{1,2}}\s*[ap]\.?m\.?{_ZONE}"
_COMPACT_TIME = rf"(?i)(?<=\d)T\d{{4}}(?:\d{{2}}(?:[.,]\d+)?)?{_ZONE}"


def _plain_date(text: Column) -> Column:
    """The date without weekday, time, ordinal endings and ``of``; six digits as day, month and year."""
    text = F.trim(text)
    for time in (_TIME, _HOUR, _COMPACT_TIME):
        text = F.regexp_replace(text, time, "")
    text = F.regexp_replace(text, rf"(?i)^(?:{_WEEKDAYS})\b[\s.,]*|[\s.,]+(?:{_WEEKDAYS})$", "")
    text = F.regexp_replace(text, r"(?i)\b(\d{1,2})(?:st|nd|rd|th)\b", "$1")
    text = F.regexp_replace(text, r"(?i)(?<=\d)\s+of\s+", " ")
    return F.trim(F.regexp_replace(text, r"^(\d{2})(\d{2})(\d{2})$", "$1-$2-$3"))


def parse_date(text: Column, default_year: int | None = None, pivot_year: int = 2025) -> Column:
    """Date meant by a text; null when it cannot be told.

    Numeric dates are month-first unless the first number cannot be a month,
    year-first when the first number cannot be a day.  Two-digit years are the
    ones within 50 years of ``pivot_year``.  A date without a year needs
    ``default_year``: nothing is ever taken from today's date.
    """
    text = _plain_date(text)
    year, month, day = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(None).cast("int")

    def number(pattern: str, group: int) -> Column:
        return F.regexp_extract(text, pattern, group).try_cast("int")

    def full_year(value: Column, digits: Column) -> Column:
        century = pivot_year // 100 * 100
        guess = value + century
        guess = (
            F.when(guess >= pivot_year + 50, guess - 100).when(guess < pivot_year - 50, guess + 100).otherwise(guess)
        )
        return F.when(F.length(digits) <= 2, guess).otherwise(value)

    day_name_year = rf"(?i)^(\d{{1,2}}){_GAP}({_NAMES}){_GAP}(\d{{4}}|\d{{2}})$"
    name_day_year = rf"(?i)^({_NAMES}){_GAP}(\d{{1,2}}){_SEP}(\d{{4}}|\d{{2}})$"
    year_name_day = rf"(?i)^(\d{{4}}){_GAP}({_NAMES}){_GAP}(\d{{1,2}})$"
    year_first = r"^(\d{4})([-/. ])(\d{1,2})[-/. ](\d{1,2})$"
    compact = r"^(\d{4})(\d{2})(\d{2})$"
    numeric = r"^(\d{1,2})[-/. ](\d{1,2})[-/. ](\d{4}|\d{2})$"
    day_name = rf"(?i)^(\d{{1,2}}){_GAP}({_NAMES})$"
    name_day = rf"(?i)^({_NAMES}){_GAP}(\d{{1,2}})$"

    def extract(pattern: str, group: int) -> Column:
        return F.regexp_extract(text, pattern, group)

    first, second = number(numeric, 1), number(numeric, 2)
    third_text = extract(numeric, 3)
    third = third_text.try_cast("int")
    two_digit_year_first = first > 31
    day_first = (first > 12) & ~two_digit_year_first

    given = F.lit(default_year).cast("int")
    cases = [
        (
            day_name_year,
            full_year(number(day_name_year, 3), extract(day_name_year, 3)),
            _month_number(extract(day_name_year, 2)),
            number(day_name_year, 1),
        ),
        (
            name_day_year,
            full_year(number(name_day_year, 3), extract(name_day_year, 3)),
            _month_number(extract(name_day_year, 1)),
            number(name_day_year, 2),
        ),
        (year_name_day, number(year_name_day, 1), _month_number(extract(year_name_day, 2)), number(year_name_day, 3)),
        (year_first, number(year_first, 1), number(year_first, 3), number(year_first, 4)),
        (compact, number(compact, 1), number(compact, 2), number(compact, 3)),
        (
            numeric,
            F.when(two_digit_year_first, full_year(first, F.lit("00"))).otherwise(full_year(third, third_text)),
            F.when(two_digit_year_first | day_first, second).otherwise(first),
            F.when(two_digit_year_first, third).when(day_first, first).otherwise(second),
        ),
        (day_name, given, _month_number(extract(day_name, 2)), number(day_name, 1)),
        (name_day, given, _month_number(extract(name_day, 1)), number(name_day, 2)),
    ]
    for pattern, y, m, d in reversed(cases):
        hit = text.rlike(pattern)
        year = F.when(hit, y).otherwise(year)
        month = F.when(hit, m).otherwise(month)
        day = F.when(hit, d).otherwise(day)
    spelled = F.concat_ws(
        "-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")
    )
    return F.try_to_timestamp(spelled, F.lit("yyyy-MM-dd")).cast("date")


def format_date(text: Column, default_year: int | None = None, pivot_year: int = 2025) -> Column:
    """The date in a text as ``yyyyMMdd``; null when it cannot be told."""
    return F.date_format(parse_date(text, default_year, pivot_year), "yyyyMMdd")
