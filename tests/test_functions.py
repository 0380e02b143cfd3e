import datetime
import random
import re

import dateutil.parser
import pytest
from pyspark.sql import functions as F

from foliospark.functions import amounts, dates, examples, names
from foliospark.functions import text as tx


def evaluate(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


AMOUNTS = {
    "$150.00": (150.0, True),
    "$12.99": (12.99, True),
    "-12.50": (12.5, True),
    "-$12.50": (-12.5, True),
    "12.50-": (-12.5, True),
    "$1,234.56 CR": (1234.56, True),
    "(45.00)": (45.0, True),
    "12.": (12.0, True),
    "1.2.3": (1.2, True),
    "12-34": (-12.0, True),
    "+7": (7.0, True),
    ".5": (0.5, True),
    "abc": (None, False),
    "": (None, True),
    None: (None, True),
}


def test_amounts(spark):
    got = evaluate(spark, list(AMOUNTS), amounts.convert_amount)
    assert [(r["value"], r["ok"]) for r in got] == list(AMOUNTS.values())


def test_corrected_sign(spark):
    got = evaluate(spark, ["-12.50", "-$12.50", "12.50-", "12.50"], lambda c: amounts.amount_value(c, "corrected"))
    assert got == [-12.5, -12.5, -12.5, 12.5]
    with pytest.raises(ValueError):
        amounts.amount_value(F.lit("1"), "other")


def test_to_number(spark):
    texts = ["1", " 2.5 ", "1e3", ".5", "3.", "1d", "1f", "$1", "1,000", "", "abc", None, "-7", "inf"]
    want = [1.0, 2.5, 1000.0, 0.5, 3.0, None, None, None, None, None, None, None, -7.0, float("inf")]
    assert evaluate(spark, texts, amounts.to_number) == want


def test_currency_text(spark):
    got = evaluate(spark, [1234.5, -0.5, 0.0, None], amounts.currency_text, "double")
    assert got == ["$1,234.50", "-$0.50", "$0.00", None]


def test_strip_is_unicode(spark):
    texts = ["  a　b \x1c\n", "\t", "", None, "x "]
    assert evaluate(spark, texts, tx.strip) == [None if t is None else t.strip() for t in texts]


NORMALISED = {
    "Page I of 3": "Page 1 of 3",
    "pageI of": "page 1 of",
    "page |of": "page 1of",
    "page | of": "page | of",
    "PAGE \n I 0f  9": "PAGE 1 of 9",
    "page i of 2": "page 1 of 2",
    "ﬁnal ｐａｇｅ Ｉ of ４": "final page 1 of 4",
    "pages I": "pages I",
    "page Ix": "page Ix",
    "": "",
    "plain": "plain",
    "½ Ⅷ é": "1⁄2 VIII é",
    "a\x1cb\u00a0\u2003c": "a b c",
    None: None,
}


def test_normalise_text(spark):
    assert evaluate(spark, list(NORMALISED), tx.normalise_text) == list(NORMALISED.values())


def test_float_text(spark):
    values = [0.95, 0.9, 1.0, 0.0, 0.001, 0.00095, 0.0005, 0.00123, 0.000123456, 5e-05, 1.5e-07, 123.25]
    assert evaluate(spark, values, tx.float_text, "double") == [repr(v) for v in values]


EXAMPLES = ["44-1234", "Statement no. 12", "12 NOV 2023", "02-FEB-2024", "04-30-2019", "123-456-789", " a1  b2. ", "(x)"]


def test_pattern_matches_its_example():
    assert examples.pattern_from_example("44-1234").regex == r"(?iU)\d{2}\-\d{4}"
    assert examples.pattern_from_example("").length == 0
    for example in EXAMPLES:
        pattern = examples.pattern_from_example(example)
        collapsed = re.sub(r"\s+", " ", example.strip())
        found = re.search(pattern.regex.replace("(?iU)", "(?i)"), collapsed)
        assert found and len(found.group()) == pattern.length == len(collapsed)


def test_pattern_from_column_agrees(spark):
    got = evaluate(spark, EXAMPLES, examples.pattern_from_column)
    assert got == [examples.pattern_from_example(e).regex for e in EXAMPLES]


def test_names(spark):
    assert evaluate(spark, ["a/b: c*(1)_x-é.pdf"], names.sanitise_name) == ["ab c(1)_x-.pdf"]
    assert evaluate(spark, ["a.b.pdf", "x", ".pdf"], names.stem) == ["a.b", "x", ".pdf"]
    assert evaluate(spark, ["file:/a/b/c.PDF"], names.base_name) == ["c.PDF"]
    assert evaluate(spark, ["file:/a/b/c.PDF"], names.parent_folder) == ["file:/a/b"]


def test_dates_agree_with_lenient_parser(spark):
    random.seed(5)
    shapes = ["%d %b %Y", "%d-%b-%Y", "%m-%d-%Y", "%d/%m/%Y", "%Y-%m-%d", "%B %d, %Y", "%Y%m%d", "%d %B %y", "%d%b%Y", "%m/%d/%y", "%d.%m.%Y"]
    texts = []
    for _ in range(300):
        day = datetime.date(1990, 1, 1) + datetime.timedelta(days=random.randrange(16000))
        text = day.strftime(random.choice(shapes))
        texts.append(random.choice([text, text.upper(), text.lower()]))
    texts += ["30 Jan 2023", "12 NOV 2023", "02-FEB-2024", "04-30-2019", "Sept 5 2020"]
    year = datetime.date.today().year
    got = evaluate(spark, texts, lambda c: dates.format_date(c, pivot_year=year))
    assert got == [dateutil.parser.parse(t).strftime("%Y%m%d") for t in texts]


def test_dates_that_cannot_be_told(spark):
    texts = ["31 FEB 2023", "13-13-2019", "hello", "", None, "01 Jan", "99 xyz 2020"]
    assert evaluate(spark, texts, dates.format_date) == [None] * len(texts)
    got = evaluate(spark, ["01 Jan", "Mar 7", "01JAN"], lambda c: dates.format_date(c, default_year=2022))
    assert got == ["20220101", "20220307", "20220101"]
