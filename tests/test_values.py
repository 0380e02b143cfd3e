import random
import re

import pytest

from foliospark import schemas
from foliospark.functions.examples import pattern_from_example
from foliospark.operators import values as v
from foliospark.operators.values import FULL_PAGE, TOP_HALF, ValueSearch

SEARCHES = [
    ValueSearch("account", "44-1234"),
    ValueSearch("number", "no. 12", FULL_PAGE),
    ValueSearch("date", "12 NOV 2023", FULL_PAGE),
    ValueSearch("nothing", "  "),
]


def make_files(seed, count=120):
    """Spans whose words are cut up at random, so values run over their ends."""
    random.seed(seed)
    pieces = ["44", "-", "1234", "no.", "12", "NOV", "2023", " ", "\t", "x", "No.", "7", "", "nov", "  3"]
    values = [["no.", "12"], ["12", "nov", "2023"], ["31 Dec", "1999"], ["44-1234"], ["x55-", "9876"], ["No. ", "", " 77"]]
    data, planned = [], []
    for n in range(count):
        for page in range(random.randrange(1, 9)):
            for line in range(random.randrange(0, 4)):
                for span in range(random.randrange(1, 4)):
                    if not planned and random.random() < 0.15:
                        planned = list(random.choice(values))
                    text = planned.pop(0) if planned else "".join(random.choice(pieces) for _ in range(random.randrange(1, 4)))
                    y1 = random.choice([100.0, 300.0, 499.0, 500.0, 900.0])
                    tall = random.random() < 0.1
                    kind = 1 if random.random() < 0.1 else 0
                    data.append(("d", f"f{n}.pdf", page, line // 2, line, span, text, 0.0, y1 - 9, 4.0 if tall else 50.0, y1, 1000.0, kind))
    return data


def whole_text(spans, fraction):
    text = ""
    for s in sorted(spans, key=lambda s: (s[2], s[3], s[4], s[5])):
        _, _, _, _, _, _, piece, x0, y0, x1, y1, height, kind = s
        if kind == 0 and x1 - x0 > y1 - y0 and y1 < height * fraction:
            text += piece + " "
    return re.sub(r"\s+", " ", text)


def brute_force(spans, search):
    pattern = pattern_from_example(search.example).regex.replace("(?iU)", "(?i)")
    found = re.findall(pattern, whole_text(spans, search.page_fraction))
    return (found[0].strip() or None) if found else None


@pytest.mark.parametrize("width", [1, 2, 3, 4096])
def test_values_against_whole_text(spark, width):
    data = make_files(width)
    random.shuffle(data)
    spans = spark.createDataFrame(data, schemas.SPANS)
    got = {r["file_name"]: r for r in v.extract_values(spans, SEARCHES, width=width).collect()}
    by_file = {}
    for s in data:
        by_file.setdefault(s[1], []).append(s)
    assert set(got) == set(by_file)
    found = 0
    for name, own in by_file.items():
        for search in SEARCHES:
            want = brute_force(own, search)
            found += want is not None
            assert got[name][search.name] == want, (name, search, whole_text(own, search.page_fraction))
    assert found > 80


def test_region_text_is_one_row_per_page(spark, rows):
    data = make_files(77, 30)
    spans = spark.createDataFrame(data, schemas.SPANS)
    want = {}
    for s in data:
        want.setdefault((s[1], s[2]), []).append(s)
    expected = [(f, p, whole_text(own, TOP_HALF)) for (f, p), own in want.items()]
    expected = sorted((e for e in expected if e[2]), key=repr)
    assert rows(v.region_text(spans), "file_name", "page_no", "region_text") == expected


def test_files_to_report(spark, rows):
    spans = spark.createDataFrame(make_files(5, 3), schemas.SPANS)
    files = spark.createDataFrame([("d", "other.pdf"), ("d", "f0.pdf")], "folder string, file_name string")
    got = rows(v.extract_value(spans, "44-1234", files=files), "file_name")
    assert got == [("f0.pdf",), ("other.pdf",)]
    assert v.extract_value(spans, "").where("value is not null").count() == 0


def test_statement_number(spark, rows):
    data = [("d", "a.pdf", 0, 0, 0, 0, "Statement  no.", 0.0, 0.0, 50.0, 10.0, 100.0, 0), ("d", "a.pdf", 3, 0, 0, 0, "42 x", 0.0, 80.0, 50.0, 90.0, 100.0, 0)]
    spans = spark.createDataFrame(data, schemas.SPANS)
    assert rows(v.statement_number(spans, "Statement no. 12"), "statement_number") == [("42",)]
