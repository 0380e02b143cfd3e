import random
import re

import pytest
from pyspark.sql import functions as F

from foliospark import schemas
from foliospark.config import StatementType
from foliospark.operators import page_text as pt
from foliospark.operators import split

EVENTS = "folder string, file_name string, page_no int, start_id string, closes boolean"
BENDING = StatementType(
    name="ranges", split_type="start_end", start_pattern=r"Statement number\s+(\d+)", must_not_contain="Continued"
)


def random_files(count, seed):
    random.seed(seed)
    files = {}
    for n in range(count):
        pages = []
        for page in range(random.randrange(1, 12)):
            kind = random.random()
            start = None
            matched = False
            if kind < 0.3:
                start, matched = str(random.randrange(3)), True
            elif kind < 0.4:
                start = str(page)
            closes = not matched and random.random() < 0.4
            pages.append((start, closes))
        files[f"f{n}.pdf"] = pages
    return files


def sequential_ranges(pages):
    """Page by page, as a person would; every run that was ever opened, in order."""
    runs, current = [], None
    for page, (start, closes) in enumerate(pages):
        if start is not None and (current is None or start != runs[current][0]):
            if current is not None:
                runs[current][2] = page - 1
            runs.append([start, page, None])
            current = len(runs) - 1
        if closes and current is not None:
            runs[current][2] = page
            current = None
    if current is not None:
        runs[current][2] = len(pages) - 1
    return [tuple(r) for r in runs]


def events_df(spark, files):
    data = [("d", name, page, start, closes) for name, pages in files.items() for page, (start, closes) in enumerate(pages)]
    random.shuffle(data)
    return spark.createDataFrame(data, EVENTS)


@pytest.mark.parametrize("width", [1, 3, 4096])
def test_ranges_against_sequential_model(spark, rows, width):
    files = random_files(400, width)
    kept, lost, assigned = [], [], []
    for name, pages in files.items():
        last = {}
        for run in sequential_ranges(pages):
            if run[0] in last:
                lost.append((name, *last[run[0]]))
            last[run[0]] = run
        kept += [(name, *run) for run in last.values()]
        assigned += [(name, page, run[0]) for run in last.values() for page in range(run[1], run[2] + 1)]
    events = events_df(spark, files)
    order = ["file_name", "statement_id", "start_page", "end_page"]
    assert rows(split.split_start_end(events, width), *order) == sorted(kept, key=repr)
    assert rows(split.superseded_ranges(events, width), *order) == sorted(lost, key=repr)
    done = split.split_events(events, BENDING, width)
    assert rows(done.assignments, "file_name", "page_no", "statement_id") == sorted(assigned, key=repr)
    silent = [(name,) for name, pages in files.items() if all(p[0] is None for p in pages)]
    assert rows(done.manual, "file_name") == sorted(silent, key=repr)


@pytest.mark.parametrize("width", [1, 3, 4096])
def test_starts_against_sequential_model(spark, rows, width):
    files = random_files(300, width + 50)
    want, pages_of = [], []
    for name, pages in files.items():
        starts = [p for p, (start, _) in enumerate(pages) if start is not None]
        for i, start in enumerate(starts):
            end = starts[i + 1] - 1 if i + 1 < len(starts) else len(pages) - 1
            want.append((name, i + 1, start, end))
            pages_of += [(name, p, f"{name[:-4]}_document_{i + 1}.pdf") for p in range(start, end + 1)]
    events = events_df(spark, files)
    assert rows(split.split_page_start(events, width), "file_name", "ordinal", "start_page", "end_page") == sorted(want, key=repr)
    done = split.split_events(events, StatementType(name="starts", split_type="page_start"), width)
    assert rows(done.assignments, "file_name", "page_no", "document_name") == sorted(pages_of, key=repr)


def test_interval_join_against_brute_force(spark, rows):
    random.seed(3)
    ranges = [("d", f"f{random.randrange(4)}", str(i), a, a + random.randrange(200)) for i in range(60) for a in [random.randrange(300)]]
    pages = [("d", f"f{n}", p) for n in range(4) for p in range(350)]
    statements = spark.createDataFrame(ranges, "folder string, file_name string, statement_id string, start_page int, end_page int")
    got = split.assign_pages(spark.createDataFrame(pages, "folder string, file_name string, page_no int"), statements)
    want = [(f, p, i) for _, f, p in pages for _, g, i, a, b in ranges if f == g and a <= p <= b]
    assert rows(got, "file_name", "page_no", "statement_id") == sorted(want, key=repr)


def page(n, text="", ocr=None, footer=None, footer_ocr=None, name="a.pdf"):
    return ("d", name, n, text, ocr, footer, footer_ocr)


def test_start_search_order_and_ids(spark):
    filler = "x" * 30
    data = [
        page(0, filler + " Statement  number 0012", footer="Statement number 7"),
        page(1, filler, footer="Statement number 13"),
        page(2, filler, footer="  ", footer_ocr="statement number 14"),
        page(3, filler, footer="nothing", footer_ocr="STATEMENT NUMBER 15"),
        page(4, filler),
        page(5, filler + " Statement number 12345678901234567890123"),
    ]
    pages = pt.resolve_page_text(spark.createDataFrame(data, schemas.PAGES))
    got = pt.match_start(pages, BENDING).orderBy("page_no").collect()
    assert [(r["source"], r["start_id"]) for r in got] == [
        ("page", "12"), ("footer", "13"), ("footer", "14"), ("footer_ocr", "15"), (None, None),
        ("page", "12345678901234567890123"),
    ]


def test_scanned_files_use_ocr(spark, rows):
    data = [
        page(0, "short", "ocr page one is long enough"),
        page(1, "a text layer that is ignored here", "ocr two"),
        page(0, "a text layer that is long enough", "unused", name="b.pdf"),
        page(1, " \n", "ocr for the empty page", name="b.pdf"),
        page(1, "no first page", "ocr", name="c.pdf"),
    ]
    pages = spark.createDataFrame(data, schemas.PAGES)
    resolved = pt.resolve_page_text(pages)
    assert rows(resolved, "file_name", "page_no", "page_text") == [
        ("a.pdf", 0, "ocr page one is long enough"),
        ("a.pdf", 1, "ocr two"),
        ("b.pdf", 0, "a text layer that is long enough"),
        ("b.pdf", 1, "ocr for the empty page"),
        ("c.pdf", 1, "ocr"),
    ]


def test_events_equal_the_step_by_step_operators(spark, rows):
    random.seed(8)
    words = ["Statement number 3", "Statement number 04", "Continued", "lorem ipsum dolor sit amet", "ＳＴＡＴＥＭＥＮＴ number 5", ""]
    data = []
    for n in range(60):
        for p in range(random.randrange(1, 6)):
            text = " ".join(random.sample(words, 2)) if random.random() < 0.8 else ""
            data.append(page(p, text, random.choice([None, "Statement number 9", "ocr"]), random.choice([None, words[0]]), None, f"f{n}.pdf"))
    pages = spark.createDataFrame(data, schemas.PAGES)
    for stype in (BENDING, StatementType(name="phrase", split_type="page_start", start_phrase="lorem ipsum")):
        steps = pt.match_phrase(pt.match_start(pt.resolve_page_text(pages), stype), stype)
        start = F.coalesce("start_id", F.when(F.col("phrase_matched"), F.col("page_no").cast("string")))
        closes = pt.statement_ends(F.col("page_text"), stype) & ~F.col("matched")
        want = steps.select("file_name", "page_no", start, closes)
        for width in (2, 4096):
            got = pt.page_events(pages, stype, width)
            assert rows(got, "file_name", "page_no", "start_id", "closes") == rows(want)


def test_phrase_is_literal_and_case_sensitive(spark):
    stype = StatementType(name="p", split_type="page_start", start_phrase="Begin (here)")
    data = [page(0, "xxxxxxxxxxxxxxxxxxxxxxxxx Begin (here)"), page(1, "begin (here)"), page(2, "Begin here")]
    done = split.split_documents(spark.createDataFrame(data, schemas.PAGES), stype)
    assert [tuple(r) for r in done.statements.select("start_page", "end_page", "document_name").collect()] == [(0, 2, "a_document_1.pdf")]


def test_unknown_type_goes_to_manual(spark, rows):
    pages = spark.createDataFrame([page(0, "text"), page(0, "text", name="b.pdf")], schemas.PAGES)
    done = split.split_documents(pages, None)
    assert rows(done.manual, "stem") == [("a",), ("b",)]
    assert done.statements.count() == 0
    assert rows(split.route_manual(pages, None), "stem") == [("a",), ("b",)]


def test_footer_strip(spark, rows):
    def span(line, text, y1, kind=0, height=1000.0):
        return ("d", "a.pdf", 0, 0, line, 0, text, 0.0, y1 - 10, 100.0, y1, height, kind)

    data = [span(3, "of 4", 990.0), span(2, "Page 1", 960.0), span(1, "body", 900.0), span(4, "picture", 995.0, 1)]
    got = pt.footer_text(spark.createDataFrame(data, schemas.SPANS))
    assert rows(got, "page_no", "footer_text") == [(0, "Page 1 of 4")]


def test_known_patterns_compile_and_match(spark):
    from foliospark.config import find_statement_type, known_split_types
    from foliospark.functions.text import search_pattern

    types = known_split_types()
    samples = {
        "AMEX - Card Statement": "page 1 of 4",
        "Westpac - Bank Statement": "statement no. 12 page 1 of 3",
        "Bendigo - Bank Statement": "Statement number 5",
        "St. George - Bank Statement": "(page 1 of 2)",
        "NAB - Bank Statement": "Page: l of 3",
    }
    for name, text in samples.items():
        stype = find_statement_type(types, name)
        assert re.search(stype.start_pattern, text, re.IGNORECASE)
        one = spark.range(1).select(F.lit(text).rlike(search_pattern(stype.start_pattern))).first()[0]
        assert one
    assert len(types) == 16 and len({t.name for t in types}) == 16
