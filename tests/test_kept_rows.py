"""No row vanishes, whatever is missing from it; names, digits, dates and patterns as users write them."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from foliospark import config, schemas
from foliospark.functions import amounts, dates
from foliospark.functions.text import search_pattern
from foliospark.operators import extract, page_text, postprocess, split, values
from foliospark.plans.preprocess import preprocess
from foliospark.plans.process import process_mixed
from foliospark.sources import readers

RULE = config.StatementType(name="r", split_type="page_start", start_pattern=r"\b1 of \d+")


def files_of(*frames):
    return {tuple(r) for f in frames for r in f.select("folder", "file_name").collect()}


def test_pages_without_folder_name_or_number(spark):
    text = "x" * 30 + " page 1 of 2"
    data = [(None, "a.pdf", 0, text), (None, "a.pdf", 1, "x" * 30), ("d", None, 0, text), ("d", "n.pdf", None, text), ("d", "half.pdf", 0, text), ("d", "half.pdf", None, text), ("d", "none.pdf", 0, "z" * 40)]
    pages = spark.createDataFrame([(*r, None, None, None) for r in data], schemas.PAGES)
    for stype in (RULE, config.StatementType(name="s", split_type="start_end", start_pattern=r"page (\d+) of")):
        done = split.split_documents(pages, stype)
        assert files_of(done.statements) == files_of(done.assignments) == {("", "a.pdf"), ("d", "")}
        assert files_of(done.manual) == {("d", "n.pdf"), ("d", "half.pdf"), ("d", "none.pdf")}
        assert done.manual.count() == 3
    unknown = split.split_documents(pages, None)
    assert files_of(unknown.manual) == {("", "a.pdf"), ("d", ""), ("d", "n.pdf"), ("d", "half.pdf"), ("d", "none.pdf")}
    assert page_text.flag_machine_readable(pages).count() == len(data)


def test_every_given_file_is_a_statement_or_manual(spark):
    data = [("d", "a.pdf", 0, "x" * 30 + " page 1 of 2"), (None, "b.pdf", 0, "x" * 30), ("d", "n.pdf", None, "x")]
    pages = spark.createDataFrame([(*r, None, None, None) for r in data], schemas.PAGES)
    files = spark.createDataFrame([("d", "a.pdf"), (None, "b.pdf"), ("d", "n.pdf"), ("d", "empty.pdf")], "folder string, file_name string")
    done = preprocess(files, pages, RULE)
    why = {r["file_name"]: (r["result"], r["reason"], r["documents"], r["pages"], r["assigned_pages"]) for r in done.coverage.collect()}
    assert why == {
        "a.pdf": ("split", None, 1, 1, 1),
        "b.pdf": ("manual", "no start found", 0, 1, 0),
        "n.pdf": ("manual", "pages without a number", 0, 1, 0),
        "empty.pdf": ("manual", "no pages", 0, 0, 0),
    }
    manual = files_of(done.split.manual)
    assert manual == {("", "b.pdf"), ("d", "n.pdf"), ("d", "empty.pdf")}
    assert files_of(done.split.statements) | manual == files_of(done.before)
    assert done.split.manual.count() == 3


def test_page_table_without_folder_column(spark, tmp_path):
    spark.createDataFrame([("a.pdf", 0, "x" * 30 + " page 1 of 2")], "file_name string, page_no int, text string").write.parquet(str(tmp_path / "p"))
    assert files_of(split.split_documents(readers.read_pages(spark, str(tmp_path / "p")), RULE).statements) == {("", "a.pdf")}


def test_results_of_unlisted_types_are_reported(spark):
    one = {"folder": "d", "documents": [{"fields": {}, "transactions": [{"Amount": {"content": "1", "value": "1"}}]}]}
    rows = [(json.dumps({**one, "file_name": f}), t) for f, t in (("a", "k"), ("b", "other"), ("c", None))]
    parsed = F.from_json("text", schemas.ANALYSIS).alias("r")
    results = spark.createDataFrame(rows, "text string, statement_type string").select(parsed, "statement_type").select("r.*", "statement_type")
    fields = (config.FieldSpec("Amount", is_amount=True),)
    known = config.StatementType(name="k", dynamic_fields=fields, summary_fields=fields)
    done = process_mixed(results, [known])
    assert files_of(done.unmatched) == {("d", "b"), ("d", "c")} and done.transactions.count() == 1


def test_transactions_without_static_row_or_folder_stay(spark):
    rows = spark.createDataFrame([(None, "a", 0, 1.0), ("d", "b", 0, 2.0), ("d", "c", 1, 3.0)], "folder string, OriginalFileName string, row_no long, `Amount.AUD` double")
    static = spark.createDataFrame([(None, "a", "one"), ("d", "b", "two")], "folder string, OriginalFileName string, `Name.X` string")
    found = sorted((r["OriginalFileName"], r["Name.X"], r["Amount.AUD"]) for r in extract.attach_static(rows, static).collect())
    assert found == [("a", "one", 1.0), ("b", "two", 2.0), ("c", None, 3.0)]


def test_spans_and_duplicates_without_folder(spark):
    spans = spark.createDataFrame([(None, "a.pdf", 0, 0, 0, 0, "No 12", 0.0, 0.0, 600.0, 9.0, 99.0, 0)], schemas.SPANS)
    assert files_of(values.region_text(spans)) == {("", "a.pdf")}
    found = values.extract_value(spans, "No 12", 1.0, spans.select("folder", "file_name")).collect()
    assert [(r["folder"], r["value"]) for r in found] == [("", "No 12")]
    nothing = values.extract_value(spans, "", 1.0, spans.select("folder", "file_name")).collect()
    assert [(r["folder"], r["value"]) for r in nothing] == [("", None)]
    files = postprocess.with_location(spark.createDataFrame([(None, "a"), (None, "b"), ("d", None)], "folder string, file_name string"))
    assert sorted(r["action"] for r in postprocess.duplicate_action(files, F.lit("same")).collect()) == ["move", "none", "none"]


@pytest.mark.parametrize("sub", ["bucket", "a b", "100%", "x+y"])
def test_object_names_below_the_root(spark, tmp_path, monkeypatch, sub):
    root = tmp_path / "bucket" / sub
    names = ["a.json", "logs/bucket/a.json", "with space.json", "p%20q.json", "bucket/bucket/b+c.json"]
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps({"n": name}))
    for given in (str(root), f"file://{root}" if "%" not in sub and " " not in sub else str(root), f"{root}/"):
        good, bad = readers.read_json_objects(spark, given, "n string")
        assert sorted((r["name"], r["n"]) for r in good.collect()) == sorted((n, n) for n in names) and bad.count() == 0
    good, _ = readers.read_json_objects(spark, str(root), "n string", prefix="with s")
    assert [r["name"] for r in good.collect()] == ["with space.json"]


def test_digits_of_all_scripts(spark):
    cases = {"１２.50": 12.5, "٣٤": 34.0, "$1,２00.5": 1200.5, "-$१२": -12.0, "12.50": 12.5}
    frame = spark.createDataFrame([(k,) for k in cases], "t string").select("t", amounts.convert_amount(F.col("t")).alias("a"))
    assert {r["t"]: (r["a"]["value"], r["a"]["ok"]) for r in frame.collect()} == {k: (v, True) for k, v in cases.items()}


@pytest.mark.parametrize(
    "text, day",
    [
        ("1st January 2023", (2023, 1, 1)),
        ("January 30th, 2023", (2023, 1, 30)),
        ("Mon 30 Jan 2023", (2023, 1, 30)),
        ("Monday, 30 January 2023", (2023, 1, 30)),
        ("30 Jan 2023 10:15", (2023, 1, 30)),
        ("30/01/2023 10:15:30 PM", (2023, 1, 30)),
        ("2023-1-30T00:00:00", (2023, 1, 30)),
        ("2023-01-30T00:00:00.000Z", (2023, 1, 30)),
        ("230130", (2030, 1, 23)),
        ("5/10/23 3pm", (2023, 5, 10)),
        ("5/10/23 at 11 a.m.", (2023, 5, 10)),
        ("20230130T101500", (2023, 1, 30)),
        ("20230130T1015Z", (2023, 1, 30)),
        ("20230130T101500.25+0100", (2023, 1, 30)),
        ("3pm", None),
        ("22nd of March 2021", (2021, 3, 22)),
        ("20230130", (2023, 1, 30)),
        ("Sat", None),
        ("no date", None),
    ],
)
def test_spellings_of_dates(spark, text, day):
    found = spark.range(1).select(dates.parse_date(F.lit(text)).alias("d")).first()["d"]
    assert found == (datetime.date(*day) if day else None)


def test_patterns_with_named_groups(spark):
    pattern = search_pattern(r"(?P<stmt_no>\d+)-(?P=stmt_no)x")
    frame = spark.createDataFrame([("no 12-12x",), ("12-13x",)], "t string")
    assert [r[0] for r in frame.select(F.regexp_extract("t", pattern, 1)).collect()] == ["12", ""]
    with pytest.raises(Exception, match="unterminated|missing"):
        search_pattern("(")
    with pytest.raises(ValueError, match="row_no"):
        config.StatementType(name="x", dynamic_fields=[config.FieldSpec("row_no")])
