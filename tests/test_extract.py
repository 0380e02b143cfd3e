import random
from operator import itemgetter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from foliospark import schemas
from foliospark.config import FieldSpec, StatementType
from foliospark.operators import extract as ex
from foliospark.plans.process import process_mixed, process_statements

CARD = StatementType(
    name="card",
    summary_fields=(FieldSpec("PreviousBalance", True), FieldSpec("Label"), FieldSpec("DocumentName")),
    static_fields=(FieldSpec("Account"), FieldSpec("Shared"), FieldSpec("Missing")),
    dynamic_fields=(FieldSpec("Date", is_date=True), FieldSpec("Amount", True), FieldSpec("Shared")),
)


def field(content=None, value=None, confidence=None):
    return {"content": content, "value": value, "confidence": confidence}


def item(**values):
    return {k: {"content": None, "value": v} for k, v in values.items()}


def results(spark, documents, name="a.pdf", tables=None, pages=None):
    return spark.createDataFrame([("d", name, documents, tables, pages)], schemas.ANALYSIS)


DOCUMENTS = [
    {
        "fields": {"Shared": field("", None), "PreviousBalance": field("$1,000.00", None, 0.95), "Label": field(" a ", "x", 0.9)},
        "transactions": [item(Date="01 Jan", Amount="$150.00"), item(Amount="oops", Shared="mine")],
    },
    {"fields": {"Account": field(None, "77"), "Shared": field("late"), "Label": field(None, "b", None)}, "transactions": None},
    {"fields": {"PreviousBalance": field(None, None, 0.5)}, "transactions": [item(Date="", Amount="")]},
]


def test_static_and_transactions(spark):
    out = process_statements(results(spark, DOCUMENTS), CARD).transactions.orderBy("row_no")
    assert out.columns == ["folder", "row_no", "OriginalFileName", "Account", "Shared", "Missing", "Date", "Amount", "ConversionSuccess"]
    assert [tuple(r) for r in out.collect()] == [
        ("d", 0, "a.pdf", "77", None, "", "01 Jan", 150.0, True),
        ("d", 1, "a.pdf", "77", "mine", "", None, None, False),
        ("d", 2, "a.pdf", "77", None, "", "", None, True),
    ]


def test_join_form_equals_row_form(spark, rows):
    data = results(spark, DOCUMENTS)
    joined = ex.attach_static(ex.transactions(data, CARD), ex.static_fields(data, CARD))
    direct = ex.transactions_with_static(data, CARD)
    columns = sorted(direct.columns)
    assert rows(joined, *columns) == rows(direct, *columns)


def test_present_but_empty_stops_the_search(spark):
    assert ex.static_fields(results(spark, DOCUMENTS), CARD).first()["Shared"] == ""


def test_summary(spark):
    row = process_statements(results(spark, DOCUMENTS), CARD).summary.first()
    assert row.asDict() == {
        "folder": "d", "DocumentName": "a.pdf",
        "PreviousBalance_Value": 1000.0, "PreviousBalance_Text": "$1,000.00", "PreviousBalance_Confidence": "0.95 0.5",
        "Label_Value": "a  b", "Label_Confidence": "0.9 N/A",
    }


def test_flattening_the_long_form(spark, rows):
    data = results(spark, DOCUMENTS)
    assert rows(ex.flatten_summary(ex.summary_fields(data, CARD), CARD)) == rows(ex.summary_table(data, CARD))


def test_flatten_example(spark):
    stype = StatementType(name="s", summary_fields=(FieldSpec("PreviousBalance", True), FieldSpec("PaymentsAndCredits", True)))
    documents = [{"fields": {"PreviousBalance": field("1000.0", None, 0.95), "PaymentsAndCredits": field("200.0", None, 0.9)}, "transactions": None}]
    row = ex.summary_table(results(spark, documents, "Invoice.pdf"), stype).first()
    assert (row["DocumentName"], row["PreviousBalance_Value"], row["PreviousBalance_Confidence"]) == ("Invoice.pdf", 1000.0, "0.95")
    assert (row["PaymentsAndCredits_Value"], row["PaymentsAndCredits_Confidence"]) == (200.0, "0.9")


def test_failed_and_empty(spark):
    failed = results(spark, None, "bad.pdf")
    empty = results(spark, [], "empty.pdf")
    both = failed.unionByName(empty).unionByName(results(spark, DOCUMENTS))
    done = process_statements(both, CARD)
    assert [r["file_name"] for r in done.failed.collect()] == ["bad.pdf"]
    assert done.transactions.count() == 3 and done.summary.count() == 2
    assert ex.extraction_totals(both).first().asDict() == {"files": 3, "failed": 1, "summaries": 2, "transactions": 3}


def test_coerce_amounts_like_to_numeric(spark):
    texts = ["1", "2.50", "abc", "", None, "1,000", " 7 ", "1e2", "-3"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, Amount string")
    got = [r["Amount"] for r in ex.coerce_amounts(df, CARD).orderBy("i").collect()]
    want = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce")
    assert got == [None if pd.isna(x) else x for x in want]


def test_mixed_types(spark):
    other = StatementType(name="other", dynamic_fields=(FieldSpec("Fee", True),), summary_fields=(FieldSpec("Label"),))
    first = results(spark, DOCUMENTS).withColumn("statement_type", F.lit("card"))
    second = results(spark, [{"fields": {}, "transactions": [item(Fee="3")]}], "b.pdf").withColumn("statement_type", F.lit("other"))
    done = process_mixed(first.unionByName(second), [CARD, other]).transactions
    row = done.where("OriginalFileName = 'b.pdf'").first()
    assert (row["Fee"], row["Amount"], row["Account"], row["ConversionSuccess"]) == (3.0, None, None, True)
    assert done.count() == 4


def test_raw_text(spark, rows):
    pages = [{"page_no": 0, "lines": [{"content": "a"}, {"content": "b"}]}, {"page_no": 1, "lines": []}, {"page_no": 2, "lines": [{"content": "c"}]}]
    assert rows(ex.raw_text(results(spark, [], pages=pages)), "Document Name", "Extracted Text") == [("a.pdf", "a\nb\nc")]
    assert ex.raw_text(results(spark, None)).count() == 0


def rows_of(cells):
    """Row index and contents of every row, in stable column order."""
    by_row = {}
    for cell in cells:
        by_row.setdefault(cell["row_index"], []).append(cell)
    return [
        (index, [c["content"] for c in sorted(row, key=itemgetter("column_index"))]) for index, row in by_row.items()
    ]


def test_table_rows_against_loop(spark):
    random.seed(4)
    tables = []
    for _ in range(40):
        cells = [{"row_index": random.randrange(5), "column_index": random.randrange(4), "content": random.choice("abcdef")} for _ in range(random.randrange(0, 15))]
        tables.append({"cells": cells})
    got = {}
    for r in ex.table_rows(results(spark, [], tables=tables)).collect():
        got.setdefault(r["table_idx"], []).append((r["row_index"], r["contents"]))
    for n, table in enumerate(tables):
        assert sorted(got.get(n, [])) == sorted(rows_of(table["cells"]))


def test_sign_mode(spark):
    documents = [{"fields": {}, "transactions": [item(Amount="-12.50")]}]
    default = ex.transactions(results(spark, documents), CARD).first()["Amount"]
    corrected = ex.transactions(results(spark, documents), CARD, "corrected").first()["Amount"]
    assert (default, corrected) == (12.5, -12.5)


def test_summary_needs_fields(spark):
    with pytest.raises(ValueError):
        ex.summary_fields(results(spark, DOCUMENTS), StatementType(name="none"))
