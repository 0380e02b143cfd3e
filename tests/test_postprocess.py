import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from foliospark import schemas
from foliospark.operators import counts
from foliospark.operators import postprocess as pp
from foliospark.plans import tasks


@pytest.mark.parametrize("width", [1, 4, 65536])
def test_fill_missing_dates_like_pandas(spark, width):
    random.seed(width)
    data, number = [], {}
    for _ in range(600):
        name = random.choice(["a", "a", "a", "a", "b", "c", None])
        number[name] = number.get(name, -1) + random.randrange(1, 3)
        data.append((name, number[name], random.choice([None, None, "01 Jan", "02 Jan"]), random.random()))
    frame = pd.DataFrame(data, columns=["OriginalFileName", "row_no", "Date", "Amount"])
    frame["want"] = frame.groupby("OriginalFileName")["Date"].transform(lambda g: g.ffill())
    want = {(r.OriginalFileName, r.row_no): None if pd.isna(r.want) else r.want for r in frame.itertuples()}
    random.shuffle(data)
    df = spark.createDataFrame(data, "OriginalFileName string, row_no long, Date string, Amount double")
    got = pp.fill_missing_dates(df, width=width)
    assert got.columns == ["OriginalFileName", "row_no", "Date", "Date_Processed", "Amount"]
    assert {(r["OriginalFileName"], r["row_no"]): r["Date_Processed"] for r in got.collect()} == want


def span(name, text, page=0, line=0, y1=10.0, folder="d"):
    return (folder, name, page, 0, line, 0, text, 0.0, y1 - 9, 50.0, y1, 100.0, 0)


def spans_df(spark, data):
    return spark.createDataFrame(data, schemas.SPANS)


def manifest(df):
    columns = ["file_name", "action", "target_folder", "target_name", "detail"]
    return [tuple(r) for r in df.orderBy("folder", "file_name").select(*columns).collect()]


def test_categorise(spark):
    data = [span("a.pdf", "Acc 44-0001"), span("b.pdf", "none"), span("c.pdf", "low 44-0002", y1=90.0)]
    got = pp.categorise_by_value(spans_df(spark, data), "Account: Number", "44-1234")
    assert manifest(got) == [
        ("a.pdf", "move", "d/AccountNumber-44-0001", "AccountNumber-44-0001-a.pdf", "44-0001"),
        ("b.pdf", "none", "d", "b.pdf", None),
        ("c.pdf", "none", "d", "c.pdf", None),
    ]
    assert [tuple(r) for r in pp.category_sizes(got).collect()] == [("d", "d/AccountNumber-44-0001", 1)]


def test_date_prefix(spark):
    data = [span("a.pdf", "from 02-FEB-2024"), span("b.pdf", "from 31-FEB-2024"), span("c.pdf", "low 03-MAR-2024", y1=90.0), span("d.pdf", "")]
    got = pp.date_prefix(spans_df(spark, data), "02-FEB-2024")
    assert manifest(got) == [
        ("a.pdf", "rename", "d", "20240202-a.pdf", "02-FEB-2024"),
        ("b.pdf", "error", "d", "b.pdf", "31-FEB-2024"),
        ("c.pdf", "rename", "d", "20240303-c.pdf", "03-MAR-2024"),
        ("d.pdf", "none", "d", "d.pdf", None),
    ]


def test_duplicates(spark):
    header = "44-1111 Statement no. 12 from 12 NOV 2023"
    data = [span("b.pdf", header), span("a.pdf", header), span("c.pdf", header), span("z.pdf", "nothing"), span("y.pdf", "nothing")]
    data += [span("b.pdf", header, folder="e"), span("x.pdf", "44-1111", folder="e")]
    got = pp.identify_duplicates(spans_df(spark, data), "44-1234", "Statement no. 12", "12 NOV 2023")
    identifier = "44-11111212 NOV 2023"
    assert manifest(got) == [
        ("a.pdf", "none", "d", "a.pdf", identifier),
        ("b.pdf", "move", "d/duplicate", "b.pdf", identifier),
        ("c.pdf", "move", "d/duplicate", "c.pdf", identifier),
        ("y.pdf", "none", "d", "y.pdf", None),
        ("z.pdf", "none", "d", "z.pdf", None),
        ("b.pdf", "none", "e", "b.pdf", identifier),
        ("x.pdf", "none", "e", "x.pdf", "44-1111"),
    ]
    assert pp.duplicate_count(got).first()[0] == 2


def test_identifier_separator(spark):
    pair = spark.createDataFrame([("12", "3", None), ("1", "23", None), ("", None, "")], "a string, s string, d string")
    plain = pp.combined_identifier(F.col("a"), F.col("s"), F.col("d"))
    apart = pp.combined_identifier(F.col("a"), F.col("s"), F.col("d"), "|")
    assert [tuple(r) for r in pair.select(plain, apart).collect()] == [("123", "12|3"), ("123", "1|23"), (None, None)]


def test_document_tasks_see_earlier_names(spark):
    header = "44-1111 Statement no. 12 from 12 NOV 2023"
    data = [span("a.pdf", header), span("b.pdf", header)]
    wanted = tasks.DocumentExamples("Account", "44-1234", "44-1234", "Statement no. 12", "12 NOV 2023")
    steps = ["categorise_by_value", "unknown", "add_date_prefix_to_filenames", "identify_and_move_duplicates"]
    got = tasks.run_document_tasks(spans_df(spark, data), steps, wanted).orderBy("file_name", "step")
    named = "Account-44-1111-b.pdf"
    assert [(r["step"], r["action"], r["target_folder"], r["target_name"]) for r in got.collect() if r["file_name"] == "b.pdf"] == [
        (0, "move", "d/Account-44-1111", named),
        (1, "rename", "d/Account-44-1111", f"20231112-{named}"),
        (2, "move", "d/duplicate", f"20231112-{named}"),
    ]


def test_task_lists(spark):
    df = spark.createDataFrame([("a", 0, None), ("a", 1, "x")], "OriginalFileName string, row_no long, Date string")
    with pytest.raises(ValueError):
        tasks.run_table_tasks(df, [])
    assert tasks.run_table_tasks(df, ["nope"]).columns == df.columns
    assert "Date_Processed" in tasks.run_table_tasks(df, ["fill_missing_dates"]).columns
    nothing = tasks.run_document_tasks(spans_df(spark, [span("a.pdf", "x")]), ["nope"], tasks.DocumentExamples())
    assert nothing.count() == 0


def test_counts(spark, rows):
    files = spark.createDataFrame([("x", "a"), ("x", "b"), ("y", "c")], "folder string, file_name string")
    pages = spark.createDataFrame([("x", "a"), ("x", "a"), ("y", "c")], "folder string, file_name string")
    detail = counts.pages_per_document(files, pages)
    assert rows(detail) == [("x", "a", 2), ("x", "b", 0), ("y", "c", 1)]
    assert rows(counts.folder_summary(detail, ["x", "y", "z"])) == [("Total", 3, 3), ("x", 2, 2), ("y", 1, 1), ("z", 0, 0)]
    assert rows(counts.folder_summary(detail, "x")) == [("Total", 2, 2), ("x", 2, 2)]
    assert rows(counts.folder_summary(detail)) == [("Total", 3, 3), ("x", 2, 2), ("y", 1, 1)]
    assert counts.reconcile(detail, detail.where("folder = 'x'")).first().asDict() == {
        "pre_files": 3, "pre_pages": 3, "post_files": 2, "post_pages": 2, "file_diff": -1, "page_diff": -1,
    }
    empty = counts.folder_summary(detail.where("false"), ["x"])
    assert rows(empty) == [("Total", 0, 0), ("x", 0, 0)]


def plain_fill(rows):
    filled, last = {}, {}
    for name, position, value in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        if value is not None:
            last[name] = value
        filled[(name, position)] = last.get(name) if name is not None else None
    return filled


def test_carries_of_sparse_positions(spark):
    """Global ids: a file's rows are far apart, most files are short, one holds a third of all rows, a sixth have no name."""
    from foliospark.operators import chunks

    rnd = random.Random(1)
    names = [rnd.choice(["long"] * 2 + [None] + [f"f{rnd.randrange(400)}"] * 3) for _ in range(6000)]
    rows = [(name, 10**12 + i * 70001, str(i) if rnd.random() < 0.05 else None) for i, name in enumerate(names)]
    frame = spark.createDataFrame(rows, "OriginalFileName string, row_no long, v string").repartition(5)
    made = []
    carry_of = chunks.range_carry
    chunks.range_carry = lambda *args: made.append(carry_of(*args)) or made[-1]
    try:
        found = chunks.last_known(frame, ["OriginalFileName"], "row_no", F.col("v"), "filled", width=100)
    finally:
        chunks.range_carry = carry_of
    assert {(r["OriginalFileName"], r["row_no"]): r["filled"] for r in found.collect()} == plain_fill(rows)
    assert found.columns == ["OriginalFileName", "row_no", "v", "filled"]
    [carry] = made
    assert 0 < carry.count() <= 60  # ranges of 100 rows
    sizes = carry_of.__globals__["range_bounds"](frame, ["OriginalFileName"], "row_no", 100).collect()
    assert sum(len(r["_bounds"]) for r in sizes) <= 60 and any(r["OriginalFileName_of_bound"] is None for r in sizes)


def test_short_tables_are_not_cut(spark):
    from foliospark.operators import chunks

    frame = spark.createDataFrame([("a", 5, "x"), ("a", 10**15, None), (None, 1, "y")], "k string, p long, v string")
    found = {r["p"]: r["o"] for r in chunks.last_known(frame, ["k"], "p", F.col("v"), "o").collect()}
    assert found == {5: "x", 10**15: "x", 1: None}
    empty = chunks.last_known(frame.limit(0), ["k"], "p", F.col("v"), "o")
    assert empty.collect() == []
