"""What must not grow with the tables beyond need: stored bytes, shuffles of nested results, tasks that list files."""

import os

from pyspark.sql import functions as F

from catalogue import fixtures as fx
from catalogue.queries import QUERIES, analysis_documents, new_folder
from foliospark import schemas
from foliospark.functions import amounts
from foliospark.operators import extract
from foliospark.session import LISTING_SETTING
from foliospark.sinks import writers
from foliospark.sources import readers
from foliospark.streaming import incremental

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def bytes_below(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)


def test_results_are_stored_compressed(spark, monkeypatch, tmp_path):
    """F1"""
    monkeypatch.setattr("catalogue.queries.new_folder", lambda spark, kind: str(tmp_path / kind))
    analysis_documents(spark, SF).count()
    plain = fx.results(spark, SF).select(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0]
    assert bytes_below(tmp_path) < plain / 5


def test_nested_results_are_neither_held_nor_shuffled(spark, monkeypatch):
    """a batch without repeated files is read, extracted and written."""
    held = []
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.persist", lambda df, *_: held.append(df.columns) or df)
    first, _ = fx.deliveries(spark, SF)
    assert "Join" not in plan_of(incremental._one_version(first))
    incremental.extract_batch(first, fx.CARD, new_folder(spark, "batch"), 0)
    assert not [columns for columns in held if "documents" in columns]


def test_best_of_several_objects(spark):
    """of a file in several objects the usable one stays, then the newest; others stay as they are."""
    rows = [("f", "a", None, "s1", 2), ("f", "a", [], "s2", 1), ("f", "b", [], "s1", 1), ("f", "b", [], "s2", 2), ("f", "c", None, "s3", 1), (None, "c", None, None, 1)]
    given = spark.createDataFrame(rows, "folder string, file_name string, documents array<int>, source string, day int")
    given = given.withColumn("version", F.timestamp_seconds("day")).drop("day")
    kept = incremental._one_version(schemas.with_known(given, *schemas.FILE_KEY))
    assert sorted((r.folder, r.file_name, r.source) for r in kept.collect()) == [("", "c", None), ("f", "a", "s2"), ("f", "b", "s2"), ("f", "c", "s3")]


def test_one_object_each_is_written_and_listed_in_few_tasks(spark, tmp_path):
    """writing is spread though one task reads the rows; listing takes a few tasks for each core."""
    rows = spark.range(0, 200, 1, 1).select("id", F.lit("x").alias("folder"))
    writers.write_named_objects(rows, str(tmp_path), F.concat(F.lit("f"), "id"))
    tasks = {f.split("-")[1] for _, _, files in os.walk(tmp_path) for f in files if f.startswith("part-")}
    assert len(tasks) > 4
    tracker, before = spark.sparkContext.statusTracker(), spark.conf.get(LISTING_SETTING)
    spark.sparkContext.setJobGroup("listing", "")
    good, bad = readers.read_named_objects(spark, str(tmp_path), "id long")
    listed = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setJobGroup("", "")
    assert listed and max(listed) <= spark.sparkContext.defaultParallelism * 4
    assert spark.conf.get(LISTING_SETTING) == before
    assert (good.count(), bad.count(), readers.read_file_inventory(spark, f"{tmp_path}/*", suffix="txt").count()) == (200, 0, 200)


def test_only_the_wanted_part_of_documents_is_made(spark):
    """summaries make no transactions. F9, F12: transactions and totals make no fields."""
    results = fx.results(spark, SF)
    for df in (extract.summary_table(results, fx.CARD), extract.summary_fields(results, fx.CARD)):
        assert "NotConfigured" not in plan_of(df)
    for df in (extract.transactions(results, fx.CARD), extract.extraction_totals(results)):
        assert "StatementNumber" not in plan_of(df)


def test_amounts_of_lines_and_scripts(spark):
    """names are made once a line, before its amounts. F13, F16: ASCII text is read by a plain pattern, with the same numbers."""
    plan = plan_of(QUERIES["convert_amount"](spark, SF))
    assert "item_" in plan.split("Generate explode")[1] and "item_" not in plan.split("Generate explode")[0]
    texts = [("$1,234.50",), ("-٣٫٥ ٤٢",), ("é 12.5-",), ("n/a",), ("",), (None,)]
    read = spark.createDataFrame(texts, "t string").select(amounts.amount_value(F.col("t")), amounts.amount_ok(F.col("t")))
    assert [tuple(r) for r in read.collect()] == [(1234.5, True), (3.0, True), (-12.5, True), (None, False), (None, True), (None, True)]
    assert "[\\d,]*\\.?\\d+, 0) ELSE regexp_extract" in plan_of(spark.range(1).select(amounts.amount_value(F.col("id").cast("string"))))


def test_tables_are_made_once(spark, rows):
    """cells aren't made a second time to see whether there are tables; results without any have no rows."""
    assert plan_of(extract.table_rows(fx.table_results(spark, SF))).count("flatten(") == 1
    cell = "struct<row_index:int,column_index:int,content:string>"
    given = [("f", "none", None), ("f", "empty", []), ("f", "one", [(None,), ([],), ([(1, 2, "c"), (1, 0, "a"), (0, 5, None)],)])]
    results = spark.createDataFrame(given, f"folder string, file_name string, tables array<struct<cells:array<{cell}>>>")
    assert rows(extract.table_rows(results)) == [("f", "one", 2, 0, [None]), ("f", "one", 2, 1, ["a", "c"])]
