"""The shape of physical plans: what is read, shuffled and joined."""

import re

import pytest

from catalogue import fixtures as fx
from catalogue.queries import QUERIES
from foliospark import schemas
from foliospark.operators import page_text, split
from foliospark.plans.preprocess import preprocess
from foliospark.plans.process import process_mixed, process_statements
from foliospark.sources import readers

SF_DIR = "/root/testdata/sf0.001"


def executed(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.fixture
def stored_pages(spark, tmp_path):
    fx.pages(spark, SF_DIR).repartition(2).write.parquet(str(tmp_path / "pages"))
    return readers.read_pages(spark, str(tmp_path / "pages"))


@pytest.fixture
def checkpoints(spark, tmp_path, monkeypatch):
    """What is materialised, in checkpoints as on a cluster."""
    spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))
    made = []
    monkeypatch.setattr(page_text, "settle", lambda df: made.append(df) or df.checkpoint())
    return made


def text_scans(plan):
    return [line for line in plan.splitlines() if "FileScan" in line and re.search(r"ReadSchema: struct<.*\btext:string", line)]


@pytest.mark.parametrize("rule", [fx.PAGE_RULE, fx.RANGE_RULE], ids=lambda r: r.name)
def test_splitting_reads_the_text_once(stored_pages, rule, checkpoints):
    done = split.split_documents(stored_pages, rule, width=2)
    outputs = [done.statements, done.assignments, done.manual, done.events]
    [materialised] = checkpoints
    plan = materialised._jdf.queryExecution().executedPlan().toString()
    assert len(text_scans(plan)) == 1 and plan.count("FileScan") == 1
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
    assert all("FileScan" not in executed(output) for output in outputs)
    assert {name for name, kind in materialised.dtypes if kind == "string"} == {"folder", "file_name"}


def test_a_whole_run_reads_the_text_once(spark, stored_pages, checkpoints):
    files = stored_pages.select("folder", "file_name").distinct()
    done = preprocess(files, stored_pages, fx.RANGE_RULE)
    assert len(checkpoints) == 1
    for output in (done.split.statements, done.split.assignments, done.split.manual, done.after, done.differences, done.coverage):
        assert not text_scans(executed(output))


def test_extraction_does_not_shuffle_and_prunes_nested_columns(spark, tmp_path):
    fx.results(spark, SF_DIR).write.parquet(str(tmp_path / "results"))
    results = readers.read_analysis_results(spark, str(tmp_path / "results"), fmt="parquet")
    done = process_statements(results, fx.CARD)
    for table in (done.transactions, done.summary):
        plan = executed(table)
        assert "Exchange" not in plan and "Python" not in plan
        assert "PushedFilters: [IsNotNull(documents)]" in plan
    summary_scan = re.search(r"ReadSchema: (.*)", executed(done.summary)).group(1)
    assert "transactions" not in summary_scan and "tables" not in summary_scan


def test_four_statement_types_are_read_once(spark, tmp_path):
    fx.typed_results(spark, SF_DIR).write.parquet(str(tmp_path / "results"))
    done = process_mixed(spark.read.parquet(str(tmp_path / "results")), fx.MIXED_TYPES)
    for table in (done.transactions, done.summary, done.failed, done.unmatched):
        plan = executed(table)
        assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Union" not in plan
    with pytest.raises(ValueError, match="different names"):
        process_mixed(done.failed, [fx.CARD, fx.CARD])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_everything(spark, name):
    if name in ("process_incremental", "incremental_retry", "analysis_documents", "named_objects", "file_inventory", "unsplit_manifest_of_runs", "raw_text_written", "tables_written"):
        pytest.skip("runs when it is built")
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    # reconcile puts two one-row totals side by side.
    assert "NestedLoop" not in plan or name == "reconcile"


def test_schemas_parse(spark):
    for schema in (schemas.FILES, schemas.PAGES, schemas.SPANS, schemas.ANALYSIS, schemas.STATEMENT_TYPES):
        assert spark.createDataFrame([], schema).count() == 0
