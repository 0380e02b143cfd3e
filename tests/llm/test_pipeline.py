"""Every stage against its definition, on its own input."""

from collections import Counter

import pytest

import corpus_pipeline as pipeline
from foliospark.llm.common import table
from test_signature_join import brute

SMALL = "/root/testdata/sf0.001"


def test_stages_and_columns(spark):
    docs = table(spark, SMALL, "documents")
    frames = [docs]
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SMALL).persist()
        frames.append(docs)
    assert all(f.columns == pipeline.COLUMNS for f in frames[1:-1])
    ids = [Counter(r["doc_id"] for r in f.select("doc_id").collect()) for f in frames]
    assert ids[1] <= ids[0] and ids[2] <= ids[1] and ids[3] <= ids[2]
    texts = {r["doc_id"]: r["text"] for r in frames[2].select("doc_id", "text").collect()}
    groups = brute(sorted(texts.items()), 5, 80, 100)
    assert set(ids[3]) == {d for d, _, first in groups if d == first}
    assert set(ids[4]) <= set(ids[3]) and max(ids[4].values()) <= 3 and ids[5] == ids[4]
    assert all(r["round_trip"] for r in frames[-1].collect())


def test_a_task_has_one_python_worker(spark):
    """Workers of two Python steps in one task live on beside each other, in the stages that follow too."""
    docs = table(spark, SMALL, "documents")
    for name, stage in pipeline.STAGES:
        plan = stage(spark, docs, SMALL)._jdf.queryExecution().executedPlan().toString()
        python = [line for line in plan.split("\n") if "MapInArrow" in line or "Exchange" in line or "Scan" in line]
        assert not any("MapInArrow" in a and "MapInArrow" in b for a, b in zip(python, python[1:])), name


def test_odd_documents(spark, odd, nothing):
    for name, stage in pipeline.STAGES:
        assert stage(spark, odd, SMALL).count() >= 0, name
        assert stage(spark, nothing, SMALL).count() == 0, name


def test_run_is_registered():
    entry = pytest.importorskip("__spark_entry__")
    assert entry.queries()["pipeline"] is pipeline.run
    assert all(any(q.startswith(f"op{n}_") for q in entry.queries()) for n in range(1, 11))


def test_near_duplicates_decides_by_rows(spark, documents):
    first, second, third = (" ".join(f"{w}{i}" for i in range(60)) for w in "abc")
    rows = [(1, first), (1, first), (2, first + " end"), (5, second), (5, third + " x"), (5, second), (4, second + " y"), (9, third), (7, first + " z"), (7, "a text of its own with words"), (None, first), (None, "no id but a text of its own"), (None, "no id but a text of its own"), (6, None), (6, None), (8, "")]
    found = pipeline.near_duplicates(spark, documents([(d, t, "en", "a") for d, t in rows]), SMALL).collect()
    kept = Counter((r["doc_id"], r["text"]) for r in found)
    assert kept == Counter([(1, first), (4, second + " y"), (5, third + " x"), (7, "a text of its own with words"), (None, "no id but a text of its own"), (6, None), (8, "")])
