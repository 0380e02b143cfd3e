"""Line dedup against a plain reading of its rules."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from foliospark.llm import line_runs
from odd_rows import ODD

LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plainly(rows, min_docs=3, min_chars=20):
    held = defaultdict(list)

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    for row in rows:
        for k in {key(line) for line in (row[1] or "").split("\n")}:
            held[k].append(row[0])
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in held.items() if len(ids) >= min_docs and len(k) >= min_chars}
    result = []
    for row in rows:
        lines = (row[1] or "").split("\n")
        kept = [line for line in lines if key(line) not in last or last[key(line)] == row[0]]
        result.append((row[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(result, key=repr)


def found(df):
    return sorted(map(tuple, df.select("doc_id", *line_runs.RESULTS).collect()), key=repr)


SHARED = ["The licence of this text is the common one.", "  the LICENCE of this text is the common one.\r", "Ünd Straße über Öl und mehr davon ÀÉ", "short one", "exactly twenty chars"]


def made(seed, count):
    rnd = random.Random(seed)
    pool = SHARED + [f"line number {i} of the pool, long enough" for i in range(30)] + ["", "  ", "x" * 19, "ünd straße über öl und mehr davon àé"]
    return [(rnd.randrange(count) if rnd.random() < 0.9 else None, "\n".join(rnd.choices(pool, k=rnd.randrange(9))), "en", "a") for _ in range(count)]


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_like_a_plain_reading(documents, batches):
    rows = made(batches, 120)
    assert found(line_runs.dedupe(documents(rows), batches=batches)) == plainly(rows)


def test_odd_rows_and_clashing_columns(documents):
    rows = ODD + [(20 + i, "a line that is long enough to count\n" * 300 + f"own {i}", "en", "a") for i in range(4)]
    docs = documents(rows).withColumns({"n_lines": F.lit("clash"), "kept": F.lit("clash"), "lines": F.lit("l")})
    done = line_runs.dedupe(docs)
    assert found(done) == plainly(rows)
    assert {r["lines"] for r in done.select("lines").collect()} == {"l"} and "text" not in done.columns


def test_light_keys_alone(documents, monkeypatch):
    monkeypatch.setattr(line_runs, "HEAVY", 1)  # no key holds all lines, so none is broadcast
    rows = made(7, 90)
    assert found(line_runs.dedupe(documents(rows))) == plainly(rows)


def test_min_docs(documents):
    rows = made(3, 60)
    assert found(line_runs.dedupe(documents(rows), min_docs=2, min_chars=5)) == plainly(rows, 2, 5)


def test_empty_table(nothing):
    assert line_runs.dedupe(nothing).collect() == []


def test_runs_are_levelled_and_joined_without_a_shuffle(spark, documents):
    lines = line_runs.hashed_lines(documents(made(5, 80)), "text", "doc_id", 4, 20)
    runs = line_runs.LineRuns(spark, min_docs=3)
    levels = []
    for number in range(4):
        runs.add(lines.where(F.col("_batch") == number))
        levels.append([len(level) for level in runs.levels])
    assert levels == [[1], [0, 1], [1, 1], [0, 0, 1]]
    runs.add(lines)
    plan = runs.merged(*runs.names())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert runs.keepers().count() > 0 and len(runs.names()) == 1


def test_settled_keys_are_not_recorded_again(spark, documents):
    rows = [(100 + i, "a line that is long enough to count", "en", "a") for i in range(5)] + [(i, "a line that is long enough to count\nanother line of this kind", "en", "a") for i in range(2)]
    lines = line_runs.hashed_lines(documents(rows), "text", "doc_id", 1, 20)
    runs = line_runs.LineRuns(spark, min_docs=3)
    runs.add(lines.where("_id >= 100"))
    runs.add(lines.where("_id < 100"))
    run = spark.table(runs.names()[0]).select("_docs", "_last").collect()  # of both batches
    assert sorted(map(tuple, run)) == [(2, 1), (5, 104)]
