"""Fill-in-middle against a plain reading of its rules."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foliospark.llm import fill_in_middle as fim
from pyspark.sql import functions as F


def plainly(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(text), "plain", None, None, text
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return len(text), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return len(text), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@given(st.lists(st.tuples(st.text(max_size=30), st.integers(0, 30), st.integers(0, 30)), max_size=8), st.integers(1, 40))
@settings(max_examples=200, deadline=None)
def test_pieces_for_every_size_of_block(rows, block):
    rows = [(t.encode("utf-8", "ignore").decode(), min(a, b), max(a, b)) for t, a, b in rows]
    texts = pa.array([t for t, _, _ in rows], pa.string())
    first, second = (np.array([r[i] for r in rows], np.int64) for i in (1, 2))
    found = [piece.to_pylist() for piece in fim.cut(texts, first, second, block)]
    assert list(zip(*found)) == [(t[:a], t[a:b], t[b:]) for t, a, b in rows]


def test_slice_of_a_batch():
    texts = pa.array(["zero", "één", "", "twee"]).slice(1)
    found = fim.cut(texts, np.array([1, 0, 2]), np.array([2, 0, 2]))
    assert [p.to_pylist() for p in found] == [["é", "", "tw"], ["é", "", ""], ["n", "", "ee"]]


def test_odd_rows_and_clashing_columns(odd):
    docs = odd.withColumns({"n": F.lit("clash"), "form": F.lit("clash"), "output": F.lit("clash"), "_text2": F.lit("kept")})
    done = fim.transform(docs, block=1000).withColumn("restored", fim.restore(F.col("output"), F.col("form")))
    found = done.select("doc_id", "text", *fim.RESULTS, "restored", "keep", "_text2").collect()
    assert len(found) == odd.count()
    for r in found:
        assert tuple(r[2:7]) == plainly(r["doc_id"], r["text"])
        assert r["restored"] == (r["text"] or "") and r["keep"] == "k" and r["_text2"] == "kept"


def test_markers_and_near_markers(documents):
    texts = ["<P>", "a<S>b", "<M", "<S", "S>", "<<P", "M>" * 9, "<P" * 9, ">" * 5, "𝄞<é>" * 7]
    rows = [(i, texts[i % len(texts)], "en", "a") for i in range(200)]
    done = fim.transform(documents(rows)).withColumn("restored", fim.restore(F.col("output"), F.col("form")))
    found = done.collect()
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    assert all((r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plainly(r["doc_id"], r["text"]) for r in found)
    assert all(r["restored"] == r["text"] for r in found)


def test_rates(documents):
    rows = [(i, "some text", "en", "a") for i in range(50)]
    assert {r["form"] for r in fim.transform(documents(rows), rate=0).collect()} == {"plain"}
    assert {r["form"] for r in fim.transform(documents(rows), rate=100, spm_rate=100).collect()} == {"spm"}


def test_empty_table(nothing):
    assert fim.transform(nothing).collect() == []
