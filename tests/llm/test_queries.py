"""Queries that SQL can express, against it; the others against the libraries on their whole small table."""

import hashlib

import duckdb
import pytest

from foliospark.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = connection.sql(ORACLE[name])
    found = QUERIES[name](spark, SMALL).select(*want.columns)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_ids_and_texts_of_whole_documents(spark):
    P, tiktoken = pytest.importorskip("public_tokenizers"), pytest.importorskip("tiktoken")
    from foliospark.llm.bpe_tree import load_ranks

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    for r in QUERIES["op2_bpe_tree"](spark, SMALL).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]] or "")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
