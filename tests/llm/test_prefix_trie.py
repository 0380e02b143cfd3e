"""The trie against a plain one, built in a dictionary."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm import prefix_trie
from foliospark.llm.common import table
from foliospark.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, depth string, x1 string, shared string"


@pytest.fixture
def conversations(spark):
    def make(rows):
        table(spark, "/root/testdata/sf0.001", "documents")
        return spark.createDataFrame([(*r, "d", "x", "s") for r in rows], SCHEMA).repartition(3)

    return make


def plainly(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(found)] for c, found in turns.items()}
    members = defaultdict(list)
    for c, found in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c - (abs(c) % 100) * (1 if c >= 0 else -1))
        path = tuple(own.get(base, [])[:h] + found[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, len(path)))
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, found in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(found) - 1) * (len(path[-1][1]) if path else 0)
    result = []
    for path, found in members.items():
        ids = ",".join(str(c) for c, n in sorted(found) if n == len(path))
        parent = min(members[path[:-1]])[0] if path else None
        result.append((min(found)[0], len(path), parent, len(found), children[path], leaves[path], saved[path], hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(result, key=repr)


def found(df):
    return sorted(map(tuple, df.select(prefix_trie.RESULTS).collect()), key=repr)


def made(seed, convs=60, turns=9):
    rnd = random.Random(seed)
    rows = []
    for _ in range(convs):
        conv = rnd.choice([rnd.randrange(-250, 450), 100 * rnd.randrange(4)])
        for turn in range(rnd.randrange(turns)):
            rows.append((conv, rnd.choice([turn, turn, turn, None]), rnd.choice(["user", "assistant", None, ""]), rnd.choice(["a", "bé", "ccc", None])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_like_a_plain_trie(conversations, seed):
    rows = made(seed)
    assert found(prefix_trie.trie(conversations(rows))) == plainly(rows)


def test_full_sketch_changes_nothing(conversations):
    rows = made(3) + [(900, i, "user", f"turn {i}") for i in range(40)]
    assert found(prefix_trie.trie(conversations(rows), least_bits=2, most_bits=3)) == plainly(rows)


def test_copies_and_one_long_conversation(conversations, monkeypatch):
    monkeypatch.setattr(prefix_trie, "HEAVY", 20)
    same = [(c, t, "user", f"common {t}") for c in range(1000, 1040) for t in range(4)]
    long_one = [(7, i, "user", f"turn {i // 2}") for i in range(1500)] + [(8, i, "user", f"turn {i // 2}") for i in range(1400)]
    rows = same + long_one + [(None, 0, "user", "nobody"), (107, 0, "user", "x"), (300, 0, None, None)]
    assert found(prefix_trie.trie(conversations(rows))) == plainly(rows)


def test_one_conversation(conversations):
    rows = [(5, 0, "user", "alone"), (5, 1, "user", "still")]
    assert found(prefix_trie.trie(conversations(rows))) == plainly(rows)


def test_empty_tables(conversations):
    assert found(prefix_trie.trie(conversations([]))) == []
    assert found(prefix_trie.trie(conversations([(None, 0, "user", "nobody")]))) == []


def test_ends_in_small_pieces(spark, conversations):
    conversations([])
    rows = spark.createDataFrame([(k, -k, c) for k in (1, 2) for c in range(-50, 500)], "x1 long, x2 long, conv_id long")
    want = hashlib.sha256(",".join(map(str, range(-50, 500))).encode()).hexdigest()
    assert [r["ends_sha256"] for r in prefix_trie.ends(rows, piece_chars=20).collect()] == [want, want]


def test_screening_keeps_all_that_is_shared(spark, conversations):
    rows = prefix_trie.prefixes(conversations(made(4) + [(c, t, "user", f"own {c} {t}") for c in range(500, 600) for t in range(8)]))
    flags = prefix_trie.screened(rows)
    counts = flags.groupBy("x1", "x2").agg(F.count("*").alias("n"), F.min("shared").alias("shared")).collect()
    assert all(r["shared"] for r in counts if r["n"] > 1)
    assert np.mean([r["shared"] for r in counts if r["n"] == 1]) < 0.01  # the tails stay where they are


def test_query(spark):
    path = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{path}/conversations.parquet'").fetchall()
    assert found(QUERIES["op13_prefix_trie"](spark, path)) == plainly(rows)
