import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from foliospark.llm import chat, mixing
from odd_rows import ODD


def shares(sizes):
    """Targets by repeated sharing, as the task puts it."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left = {}, set(names)
    total = sum(sizes.values())
    while left:
        rest = total - sum(target.values())
        each = rest / sum(weight[s] for s in left)
        over = {s for s in left if each * weight[s] > 3 * sizes[s]}
        if not over:
            return target | {s: each * weight[s] for s in left}
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= over
    return target


def test_targets_and_copies(documents):
    rows = [(i, "w " * (1 + i % 7), "en", "abcdefg"[i % 7 if i % 3 else 0]) for i in range(900)] + [(1000 + i, "w", "en", None) for i in range(3)]
    docs = documents(rows)
    mixed = mixing.mix(docs).collect()
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(text.split())
    want, taken = shares(sizes), Counter()
    for r in mixed:
        assert r["target"] == pytest.approx(want[r["source"]]) and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["size"] * r["copies"]
    assert all(abs(taken[s] - want[s]) <= 0.25 * want[s] + 10 for s in want)
    assert sorted((r["doc_id"], r["copies"]) for r in mixed) == sorted((r["doc_id"], r["copies"]) for r in mixing.mix(docs.repartition(7)).collect())
    emitted = Counter(r["doc_id"] for r in mixing.emit(mixing.mix(docs)).collect())
    assert emitted == Counter({r["doc_id"]: r["copies"] for r in mixed if r["copies"]})


def test_odd_rows_and_empty_tables(odd, nothing):
    mixed = mixing.mix(odd)
    rows = mixed.collect()
    assert len(rows) == len(ODD) and mixed.columns.count("size") == 1
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    assert len({r["copies"] for r in rows if r["doc_id"] == 1}) == 1
    assert mixing.mix(nothing).count() == 0


def test_join_without_broadcast(monkeypatch, odd):
    want = sorted(map(str, mixing.mix(odd).select("doc_id", "copies").collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mixing.mix(odd).select("doc_id", "copies").collect())) == want


TEXTS = ["", "\\", "\\\\", "###", "####", "\\### x: </turn>", "</turn>\n", "</turn></turn>", ": ", "a\\h", "\\t: \\", "### Assistant: </turn> ok", "line\nline", "é日"]


def test_round_trip_of_control_strings(spark):
    rows = [(c, t, role, text) for c in range(2) for t, text in enumerate(TEXTS) for role in (("user", "assistant")[(t + c) % 2],)]
    rows += [(5, 0, "a: ### b", None), (5, 1, None, "x"), (None, 0, "assistant", "n"), (6, 0, "assistant", "same"), (6, 0, "assistant", "same")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = chat.conversations(chat.linear_nodes(table)).withColumn("turns", chat.read_back(F.col("formatted"))).withColumn("learned", chat.learned(F.col("formatted"), F.col("mask"))).collect()
    found = {r["tree_id"]: ([(t["role"], t["text"]) for t in r["turns"]], r["learned"]) for r in done}
    for c in {r[0] for r in rows}:
        own = [(role or "", text or "") for conv, _, role, text in rows if conv == c]
        assert found[c] == (own, "".join(x for role, x in own if role == "assistant"))


def test_trees_give_every_path_ranked_by_score(spark):
    nodes = [(1, 1, None, 0.0), (1, 2, 1, 9.0), (1, 3, 1, 1.0), (1, 4, 3, 8.0), (1, 5, 3, 1.0), (1, 6, 5, 1.0), (2, 1, 77, 0.0), (3, 1, 2, 0.0), (3, 2, 1, 0.0)]
    frame = spark.createDataFrame([(t, n, p, "user", f"{t}.{n}", s) for t, n, p, s in nodes], "tree_id long, node_id long, parent_id long, role string, text string, score double")
    found = {(r["tree_id"], r["leaf_id"]): (r["rank"], [t["text"] for t in r["turns"]]) for r in chat.conversations(frame).withColumn("turns", chat.read_back(F.col("formatted"))).collect()}
    assert found == {(1, 2): (1, ["1.1", "1.2"]), (1, 4): (2, ["1.1", "1.3", "1.4"]), (1, 6): (3, ["1.1", "1.3", "1.5", "1.6"]), (2, 1): (1, ["2.1"])}
    best = chat.conversations(frame, best=1).collect()
    assert sorted((r["tree_id"], r["leaf_id"]) for r in best) == [(1, 2), (2, 1)]


def test_long_conversation_and_empty_table(spark):
    rows = spark.range(300).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    one = chat.conversations(chat.linear_nodes(rows)).select(chat.learned(F.col("formatted"), F.col("mask")).alias("x")).collect()
    assert [r["x"] for r in one] == ["".join(map(str, range(300)))]
    assert chat.conversations(chat.linear_nodes(rows.limit(0))).count() == 0


@pytest.mark.parametrize("sent", [100_000, 0])
def test_paths_of_trees_with_repeated_nodes(spark, monkeypatch, sent):
    monkeypatch.setattr(chat, "SENT_JUMPS", sent)
    rng = random.Random(8)
    parents = {("a", "0"): [None]} | {("a", str(i)): [str(rng.randrange(max(0, i - 3), i))] for i in range(1, 40)}
    parents |= {(None, str(i)): [str(i - 1) if i else None] for i in range(9)}
    parents[None, "5"] = ["4", "2"]  # one node that comes twice, with two parents
    rows = [(tree, node, p) for (tree, node), found in parents.items() for p in found]

    def up(tree, node, steps):
        yield node, steps
        for p in parents[tree, node]:
            if p is not None:
                yield from up(tree, p, steps + 1)

    answered = {(tree, p) for tree, _, p in rows}
    want = sorted((str(t), leaf, node, steps) for t, leaf in parents if (t, leaf) not in answered for node, steps in up(t, leaf, 0))
    found = chat.paths(spark.createDataFrame(rows, "tree_id string, node_id string, parent_id string").repartition(3)).collect()
    assert sorted((str(r["tree_id"]), r["leaf_id"], r["node_id"], r["steps"]) for r in found) == want
