"""Connected components: union-find inside tasks, then contraction in shuffles only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import settled

#: Nodes that one task remembers; beyond it hands on what it has and begins anew.
REMEMBERED_NODES = 1 << 20


def forest(edges: DataFrame, most: int = REMEMBERED_NODES) -> DataFrame:
    """Each task's edges (a, b) as stars: every node but the smallest of its group tied to that one. Connects the same nodes."""

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while x != top:
                parent[x], x = top, parent[x]
            return top

        def rows() -> pa.RecordBatch:
            tied = [(x, r) for x in list(parent) if (r := root(x)) != x]
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in tied], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist()):
                x, y = root(a), root(b)
                if x != y:
                    low, high = min(x, y), max(x, y)
                    parent[high] = parent.setdefault(low, low)
            if len(parent) >= most:
                yield rows()
                parent.clear()
        yield rows()

    return edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).mapInArrow(stars, "a long, b long")


def reached(rounds: list[DataFrame]) -> DataFrame:
    """The group that each node of the first round ends in (node, group), from the moves (a, to) of all rounds.

    Goes back from the last round, so that each round's nodes are looked up once,
    in the next round. Rounds have fewer and fewer nodes; following every node of the first
    through all of them would make as many rows each time.
    """
    found = rounds[-1].select(F.col("a").alias("node"), F.col("to").alias("group"))
    for move in reversed(rounds[:-1]):
        nxt = found.select(F.col("node").alias("to"), "group").hint("merge")
        found = move.join(nxt, "to", "left").select(F.col("a").alias("node"), F.coalesce("group", "to").alias("group"))
    return found


def connected(edges: DataFrame) -> DataFrame:
    """Components of undirected edges (a, b): one row (node, component) for each node, the component its smallest node.

    Tasks first reduce their edges to stars. Then each round every node moves to its
    first neighbour or stays, and edges within a group go. Rounds order nodes by id
    (a star is done in one) and by digest (so that no numbering makes long
    chains slow) in turn. Minima are combined before the shuffle; a node with
    very many edges is a skewed join, not a group. Joins are by shuffle: what
    moves is of no proven size, and nothing of it passes the driver.
    """
    left = settled(forest(edges.select("a", "b").where("a <> b")).distinct())
    rounds = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if len(rounds) % 2 == 0:
            first = F.least(F.min("b"), F.first("a"))
        else:
            own, other = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("n")), F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("n"))
            first = F.min(F.least(own, other))["n"]
        # Not materialised: it is a small aggregate of what is.
        move = both.groupBy("a").agg(first.alias("to"))
        rounds.append(move)
        to = move.select(F.col("a").alias("a"), F.col("to").alias("x")).hint("merge")
        at = move.select(F.col("a").alias("b"), F.col("to").alias("y")).hint("merge")
        moved = left.join(to, "a").join(at, "b").where("x <> y")
        left = settled(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    found = settled(reached(rounds))
    smallest = found.groupBy("group").agg(F.min("node").alias("component")).hint("merge")
    return settled(found.join(smallest, "group").select("node", "component"))
