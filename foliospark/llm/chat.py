"""Chat formatting: reply trees to conversations.

Nodes name the node they answer. Self-joins on ancestors 1, 2, 4, ... steps up
enumerate all root-to-leaf paths in as many rounds as the depth has binary
digits; paths are ranked by score within their tree, and each chosen one becomes
one conversation with a mask of what the model is to learn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import settled

#: The template. Inside texts and roles these strings are escaped by a backslash and a letter.
OPEN, AFTER_ROLE, CLOSE = "### ", ": ", " </turn>\n"
#: Jumps of one length that are sent to all tasks; more are joined by shuffle.
SENT_JUMPS = 100_000
ESCAPES = (("###", "\\h"), ("</turn>", "\\t"), (": ", "\\c"))


def escaped(text: Column) -> Column:
    """Text without any string of the template; a backslash is doubled."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for plain, code in ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(code))
    return out


def unescaped(text: Column) -> Column:
    """The text back. Between doubled backslashes every backslash starts a code."""

    def part(x: Column) -> Column:
        for plain, code in ESCAPES:
            x = F.replace(x, F.lit(code), F.lit(plain))
        return x

    return F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")


def linear_nodes(rows: DataFrame, conversation: str = "conv_id", order: str = "turn") -> DataFrame:
    """Nodes of conversations given as rows: each turn answers the one before it.

    Returns tree_id, node_id, parent_id, role, text, score (1 for each turn).
    Turns of equal number are ordered by role and text, nulls first; repeated
    rows stay as turns of their own; rows without a conversation form one.
    """
    before = Window.partitionBy(conversation).orderBy(order, "role", "text")
    numbered = rows.select(F.col(conversation).alias("tree_id"), "role", "text", F.row_number().over(before).cast("long").alias("node_id"))
    return numbered.select("tree_id", "node_id", F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"), "role", "text", F.lit(1.0).alias("score"))


def paths(nodes: DataFrame) -> DataFrame:
    """All root-to-leaf paths: tree_id, leaf_id, node_id, steps (from the leaf up).

    In round k each known pair of leaf and ancestor gets a second one, 2^k steps
    further up, going from the longest steps to the shortest; so every ancestor
    comes up exactly once. A parent that doesn't exist makes a node a root; on
    a cycle there is no leaf. Only ids are joined, never texts. The jumps are
    settled, the paths are not: each round reads the one before it once, and
    long jumps, which few nodes have, are sent instead of shuffling the paths.
    """
    ids = settled(nodes.select("tree_id", "node_id", "parent_id"))
    known = ids.select(F.col("tree_id").alias("_tree"), F.col("node_id").alias("_node"))
    up = ids.where("parent_id IS NOT NULL").join(known, F.col("tree_id").eqNullSafe(F.col("_tree")) & (F.col("parent_id") == F.col("_node")), "left_semi")
    jumps = [settled(up.select("tree_id", F.col("node_id").alias("low"), F.col("parent_id").alias("high")))]
    most = ids.groupBy("tree_id").count().agg(F.max("count")).first()[0] or 0
    while 1 << len(jumps) < most:  # no path is longer than its tree; on a cycle jumps would never end
        a, b = jumps[-1].alias("a"), jumps[-1].alias("b")
        longer = a.join(b, F.col("a.tree_id").eqNullSafe(F.col("b.tree_id")) & (F.col("a.high") == F.col("b.low")))
        longer = settled(longer.select("a.tree_id", "a.low", "b.high"))
        if longer.isEmpty():
            break
        jumps.append(longer)
    answered = jumps[0].select(F.col("tree_id").alias("_tree"), F.col("high").alias("_node"))
    leaves = ids.join(answered, F.col("tree_id").eqNullSafe(F.col("_tree")) & (F.col("node_id") == F.col("_node")), "left_anti")
    found = leaves.select("tree_id", F.col("node_id").alias("leaf_id"), "node_id", F.lit(0).cast("long").alias("steps"))
    for k in range(len(jumps) - 1, -1, -1):
        highs = jumps[k].groupBy(F.col("tree_id").alias("_tree"), "low").agg(F.collect_list("high").alias("highs"))  # one, unless a node is repeated
        if jumps[k].limit(SENT_JUMPS + 1).count() <= SENT_JUMPS:
            highs = F.broadcast(highs)
        further = found.join(highs, F.col("tree_id").eqNullSafe(F.col("_tree")) & (F.col("node_id") == F.col("low")), "left")
        own = F.struct("node_id", "steps")
        above = F.transform(F.coalesce("highs", F.array()), lambda high: F.struct(high.alias("node_id"), (F.col("steps") + (1 << k)).alias("steps")))
        found = further.select("tree_id", "leaf_id", F.inline(F.concat(F.array(own), above)))
    return found


def conversations(nodes: DataFrame, best: int | None = None, learn: str = "assistant") -> DataFrame:
    """One conversation for each path: tree_id, leaf_id, rank, formatted, mask.

    Paths of a tree are ranked by the mean score of their nodes, then by the
    number of turns, then by the smaller leaf; ``best`` keeps so many of each
    tree. ``mask`` lists (start, length) of the texts of role ``learn`` within
    ``formatted``, in code points from 0. Null texts and roles are empty.
    """
    at = paths(nodes)
    turn = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(AFTER_ROLE), escaped(F.col("text")), F.lit(CLOSE))
    texts = nodes.select(
        F.col("tree_id").alias("_tree"), F.col("node_id").alias("_node"), F.col("score"), turn.alias("turn"), F.col("role").eqNullSafe(learn).alias("learn"), F.char_length(F.coalesce(escaped(F.col("text")), F.lit(""))).alias("n")
    )
    rows = at.join(texts, F.col("tree_id").eqNullSafe(F.col("_tree")) & (F.col("node_id") == F.col("_node")))
    one = F.struct((-F.col("steps")).alias("at"), "turn", "learn", "n")
    grouped = rows.groupBy("tree_id", "leaf_id").agg(F.array_sort(F.collect_list(one)).alias("turns"), F.avg("score").alias("score"))
    order = Window.partitionBy("tree_id").orderBy(F.col("score").desc(), F.size("turns").desc(), "leaf_id")
    ranked = grouped.withColumn("rank", F.row_number().over(order))
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
    nothing = F.array().cast("array<struct<start:bigint,length:bigint>>")
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("spans")),
        lambda done, t: F.struct(
            (done["at"] + F.char_length(t["turn"])).cast("long").alias("at"),
            F.when(
                t["learn"],
                F.concat(done["spans"], F.array(F.struct((done["at"] + F.char_length(t["turn"]) - len(CLOSE) - t["n"]).cast("long").alias("start"), t["n"].cast("long").alias("length")))),
            )
            .otherwise(done["spans"])
            .alias("spans"),
        ),
        lambda done: done["spans"],
    )
    return ranked.select("tree_id", "leaf_id", "rank", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"), spans.alias("mask"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, text)."""
    pieces = F.filter(F.split(formatted, CLOSE.strip(" "), -1), lambda x: x != "")
    return F.transform(
        pieces,
        lambda x: F.struct(
            unescaped(F.substring_index(F.substr(x, F.lit(len(OPEN) + 1)), AFTER_ROLE, 1)).alias("role"),
            unescaped(_body(x)).alias("text"),
        ),
    )


def _body(piece: Column) -> Column:
    """What follows the role, without the blank before the closing mark."""
    start = F.locate(AFTER_ROLE, piece) + len(AFTER_ROLE)
    return F.substr(piece, start, F.char_length(piece) - start)


def learned(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(mask, lambda m: unescaped(F.substr(formatted, (m["start"] + 1).cast("int"), m["length"].cast("int")))), "")
