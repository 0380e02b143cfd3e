"""Conversation prefix trie: one row for each distinct sequence of first turns that conversations start with.

A prefix is known by a 128-bit digest, the exclusive or of the digests of its
turns and their places, so prefixes of one long conversation are computed in
parallel: turns are dealt out by range, and one summary row for each conversation
and range carries number, digest and length across.

Count-min screening: a sketch counts all prefix digests, up to two.  An estimate of
one proves that no other conversation has the prefix, so its node is emitted where
its row is; only prefixes that may be shared are shuffled, to be grouped exactly.  The
sketch has a fixed largest size; when it fills up more rows are shuffled, with the same result.

Sums over subtrees need no walk.  Each conversation owns the nodes of which it is the
smallest member: a tail of its path.  A node's subtree is the owned tails of its
members, so sums over members of one number a conversation give sums over subtrees.

Defined results: turns are ordered by turn (null first), equal ones by a digest of role
and text; null role or text is empty; rows without a conv_id take no part; repeated
rows are turns of their own; an empty table has no nodes.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import settled, stored

#: Counters of the sketch: a power of two for each row of it, at most so many.
ROWS, LEAST_BITS, MOST_BITS = 3, 16, 24
BLOCK = 1 << 16
#: Most keys that hold 1 / HEAVY of the rows each: a proven bound of what is broadcast.
HEAVY = 10_000
#: Characters of joined ids that are put together before they are digested.
PIECE_CHARS = 1 << 20
SPREAD = 100
NONE = hashlib.sha256(b"").hexdigest()
RESULTS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes over from the first of its hundred."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 6).cast("int")


def _place(depth: Column, digest: Column, one: bool) -> Column:
    """Half of the digest of a turn at its place."""
    return F.xxhash64(depth.cast("long"), digest) if one else F.xxhash64(F.lit(1), depth.cast("long"), digest)


def numbered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with ``part``, ``local`` (place within conversation and part, from 0); and, for each conversation and part, rows ``n`` and those ``before``."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = settled(turns.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    rows = dealt.withColumn("local", F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order[1:])) - 1)
    counts = dealt.groupBy("part", "conv_id").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return rows, settled(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))


def prefixes(conversations: DataFrame) -> DataFrame:
    """One row for each prefix of each rebuilt conversation: its digest (x1, x2), that without its last turn (p1, p2), depth, code points of the last turn's text and of those before, and the conversation's length."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.char_length(text).cast("long").alias("chars"))
    rows, counts = numbered(turns)

    # The first turns that others take over: at most five of every hundredth conversation.
    first = rows.where(F.col("conv_id") % SPREAD == 0).join(counts.where("before < 5"), ["part", "conv_id"]).withColumn("at", F.col("before") + F.col("local")).where("at < 5")
    heads = first.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("at", "digest", "chars"))).alias("head"))
    whole = counts.groupBy("conv_id").agg(F.sum("n").alias("n")).withColumn("h", shared_turns(F.col("conv_id"))).withColumn("base", F.col("conv_id") - F.col("conv_id") % SPREAD)
    head = F.coalesce(F.slice("head", 1, F.col("h")), F.array().cast("array<struct<at:bigint,digest:binary,chars:bigint>>"))
    whole = whole.join(heads, "base", "left").select("conv_id", "n", "h", head.alias("head"))

    def folded(half: bool) -> Column:
        return F.aggregate("head", F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(_place(x["at"] + 1, x["digest"], half)))

    whole = settled(
        whole.select(
            "conv_id",
            "h",
            "head",
            F.size("head").alias("b"),
            (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long").alias("length"),
            folded(True).alias("h1"),
            folded(False).alias("h2"),
            F.aggregate("head", F.lit(0).cast("long"), lambda s, x: s + x["chars"]).alias("h_chars"),
        )
    )

    # Own turns after the first h, each part by itself, then with what the head and earlier parts add.
    info = counts.select("part", "conv_id", "before").join(whole.drop("head"), "conv_id")
    own = rows.select("part", "conv_id", "local", "digest", "chars").join(info, ["part", "conv_id"]).where(F.col("before") + F.col("local") >= F.col("h"))
    own = own.withColumn("depth", (F.col("b") + F.col("before") + F.col("local") - F.col("h") + 1).cast("long"))
    own = own.select("*", *(_place(F.col("depth"), F.col("digest"), half).alias(name) for half, name in ((True, "t1"), (False, "t2"))))
    carry = own.groupBy("part", "conv_id").agg(F.bit_xor("t1").alias("c1"), F.bit_xor("t2").alias("c2"), F.sum("chars").alias("c_chars"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    carry = carry.select("part", "conv_id", *(F.coalesce(f(c).over(earlier), zero).alias(c) for f, c in ((F.bit_xor, "c1"), (F.bit_xor, "c2"), (F.sum, "c_chars"))))
    inside = Window.partitionBy("part", "conv_id").orderBy("local").rowsBetween(Window.unboundedPreceding, 0)
    own = own.select("*", F.bit_xor("t1").over(inside).alias("s1"), F.bit_xor("t2").over(inside).alias("s2"), F.sum("chars").over(inside).alias("s_chars")).join(carry, ["part", "conv_id"])
    x1, x2 = (F.col(f"s{i}").bitwiseXOR(F.col(f"c{i}")).bitwiseXOR(F.col(f"h{i}")) for i in (1, 2))
    own = own.select(
        "conv_id", "depth", "length", x1.alias("x1"), x2.alias("x2"), x1.bitwiseXOR(F.col("t1")).alias("p1"), x2.bitwiseXOR(F.col("t2")).alias("p2"),
        "chars", (F.col("s_chars") + F.col("c_chars") + F.col("h_chars") - F.col("chars")).alias("chars_before"),
    )

    # Prefixes within the head, the empty one included: at most six a conversation.
    def upto(depth: Column, half: bool) -> Column:
        return F.aggregate(F.slice("head", 1, depth), F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(_place(x["at"] + 1, x["digest"], half)))

    begin = whole.select("conv_id", "length", "head", F.explode(F.sequence(F.lit(0), F.col("b"))).alias("d"))
    above = F.greatest(F.col("d") - 1, F.lit(0))
    begin = begin.select(
        "conv_id", F.col("d").cast("long").alias("depth"), "length",
        upto(F.col("d"), True).alias("x1"), upto(F.col("d"), False).alias("x2"), upto(above, True).alias("p1"), upto(above, False).alias("p2"),
        F.when(F.col("d") > 0, F.get("head", above)["chars"]).otherwise(0).cast("long").alias("chars"),
        F.aggregate(F.slice("head", 1, above), F.lit(0).cast("long"), lambda s, x: s + x["chars"]).alias("chars_before"),
    )
    return stored(begin.unionByName(own))


def _cells(x1: np.ndarray, x2: np.ndarray, bits: int) -> list[np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    a, b = x1.view(np.uint64), x2.view(np.uint64) | np.uint64(1)
    return [((a + np.uint64(r) * b) & mask).astype(np.int64) for r in range(ROWS)]


def _longs(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch[name].to_numpy(zero_copy_only=False).astype(np.int64, copy=False) for name in names]


def sketch(rows: DataFrame, bits: int) -> np.ndarray:
    """Counts of digests (x1, x2), up to two, in ``ROWS`` rows of 2 ** bits counters; tasks add up their own first."""
    block = min(BLOCK, 1 << bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((ROWS, 1 << bits), np.uint8)
        for batch in batches:
            for row, cells in zip(table, _cells(*_longs(batch, "x1", "x2"), bits)):
                found, times = np.unique(cells, return_counts=True)
                row[found] = np.minimum(row[found] + np.minimum(times, 2), 2)
        yield from pieces(table.reshape(-1, block))

    def pieces(table: np.ndarray) -> Iterator[pa.RecordBatch]:
        for number in np.flatnonzero(table.any(axis=1)):
            yield pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), "counts": pa.array([table[number].tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, counts in zip(batch["block"].to_pylist(), batch["counts"]):
                part = np.frombuffer(counts.as_buffer(), np.uint8)
                sums[number] = np.minimum(sums[number] + part, 2) if number in sums else part.copy()
        for number, counts in sums.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), "counts": pa.array([counts.tobytes()], pa.binary())})

    schema = "block long, counts binary"
    whole = np.zeros((ROWS << bits) // block * block, np.uint8).reshape(-1, block)
    for r in rows.select("x1", "x2").mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).collect():
        whole[r["block"]] = np.frombuffer(r["counts"], np.uint8)
    return whole.reshape(ROWS, 1 << bits)


def screened(rows: DataFrame, least_bits: int = LEAST_BITS, most_bits: int = MOST_BITS) -> DataFrame:
    """Rows with ``shared`` and ``p_shared``: whether the prefix, and that without its last turn, may have a second conversation."""
    spark = rows.sparkSession
    bits = int(np.clip(int(4 * rows.count()).bit_length(), least_bits, most_bits))
    counts = spark.sparkContext.broadcast(sketch(rows, bits))
    names = rows.columns

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        for batch in batches:
            flags = []
            for one, other in (("x1", "x2"), ("p1", "p2")):
                cells = _cells(*_longs(batch, one, other), bits)
                flags.append(pa.array(np.min([row[c] for row, c in zip(table, cells)], axis=0) > 1))
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), *flags], names=[*names, "shared", "p_shared"])

    return stored(rows.mapInArrow(look, ", ".join(f"{n} long" for n in names) + ", shared boolean, p_shared boolean"))


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], total: int) -> DataFrame:
    """Rows with the columns of their group; ``groups`` has one row for each key, and the number ``members`` of its rows.

    Groups of a 1 / HEAVY share of the rows or more are broadcast, so the shuffle
    of the others has no hot key.
    """
    least = total // HEAVY + 1
    few = F.broadcast(groups.where(F.col("members") >= least))
    many = groups.where(F.col("members") < least)
    return rows.join(few, keys).unionByName(rows.join(few.select(keys), keys, "left_anti").join(many, keys))


def ends(rows: DataFrame, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Digest of the ids, in order and joined by commas, of the rows of each prefix: ids are joined in parts, and the parts digested one after the other."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def runs(batches: Iterator[pa.RecordBatch], value: str) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(column.tolist() for column in _longs(batch, "x1", "x2", "first")), batch[value].to_pylist())

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, first, ids, size = None, 0, [], 0
        for x1, x2, conv, text in runs(batches, "ids"):
            if ids and (key != (x1, x2) or size >= piece_chars):
                yield *key, first, ",".join(ids)
                ids, size = [], 0
            if not ids:
                key, first = (x1, x2), conv
            ids.append(text)
            size += len(text) + 1
        if ids:
            yield *key, first, ",".join(ids)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, state = None, None
        for x1, x2, _, ids in runs(batches, "ids"):
            if key == (x1, x2):
                state.update(b"," + ids.encode())
                continue
            if key:
                yield *key, state.hexdigest()
            key, state = (x1, x2), hashlib.sha256(ids.encode())
        if key:
            yield *key, state.hexdigest()

    joined_fields = [("x1", pa.int64()), ("x2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]
    digest_fields = [("x1", pa.int64()), ("x2", pa.int64()), ("ends_sha256", pa.string())]
    own = rows.select("x1", "x2", F.col("conv_id").alias("first"), F.col("conv_id").cast("string").alias("ids"))
    dealt = own.repartitionByRange(parts, "x1", "x2", "first").sortWithinPartitions("x1", "x2", "first")
    joined = dealt.mapInArrow(_emitting(join, joined_fields), "x1 long, x2 long, first long, ids string")
    return joined.repartition(parts, "x1", "x2").sortWithinPartitions("x1", "x2", "first").mapInArrow(_emitting(digest, digest_fields), "x1 long, x2 long, ends_sha256 string")


def _emitting(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]], fields: list[tuple], most: int = 256) -> Callable:
    """A task's rows as batches of bounded numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batched(rows(batches), most):
            yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, (_, kind) in zip(zip(*some), fields)], names=[name for name, _ in fields])

    return run


def owned(known: DataFrame, borders: DataFrame) -> DataFrame:
    """One row for each conversation: the depth ``since`` which it owns the nodes of its path, the code points ``before`` (all, if it owns none), whether its end is a ``leaf``, the owner ``up`` above, and its shared rows ``members``."""
    at, own = F.col("depth"), F.col("owner") == F.col("conv_id")
    last = at == F.col("length")
    everything = F.when(last, F.col("chars_before") + F.col("chars"))
    leaf = own & last & (F.col("n_ends") == F.col("n_convs"))
    seen = known.select("conv_id", "depth", "chars_before", own.alias("own"), leaf.cast("int").alias("leaf"), F.when(~own, F.col("owner")).alias("above"), everything.alias("everything"), F.lit(1).alias("row"))
    none = F.lit(None).cast("long")
    single = borders.select("conv_id", "depth", "chars_before", F.lit(True).alias("own"), F.lit(1).alias("leaf"), none.alias("above"), none.alias("everything"), F.lit(0).alias("row"))
    first_owned = F.when(F.col("own"), at)
    return (
        seen.unionByName(single)
        .groupBy("conv_id")
        .agg(
            F.min(first_owned).alias("since"),
            F.coalesce(F.min_by("chars_before", first_owned), F.max("everything")).alias("before"),
            F.max("leaf").cast("long").alias("leaf"),
            F.max_by("above", F.when(F.col("above").isNotNull(), at)).alias("up"),
            F.sum("row").alias("members"),
        )
    )


def trie(conversations: DataFrame, least_bits: int = LEAST_BITS, most_bits: int = MOST_BITS) -> DataFrame:
    """The nodes: smallest member ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    rows = screened(prefixes(conversations), least_bits, most_bits)
    at, conv = F.col("depth"), F.col("conv_id")
    last = at == F.col("length")
    # The node above the first owned one is another's; above others of the path it is the conversation's own.
    parent = F.when(at > 0, F.when(at == F.col("since"), F.col("up")).otherwise(conv))

    maybe = rows.where("shared").drop("p1", "p2", "shared", "p_shared")
    total = maybe.count()
    groups = settled(maybe.groupBy("x1", "x2").agg(F.min("conv_id").alias("owner"), F.count("*").alias("members"), F.sum(last.cast("long")).alias("n_ends")))
    known = stored(attach(maybe, groups, ["x1", "x2"], total).withColumnRenamed("members", "n_convs"))
    # A row that is proved single is the first such one of its path if the row above may be shared.
    alone = rows.where(~F.col("shared"))
    first_alone = F.col("p_shared") | (at == 0)
    each = settled(owned(known, alone.where(first_alone)))

    mine = conv == F.col("owner")
    nodes = (
        attach(known, each, ["conv_id"], total)
        .groupBy("x1", "x2")
        .agg(
            F.min("owner").alias("conv_id"),
            F.max("depth").alias("depth"),
            F.max(F.when(mine, parent)).alias("parent_conv_id"),
            F.max("n_convs").alias("n_convs"),
            (F.max((mine & (F.col("length") > at)).cast("long")) + F.sum((~mine & F.coalesce(F.col("since") == at + 1, F.lit(False))).cast("long"))).alias("n_children"),
            F.sum("leaf").alias("n_leaves"),
            F.sum(F.when(mine, 0).otherwise(F.col("before") - F.col("chars_before"))).alias("saved_tokens"),
        )
        .join(ends(maybe.where(last)), ["x1", "x2"], "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NONE)))
        .select(*RESULTS)
    )

    def tails(some: DataFrame, above: Column) -> DataFrame:
        one = F.lit(1).cast("long")
        end = F.when(last, F.sha2(conv.cast("string"), 256)).otherwise(NONE)
        return some.select("conv_id", "depth", above.alias("parent_conv_id"), one.alias("n_convs"), (F.col("length") > at).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), end.alias("ends_sha256"))

    firsts = alone.where(first_alone).join(each.select("conv_id", "since", "up"), "conv_id")
    return nodes.unionByName(tails(alone.where(~first_alone), conv)).unionByName(tails(firsts, parent))
