"""Running values over long sequences, in bounded tasks.

A window per file puts all of a file's rows into one task, so one huge file
would set the run time of the whole job.  Here a sequence is cut into chunks of
consecutive positions; windows run inside chunks, one summary row per chunk
carries the state across them, and only those summaries are windowed per file
(``width`` times fewer rows).  Pages are numbered densely, so their chunks are
plain divisions of the page number; rows with positions of any kind are cut at
bounds that a first pass finds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from foliospark.session import settle

CHUNK = "_chunk"
PAGE_WIDTH = 4096
ROW_WIDTH = 65536
#: Ranges a table is dealt into at most, and so the most bounds and carry rows that are broadcast.
MOST_RANGES = 10_000


def with_chunk(df: DataFrame, order_col: str, width: int) -> DataFrame:
    """Add the chunk number of an integral position.

    Rows that come with a chunk number keep it, and with it the way they are
    already spread over tasks.
    """
    if CHUNK in df.columns:
        return df
    return df.withColumn(CHUNK, F.expr(f"`{order_col}` div {int(width)}L"))


def within_chunk(keys: list[str], order_col: str) -> WindowSpec:
    return Window.partitionBy(*keys, CHUNK).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)


def before_in_chunk(keys: list[str], order_col: str) -> WindowSpec:
    return Window.partitionBy(*keys, CHUNK).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)


def earlier_chunks(keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)


def join_carry(df: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """Attach one carry row per chunk; both sides are partitioned by the chunk."""
    return df.join(carry, [*keys, CHUNK], "left")


def _same(a: DataFrame, keys: list[str], suffix: str) -> Column:
    same = F.lit(True)
    for key in keys:
        same = same & a[key].eqNullSafe(F.col(f"{key}{suffix}"))
    return same


def range_bounds(df: DataFrame, keys: list[str], order_col: str, width: int) -> DataFrame:
    """Where long keys are cut: one row ``(keys, _bounds)`` for each key that the bounds of ranges of about ``width`` rows fall into.

    A first pass over keys and positions deals them into equal ranges; only the
    first position of each range is kept, so there are fewer bounds than
    ranges, whatever the positions look like.  Null keys are keys like others.
    """
    slim = df.select(*keys, order_col)
    ranges = min(max(-(-slim.count() // width), 1), MOST_RANGES)
    # As many names as there are keys, whatever they are called.
    named = [F.col(key).alias(f"{key}_of_bound") for key in keys]
    place = F.struct(*[F.col(key) for key in keys], F.col(order_col).alias("_position"))
    starts = slim.repartitionByRange(ranges, *keys, order_col).groupBy(F.spark_partition_id().alias("_range")).agg(F.min(place).alias("_start"))
    # Where a key begins there is nothing to cut, but no harm either: the chunk before is empty.
    cut = starts.select("_start.*").groupBy(*keys).agg(F.sort_array(F.collect_set("_position")).alias("_bounds"))
    return settle(cut.select(*named, "_bounds"))


def range_carry(chunked: DataFrame, keys: list[str], order_col: str, value: str) -> DataFrame:
    """The last non-null ``value`` before each range that has an earlier one: at most one row for each range."""
    seen = F.struct(F.col(order_col).alias("position"), F.col(value).alias("value"))
    cut = chunked.where(F.col("_cut"))
    last = cut.groupBy(*keys, CHUNK).agg(F.max(F.when(F.col(value).isNotNull(), seen)).alias("_last"))
    carried = F.last("_last", ignorenulls=True).over(earlier_chunks(keys))["value"]
    return last.select(*keys, CHUNK, carried.alias("_carry")).where(F.col("_carry").isNotNull())


def last_known(
    df: DataFrame, keys: list[str], order_col: str, value: Column, output: str, width: int = ROW_WIDTH
) -> DataFrame:
    """The last non-null ``value`` up to and including each row, per key.

    A prefix scan in two passes: the first finds where keys of more than about
    ``width`` rows are cut, the second fills each range by itself and adds what
    the ranges before carry.  Positions may be as sparse as they like: keys
    that no bound falls into have no carry row at all.  Keys and positions
    must identify a row.  Rows with a null key get null.
    """
    bounds = range_bounds(df, keys, order_col, width)
    valued = df.withColumn("_value", value)
    below = F.size(F.filter("_bounds", lambda b: b <= F.col(order_col)))
    joined = valued.join(F.broadcast(bounds), _same(valued, keys, "_of_bound"), "left")
    chunked = joined.select(
        *[valued[c] for c in valued.columns],
        F.coalesce(below, F.lit(0)).cast("long").alias(CHUNK),
        F.col("_bounds").isNotNull().alias("_cut"),
    )
    local = F.last("_value", ignorenulls=True).over(within_chunk(keys, order_col))
    filled = chunked.withColumn("_local", local)
    carry = range_carry(chunked, keys, order_col, "_value").withColumnsRenamed({c: f"{c}_of_carry" for c in [*keys, CHUNK]})
    filled = filled.join(F.broadcast(carry), _same(filled, [*keys, CHUNK], "_of_carry"), "left")
    has_key = F.lit(True)
    for key in keys:
        has_key = has_key & F.col(key).isNotNull()
    result = F.when(has_key, F.coalesce("_local", "_carry"))
    return filled.select(*[filled[c] for c in df.columns], result.alias(output))
