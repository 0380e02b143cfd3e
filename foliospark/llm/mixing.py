"""Mixing sources to target weights.

Words are summed per source, targets and repetition rates follow from the sums,
and each document is taken floor(rate) times plus once more if a coin seeded by
its id falls below the rate's fraction. Only sums per source are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import WORD, broadcast_if_small, settled

#: Sources up to which their table is broadcast; beyond, it is joined by shuffle.
BROADCAST_SOURCES = 50_000


def words(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def coin(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on key and seed only: 52 bits of a digest."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def targets(sizes: DataFrame, limit: int = 3, cycle: int = 3) -> DataFrame:
    """Targets of (source, source_size) rows, with the repetition rate.

    Sources by code point, null last, weigh 1, 2, ..., ``cycle``, repeating, and
    share all words by weight. No target is above ``limit`` times its source's
    size; what exceeds it is shared among the others by weight until none is
    above. In the order of size per weight those that reach their limit come
    first, so running sums over the sources tell where sharing settles.
    One row per source; a source of size 0 gets target and rate 0.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % cycle + 1).cast("long"))
    most = F.col("source_size") * limit
    order = Window.orderBy((most / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    shared = (
        weighed.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("spent", F.coalesce(F.sum(most).over(earlier), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(later))
        .withColumn("share", (F.col("total") - F.col("spent")) / F.col("left_weight"))
        .withColumn("settles", F.col("share") * F.col("weight") <= most)
        .withColumn("per_weight", F.first(F.when(F.col("settles"), F.col("share")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    target = F.least(F.col("per_weight") * F.col("weight"), most.cast("double"))
    rate = F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(float(limit)))).otherwise(0.0)
    return shared.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def mix(docs: DataFrame, limit: int = 3, seed: str = "mix") -> DataFrame:
    """Adds size, source_size, target and copies: how often the mix takes each document.

    Every row is decided by itself: rows with equal ids get equal coins, rows
    without an id are told apart by their text. Null sources are one source.
    Columns of the added names are replaced; an empty table stays empty. Rows
    are not moved: the table of sources is broadcast after its rows are counted.
    """
    docs = docs.drop("size", "source_size", "target", "copies", "_mix_source", "_mix_rate")
    sized = docs.withColumn("size", words(F.col("text")))
    sums = settled(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), limit))
    per_source = broadcast_if_small(sums, BROADCAST_SOURCES).withColumnRenamed("source", "_mix_source").withColumnRenamed("rate", "_mix_rate")
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    whole = F.floor("_mix_rate")
    extra = (coin(key, seed) < F.col("_mix_rate") - whole).cast("long")
    joined = sized.join(per_source, F.col("source").eqNullSafe(F.col("_mix_source")))
    return joined.withColumn("copies", whole + extra).drop("_mix_source", "_mix_rate")


def emit(mixed: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it."""
    repeated = mixed.where("copies > 0").withColumn("_mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.drop("_mix_copy", "size", "source_size", "target", "copies")


SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size, text FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sums
), running AS (
  SELECT *, sum(source_size) OVER () AS total,
    coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight
  FROM weighed WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST)
), shares AS (
  SELECT *, (total - spent)::DOUBLE / left_weight::DOUBLE AS share FROM running
), settled AS (
  SELECT min_by(share, 3 * source_size / weight) AS per_weight FROM shares WHERE share * weight <= 3 * source_size
), rates AS (
  SELECT source, source_size, least(per_weight * weight, (3 * source_size)::DOUBLE) AS target,
    CASE WHEN source_size > 0 THEN least(least(per_weight * weight, (3 * source_size)::DOUBLE) / source_size, 3.0::DOUBLE) ELSE 0.0 END AS rate
  FROM shares, settled
)
SELECT doc_id, size, source_size, target,
  size * (floor(rate)::BIGINT + CASE WHEN ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE
    < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source
"""
