"""Line dedup: lines that many documents share stay in one document only.

The hashes of lines are kept in levelled sorted runs: bucketed tables of one row
for each key, sorted by key.  Each batch of documents merge-anti-joins the runs, so
that a key which is settled there isn't recorded again, and adds what is left as
a run of its own; two runs of one level are compacted to one of the next.
Batches come in descending order of ids, so the first batch with a key has its
largest id.  Runs have the partitioning of the shuffle that joins them, hence
joins and compaction move no rows.

Texts are read twice: to hash their lines, and to rebuild them. A key with
very many lines never meets them in one task: there are at most ``HEAVY`` such
keys, which are broadcast; only lines of other keys are shuffled.

Defined results for odd rows: each row is a document, also one that repeats an id
or has none; ids that are null count as smaller than all others; where several rows
have the largest id that holds a key, all of them keep its lines.  Null and empty
texts are one empty line.  Columns of the input named as results are replaced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import shared_folder, stored

#: Code points of the shortest key that counts, and documents from which on it does.
MIN_CHARS, MIN_DOCS = 20, 3
BATCHES = 4
#: Most (batch, key) pairs that hold a share of 1 / HEAVY of all lines each: a proven bound of what is broadcast.
HEAVY = 40_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK = " \t\n\x0b\x0c\r"
KEY = ["_h1", "_h2"]
RESULTS = ["n_lines", "n_dropped", "kept"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keys_of(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """(hash, hash, position) of each line whose key is long enough, in this order."""

    def lower(key: Column) -> Column:
        ascii_only = F.octet_length(key) == F.char_length(key)
        return F.when(ascii_only, F.lower(key)).otherwise(F.translate(key, UPPER, LOWER))

    stripped = F.transform(lines_of(text), lambda line, at: F.struct(F.btrim(line, F.lit(BLANK)).alias("key"), at.alias("at")))
    long_ones = F.filter(stripped, lambda x: F.char_length(x["key"]) >= min_chars)
    lowered = F.transform(long_ones, lambda x: F.struct(lower(x["key"]).alias("key"), x["at"].alias("at")))
    hashed = F.transform(lowered, lambda x: F.struct(F.xxhash64(x["key"]).alias("_h1"), F.xxhash64(F.lit(1), x["key"]).alias("_h2"), x["at"].alias("_at")))
    return F.sort_array(hashed)


def hashed_lines(docs: DataFrame, text: str, doc_id: str, batches: int, min_chars: int) -> DataFrame:
    """One row for each line with a key: document, position, key, and whether it is the key's first in its document; stored by batch."""
    bounds = docs.agg(F.percentile_approx(F.col(doc_id), [1 - (i + 1) / batches for i in range(batches - 1)]).alias("b")).first()["b"] or []
    batch = F.lit(0)
    for bound in bounds:
        batch = batch + F.when(F.col(doc_id) > bound, 0).otherwise(1)
    keys = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(F.col(text)).alias("_text"), batch.alias("_batch"), keys_of(F.col(text), min_chars).alias("_keys"))
    before = F.concat(F.array(F.lit(None).cast("struct<_h1:long,_h2:long,_at:int>")), F.col("_keys"))
    same = lambda x, y: (x["_h1"] == y["_h1"]) & (x["_h2"] == y["_h2"])
    marked = F.zip_with("_keys", before, lambda x, y: F.struct(x["_h1"].alias("_h1"), x["_h2"].alias("_h2"), x["_at"].alias("_at"), F.when(same(x, y), 0).otherwise(1).alias("_first")))
    rows = keys.select("_id", "_text", "_batch", F.inline(marked)).where(F.col("_at").isNotNull())
    return stored(rows, "_batch")


class LineRuns:
    """Levelled sorted runs of keys: rows (key, documents, lines, largest id), in tables of the shared folder."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, heavy: int = 1 << 62):
        self.spark, self.min_docs, self.heavy = spark, min_docs, heavy
        self.space = f"line_runs_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {self.space} LOCATION '{shared_folder(spark)}/{self.space}'")
        self.levels: list[list[str]] = []
        self.made = 0

    def _write(self, rows: DataFrame) -> str:
        name = f"{self.space}.run_{self.made}"
        self.made += 1
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows.write.bucketBy(buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        return name

    def merged(self, one: str, other: str) -> DataFrame:
        """Two runs as one, by a merge join."""
        right = self.spark.table(other).select(*KEY, *(F.col(c).alias(c + "2") for c in ("_docs", "_rows", "_last")))
        both = self.spark.table(one).join(right.hint("merge"), KEY, "full")
        total = lambda c: (F.coalesce(c, F.lit(0)) + F.coalesce(c + "2", F.lit(0))).alias(c)
        return both.select(*KEY, total("_docs"), total("_rows"), F.greatest("_last", "_last2").alias("_last"))

    def _drop(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")

    def names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, batch: DataFrame) -> None:
        """Record a batch of hashed lines; its ids are smaller than those of all batches before it.

        Keys that a run has from enough documents are left out, unless the batch has so many of
        their lines that they count as heavy.
        """
        own = batch.groupBy(*KEY).agg(F.sum("_first").alias("_docs"), F.count("*").alias("_rows"), F.max("_id").alias("_last"))
        for name in self.names():
            done = self.spark.table(name).where(F.col("_docs") >= self.min_docs).select(*(F.col(c).alias(c + "k") for c in KEY))
            match = (F.col("_h1") == F.col("_h1k")) & (F.col("_h2") == F.col("_h2k")) & (F.col("_rows") < self.heavy)
            own = own.join(done.hint("merge"), match, "left_anti")
        self._push(0, own)

    def _push(self, level: int, rows: DataFrame) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(self._write(rows))
        if len(self.levels[level]) == 2:
            old, self.levels[level] = self.levels[level], []
            self._push(level + 1, self.merged(*old))
            self._drop(*old)

    def keepers(self) -> DataFrame:
        """Keys of enough documents, with their largest id, when all runs are compacted into one."""
        if not self.names():
            raise ValueError("no batch was added")
        while len(self.names()) > 1:  # the newest are the smallest
            one, other, *rest = self.names()
            self.levels = [[self._write(self.merged(one, other)), *rest]]
            self._drop(one, other)
        return self.spark.table(self.names()[0]).where(F.col("_docs") >= self.min_docs)


def dropped_positions(lines: DataFrame, keepers: DataFrame, heavy: int) -> DataFrame:
    """The positions of dropped lines of each document that has any."""
    few = F.broadcast(keepers.where(F.col("_rows") >= heavy).select(*KEY, "_last"))
    many = keepers.where(F.col("_rows") < heavy).select(*KEY, "_last")
    hot = lines.join(few, KEY)
    cold = lines.join(few.select(*KEY), KEY, "left_anti").join(many.hint("merge"), KEY)
    goes = ~F.col("_id").eqNullSafe(F.col("_last"))
    columns = ["_id", "_text", "_at"]
    both = hot.where(goes).select(columns).unionByName(cold.where(goes).select(columns))
    return both.groupBy("_id", "_text").agg(F.collect_set("_at").alias("_gone"))


def dedupe(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """The rows of ``docs`` without their text, and ``n_lines`` (before dropping), ``n_dropped`` and the ``kept`` text."""
    lines = hashed_lines(docs, text, doc_id, batches, min_chars)
    heavy = -(-lines.count() // HEAVY) or 1
    runs = LineRuns(docs.sparkSession, min_docs, heavy)
    for number in range(batches):
        runs.add(lines.where(F.col("_batch") == number))
    gone = dropped_positions(lines, runs.keepers(), heavy).select(F.col("_id").alias("_gid"), F.col("_text").alias("_gtext"), "_gone")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in RESULTS and c != text]
    whole = docs.select(*others, F.col(doc_id).alias("_id"), F.xxhash64(F.col(text)).alias("_text"), lines_of(F.col(text)).alias("_lines"))
    # Lines are split before the join, so that the lambda below picks from an array instead of splitting again.
    both = whole.join(gone, F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_text") == F.col("_gtext")), "left")
    stays = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.when(F.col("_gone").isNull(), F.array_join("_lines", "\n")).otherwise(F.array_join(F.transform(stays, lambda at: F.col("_lines")[at]), "\n"))
    return both.select(
        *others,
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept"),
    )


#: DuckDB SQL for the digest columns of the query.
SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM docs
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS k FROM lines
), shared AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE len(k) >= {MIN_CHARS} GROUP BY k HAVING count(DISTINCT r) >= {MIN_DOCS}
), marked AS (
  SELECT keyed.*, shared.k IS NOT NULL AND keyed.doc_id IS DISTINCT FROM shared.last AS gone FROM keyed LEFT JOIN shared USING (k)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""
