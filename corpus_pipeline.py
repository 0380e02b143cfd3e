"""Documents to a tokenised training mix.

Five stages, each over all that the one before kept: language identification,
quality classification, near-duplicate removal, mixing to target weights, and
byte-level BPE encoding, which checks that decoding gives each text back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import bigru, bpe_tree, importance, mixing, signature_join
from foliospark.llm.common import broadcast_if_small, settled, stored, table

#: A language's mean probability below which a document counts as unrecognised.
LEAST_SCORE = 0.4
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language stay; null texts and texts without letters go."""
    docs = docs.select(COLUMNS)
    known = bigru.identify(docs, bigru.train(table(spark, sf_dir, "documents")))
    return known.where((F.col("lang_pred") != bigru.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance sample takes stay."""
    docs = docs.select(COLUMNS)
    model = importance.fit(docs, table(spark, sf_dir, "labels"))
    return importance.resample(docs, model).where("keep").select(COLUMNS)


def _row_keys(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """One row of each id and text, with a key ``row``; and row and id of those whose key isn't their id, or None if there are none.

    Rows whose id no other has keep it as key and aren't shuffled for it; all
    others get numbers beyond the ids.
    """
    ids = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n"))
    repeated = settled(ids.where("n > 1").select("doc_id"))
    if repeated.isEmpty() and docs.where(F.col("doc_id").isNull()).isEmpty():
        return docs.withColumn("row", F.col("doc_id")), None
    few = broadcast_if_small(repeated, 1_000_000)
    others = docs.where(F.col("doc_id").isNull()).unionByName(docs.where(F.col("doc_id").isNotNull()).join(few, "doc_id", "left_semi").select(COLUMNS))
    rest = F.min(F.struct(*(F.col(c) for c in COLUMNS if c not in ("doc_id", "text")))).alias("rest")
    one = others.groupBy("doc_id", "text").agg(rest).select("doc_id", "text", "rest.*").select(COLUMNS)
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    number = F.monotonically_increasing_id()
    key = F.lit((high if high is not None else 0) + 1) + number if high is None or high < 1 << 62 else F.lit(low - 1) - number
    others = settled(one.withColumn("row", key))
    alone = docs.where(F.col("doc_id").isNotNull()).join(few, "doc_id", "left_anti").select(*COLUMNS, F.col("doc_id").alias("row"))
    return alone.unionByName(others), others.select("row", F.col("doc_id").alias("id"), F.lit(True).alias("other"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 0.8 of their five-word shingles, the one with the smallest id stays.

    Rows of one id and text are one document, of which one row stays. Rows of
    one id and different texts are different documents, and so are rows without an
    id, of which one stays only where no similar document has an id.
    """
    rows, others = _row_keys(docs.select(COLUMNS))
    groups = signature_join.jaccard_components(rows, width=5, num=80, den=100, doc_id="row").select(F.col("doc_id").alias("row"), "component_id")
    if others is None:
        gone = groups.where(F.col("row") != F.col("component_id")).select("row")
    else:
        groups = settled(groups)
        known = groups.join(others, "row", "left").withColumn("id", F.when(F.col("other"), F.col("id")).otherwise(F.col("row")))
        stays = known.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row"))["row"].alias("row"))
        gone = groups.select("row").join(stays.select("row"), "row", "left_anti")
    return rows.join(gone.distinct(), "row", "left_anti").select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight asks for."""
    return mixing.emit(mixing.mix(docs.select(COLUMNS))).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    both = bpe_tree.encode_texts(docs.select(COLUMNS), path, pattern, decoded="decoded", remember=False)
    return both.select("doc_id", "lang", "source", "token_ids", F.size("token_ids").cast("long").alias("n_tokens"), (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [("language_id", languages), ("quality_classifier", quality), ("ngram_jaccard_join", near_duplicates), ("mixing", mix), ("bpe", encode)]

#: The models of the first stages can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; between two of them documents are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
