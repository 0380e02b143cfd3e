"""One query per operator over its whole given table, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import bigru, bpe_tree, chat, fill_in_middle, importance, line_runs, mixing, prefix_trie, signature_join, text_density, token_counts, vector_search
from foliospark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_join.jaccard_components(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


@query
def op2_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe_tree.encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern, keep_text=False)
    decoded = bpe_tree.decode_ids(encoded, path, pattern)
    return decoded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, path, pattern, budget=512)


@query
def op3_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_density.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE["op4_mixing"] = mixing.SQL


@query
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    done = chat.conversations(chat.linear_nodes(rows.unionByName(extra)))
    turns, learned = chat.read_back(F.col("formatted")), chat.learned(F.col("formatted"), F.col("mask"))
    return (
        done.withColumn("turns", turns)
        .withColumn("learned", learned)
        .select(
            F.col("tree_id").alias("conv_id"),
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
            F.char_length("learned").cast("long").alias("loss_chars"),
            F.sha2("learned", 256).alias("loss_sha256"),
            F.char_length("formatted").cast("long").alias("formatted_chars"),
        )
    )


ORACLE["op8_chat"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok', 'user', '' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok', 'assistant', ''
), lengths AS (
  SELECT *, len(replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\t'), ': ', '\c'))
    + len(replace(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t'), ': ', '\c')) + 4 + 2 + 9 AS n FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
  coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM lengths GROUP BY conv_id
"""


@query
def op6_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = bigru.identify(docs.select("doc_id", "text"), bigru.train(docs))
    return found.select("doc_id", bigru.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op7_stable_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.stable_projection_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op9_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = importance.fit(docs, table(spark, sf_dir, "labels"))
    return importance.resample(docs, model).select("doc_id", "log_weight", "sample_key", "keep")


@query
def op10_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.mtree_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLE["op10_mtree"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_in_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = fill_in_middle.restore(F.col("output"), F.col("form"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))


ORACLE["op12_fill_in_middle"] = fill_in_middle.SQL


@query
def op11_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_runs.dedupe(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op11_line_runs"] = line_runs.SQL


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))
