"""Fill-in-middle: documents cut into prefix, middle and suffix, put in the order a model learns to fill from.

Draws are planned by SQL functions from a digest of the id, so reruns agree.
The text is cut by a pyarrow.compute pipeline for each Arrow batch: code points
become list arrays, are flattened with the index of their text, get ordinals,
are filtered by role, and lists of each role are rebuilt and joined.  It works
on blocks of bounded bytes, so a long text takes no more memory than its pieces.

Null and empty texts, and texts that hold a marker, stay as they are ("plain").
Rows without an id draw as one id, the empty one.  Repeated rows give repeated
results.  Columns of the input named as results are replaced, others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Percentages of texts that are transformed, and of those that put the suffix first.
RATE, SPM_RATE = 90, 20
#: Bytes of text whose code points are handled at once.
BLOCK_BYTES = 1 << 20
RESULTS = ["n", "form", "prefix_chars", "middle_chars", "output"]


def plan(text: Column, doc_id: Column, rate: int = RATE, spm_rate: int = SPM_RATE) -> dict[str, Column]:
    """``n``, ``form`` and the two cuts ``_first`` <= ``_second``, in code points; a plain text is all prefix."""
    text = F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h1, h2, h3, h4 = (F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4))
    n = F.char_length(text).cast("long")
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (n == 0) | marked | (h3 % 100 >= rate)
    form = F.when(plain, PLAIN).when(h4 % 100 < spm_rate, SPM).otherwise(PSM)
    one, other = h1 % (n + 1), h2 % (n + 1)
    return {
        "n": n,
        "form": form,
        "_first": F.when(plain, n).otherwise(F.least(one, other)),
        "_second": F.when(plain, n).otherwise(F.greatest(one, other)),
    }


def _lists(values: pa.Array, parents: np.ndarray, count: int) -> pa.ListArray:
    """Values, in the order of their parents, as one list for each of ``count`` parents."""
    ends = np.zeros(count + 1, np.int32)
    np.cumsum(np.bincount(parents, minlength=count), out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), values)


def cut(texts: pa.StringArray, first: np.ndarray, second: np.ndarray, block: int = BLOCK_BYTES) -> list[pa.Array]:
    """Prefix, middle and suffix of each text; ``texts`` has no nulls."""
    texts = pa.concat_arrays([texts])  # a copy of its own, from offset 0
    data = texts.buffers()[2]
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[: len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[: bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    pieces: list[list[pa.Array]] = [[], [], []]
    owners: list[np.ndarray] = []
    start, seen, last = 0, 0, -1  # of the block's first text: units before the block
    while start < len(raw):
        stop = min(start + block, len(raw))
        while stop < len(raw) and raw[stop] & 0xC0 == 0x80:
            stop += 1
        part = raw[start:stop]
        starts = np.flatnonzero((part & 0xC0) != 0x80).astype(np.int32)
        offsets = pa.py_buffer(np.append(starts, np.int32(len(part))))
        units = pa.StringArray.from_buffers(len(starts), offsets, data.slice(start, stop - start))
        low = int(np.searchsorted(bounds, start, "right")) - 1
        high = int(np.searchsorted(bounds, stop, "left"))
        inside = np.clip(bounds[low : high + 1] - start, 0, len(part))
        ends = np.searchsorted(starts, inside).astype(np.int32)
        ends[0] = 0
        lists = pa.ListArray.from_arrays(pa.array(ends), units)
        flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
        before = -ends[:-1].astype(np.int64)
        before[0] += seen if low == last else 0
        ordinals = pc.add(pa.array(np.arange(len(starts), dtype=np.int64)), pc.take(pa.array(before), parents))
        in_middle = pc.greater_equal(ordinals, pc.take(pa.array(first[low:high]), parents))
        in_suffix = pc.greater_equal(ordinals, pc.take(pa.array(second[low:high]), parents))
        roles = [pc.invert(in_middle), pc.and_not(in_middle, in_suffix), in_suffix]
        for kept, role in zip(pieces, roles):
            rebuilt = _lists(pc.filter(flat, role), pc.filter(parents, role).to_numpy(), high - low)
            kept.append(pc.binary_join(rebuilt, ""))
        owners.append(np.arange(low, high))
        units_of_last = int(ends[-1] - ends[-2])
        seen = units_of_last + (seen if high - 1 == last and high - low == 1 else 0)
        last = high - 1
        start = stop
    if not owners:
        return [pa.array([""] * len(texts), pa.string())] * 3
    owner = np.concatenate(owners)
    return [pc.binary_join(_lists(pa.concat_arrays(kept), owner, len(texts)), "") for kept in pieces]


def arrange(prefix: pa.Array, middle: pa.Array, suffix: pa.Array, form: pa.Array) -> pa.Array:
    spm = pc.equal(form, SPM)
    marker, other = pc.if_else(spm, SUFFIX, PREFIX), pc.if_else(spm, PREFIX, SUFFIX)
    one, two = pc.if_else(spm, suffix, prefix), pc.if_else(spm, prefix, suffix)
    return pc.if_else(pc.equal(form, PLAIN), prefix, pc.binary_join_element_wise(marker, one, other, two, MIDDLE, middle, ""))


def transform(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rate: int = RATE, spm_rate: int = SPM_RATE, block: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``."""
    kept = [c for c in docs.columns if c not in RESULTS]
    planned = docs.select(
        *(F.col(f"`{c}`") for c in kept),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        *(c.alias(name) for name, c in plan(F.col(text), F.col(doc_id), rate, spm_rate).items()),
    )
    cuts = F.col("form") != PLAIN
    planned = planned.withColumns({"prefix_chars": F.when(cuts, F.col("_first")), "middle_chars": F.when(cuts, F.col("_second") - F.col("_first"))})
    schema = T.StructType([f for f in planned.schema.fields if f.name not in ("_text", "_first", "_second")] + [T.StructField("output", T.StringType())])
    names = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = batch["_first"].to_numpy(zero_copy_only=False), batch["_second"].to_numpy(zero_copy_only=False)
            output = arrange(*cut(batch["_text"], first, second, block), batch["form"])
            yield pa.RecordBatch.from_arrays([*(batch[name] for name in names), output], names=schema.names)

    return planned.mapInArrow(run, schema).select(*(f"`{c}`" for c in kept), *RESULTS)


def restore(output: Column, form: Column) -> Column:
    """The text from its transformed form alone: markers occur nowhere but between the pieces."""
    second = F.when(form == SPM, F.lit(PREFIX)).otherwise(F.lit(SUFFIX))
    at, end = F.locate(SUFFIX, output), F.locate(MIDDLE, output)
    at = F.when(form == SPM, F.locate(PREFIX, output)).otherwise(at)
    width = F.char_length(second)
    one = F.substr(output, F.lit(len(PREFIX) + 1), at - len(PREFIX) - 1)
    two = F.substr(output, at + width, end - at - width)
    middle = F.substr(output, end + len(MIDDLE))
    return F.when(form == PLAIN, output).when(form == SPM, F.concat(two, middle, one)).otherwise(F.concat(one, middle, two))


#: DuckDB SQL for the digest columns of the query.
SQL = """
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, len(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents
), draws AS (
  SELECT *, ('0x' || d[1:8])::UBIGINT::BIGINT % (n + 1) AS a, ('0x' || d[9:16])::UBIGINT::BIGINT % (n + 1) AS b,
    ('0x' || d[17:24])::UBIGINT::BIGINT % 100 AS h3, ('0x' || d[25:32])::UBIGINT::BIGINT % 100 AS h4 FROM h
), forms AS (
  SELECT *, least(a, b) AS x, greatest(a, b) AS y,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM draws
), cuts AS (
  SELECT *, substring(t, 1, x) AS p, substring(t, x + 1, y - x) AS m, substring(t, y + 1, n - y) AS s FROM forms
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars, CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cuts
"""
