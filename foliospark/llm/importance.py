"""Quality classification by importance resampling.

Two generative models of hashed n-grams, one of target text (labelled as good
and not toxic) and one of all raw text, give each document an importance
weight, the product of its n-grams' probability ratios, judged against what good
documents of its length have. Gumbel noise is added
to the log weights and the k largest are kept: a sample without replacement in
proportion to the weights.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.bpe_tree import REMEMBERED, slices
from foliospark.llm.common import broadcast_if_small, give_back, sample_by_id, settled
from foliospark.llm.mixing import coin

#: Labelled documents the spread of good documents and the cut are fitted to, about; labels that are sent to all tasks, else labels are joined by shuffle.
LABELLED, SENT_LABELS = 40_000, 1_000_000
#: Buckets for n-grams of each order, and the orders.
BUCKETS, ORDERS = 1 << 18, 2
#: Share of the expected count that is added to observed and expected ones; share of false ratios among those that count; log weights are multiplied by this before noise.
PRIOR, FALSE, SHARPNESS = 0.05, 0.01, 10.0
#: Only n-grams are tested that could reach this level if the target had none of them.
TESTABLE = 1e-3

_TOKEN = re.compile(r"\w+|[^\w\s]+")


class Hasher:
    """Texts to buckets of words and marks (runs of other signs), lower case, and of neighbouring pairs.

    No word or mark holds white space, so what stands between white space is cut up once and its digests are remembered.
    """

    def __init__(self):
        self.known: dict[str, bytes] = {}

    def _digests(self, text: str) -> np.ndarray:
        parts, known = text.lower().split(), self.known
        try:
            found = b"".join(map(known.__getitem__, parts))
        except KeyError:
            if len(known) >= REMEMBERED:
                known.clear()
            for p in set(parts).difference(known):
                tokens = (p,) if p.isalnum() else _TOKEN.findall(p)
                known[p] = b"".join([zlib.crc32(t.encode()).to_bytes(8, "little") for t in tokens])
            found = b"".join(map(known.__getitem__, parts))
        return np.frombuffer(found, "<u8")

    def buckets(self, text: str | None) -> np.ndarray:
        one = self._digests(text or "")
        pair = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)
        return np.concatenate([one % np.uint64(BUCKETS), pair % np.uint64(BUCKETS) + np.uint64(BUCKETS)]).astype(np.int64)


def _distinct(buckets: np.ndarray) -> np.ndarray:
    found = np.sort(buckets.astype(np.int32))
    return found[np.flatnonzero(np.diff(found, prepend=-1))]


def ngram_counts(docs: DataFrame, text: str = "text", good: str = "good") -> tuple[np.ndarray, np.ndarray]:
    """Numbers of documents with each bucket: of all rows, and of those where ``good`` is true.

    Tasks count first; the results have ORDERS * BUCKETS numbers, whatever the
    input. Documents are counted, not occurrences, since those within one document
    depend on each other.
    """
    size = ORDERS * BUCKETS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = Hasher(), np.zeros((2, size), np.int64)
        for batch in batches:
            for part in slices(batch):
                found = [_distinct(hasher.buckets(t)) for t in part.column(text).to_pylist()]
                total[0] += np.bincount(np.concatenate(found), minlength=size)
                chosen = [f for f, g in zip(found, part.column(good).to_pylist()) if g]
                if chosen:
                    total[1] += np.bincount(np.concatenate(chosen), minlength=size)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])], ["bucket", "n", "n_good"])
        del hasher, total
        give_back()

    counts = docs.select(text, good).mapInArrow(count, "bucket long, n long, n_good long")
    sums = counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("n_good").alias("n_good")).toArrow()
    raw, target = np.zeros(size), np.zeros(size)
    raw[np.asarray(sums.column("bucket"))] = np.asarray(sums.column("n"))
    target[np.asarray(sums.column("bucket"))] = np.asarray(sums.column("n_good"))
    return raw, target


def log_ratios(target: np.ndarray, raw: np.ndarray) -> dict[int, float]:
    """Log ratios by bucket, those of 0 left out.

    A ratio is that of the target's count to the one expected from the raw text,
    both raised by PRIOR times the expected one, so equal rates give equal ratios at
    all sizes. It counts, whatever its sign, if its likelihood-ratio test is among
    those with at most a share FALSE of false ones (Benjamini and Hochberg). The
    target is a part of the raw text.
    """
    ratios = {}
    for order in range(ORDERS):
        part = slice(order * BUCKETS, (order + 1) * BUCKETS)
        n, seen = raw[part], target[part]
        share = seen.sum() / max(1.0, n.sum())
        if not 0 < share < 1:
            continue
        at = np.flatnonzero(-2 * n * math.log1p(-share) >= -2 * math.log(TESTABLE))
        n, seen = n[at], seen[at]
        expected, others = n * share, n - seen
        deviance = 2 * (seen * np.log(np.maximum(seen, 1) / expected) + others * np.log(np.maximum(others, 1) / (n - expected)))
        chance = np.array([math.erfc(math.sqrt(max(0.0, d) / 2)) for d in deviance.tolist()])
        passed = np.flatnonzero(np.sort(chance) <= FALSE * np.arange(1, len(at) + 1) / max(1, len(at)))
        if not len(passed):
            continue
        log = np.log((seen + PRIOR * expected) / (expected + PRIOR * expected))
        for k in np.flatnonzero(chance <= np.sort(chance)[passed[-1]]).tolist():
            ratios[order * BUCKETS + int(at[k])] = float(log[k])
    return ratios


def _summed(docs: DataFrame, ratios: dict[int, float], text: str, add: str, columns: Callable[[np.ndarray, np.ndarray], list[pa.Array]]) -> DataFrame:
    """Adds columns made of each text's sum of log ratios and number of n-grams."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, log = Hasher(), np.zeros(ORDERS * BUCKETS)
        log[list(ratios)] = list(ratios.values())
        for batch in batches:
            for part in slices(batch):
                found = [hasher.buckets(t) for t in part.column(text).to_pylist()]
                sums, sizes = np.array([log[f].sum() for f in found], float), np.array([len(f) for f in found], float)
                yield pa.RecordBatch.from_arrays([*part.columns, *columns(sums, sizes)], [*part.schema.names, *(c.split()[0] for c in add.split(", "))])
        del hasher, log
        give_back()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(weigh, f"{schema}, {add}")


#: Mean sum of log ratios of an n-gram, its variance, and the variance of means between documents.
Spread = tuple[float, float, float]


def good_spread(sums: np.ndarray, sizes: np.ndarray) -> Spread:
    """How the sums of good documents grow with their number of n-grams n: by mean * n, with a variance of own * n + between * n^2."""
    sums, sizes = sums[sizes > 0], sizes[sizes > 0]
    if not len(sums):
        return 0.0, 1.0, 0.0
    mean = float(sums.sum() / sizes.sum())
    square = (sums - mean * sizes) ** 2 / sizes
    least = 1.0 / float(sizes.sum())
    own, between = max(least, float(square.mean())), 0.0
    for _ in range(20):  # least squares of square on own + between * n, weighted by what was found before
        w = 1 / (own + between * sizes) ** 2
        w /= w.sum()
        middle, height = float((w * sizes).sum()), float((w * square).sum())
        wide = float((w * (sizes - middle) ** 2).sum())
        between = max(0.0, float((w * (sizes - middle) * square).sum()) / wide) if wide > 0 else 0.0
        own = max(least, height - between * middle)
    return mean, own, between


def log_weights(docs: DataFrame, ratios: dict[int, float], spread: Spread, text: str = "text") -> DataFrame:
    """Adds log_weight: by how many standard deviations of good documents of its length a text's sum is above theirs (0 for a text without n-grams)."""
    mean, own, between = spread

    def standard(sums: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
        n = np.maximum(sizes, 1)
        return [pa.array((sums - mean * sizes) / np.sqrt(own * n + between * n * n), pa.float64())]

    return _summed(docs.drop("log_weight"), ratios, text, "log_weight double", standard)


def best_cut(weights: np.ndarray, good: np.ndarray, lose: float = 0.01) -> float:
    """The cut with most right decisions among those that lose at most this share of good documents."""
    if not good.any():
        return -math.inf
    highest = float(np.quantile(weights[good], lose))
    cuts = np.unique(np.append(weights[weights <= highest], highest))
    order = np.sort(weights[good]), np.sort(weights[~good])
    right = len(order[0]) - np.searchsorted(order[0], cuts) + np.searchsorted(order[1], cuts)
    k = int(np.argmax(right))
    below = weights[weights < cuts[k]]
    return float((cuts[k] + below.max()) / 2) if len(below) else float(cuts[k])


def kth_largest(keys: DataFrame, column: str, k: int, bins: int = 4096) -> float:
    """The k-th largest value, by histograms that narrow in on it; bounded counts come to the driver, never rows."""
    low, high = keys.agg(F.min(column), F.max(column)).first()
    if low is None or k <= 0:
        return math.inf
    while True:
        inside = keys.where((F.col(column) >= low) & (F.col(column) <= high))
        width = (high - low) / bins
        if width == 0 or low + width == low:
            return low
        bin_ = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("int").alias("bin")
        parts = inside.groupBy(bin_).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for part in sorted(parts, key=lambda r: -r["bin"]):
            if part["n"] >= k:
                break
            k -= part["n"]
        if part["low"] == part["high"] or k == 1 and part["n"] == 1:
            return part["high"]
        low, high = part["low"], part["high"]


class Model:
    """The ratios, the spread of good documents, the cut of log weights, and the smallest key that is kept."""

    def __init__(self, ratios: dict[int, float], spread: Spread, cut: float, least: float):
        self.ratios, self.spread, self.cut, self.least = ratios, spread, cut, least


def _key(log_weight: Column) -> Column:
    """Log weight with Gumbel noise, seeded by the row's id, or by its text where it has none."""
    seed = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    noise = -F.log(-F.log((coin(seed, "gumbel") * (1 << 52) + 0.5) / float(1 << 52)))
    return log_weight * SHARPNESS + noise


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits both models, the cut and the sample's size.

    The raw model is that of all rows of ``docs``, the target model that of all
    rows labelled good. The spread of good documents by length, and the cut between
    good and other documents, come from about LABELLED labelled rows, chosen by digest
    of the id. The sample's size k is the number of rows above the cut.
    Without usable labels everything is kept.
    """
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.min((F.col("quality") == 1) & ~(F.coalesce("toxic", F.lit(0)) == 1))).alias("good"))
    marks = settled(marks)
    docs = docs.select("doc_id", "text")
    raw, target = ngram_counts(docs.join(broadcast_if_small(marks, SENT_LABELS), "doc_id", "left"))
    ratios = log_ratios(target, raw)
    marked = docs.join(broadcast_if_small(sample_by_id(marks, "doc_id", LABELLED), 2 * LABELLED), "doc_id")
    seen = settled(_summed(marked, ratios, "text", "total double, n double", lambda sums, sizes: [pa.array(sums), pa.array(sizes)]).select("good", "total", "n")).toArrow()
    good, sums, sizes = (np.asarray(seen.column(c)).astype(t) for c, t in (("good", bool), ("total", float), ("n", float)))
    mean, own, between = spread = good_spread(sums[good], sizes[good])
    n = np.maximum(sizes, 1)
    cut = best_cut((sums - mean * sizes) / np.sqrt(own * n + between * n * n), good)
    keys = settled(log_weights(docs, ratios, spread).select("log_weight", _key(F.col("log_weight")).alias("key")))
    return Model(ratios, spread, cut, kth_largest(keys, "key", keys.where(F.col("log_weight") >= cut).count()))


def resample(docs: DataFrame, model: Model) -> DataFrame:
    """Adds log_weight, sample_key and keep (whether the key is among the k largest; equal keys go together).

    Null and empty texts have log weight 0. Rows without an id are told apart
    by their text. Columns of those names are replaced.
    """
    weighed = log_weights(docs, model.ratios, model.spread).withColumn("sample_key", _key(F.col("log_weight")))
    return weighed.withColumn("keep", F.col("sample_key") >= model.least)
