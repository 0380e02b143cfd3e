"""N-gram Jaccard join with signature trees.

Every document is the set of its word shingles. Documents that may be similar
are brought together by keys that any two similar sets share, and each family
so found is joined with itself by a signature tree: leaves hold a few sets,
every node the OR of their token bitmaps and their range of sizes. A dual
traversal goes down from pairs of nodes and drops a pair when even the largest
overlap that its bitmaps and sizes allow is too small; what is left at the
leaves is counted exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.bpe_tree import REMEMBERED, slices
from foliospark.llm.common import give_back, settled, stored
from foliospark.llm.components import connected

#: Sets that one task joins with as many others; larger families are dealt out as pairs of blocks.
BLOCK = 4096
#: Keys that a task combines before it hands them on.
COMBINE = 1 << 21
LEAF, FANOUT = 8, 8
#: Pairs of leaves that are looked at together.
PAIRS = 256
#: Counters in which tokens are counted for their order, as a power of two, and counters of one row.
COUNTERS, CHUNK = 25, 1 << 16

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Texts to sorted distinct 64-bit digests of their word shingles."""

    def __init__(self, width: int):
        self.width = width
        self.known: dict[bytes, bytes] = {}

    @staticmethod
    def _words(text: str | None) -> list[bytes]:
        return (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only

    def _digests(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        try:
            found = b"".join(map(known.__getitem__, words))
        except KeyError:
            if len(known) >= REMEMBERED:
                known.clear()
            for w in set(words).difference(known):
                known[w] = xxhash.xxh3_64_intdigest(w).to_bytes(8, "little")
            found = b"".join(map(known.__getitem__, words))
        return np.frombuffer(found, "<u8")

    @staticmethod
    def _mix(digests: np.ndarray, width: int) -> np.ndarray:
        count = len(digests) - width + 1
        mix = np.full(count, np.uint64(width), np.uint64)
        for i in range(width):
            mix = mixed(mix * _M1 + digests[i : i + count])
        return mix

    def tokens(self, text: str | None) -> np.ndarray:
        words = self._words(text)
        if not words:
            return np.empty(0, np.uint64)
        mix = self._mix(self._digests(words), min(self.width, len(words)))
        mix.sort()
        return mix[np.concatenate(([True], mix[1:] != mix[:-1]))]

    def all_tokens(self, texts: list[str | None]) -> np.ndarray:
        """The digests of several texts together, unsorted and as often as they occur; those of texts with fewer words than a shingle are left out."""
        parts = [d for t in texts if len(d := self._digests(self._words(t))) >= self.width]
        if not parts:
            return np.empty(0, np.uint64)
        mix = self._mix(np.concatenate(parts), self.width)
        whole = np.ones(len(mix) + self.width - 1, bool)
        ends = np.cumsum([len(d) for d in parts])
        for i in range(1, self.width):
            whole[ends - i] = False  # begins in one text and ends in the next
        return mix[whole[: len(mix)]]


class Bands:
    """Keys that two sets share whenever their similarity is at least num / den.

    Two such sets differ in at most k tokens, k following from their sizes. If
    tokens are dealt by digest into k + 1 parts, one part is the same in both.
    Small parts would be shared by chance, so each set leaves out its ``spare``
    smallest ones, and the parts are 2 * spare more. The number of parts belongs
    to a band of sizes; sets near a band's end have keys of the next one too.
    Where parts would hold too few tokens (low thresholds), the keys are the
    first tokens in an order of all tokens instead: sets of n tokens share one
    of their first n - ceil(n * num / den) + 1. Any order will do; this one has
    rare tokens first (``order`` is the class of each counter, see
    ``token_order``), so that passages which many documents share don't bring
    those together.
    """

    def __init__(self, num: int, den: int, order: np.ndarray | None = None):
        if not 0.7 * den <= num <= den:
            raise ValueError("similarities from 0.7 to 1")
        self.order = order
        self.num, self.den = num, den
        self.by_prefix = (den - num) / (den + num) * 3 > 0.2
        self.starts = [1]

    def _band(self, n: int) -> int:
        while self.starts[-1] <= n:
            self.starts.append(max(self.starts[-1] + 1, self.starts[-1] * 3 // 2))
        lo, hi = 0, len(self.starts) - 1
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if self.starts[mid] <= n else (lo, mid)
        return lo

    def _parts(self, band: int) -> tuple[int, int]:
        low, high = self.starts[band], self.starts[band + 1] - 1
        most = (self.den - self.num) * 2 * high // (self.den + self.num)
        spare = 0
        for _ in range(8):
            parts = most + 1 + 2 * spare
            empty = parts * math.exp(-low / parts) if parts > 1 else 0
            spare = math.ceil(empty + 3 * math.sqrt(empty)) if empty > 0.01 else 0
        return most + 1 + 2 * spare, spare

    def keys(self, tokens: np.ndarray, longer: bool = False) -> np.ndarray:
        """With ``longer`` a set has more keys than it needs, ``_more`` says how many; see ``_by_rare_keys``."""
        n = len(tokens)
        if n == 0:
            return np.empty(0, np.uint64)
        if self.by_prefix:
            if self.order is not None:
                tokens = tokens[np.argsort(self.order[_counter(tokens)], kind="stable")]
            return tokens[: n - -(-n * self.num // self.den) + 1 + (_more(n) if longer else 0)]
        largest = n * self.den // self.num
        band = self._band(n)
        self._band(self.starts[band + 1])
        out = []
        for scheme in {band, self._band(largest)}:
            self._band(self.starts[scheme] * 3)
            parts, spare = self._parts(scheme)
            spread = mixed(tokens + np.uint64(scheme * int(_M1) & 0xFFFFFFFFFFFFFFFF))
            part = ((spread >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            sums = np.zeros(parts, np.uint64)
            np.add.at(sums, part, mixed(spread))
            counts = np.bincount(part, minlength=parts)
            emit = (self.den - self.num) * (n + largest) // (self.den + self.num) + 1 + 2 * spare
            chosen = np.argsort(counts[:emit], kind="stable")[spare:]
            out.append(mixed(sums[chosen] + counts[chosen].astype(np.uint64) * _M2 + (chosen + parts * 1000003).astype(np.uint64) * _M1))
        return np.concatenate(out)


class SignatureTree:
    """Sets in leaves of LEAF, nodes of FANOUT; each node knows the OR of bitmaps, the sizes, and by how much bitmaps fall short of sizes."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: (sets[i][0] if len(sets[i]) else 0, len(sets[i])))
        self.sets = [sets[i] for i in self.order]
        sizes = np.array([len(s) for s in self.sets], np.int64)
        self.bits = 1 << min(17, max(8, int(sizes.max() * 4).bit_length()))
        maps = np.zeros((len(sets), self.bits // 64), np.uint64)
        row = np.zeros(self.bits, bool)
        for k, s in enumerate(self.sets):
            at = (mixed(s) & np.uint64(self.bits - 1)).astype(np.int64)
            row[at] = True
            maps[k] = np.packbits(row).view(np.uint64)
            row[at] = False
        slack = sizes - np.bitwise_count(maps).sum(1).astype(np.int64)
        self.levels = [(maps, sizes, sizes, slack)]
        width = LEAF
        while True:
            maps, low, high, slack = self.levels[-1]
            at = np.arange(0, len(maps), width)
            self.levels.append((np.bitwise_or.reduceat(maps, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(slack, at)))
            if len(at) == 1:
                break
            width = FANOUT

    def possible(self, level: int, i: np.ndarray, j: np.ndarray, num: int, den: int) -> np.ndarray:
        """Which pairs of nodes may hold a similar pair."""
        maps, low, high, slack = self.levels[level]
        ok = (high[i] * den >= low[j] * num) & (high[j] * den >= low[i] * num)
        step = max(1, (1 << 22) // maps.shape[1])
        for at in range(0, len(i), step):
            part = np.flatnonzero(ok[at : at + step]) + at
            a, b = i[part], j[part]
            common = np.bitwise_count(maps[a] & maps[b]).sum(1).astype(np.int64) + np.minimum(slack[a], slack[b])
            most = np.minimum(common, np.minimum(high[a], high[b]))
            ok[part] = most * (den + num) >= num * (low[a] + low[b])
        return ok

    def _labels(self, label: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The smallest and largest component number in each node of each level."""
        found, width = [(label, label)], LEAF
        for _ in self.levels[1:]:
            low, high = found[-1]
            at = np.arange(0, len(low), width)
            found.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))
            width = FANOUT
        return found

    @staticmethod
    def _apart(labels: tuple[np.ndarray, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs of nodes hold more than one component between them."""
        low, high = labels
        return np.minimum(low[i], low[j]) != np.maximum(high[i], high[j])

    def links(self, num: int, den: int, sides: np.ndarray | None = None, spanning: bool = True) -> list[tuple[int, int]]:
        """Pairs (positions in the given order) whose similarity is at least num / den.

        ``sides`` limits them to pairs of different sides. With ``spanning``
        pairs that are connected already are not looked at again, so that a
        family of n near copies takes about n exact counts, not n * n.
        """
        n = len(self.sets)
        label = np.arange(n)
        side = np.zeros(n, np.int64) if sides is None else sides[self.order]
        found = []
        offsets = np.arange(LEAF)

        def compare(x: np.ndarray, y: np.ndarray) -> None:
            """Sets of pairs of leaves, one by one, in the order given."""
            if spanning:
                apart = self._apart(self._labels(label)[1], x, y)
                x, y = x[apart], y[apart]
            a, b = (x[:, None] * LEAF + offsets)[:, :, None], (y[:, None] * LEAF + offsets)[:, None, :]
            a, b = (v.ravel() for v in np.broadcast_arrays(a, b))
            ok = (a < b) & (b < n)
            a, b = a[ok], b[ok]
            ok = np.ones(len(a), bool) if sides is None else side[a] != side[b]
            if spanning:
                ok &= label[a] != label[b]
            a, b = a[ok], b[ok]
            ok = self.possible(0, a, b, num, den)
            for p, q in zip(a[ok].tolist(), b[ok].tolist()):
                if spanning and label[p] == label[q]:
                    continue
                small, large = sorted((self.sets[p], self.sets[q]), key=len)
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                if both * den >= (len(small) + len(large) - both) * num:
                    found.append((self.order[p], self.order[q]))
                    label[label == label[q]] = label[p]

        leaves = len(self.levels[1][1])
        if spanning:
            # Near copies are neighbours in the order: these tie most of a family, so that the
            # traversal finds whole nodes in one component and leaves them out.
            for start in range(0, leaves, 16):
                x = np.arange(start, min(start + 16, leaves))
                compare(x, x)
                compare(x[x + 1 < leaves], x[x + 1 < leaves] + 1)
        one = self._labels(label) if spanning else None
        level = len(self.levels) - 1
        i = j = np.zeros(1, np.int64)
        while level > 1:
            if spanning:
                open_pairs = self._apart(one[level], i, j)
                i, j = i[open_pairs], j[open_pairs]
            level -= 1
            below = len(self.levels[level][1])
            a = (i[:, None] * FANOUT + np.arange(FANOUT)[None])[:, :, None]
            b = (j[:, None] * FANOUT + np.arange(FANOUT)[None])[:, None, :]
            a, b = (x.ravel() for x in np.broadcast_arrays(a, b))
            fits = (a <= b) & (b < below)
            a, b = a[fits], b[fits]
            ok = (a == b) | self.possible(level, a, b, num, den)
            i, j = a[ok], b[ok]
        if spanning:
            open_pairs = self._apart(one[1], i, j)
            i, j = i[open_pairs], j[open_pairs]
        nearest = np.argsort(j - i, kind="stable")
        for start in range(0, len(nearest), PAIRS):
            part = nearest[start : start + PAIRS]
            compare(i[part], j[part])
        return found


def _columns(text: str, doc_id: str):
    return [F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")]


def _counter(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - COUNTERS)).astype(np.int64)


def token_order(docs: DataFrame, width: int) -> bytes:
    """How often tokens occur in all of the texts: twice the binary logarithm of each counter, compressed.

    Tokens that share a counter are counted together; a task counts to 255. That only
    fixes the order in which tokens become keys; links never depend on it. The
    counters' number is fixed, whatever the input, and rows of them are added up by shuffle.
    """
    size = 1 << COUNTERS
    row = min(CHUNK, size)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, total = Shingler(width), np.zeros(size, np.uint8)
        for batch in batches:
            for part in slices(batch):
                at, n = np.unique(_counter(shingler.all_tokens(part.column("text").to_pylist())), return_counts=True)
                total[at] = np.minimum(total[at] + n, 255)
        rows = total.reshape(-1, row)
        for k in np.flatnonzero(rows.any(1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([pa.compress(rows[k].tobytes(), "zstd", asbytes=True)], pa.binary())], ["chunk", "counts"])
        del shingler, total, rows
        give_back()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column("chunk").to_pylist(), b.column("counts").to_pylist()))
        for k, group in groupby(rows, key=lambda r: r[0]):
            total = np.zeros(row, np.int64)
            for _, counts in group:
                total += np.frombuffer(pa.decompress(counts, row, "zstd", asbytes=True), np.uint8)
            classes = (2 * np.log2(np.maximum(total, 1))).astype(np.int8).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([classes], pa.binary())], ["chunk", "classes"])

    counts = docs.select("text").mapInArrow(count, "chunk int, counts binary")
    sums = counts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, "chunk int, classes binary").toArrow()
    order = np.zeros((size // row, row), np.int8)
    for k, classes in zip(sums.column("chunk").to_pylist(), sums.column("classes").to_pylist()):
        order[k] = np.frombuffer(classes, np.int8)
    return pa.compress(order.tobytes(), "zstd", asbytes=True)


def _more(n: int) -> int:
    """Keys of a set of n tokens beyond those it needs."""
    return max(n // 20, min(4, n // 5))


def _spare(n: Column, num: int, den: int) -> Column:
    """Keys that a set of n tokens may leave out again: ``_more`` of the least size of a similar set."""
    least = F.floor((n * num + den - 1) / den)
    return F.greatest(F.floor(least / 20), F.least(F.lit(4), F.floor(least / 5)))


def _combined(keys: list[np.ndarray], ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with its first document; other documents of the key are tied to that one by keys of their own."""
    doc = np.repeat(np.array(ids, np.int64), [len(k) for k in keys])
    key = np.concatenate(keys)
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    first = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
    tie = np.unique(np.stack([doc, first], 1)[doc != first], axis=0)
    name = mixed(mixed(tie[:, 0].astype(np.uint64) * _M1) + tie[:, 1].astype(np.uint64) * _M2)
    return np.concatenate([key[new], name, name]), np.concatenate([doc[new], tie[:, 0], tie[:, 1]])


def sets_and_keys(docs: DataFrame, width: int, num: int, den: int, order: bytes | None = None, longer: bool = False) -> DataFrame:
    """In one pass over the texts: for each row doc_id, n_shingles and a digest of the whole set, and rows (key, doc_id) of the join keys.

    A task hands on each key once: documents in it that share a key are tied by
    a key of their own instead. So a key has a row for each task, not for each
    document, however many share it.

    With ``longer`` rows of join keys are (key, digest) instead, so that all sets
    of a key can be counted; a task hands on each set's keys once as a rule.
    """

    def rows(doc, key, count, digest) -> pa.RecordBatch:
        none = pa.nulls(len(key if doc is None else doc), pa.int64())
        columns = [none if c is None else pa.array(c, pa.int64()) for c in (doc, key, count, digest)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n_shingles", "digest"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        bands = Bands(num, den, None if order is None else np.frombuffer(pa.decompress(order, 1 << COUNTERS, "zstd"), np.int8))
        keys, ids, held = [], [], 0
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch):
                docs_of, sizes, digests = part.column("doc_id").to_pylist(), [], []
                for doc, text in zip(docs_of, part.column("text").to_pylist()):
                    tokens = shingler.tokens(text)
                    sizes.append(len(tokens))
                    digests.append(xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63))
                    if doc is None or longer and digests[-1] in seen:
                        continue
                    found = bands.keys(tokens, longer)
                    if len(found):
                        keys.append(found)
                        ids.append(digests[-1] if longer else doc)
                        held += len(found)
                yield rows(docs_of, None, sizes, digests)
                if longer:
                    if keys:
                        digest = np.repeat(np.array(ids, np.int64), [len(k) for k in keys])
                        yield rows(None, np.concatenate(keys).view(np.int64), None, digest)
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.update(ids)
                    keys, ids, held = [], [], 0
                elif held >= COMBINE:
                    key, doc = _combined(keys, ids)
                    yield rows(doc, key.view(np.int64), None, None)
                    keys, ids, held = [], [], 0
        if keys:
            key, doc = _combined(keys, ids)
            yield rows(doc, key.view(np.int64), None, None)
        del shingler, bands, keys, ids, seen
        give_back()

    return docs.mapInArrow(emit, "doc_id long, key long, n_shingles long, digest long")


def _token_rows(docs: DataFrame, width: int) -> DataFrame:
    """The sets themselves, as bytes."""
    keep = [f for f in docs.schema.fields if f.name != "text"]
    names = [f.name for f in keep]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Shingler(width).tokens
        for batch in batches:
            for part in slices(batch):
                found = pa.array([tokens(t).tobytes() for t in part.column("text").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), found], [*names, "tokens"])
        del tokens
        give_back()

    return docs.select(*names, "text").mapInArrow(add, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep) + ", tokens binary")


def _rows(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part in slices(batch, 256):
            yield from zip(*(part.column(c).to_pylist() for c in ("family", "band", "low", "high", "block", "doc_id", "tokens")))


def tree_links(rows: DataFrame, num: int, den: int, spanning: bool) -> DataFrame:
    """Links (a, b) within each group of rows (family, band, low, high): of one block with itself, or of two blocks with each other."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for (_, _, low, high), group in groupby(_rows(batches), key=lambda r: r[:4]):
            group = list(group)
            if len(group) > 1:
                sides = None if low == high else np.array([r[4] for r in group])
                tree = SignatureTree([np.frombuffer(r[6], np.uint64) for r in group])
                out += [(group[p][5], group[q][5]) for p, q in tree.links(num, den, sides, spanning)]
            if len(out) >= 8192:
                yield _pairs(out)
                out = []
        yield _pairs(out)
        give_back()

    groups = ["family", "band", "low", "high"]
    return rows.repartition(*groups).sortWithinPartitions(*groups, "doc_id").mapInArrow(join, "a long, b long")


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])


def _families(keys: DataFrame) -> DataFrame:
    """doc_id and family of the documents that share keys with others; similar ones are always of one family."""
    first = F.min("doc_id").over(Window.partitionBy("key"))
    edges = keys.select(F.col("doc_id").alias("a"), first.alias("b")).where("a > b")
    return connected(edges).select(F.col("node").alias("doc_id"), F.col("component").alias("family"))


def _by_rare_keys(keys: DataFrame, firsts: DataFrame, num: int, den: int) -> DataFrame:
    """digest and family of the sets that share rare keys with others, of the ``longer`` keys (key, digest); similar ones are always of one family.

    A set of n tokens of which t = ceil(n * num / den) must be shared has its first
    n - t + 1 + _more(n) tokens as keys, so two similar sets share at least
    1 + _more(m) of them, m being the smaller size, which is t or more. So each may leave
    out _more(t) of its keys, if all sets agree on which go first: those that
    most sets have, as counted exactly here. What is left still meets. Keys of one set alone
    tie nothing and go before that. So sets are brought together by what is rare among all of them,
    however many tokens share a counter of ``token_order``.
    """
    every = Window.partitionBy("key")
    counted = keys.select("key", "digest", F.count("*").over(every).alias("often"), F.min("digest").over(every).alias("_least"), F.max("digest").over(every).alias("_last"))
    shared = counted.where("_least < _last").select("key", "digest", "often")
    sized = shared.join(firsts.select("digest", "n_shingles").hint("merge"), "digest")
    # A set that several tasks have has several rows of a key, of one rank.
    rank = F.dense_rank().over(Window.partitionBy("digest").orderBy(F.desc("often"), F.desc("key")))
    kept = sized.withColumn("_rank", rank).where(F.col("_rank") > _spare(F.col("n_shingles"), num, den))
    return _families(kept.select("key", F.col("digest").alias("doc_id"))).withColumnRenamed("doc_id", "digest")


def _by_size(firsts: DataFrame, num: int, den: int) -> DataFrame:
    """Adds ``band``: families of more than BLOCK sets are divided by size, each size at most twice the least of its band.

    Sets whose sizes differ by more than num / den aren't similar. One that is
    near enough to the least size of its band to have similar ones in the band below is in
    that one too, so two similar sets always share a band. Other families are of one band.
    """
    sizes = firsts.groupBy("family").agg(F.count("*").alias("sets"))
    band = F.length(F.bin("n_shingles")) - 1
    below = F.col("n_shingles") * num < F.expr("shiftleft(1L, length(bin(n_shingles)) - 1)") * den
    bands = F.when(F.col("sets") <= BLOCK, F.array(F.lit(0))).when(below, F.array(band - 1, band)).otherwise(F.array(band))
    return firsts.join(sizes.hint("merge"), "family").withColumn("band", F.explode(bands)).drop("sets")


def similar(docs: DataFrame, width: int = 3, num: int = 90, den: int = 100, text: str = "text", doc_id: str = "doc_id", spanning: bool = True) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets, and the links between them.

    Returns ``classes`` (doc_id, n_shingles, representative: the smallest id
    with the same set) and ``links`` (a, b) between representatives, where
    den * intersection >= num * union. With ``spanning`` enough links to connect
    whatever is linked, else all of them.

    Null, empty and blank texts have no shingles and no links. Texts of fewer
    words than ``width`` have one shingle. Rows without an id have no
    representative and no links; rows of one id count as one document.
    Other columns are ignored. An empty table gives empty results.
    """
    docs = docs.select(*_columns(text, doc_id))
    by_prefix = Bands(num, den).by_prefix
    order = token_order(docs, width) if by_prefix else None
    found = stored(sets_and_keys(docs, width, num, den, order, longer=by_prefix))
    info = found.where(F.col("key").isNull()).select("doc_id", "n_shingles", "digest")
    keys = found.where(F.col("key").isNotNull())
    first = F.min("doc_id").alias("representative"), F.min("n_shingles").alias("n_shingles")
    if by_prefix:
        whole = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
        sets = settled(info.where(whole).groupBy("digest").agg(*first))
        families = _by_rare_keys(keys.select("key", "digest"), sets, num, den)
        firsts = settled(sets.join(families.hint("merge"), "digest"))
        classes = info.where(whole).join(sets.select("digest", "representative").hint("merge"), "digest")
        classes = classes.unionByName(info.where(~whole), allowMissingColumns=True)
    else:
        families = _families(keys.select("key", "doc_id"))
        member = settled(info.join(families.hint("merge"), "doc_id"))
        firsts = settled(member.groupBy("family", "digest").agg(*first))
        known = member.select("doc_id", "digest", "family").distinct().join(firsts.drop("n_shingles").hint("merge"), ["family", "digest"])
        classes = info.join(known.select("doc_id", "digest", "representative").hint("merge"), ["doc_id", "digest"], "left")
    banded = _by_size(firsts, num, den)
    sizes = banded.groupBy("family", "band").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("representative"), blocks).cast("int")
    chosen = banded.join(sizes.hint("merge"), ["family", "band"]).select("family", "band", F.col("representative").alias("doc_id"), block.alias("block"), blocks.alias("blocks"))
    rows = _token_rows(chosen.join(docs.hint("merge"), "doc_id"), width)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("family", "band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "doc_id", "tokens")
    links = tree_links(rows, num, den, spanning)
    if not spanning:  # two bands may have found the same link
        links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = settled(links)
    own = F.when(F.col("n_shingles") > 0, F.coalesce("representative", "doc_id")).otherwise(F.col("doc_id"))
    return classes.select("doc_id", "n_shingles", own.alias("representative")), links


def jaccard_components(docs: DataFrame, width: int = 3, num: int = 90, den: int = 100, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id reachable by links (its own if it has none). See ``similar``."""
    classes, links = similar(docs, width, num, den, text, doc_id)
    linked = connected(links).select(F.col("node").alias("representative"), "component")
    joined = classes.join(linked.hint("merge"), "representative", "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "representative").alias("component_id"))
