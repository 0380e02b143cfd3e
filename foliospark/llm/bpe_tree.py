"""Byte-level BPE encoding and decoding as a reduction over a tree.

Concatenation of texts is a monoid; so is that of their encodings, if the
product of two encodings repairs the seam. ``BytePairs.join`` is that product:
it encodes again a window around the seam, which grows until both its borders
are stable. Texts are halved, the halves encoded by themselves and joined.

Why a border is stable: merges run by rank, leftmost first. As long as no merge
has crossed a token border, the bytes on either side evolve as if they were
alone. So a border of a sequence of tokens is crossed if and only if it is
crossed in the encoding of its two neighbours alone: a sequence is *the*
encoding of its bytes exactly if each two neighbours encode to themselves.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from foliospark.llm.common import give_back

#: Pieces whose encoding a task remembers; beyond, it forgets all and starts anew.
REMEMBERED = 1 << 19
#: Bytes of a piece, and code points of a text, that are encoded without halving.
LEAF_BYTES, LEAF_CHARS = 4, 1 << 12
#: Bytes of subtrees whose encoding a task remembers: words share them, so most joins of a new word are at its top.
SHARED_BYTES = 8


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class BytePairs:
    """Merges of one vocabulary: any two neighbours whose bytes together are a token may merge, lowest rank first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.seams: dict[tuple[int, int], list[int]] = {}
        self.subtrees: dict[bytes, list[int]] = {}
        self.joins = 0

    @cached_property
    def tokens(self) -> pa.Array:
        """The bytes of each rank; null for numbers that are no rank."""
        return pa.array([self.token.get(k) for k in range(max(self.token, default=-1) + 1)], pa.large_binary())

    def merged(self, data: bytes) -> list[int]:
        """The encoding by its definition. A heap of possible merges keeps long inputs near-linear."""
        ranks = self.ranks
        if len(data) <= 48:
            parts = [data[i : i + 1] for i in range(len(data))]
            no = 1 << 60
            seams = [ranks.get(data[i : i + 2], no) for i in range(len(data) - 1)]
            while seams and (best := min(seams)) < no:
                i = seams.index(best)
                parts[i] += parts.pop(i + 1)
                del seams[i]
                if i < len(seams):
                    seams[i] = ranks.get(parts[i] + parts[i + 1], no)
                if i:
                    seams[i - 1] = ranks.get(parts[i - 1] + parts[i], no)
            return [ranks[p] for p in parts]
        end = len(data)
        follows, before, stop = list(range(1, end + 1)), list(range(-1, end - 1)), list(range(1, end + 1))
        alive = bytearray(b"\1") * end
        heap = [(r, i, i + 2) for i in range(end - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, till = heapq.heappop(heap)
            j = follows[i]
            if not alive[i] or j >= end or stop[j] != till:
                continue  # one of the two has changed since
            stop[i], follows[i], alive[j] = till, follows[j], 0
            if follows[i] < end:
                before[follows[i]] = i
                if (r := ranks.get(data[i : stop[follows[i]]])) is not None:
                    heapq.heappush(heap, (r, i, stop[follows[i]]))
            if before[i] >= 0 and (r := ranks.get(data[before[i] : till])) is not None:
                heapq.heappush(heap, (r, before[i], till))
        return [ranks[data[i : stop[i]]] for i in range(end) if alive[i]]

    def seam(self, a: int, b: int) -> list[int]:
        """The encoding of two neighbours' bytes together."""
        known = self.seams.get((a, b))
        if known is None:
            if len(self.seams) >= REMEMBERED:
                self.seams.clear()
            known = self.seams[a, b] = self.merged(self.token[a] + self.token[b])
        return known

    def is_stable(self, a: int, b: int) -> bool:
        """Whether two tokens side by side encode to themselves."""
        return self.seam(a, b) == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encodings' bytes together."""
        if not left or not right:
            return left or right
        self.joins += 1
        i, j, step = len(left) - 1, 1, 1
        window = self.seam(left[-1], right[0])
        while True:
            left_ok = i == 0 or window[0] == left[i] or self.is_stable(left[i - 1], window[0])
            right_ok = j == len(right) or window[-1] == right[j - 1] or self.is_stable(window[-1], right[j])
            if left_ok and right_ok:
                return left[:i] + window + right[j:]
            i, j, step = i if left_ok else max(0, i - step), j if right_ok else min(len(right), j + step), step * 2
            window = self.merged(b"".join(self.token[t] for t in chain(left[i:], right[:j])))

    def encode(self, data: bytes) -> list[int]:
        size = len(data)
        if size > SHARED_BYTES:
            return self.join(self.encode(data[: size // 2]), self.encode(data[size // 2 :]))
        known = self.subtrees.get(data)
        if known is None:
            if len(self.subtrees) >= REMEMBERED:
                self.subtrees.clear()
            half = size // 2
            known = self.merged(data) if size <= LEAF_BYTES else self.join(self.encode(data[:half]), self.encode(data[half:]))
            self.subtrees[data] = known
        return known

    def encode_piece(self, data: bytes) -> list[int]:
        """One match of the splitting pattern: whole tokens stay whole."""
        rank = self.ranks.get(data)
        return [rank] if rank is not None else self.encode(data)


class TextEncoder:
    """Encodes texts: the pattern's matches are tree elements too, so long texts are halved before they are split.

    A match that starts at p depends on what follows p only. It is stable
    under more text to its right if what the pattern looked at ended before the
    text did: one code point after the match, and ``reach`` code points from p.
    """

    def __init__(self, pairs: BytePairs, pattern: str, reach: int = 3):
        self.pairs, self.pattern, self.reach = pairs, regex.compile(pattern), reach
        #: Ids of pieces as 32-bit numbers, so that those of a text are put together without a Python number each.
        self.known: dict[str, bytes] = {}

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        known = self.known
        try:
            return list(map(known.__getitem__, pieces))
        except KeyError:
            pass
        if len(known) >= REMEMBERED:
            known.clear()
        long = {}
        for p in set(pieces).difference(known):
            (known if len(p) <= 64 else long)[p] = array("i", self.pairs.encode_piece(p.encode())).tobytes()
        return [long[p] if p in long else known[p] for p in pieces] if long else list(map(known.__getitem__, pieces))

    def _tree(self, text: str) -> tuple[list[str], list[bytes]]:
        if len(text) <= LEAF_CHARS:
            pieces = self.pattern.findall(text)
            return pieces, self._encoded(pieces)
        half = len(text) // 2
        return self._join(self._tree(text[:half]), self._tree(text[half:]))

    def _join(self, left, right):
        (pieces, ids), (more, more_ids) = left, right
        keep, open_chars = len(pieces), 0
        while keep and (open_chars < 1 or open_chars + len(pieces[keep - 1]) < self.reach):
            keep -= 1
            open_chars += len(pieces[keep])
        tail, take = "".join(pieces[keep:]), 4
        while True:
            window = tail + "".join(more[:take])
            found = self.pattern.findall(window)
            borders, at = {}, len(tail)
            for k in range(min(take, len(more))):
                borders[at] = k
                at += len(more[k])
            if take >= len(more):
                borders[at] = len(more)
            at = 0
            for k, piece in enumerate([*found, ""]):
                whole = take >= len(more) or at + self.reach <= len(window)
                if at in borders and whole:
                    d = borders[at]
                    again = found[:k]
                    return pieces[:keep] + again + more[d:], ids[:keep] + self._encoded(again) + more_ids[d:]
                at += len(piece)
            take *= 2

    def id_bytes(self, text: str | None) -> bytes:
        """The ids of a text as 32-bit numbers; none for a null text."""
        return b"".join(self._tree(text)[1]) if text else b""

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.id_bytes(text), np.int32).tolist()

    def encode_all(self, texts: list[str | None]) -> pa.ListArray:
        """The ids of each text."""
        found = [self.id_bytes(t) for t in texts]
        ends = np.cumsum([0, *(len(f) // 4 for f in found)], dtype=np.int64)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int32)))

    def forget(self, all_: bool = False) -> None:
        """Drops the pieces, as a task does at its end: its worker may live on beside others. Subtrees, which take less and save most, stay unless all are to go."""
        self.known.clear()
        if all_:
            self.pairs.subtrees.clear()
            self.pairs.seams.clear()
            give_back()


_ENCODERS: dict[tuple[str, str], TextEncoder] = {}


def encoder(path: str, pattern: str) -> TextEncoder:
    """One encoder for each Python worker."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = TextEncoder(BytePairs(load_ranks(path)), pattern)
    return _ENCODERS[path, pattern]


def decode(tokens: pa.Array, ids: pa.Array) -> pa.Array:
    """The bytes that each list of ids stands for: the product of encodings, concatenation, for all lists at once. Null for a null list."""
    if not len(ids):
        return pa.array([], pa.binary())
    found = tokens.take(ids.flatten())
    if found.null_count:
        raise KeyError("an id that is null or no token")
    ends = np.cumsum(np.append(0, np.asarray(pc.fill_null(pc.list_value_length(ids), 0))))
    # The bytes of tokens that were taken stand one after the other; only the borders of lists are kept.
    borders = np.append(np.zeros(1, np.int64), np.cumsum(np.asarray(pc.binary_length(found), np.int64)))
    data = found.buffers()[2] or pa.py_buffer(b"")
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(np.ascontiguousarray(borders[ends])), data])
    return pc.if_else(ids.is_valid(), whole, pa.scalar(None, pa.large_binary())).cast(pa.binary())


def encode_texts(
    docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids", keep_text: bool = True, decoded: str | None = None, remember: bool = True
) -> DataFrame:
    """Adds the token ids of each whole text; a null text has none. A column of that name is replaced.

    Without ``keep_text`` the text itself is not handed back. ``decoded`` names a
    column for the bytes that the ids stand for, as :func:`decode_ids` adds it, but
    without a second Python worker for each task. Texts are independent, so
    nothing is shuffled; a task holds one Arrow batch. Without ``remember``
    workers keep nothing of texts from task to task and give their memory back,
    for jobs whose other steps need it.
    """
    docs = docs.drop(ids, *([decoded] if decoded else []))
    keep = [f for f in docs.schema.fields if keep_text or f.name != text]
    added = [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False), *([T.StructField(decoded, T.BinaryType())] if decoded else [])]
    schema = T.StructType([*keep, *added])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        try:
            for batch in batches:
                for part in slices(batch):
                    found = own.encode_all(part.column(text).to_pylist())
                    again = [decode(own.pairs.tokens, found)] if decoded else []
                    yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in keep), found, *again], schema.names)
        finally:
            own.forget(all_=not remember)

    return docs.mapInArrow(encode, schema)


def decode_ids(docs: DataFrame, path: str, pattern: str, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for; null ids give null."""
    docs = docs.drop(decoded)
    schema = T.StructType([*docs.schema.fields, T.StructField(decoded, T.BinaryType())])

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path, pattern).pairs.tokens
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([*part.columns, decode(tokens, part.column(ids))], [*part.schema.names, decoded])

    return docs.mapInArrow(back, schema)


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """A batch in parts of a few rows, so that Python objects of few rows exist at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
