"""Token counts of every prefix of a text, by dynamic programming over prefixes.

For a piece of text the last token of each prefix follows from those of shorter
prefixes: token t ends prefix i if the last token of prefix i - len(t) and t are
stable side by side (see ``bpe_tree``), and exactly one token is. Counts of the
prefixes follow: one more than that of the shorter prefix. A table of all
prefixes of a whole text answers how many tokens a truncated text has and how
much of a text fits a budget, without encoding anything again.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from foliospark.llm.bpe_tree import REMEMBERED, slices

#: Bytes of a piece whose table is shared by pieces that begin alike.
SHARED_BYTES = 5
#: Bytes before the end of a prefix by which the tokens that may end it are looked up.
TAIL_BYTES = 5


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in a byte-level vocabulary: printable Latin-1 as it is, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Remembered(dict):
    """Results of a function of one argument."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, key):
        found = self[key] = self.function(key)
        return found


class PrefixCounter:
    """Counts for one vocabulary file of the ``tokenizers`` library (byte-level BPE, its own splitting pattern)."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        self.special = [t["content"] for t in model["added_tokens"]]
        self.split_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.tokens = {as_bytes(t) for t in model["model"]["vocab"] if t not in self.special}
        merges = model["model"]["merges"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in merges)
        self.merges = {(as_bytes(a), as_bytes(b)): rank for rank, (a, b) in enumerate(pairs)}
        self.endings = {t[k:] for t in self.tokens for k in range(len(t))}
        self.longest = max(map(len, self.tokens))
        self.pattern = regex.compile(pattern)
        self.stable: dict[tuple[bytes, bytes], bool] = {}
        self.made = _Remembered(self.last_merge)
        self.tails: dict[bytes, list[int]] = {}
        self.heads: dict[bytes, tuple[list[bytes], list[int]]] = {}
        self.known: dict[str, tuple[bytes, int, bool]] = {}

    def merged(self, data: bytes) -> list[bytes]:
        """The encoding of a few bytes by its definition."""
        merges, no = self.merges, 1 << 60
        parts = [data[i : i + 1] for i in range(len(data))]
        seams = [merges.get(p, no) for p in zip(parts, parts[1:])]
        while seams and (best := min(seams)) < no:
            i = seams.index(best)
            parts[i] += parts.pop(i + 1)
            del seams[i]
            if i < len(seams):
                seams[i] = merges.get((parts[i], parts[i + 1]), no)
            if i:
                seams[i - 1] = merges.get((parts[i - 1], parts[i]), no)
        return parts

    def last_merge(self, token: bytes) -> tuple[bytes, bytes, int] | None:
        """The merge that completes a token and its rank; None for a byte, or if ranks don't rise up to it."""
        if len(token) == 1 or self.merged(token) != [token]:
            return None
        for cut in range(1, len(token)):
            left, right = token[:cut], token[cut:]
            rank = self.merges.get((left, right))
            if rank is not None and all(len(x) == 1 or (m := self.made[x]) and m[2] < rank for x in (left, right)) and self.apart(left, right, rank):
                return left, right, rank
        return None

    def apart(self, x: bytes, y: bytes, till: int = 1 << 60) -> bool:
        """Whether no merge of a rank below ``till`` crosses the border of two tokens.

        Undoes the merges on both sides of the border, latest first. Two parts
        side by side merge if that has a lower rank than the merge that takes
        one of them elsewhere; at equal ranks the left one comes first.
        """
        merges, made = self.merges, self.made
        while True:
            rank = merges.get((x, y))
            if rank is not None and rank < till:
                return False
            a, b = made[x], made[y]
            if b is not None and (a is None or b[2] >= a[2]):
                y, till = b[0], b[2] + 1
            elif a is not None:
                x, till = a[1], a[2]
            else:
                return True

    def is_stable(self, before: bytes, token: bytes) -> bool:
        key = (before, token)
        known = self.stable.get(key)
        if known is None:
            if len(self.stable) >= REMEMBERED:
                self.stable.clear()
            rising = (len(token) == 1 or self.made[token]) and (len(before) < 2 or self.made[before])
            if not rising:
                known = self.merged(before + token) == ([before, token] if before else [token])
            else:
                known = not before or self.apart(before, token)
            self.stable[key] = known
        return known

    def lengths(self, tail: bytes, whole: bool) -> list[int]:
        """Lengths of the tokens that end ``tail``, longest first; an empty list if longer ones may exist before it."""
        size = 1
        while size < len(tail) and tail[-size - 1 :] in self.endings:
            size += 1
        return [] if size == len(tail) and not whole else [n for n in range(size, 0, -1) if tail[-n:] in self.tokens]

    def piece_prefixes(self, data: bytes) -> list[int]:
        """Token counts of the prefixes 1, 2, ... bytes of one piece. Pieces that begin alike share the start of the table."""
        of, stable, tails = self.stable, self.is_stable, self.tails
        known = self.heads.get(data[:SHARED_BYTES])
        last, counts = (known[0][:], known[1][:]) if known else ([b""], [0])
        for i in range(len(last), len(data) + 1):
            tail = data[max(0, i - TAIL_BYTES) : i]
            lengths = tails.get(tail)
            if lengths is None:
                if len(tails) >= REMEMBERED:
                    tails.clear()
                lengths = tails[tail] = self.lengths(tail, len(tail) < TAIL_BYTES)
            for size in lengths or self.lengths(data[max(0, i - self.longest) : i], True):
                start, token = i - size, data[i - size : i]
                fits = of.get((last[start], token))
                if fits is None:
                    fits = stable(last[start], token)
                if fits:
                    break
            else:
                raise ValueError("a byte is missing from the vocabulary")
            last.append(token)
            counts.append(counts[start] + 1)
            if i == SHARED_BYTES:
                if len(self.heads) >= REMEMBERED:
                    self.heads.clear()
                self.heads[data[:i]] = last[:], counts[:]
        return counts[1:]

    def _entry(self, piece: str) -> tuple[bytes, int, bool]:
        """Counts by code point, as bytes of int32; the last of them; whether what follows can change the prefixes."""
        data = piece.encode()
        counts = self.piece_prefixes(data)
        if len(data) > len(piece):
            counts = [c for k, c in enumerate(counts, 1) if k == len(data) or data[k] & 0xC0 != 0x80]
        odd = piece.isspace() or len(piece) == 3 and piece[0] == "'" and piece[1].isalpha()
        return array("i", counts).tobytes(), counts[-1], odd

    def _entries(self, pieces: list[str]) -> list[tuple[bytes, int, bool]]:
        known = self.known
        try:
            return [known[p] for p in pieces]
        except KeyError:
            pass
        if len(known) >= REMEMBERED:
            known.clear()
        out = []
        for p in pieces:
            entry = known.get(p)
            if entry is None:
                entry = self._entry(p)
                if len(p) <= 64:
                    known[p] = entry
            out.append(entry)
        return out

    def plain_prefixes(self, text: str) -> np.ndarray:
        """The table of a text in which special strings are ordinary text."""
        if not text:
            return np.empty(0, np.int32)
        pieces = self.pattern.findall(text)
        entries = self._entries(pieces)
        table = np.frombuffer(b"".join([e[0] for e in entries]), np.int32)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(np.fromiter([e[1] for e in entries], np.int64, len(entries)))
        bases = np.concatenate(([0], ends[:-1]))
        table = table + np.repeat(bases, lengths).astype(np.int32)
        starts = np.cumsum(lengths) - lengths
        for k in [k for k, e in enumerate(entries) if e[2]]:
            piece = pieces[k]
            if piece[0] == "'":  # its first two code points alone are two pieces
                table[starts[k] + 1] = bases[k] + sum(e[1] for e in self._entries([piece[0], piece[1]]))
            elif k + 1 < len(pieces) and pieces[k + 1][0].isspace():  # the prefix that ends with the white space has it as one piece
                table[starts[k + 1]] = bases[k] + self._entries([piece + pieces[k + 1][0]])[0][1]
        return table

    def prefixes(self, text: str) -> np.ndarray:
        """Token counts of the prefixes of 1, 2, ... code points; a special string, once whole, is one token."""
        if self.split_special is None or not self.split_special.search(text):
            return self.plain_prefixes(text)
        parts, base, at = [], 0, 0
        for found in self.split_special.finditer(text):
            head = self.plain_prefixes(text[at : found.end() - 1])
            before = int(head[found.start() - at - 1]) if found.start() > at else 0
            parts += [head + base, [base + before + 1]]
            base, at = base + before + 1, found.end()
        parts.append(self.plain_prefixes(text[at:]) + base)
        return np.concatenate(parts).astype(np.int32)


_COUNTERS: dict[tuple[str, str], PrefixCounter] = {}


def counter(path: str, pattern: str) -> PrefixCounter:
    """One counter for each Python worker."""
    if (path, pattern) not in _COUNTERS:
        _COUNTERS[path, pattern] = PrefixCounter(path, pattern)
    return _COUNTERS[path, pattern]


def fits(table: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix that has at most so many tokens."""
    within = np.flatnonzero(table <= budget)
    return int(within[-1]) + 1 if len(within) else 0


def prefix_tables(docs: DataFrame, path: str, pattern: str, text: str = "text", table: str = "prefix_tokens") -> DataFrame:
    """Adds each text's whole table as an array; a null text has an empty one. A column of that name is replaced."""
    docs = docs.drop(table)
    schema = T.StructType([*docs.schema.fields, T.StructField(table, T.ArrayType(T.IntegerType(), False), False)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = counter(path, pattern).prefixes
        for batch in batches:
            for part in slices(batch, 64):
                found = [prefixes(t or "") for t in part.column(text).to_pylist()]
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
                arrays = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found), pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, arrays], [*part.schema.names, table])

    return docs.mapInArrow(add, schema)


def count_tokens(docs: DataFrame, path: str, pattern: str, budget: int = 512, text: str = "text") -> DataFrame:
    """Adds n_bytes (UTF-8), n_tokens, over_limit and fitting_chars, read from each text's table where that is made.

    n_tokens is the table's last entry, over_limit whether it is above
    ``budget``, fitting_chars the longest prefix in code points that the budget
    allows. A null text counts as empty. Columns of those names are replaced.
    Nothing is shuffled; a task holds one table at a time.
    """
    docs = docs.drop("n_bytes", "n_tokens", "over_limit", "fitting_chars")
    added = [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType()), ("fitting_chars", T.LongType())]
    keep = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*keep, *(T.StructField(n, t, False) for n, t in added)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = counter(path, pattern).prefixes
        for batch in batches:
            for part in slices(batch):
                sizes, totals, cuts = [], [], []
                for t in part.column(text).to_pylist():
                    table = prefixes(t or "")
                    sizes.append(len((t or "").encode()))
                    totals.append(int(table[-1]) if len(table) else 0)
                    cuts.append(len(table) if totals[-1] <= budget else fits(table, budget))
                columns = [part.column(f.name) for f in keep]
                new = [pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()), pa.array([n > budget for n in totals]), pa.array(cuts, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *new], schema.names)

    return docs.mapInArrow(count, schema)
