"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent units read a window of bytes from either end; at every
position their states give probabilities of the languages, and a document's
probabilities are the mean over all its positions. The network is trained here,
in numpy, by backpropagation through time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.bpe_tree import slices
from foliospark.llm.common import give_back

#: Documents the network is trained on, about; texts of each language at least, if it has so many; bytes of a window; windows read at a time.
SAMPLE, LEAST, WINDOW, TOGETHER = 2000, 8, 64, 4096
UNKNOWN = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class BiGru:
    """Weights: input (2, 257, 3h), one row for each byte and one for padding; recurrent (2, h, 3h); bias (2, 3h); output (2h, languages).

    Gates in the order reset, update, candidate; the two directions are stacked.
    """

    def __init__(self, languages: list[str], hidden: int = 8, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        h = hidden
        self.p = {
            "x": rng.normal(0, 0.3, (2, 257, 3 * h)).astype(np.float32),
            "u": rng.normal(0, 0.4, (2, h, 3 * h)).astype(np.float32),
            "b": np.zeros((2, 1, 3 * h), np.float32),
            "o": rng.normal(0, 0.3, (2 * h, len(languages))).astype(np.float32),
            "c": np.zeros(len(languages), np.float32),
        }

    def states(self, bytes_: np.ndarray, keep: bool = False):
        """bytes_ (time, n). Both directions' states at every position: (2, time, n, h), each in the text's order."""
        time, n = bytes_.shape
        h = self.hidden
        x, u, b = self.p["x"], self.p["u"], self.p["b"]
        table = x + b
        out = np.zeros((2, time, n, h), np.float32)
        kept = []
        for d in (0, 1):
            state = np.zeros((n, h), np.float32)
            gates, candidate = np.ascontiguousarray(u[d][:, : 2 * h]), np.ascontiguousarray(u[d][:, 2 * h :])
            for t in range(time) if d == 0 else range(time - 1, -1, -1):
                seen = table[d].take(bytes_[t], 0)
                rz = state @ gates
                rz += seen[:, : 2 * h]
                rz = _sigmoid(rz)
                r, z = rz[:, :h], rz[:, h:]
                reset = r * state
                c = reset @ candidate
                c += seen[:, 2 * h :]
                np.tanh(c, out=c)
                if keep:
                    kept.append((d, t, state, r, z, reset, c))
                state = state - c
                state *= z
                state += c
                out[d, t] = state
        return (out, kept) if keep else out

    def probabilities(self, states: np.ndarray) -> np.ndarray:
        """(time, n, languages)."""
        h = self.hidden
        logits = states[0] @ self.p["o"][:h]
        logits += states[1] @ self.p["o"][h:]
        logits += self.p["c"]
        logits -= logits.max(-1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(-1, keepdims=True)
        return logits

    def gradients(self, bytes_: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all positions, each of which should give its window's language; and its gradients, back through time."""
        time, n = bytes_.shape
        h = self.hidden
        states, kept = self.states(bytes_, keep=True)
        prob = self.probabilities(states)
        loss = -np.log(prob[:, np.arange(n), target] + 1e-9).mean()
        d_logit = prob
        d_logit[:, np.arange(n), target] -= 1
        d_logit /= time * n
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        flat = d_logit.reshape(-1, d_logit.shape[-1])
        for d in (0, 1):
            g["o"][d * h : (d + 1) * h] = states[d].reshape(-1, h).T @ flat
        g["c"] = flat.sum(0)
        d_state = [d_logit @ self.p["o"][:h].T, d_logit @ self.p["o"][h:].T]
        carried = [np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)]
        d_seen = np.zeros((2, time, n, 3 * h), np.float32)
        for d, t, before, r, z, reset, c in reversed(kept):
            u = self.p["u"][d]
            ds = d_state[d][t] + carried[d]
            dc = ds * (1 - z) * (1 - c * c)
            dz = ds * (before - c) * z * (1 - z)
            d_reset = dc @ u[:, 2 * h :].T
            dr = d_reset * before * r * (1 - r)
            drz = np.concatenate([dr, dz], 1)
            g["u"][d][:, 2 * h :] += reset.T @ dc
            g["u"][d][:, : 2 * h] += before.T @ drz
            carried[d] = ds * z + d_reset * r + drz @ u[:, : 2 * h].T
            d_seen[d, t, :, : 2 * h] = drz
            d_seen[d, t, :, 2 * h :] = dc
        order = np.argsort(bytes_.ravel(), kind="stable")
        values, starts = np.unique(bytes_.ravel()[order], return_index=True)
        for d in (0, 1):
            g["x"][d][values] = np.add.reduceat(d_seen[d].reshape(-1, 3 * h)[order], starts)
            g["b"][d] = d_seen[d].sum((0, 1))
        return float(loss), g

    def fit(self, texts: list[bytes], labels: list[int], steps: int = 160, batch: int = 192, rate: float = 0.03, seed: int = 5) -> BiGru:
        """Adam over random windows of the texts, languages drawn evenly."""
        rng = np.random.default_rng(seed)
        by_label = [[t for t, y in zip(texts, labels) if y == k] for k in range(len(self.languages))]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for step in range(1, steps + 1):
            target = rng.integers(0, len(self.languages), batch)
            windows = np.full((batch, WINDOW), 256, np.int64)
            for i, y in enumerate(target):
                text = by_label[y][rng.integers(len(by_label[y]))]
                at = rng.integers(max(1, len(text) - WINDOW + 1))
                piece = np.frombuffer(text[at : at + WINDOW], np.uint8)
                windows[i, : len(piece)] = piece
            _, g = self.gradients(np.ascontiguousarray(windows.T), target)
            slow = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k in self.p:
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.01 * (g[k] ** 2 - v[k])
                self.p[k] -= slow * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over all positions of each text; windows of all texts are read together."""
        lengths = np.array([len(t) for t in texts], np.int64)
        counts = -(-lengths // WINDOW)
        owner = np.repeat(np.arange(len(texts)), counts)
        data = np.full(int(counts.sum()) * WINDOW, 256, np.int16)  # a byte, or 256 for padding
        starts = (np.cumsum(counts) - counts) * WINDOW
        for t, at in zip(texts, starts.tolist()):
            data[at : at + len(t)] = np.frombuffer(t, np.uint8)
        windows = data.reshape(-1, WINDOW)
        total = np.zeros((len(texts), len(self.languages)))
        for at in range(0, len(windows), TOGETHER):
            part = np.ascontiguousarray(windows[at : at + TOGETHER].T)
            prob = self.probabilities(self.states(part))
            prob *= (part < 256)[..., None]
            np.add.at(total, owner[at : at + TOGETHER], prob.sum(0))
        return total / np.maximum(lengths, 1)[:, None]


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def shares(counts: dict[str, int], documents: int) -> dict[str, int]:
    """How many texts of each language make up about so many: all of rare ones, at least LEAST of each, the others alike."""
    out, left = {}, documents
    for k, (language, n) in enumerate(sorted(counts.items(), key=lambda c: (c[1], c[0]))):
        out[language] = min(n, max(LEAST, left // (len(counts) - k)))
        left = max(0, left - out[language])
    return out


def train(docs: DataFrame, documents: int = SAMPLE) -> BiGru | None:
    """A network for the languages of the ``lang`` column, or None if there are none.

    All languages of documents that have an id and aren't held out are learned.
    Learns from about so many whole, different texts, drawn evenly by language
    and chosen by digest of the text, so that copies count once.
    """
    scale = 1 << 40
    usable = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & (F.length("text") > 0))
    usable = usable.select("text", "lang", F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(scale)).alias("digest"))
    counts = usable.select("lang", "digest").distinct().groupBy("lang").agg(F.count("*").alias("n"), F.min("digest").alias("first")).collect()
    if not counts:
        return None
    wanted = shares({r["lang"]: r["n"] for r in counts}, documents)
    below = [(r["lang"], scale if wanted[r["lang"]] == r["n"] else max(r["first"] + 1, scale * wanted[r["lang"]] // r["n"])) for r in counts]
    limits = docs.sparkSession.createDataFrame(below, "lang string, below long")
    chosen = usable.join(F.broadcast(limits), "lang").where(F.col("digest") < F.col("below")).select("text", "lang").distinct()
    rows = sorted(chosen.toArrow().to_pylist(), key=lambda r: (r["text"], r["lang"]))
    languages = sorted({r["lang"] for r in rows})
    return BiGru(languages).fit([r["text"].encode() for r in rows], [languages.index(r["lang"]) for r in rows])


def identify(docs: DataFrame, model: BiGru | None, text: str = "text") -> DataFrame:
    """Adds lang_pred and score, the mean probability of that language over the text's positions.

    Texts that are null or have no letter are ``und`` with score 0, and so is
    everything if there was nothing to learn from. Columns of those names are
    replaced; other columns play no part. Nothing is shuffled; the network
    (some 13,000 numbers) travels with the task.
    """
    docs = docs.drop("lang_pred", "score")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = regex.compile(r"\p{L}")
        for batch in batches:
            for part in slices(batch, 1024):
                texts = [t if t and letter.search(t) else None for t in part.column(text).to_pylist()]
                pred, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
                at = [i for i, t in enumerate(texts) if t is not None and model is not None]
                if at:
                    prob = model.documents([texts[i].encode() for i in at])
                    for i, row in zip(at, prob):
                        pred[i], score[i] = model.languages[int(row.argmax())], float(min(1.0, row.max()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())], [*part.schema.names, "lang_pred", "score"])
        give_back()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(predict, f"{schema}, lang_pred string, score double")
