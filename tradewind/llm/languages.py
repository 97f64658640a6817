"""Language identification by a bidirectional gated recurrent network over bytes, trained here by backpropagation through time.

Every byte position of a text gets label probabilities from both directions; a document's probabilities are the
mean over its positions. A text is cut into segments of ``SEGMENT`` bytes that are read side by side.
Gates and candidates use clipped linear functions, which are cheap and have plain derivatives.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.arrays import Text, blocks

SEGMENT = 64
HIDDEN = 8
UNDETERMINED = "und"


class Network:
    """Two gated recurrent layers (forward, backward) and a shared output layer, as numpy arrays."""

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        n, h = len(labels), hidden
        self.labels, self.hidden = labels, h
        self.input = rng.normal(0, 0.3, (2, 256, 3 * h)).astype(np.float32)
        self.input[:, :, : 2 * h] += 0.5
        self.state = rng.normal(0, 0.3, (2, h, 3 * h)).astype(np.float32)
        self.output = rng.normal(0, 0.3, (2, h, n)).astype(np.float32)
        self.bias = np.zeros(n, np.float32)

    def _step(self, before: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        """One step of both directions: gates, candidate, part of the candidate that comes from the state, new state."""
        h = self.hidden
        x = np.stack([self.input[0].take(codes[0], axis=0), self.input[1].take(codes[1], axis=0)])
        u = before @ self.state
        gates = x[:, :, : 2 * h]
        gates += u[:, :, : 2 * h]
        np.clip(gates, 0, 1, out=gates)
        keep, reset = gates[:, :, :h], gates[:, :, h:]
        candidate = x[:, :, 2 * h :]
        candidate += reset * u[:, :, 2 * h :]
        np.clip(candidate, -1, 1, out=candidate)
        after = before - candidate
        after *= keep
        after += candidate
        return keep, reset, candidate, u[:, :, 2 * h :], after

    def read(self, codes: np.ndarray) -> np.ndarray:
        """States (2, steps, segments, hidden) of byte codes (segments, steps); backward states stand at their position."""
        segments, steps = codes.shape
        both = np.stack([codes.T, codes.T[::-1]])
        states = np.empty((2, steps, segments, self.hidden), np.float32)
        now = np.zeros((2, segments, self.hidden), np.float32)
        for t in range(steps):
            now = self._step(now, both[:, t])[-1]
            states[0, t], states[1, steps - 1 - t] = now[0], now[1]
        return states

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Label probabilities (steps, segments, labels) of every position."""
        states = self.read(codes)
        scores = states[0] @ self.output[0]
        scores += states[1] @ self.output[1]
        scores += self.bias
        scores -= scores.max(axis=-1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=-1, keepdims=True)
        return scores

    def gradients(self, codes: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over the weighted positions and its gradients, by backpropagation through time."""
        segments, steps = codes.shape
        h = self.hidden
        both = np.stack([codes.T, codes.T[::-1]])
        kept = []
        now = np.zeros((2, segments, h), np.float32)
        states = np.empty((2, steps, segments, h), np.float32)
        for t in range(steps):
            kept.append((now, *self._step(now, both[:, t])))
            now = kept[-1][-1]
            states[0, t], states[1, steps - 1 - t] = now[0], now[1]
        scores = states[0] @ self.output[0] + states[1] @ self.output[1] + self.bias
        scores = np.exp(scores - scores.max(axis=-1, keepdims=True))
        p = scores / scores.sum(axis=-1, keepdims=True)
        w = (weight.T / weight.sum()).astype(np.float32)
        loss = float(-(np.log(p[:, np.arange(segments), target] + 1e-9) * w).sum())
        p[:, np.arange(segments), target] -= 1
        p *= w[:, :, None]
        grad = {"bias": p.sum(axis=(0, 1)), "output": np.stack([np.einsum("tsh,tsn->hn", states[d], p) for d in (0, 1)])}
        grad["input"], grad["state"] = np.zeros_like(self.input), np.zeros_like(self.state)
        outer = np.stack([p @ self.output[0].T, (p @ self.output[1].T)[::-1]])
        back = np.zeros((2, segments, h), np.float32)
        backward = self.state.transpose(0, 2, 1)
        for t in reversed(range(steps)):
            before, keep, reset, candidate, part, _ = kept[t]
            d = back + outer[:, t]
            d_keep = d * (before - candidate) * ((keep > 0) & (keep < 1))
            d_candidate = d * (1 - keep) * (np.abs(candidate) < 1)
            d_reset = d_candidate * part * ((reset > 0) & (reset < 1))
            d_u = np.concatenate([d_keep, d_reset, d_candidate * reset], axis=2)
            d_x = np.concatenate([d_keep, d_reset, d_candidate], axis=2)
            grad["state"] += before.transpose(0, 2, 1) @ d_u
            for i in (0, 1):
                np.add.at(grad["input"][i], both[i, t], d_x[i])
            back = d * keep + d_u @ backward
        return loss, grad

    def fit(self, codes: np.ndarray, target: np.ndarray, weight: np.ndarray, steps: int = 500, batch: int = 96, rate: float = 0.02, seed: int = 2) -> Network:
        """Adam over random batches of segments."""
        rng = np.random.default_rng(seed)
        names = ["input", "state", "output", "bias"]
        first = {n: np.zeros_like(getattr(self, n)) for n in names}
        second = {n: np.zeros_like(getattr(self, n)) for n in names}
        for i in range(1, steps + 1):
            pick = rng.integers(0, len(codes), min(batch, len(codes)))
            _, grad = self.gradients(codes[pick], target[pick], weight[pick])
            pace = rate * (1 - 0.9 * i / steps)
            for n in names:
                g = np.clip(grad[n], -1, 1)
                first[n] += 0.1 * (g - first[n])
                second[n] += 0.01 * (g * g - second[n])
                getattr(self, n)[...] -= pace * (first[n] / (1 - 0.9**i)) / (np.sqrt(second[n] / (1 - 0.99**i)) + 1e-7)
        return self


def segments(text: Text, length: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All rows' bytes as (segments, length) with zeros at the end of a row, the number of bytes of each segment, its row."""
    sizes = np.diff(text.offsets)
    counts = -(-sizes // length)
    row = np.repeat(np.arange(text.rows), counts)
    within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = text.offsets[:-1][row] + within * length
    filled = np.minimum(length, text.offsets[1:][row] - start)
    padded = np.concatenate([text.data, np.zeros(length, np.uint8)])
    codes = padded[start[:, None] + np.arange(length)]
    codes[np.arange(length) >= filled[:, None]] = 0
    return codes, filled, row


def pooled(network: Network, text: Text, group: int = 1024) -> np.ndarray:
    """Mean label probabilities (rows, labels) over all byte positions of each row; zeros for an empty row."""
    codes, filled, row = segments(text)
    total = np.zeros((text.rows, len(network.labels)))
    for i in range(0, len(codes), group):
        p = network.probabilities(codes[i : i + group])
        p *= (np.arange(codes.shape[1])[:, None] < filled[i : i + group])[:, :, None]
        np.add.at(total, row[i : i + group], p.sum(axis=0))
    return total / np.maximum(np.diff(text.offsets), 1)[:, None]


def training_fold(doc_id: Column) -> Column:
    """True for documents that may be learned from; the others are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def train(docs: DataFrame, per_language: int = 300, window: int = 1024, steps: int = 500) -> Network | None:
    """Fit on a bounded sample of labelled rows of the training fold.

    Of every label, about ``per_language`` documents with the least hash of doc_id give one stretch of
    ``window`` characters at a place given by that hash. Labels are counted first, so that rows beyond three times the wanted number
    are left out by their hash where they are read. Returns None where nothing is labelled.
    """
    chosen = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    chosen = chosen.where(F.col("lang").isNotNull() & F.col("id").isNotNull() & training_fold(F.col("id")) & (F.trim("text") != ""))
    order = F.xxhash64("id")
    room = F.greatest(F.char_length("text") - F.lit(window), F.lit(0)) + 1
    stretch = F.col("text").substr((F.pmod(order, room) + 1).cast("int"), F.lit(window))
    counted = chosen.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()
    if not counted:
        return None
    reach = [(r["lang"], min((3 * per_language << 64) // r["n"], 1 << 64) - (1 << 63) - 1) for r in counted]
    limits = docs.sparkSession.createDataFrame(reach, "lang string, most long")
    near = chosen.join(F.broadcast(limits), "lang").where(order <= F.col("most"))
    narrow = near.select("lang", "id", order.alias("h"), stretch.alias("stretch"))
    first = narrow.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "id", "stretch"))).where(F.col("n") <= per_language)
    rows = first.collect()
    labels = sorted({r["lang"] for r in rows})
    rows = sorted((r["lang"], r["h"], r["id"], r["stretch"]) for r in rows)
    if not rows:
        return None
    codes, filled, target = [], [], []
    for text in blocks(pa.array([r[3] for r in rows], pa.string()), 1 << 30):
        c, f, row = segments(text)
        codes.append(c), filled.append(f), target.append(np.array([labels.index(r[0]) for r in rows])[row])
    codes, filled, target = np.concatenate(codes), np.concatenate(filled), np.concatenate(target)
    weight = (np.arange(codes.shape[1]) < filled[:, None]).astype(np.float32)
    # Every language weighs the same, whatever its share.
    weight *= (1 / np.bincount(target, minlength=len(labels)))[target][:, None]
    return Network(labels).fit(codes, target, weight * len(codes), steps=steps)


def language(text: Column, network: Network | None) -> Column:
    """Struct (lang_pred, score); ``und`` and 0 for a text that is null or has no letter, or without a network."""

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def run(column: pa.Array) -> pa.Array:
        labels, scores = [], []
        for part in blocks(column, 1 << 18):
            p = pooled(network, part)
            best = p.argmax(axis=1)
            labels += [network.labels[b] for b in best]
            scores += p[np.arange(part.rows), best].clip(0, 1).tolist()
        return pa.StructArray.from_arrays([pa.array(labels, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    none = F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    if network is None:
        return none
    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), run(text)).otherwise(none)


def predicted(docs: DataFrame, network: Network | None = None) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), one per row of ``docs`` (columns doc_id, text, lang; others are ignored).

    Without a network, one is trained on the labelled rows first. A null doc_id is never learned from and has held_out null;
    repeated rows give repeated results; an empty table gives no rows.
    """
    network = network or train(docs)
    doc_id = F.col("doc_id").cast("long")
    out = docs.select(doc_id.alias("doc_id"), (~training_fold(doc_id)).alias("held_out"), language(F.col("text").cast("string"), network).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")


def identified(docs: DataFrame, least: float = 0.4, network: Network | None = None) -> DataFrame:
    """The rows of ``docs`` whose text has a language: it holds a letter and the best label's pooled probability is at least ``least``.

    Without any labelled row there is nothing to tell languages by, and all texts with a letter stay. A null or empty text goes, a text of
    any length is read whole, repeated rows are judged alike, columns of any other name are untouched, an empty table gives no rows.
    """
    network = network or train(docs)
    if network is None:
        return docs.where(F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)))
    name = "_language_"
    while name in docs.columns:
        name += "_"
    found = docs.withColumn(name, language(F.col("text").cast("string"), network))
    return found.where((F.col(name)["lang_pred"] != UNDETERMINED) & (F.col(name)["score"] >= least)).drop(name)
