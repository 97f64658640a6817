"""Quality scores by a convolutional network over bytes, trained here in numpy.

A text is cut into overlapping chunks that cover all of it. Filters over ``WIDTH`` neighbouring bytes slide along each chunk, the greatest
answer of each filter is the chunk's, and a document is described by the greatest and the mean answer over its chunks. One logistic unit
makes a probability of these.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.arrays import Text, blocks

WIDTH = 6
CHUNK = 256
STEP = 192
FILTERS = 8


class Chunks:
    """Where the chunks of some rows begin and end; a row has one at least, and only a row's only chunk may be shorter than ``WIDTH``."""

    def __init__(self, text: Text):
        sizes = np.diff(text.offsets)
        counts = np.maximum(1, -(-(sizes - (CHUNK - STEP)) // STEP))
        self.first = np.cumsum(counts) - counts
        self.row = np.repeat(np.arange(text.rows), counts)
        within = np.arange(len(self.row)) - self.first[self.row]
        self.start = text.offsets[:-1][self.row] + within * STEP
        self.end = np.minimum(self.start + CHUNK, text.offsets[1:][self.row])

    def __len__(self) -> int:
        return len(self.row)


class Network:
    """``filters`` (WIDTH, 256, n): weight of each byte at each place; ``output`` (2 n) and ``bias`` of the logistic unit."""

    def __init__(self, n: int = FILTERS, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.filters = rng.normal(0, 0.1, (WIDTH, 256, n)).astype(np.float32)
        self.output = rng.normal(0, 0.3, 2 * n).astype(np.float32)
        self.bias = np.zeros(1, np.float32)
        self._pairs: np.ndarray | None = None

    def answers(self, codes: np.ndarray) -> np.ndarray:
        """What each filter says at each place of byte codes (…, length): (…, length - WIDTH + 1, n)."""
        places = codes.shape[-1] - WIDTH + 1
        return sum(self.filters[j].take(codes[..., j : j + places], axis=0) for j in range(WIDTH))

    def _along(self, data: np.ndarray) -> np.ndarray:
        """:meth:`answers` of one run of bytes, two bytes at a time."""
        if self._pairs is None:
            self._pairs = np.stack([(self.filters[j][:, None] + self.filters[j + 1][None]).reshape(65536, -1) for j in range(0, WIDTH, 2)])
        pair = (data[:-1].astype(np.uint16) << 8) | data[1:]
        places = len(data) - WIDTH + 1
        out = self._pairs[0].take(pair[:places], axis=0)
        for j in range(1, WIDTH // 2):
            out += self._pairs[j].take(pair[2 * j : 2 * j + places], axis=0)
        return out

    def chunk_answers(self, text: Text, chunks: Chunks) -> np.ndarray:
        """Greatest answer of each filter in each chunk (chunks, n); a text shorter than a filter is filled up with zeros."""
        size = chunks.end - chunks.start
        out = np.empty((len(chunks), self.filters.shape[2]), np.float32)
        full = np.flatnonzero(size >= WIDTH)
        if len(full):
            along = self._along(np.concatenate([text.data, np.zeros(1, np.uint8)]))
            edges = np.stack([chunks.start[full], chunks.end[full] - WIDTH + 1], axis=1).ravel()
            out[full] = np.maximum.reduceat(along, edges, axis=0)[::2]
        short = np.flatnonzero(size < WIDTH)
        if len(short):
            out[short] = self.answers(_padded(text.data, chunks.start[short], size[short], WIDTH))[:, 0]
        return out

    def scores(self, text: Text) -> np.ndarray:
        """Probability of label 1 of each row."""
        chunks = Chunks(text)
        h = np.tanh(self.chunk_answers(text, chunks))
        counts = np.diff(np.append(chunks.first, len(chunks)))
        described = np.concatenate([np.maximum.reduceat(h, chunks.first), np.add.reduceat(h, chunks.first) / counts[:, None]], axis=1)
        return 1 / (1 + np.exp(-(described @ self.output + self.bias).astype(np.float64)))

    def gradients(self, codes: np.ndarray, size: np.ndarray, first: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of documents and its gradients; ``codes`` are their chunks filled up with zeros, ``first`` where each begins."""
        z = self.answers(codes)
        places = np.maximum(size - WIDTH + 1, 1)
        z[np.arange(z.shape[1]) >= places[:, None]] = -np.inf
        at = z.argmax(axis=1)
        h = np.tanh(np.take_along_axis(z, at[:, None], axis=1)[:, 0])
        counts = np.diff(np.append(first, len(codes)))
        doc = np.repeat(np.arange(len(first)), counts)
        greatest = np.maximum.reduceat(h, first)
        described = np.concatenate([greatest, np.add.reduceat(h, first) / counts[:, None]], axis=1)
        p = 1 / (1 + np.exp(-(described @ self.output + self.bias)))
        loss = float(-np.log(np.where(target == 1, p, 1 - p) + 1e-9).mean())
        d = ((p - target) / len(first)).astype(h.dtype)
        grad = {"bias": np.array([d.sum()], h.dtype), "output": d @ described, "filters": np.zeros_like(self.filters)}
        n = h.shape[1]
        of_greatest, of_mean = d[:, None] * self.output[:n], d[:, None] * self.output[n:] / counts[:, None]
        # Of equal greatest chunks the first one is moved.
        is_first = h == greatest[doc]
        seen = np.cumsum(is_first, axis=0)
        before = np.concatenate([np.zeros((1, n), seen.dtype), seen])[first][doc]
        d_h = of_mean[doc] + of_greatest[doc] * (is_first & (seen - before == 1))
        d_z = d_h * (1 - h * h)
        for j in range(WIDTH):
            byte = np.take_along_axis(codes, at + j, axis=1)
            np.add.at(grad["filters"][j], (byte, np.arange(n)), d_z)
        return loss, grad

    def fit(self, codes: np.ndarray, size: np.ndarray, first: np.ndarray, target: np.ndarray, steps: int = 400, batch: int = 48, rate: float = 0.02, seed: int = 2) -> Network:
        """Adam over random batches of documents."""
        rng = np.random.default_rng(seed)
        names = ["filters", "output", "bias"]
        one = {n: np.zeros_like(getattr(self, n)) for n in names}
        two = {n: np.zeros_like(getattr(self, n)) for n in names}
        counts = np.diff(np.append(first, len(codes)))
        for i in range(1, steps + 1):
            pick = rng.integers(0, len(first), min(batch, len(first)))
            starts = np.cumsum(counts[pick]) - counts[pick]
            rows = np.repeat(first[pick] - starts, counts[pick]) + np.arange(counts[pick].sum())
            _, grad = self.gradients(codes[rows], size[rows], starts, target[pick])
            pace = rate * (1 - 0.9 * i / steps)
            for n in names:
                one[n] += 0.1 * (grad[n] - one[n])
                two[n] += 0.01 * (grad[n] ** 2 - two[n])
                getattr(self, n)[...] -= pace * (one[n] / (1 - 0.9**i)) / (np.sqrt(two[n] / (1 - 0.99**i)) + 1e-7)
        self._pairs = None
        return self


def _padded(data: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """Stretches of bytes as rows of a matrix, zeros behind them."""
    at = np.arange(width)
    codes = np.concatenate([data, np.zeros(width, np.uint8)])[start[:, None] + at]
    codes[at >= size[:, None]] = 0
    return codes


def training_fold(doc_id: Column) -> Column:
    """True for documents that may be learned from; the others are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = 800, window: int = 8192, steps: int = 400) -> Network | None:
    """Fit on a bounded sample of labelled documents of the training fold.

    Of each label value (1, or anything else) the ``per_label`` documents with the least hash of doc_id give one stretch of at most
    ``window`` characters, at a place given by that hash. A document with several labels counts as 1 if at least half of them do.
    The two values are drawn alike and the bias is then moved by their true shares. None where nothing is labelled.
    """
    doc_id = F.col("doc_id").cast("long")
    order = F.xxhash64("id")
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(doc_id.alias("id"), (F.col(label) == 1).cast("int").alias("y"))
    known = known.where(training_fold(F.col("id"))).groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    # Labels beyond three times the wanted number are left out by their hash before any text is read.
    reach = {y: min((3 * per_label << 64) // n, 1 << 64) - (1 << 63) - 1 for y, n in counts.items()}
    limit = F.when(F.col("y") == 1, F.lit(reach.get(1))).otherwise(F.lit(reach.get(0)))
    chosen = known.where(order <= limit).withColumn("h", order)
    first = Window.partitionBy("y").orderBy("h", "id")
    chosen = chosen.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_label).select("id", "y", "h")
    texts = docs.select(doc_id.alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    room = F.greatest(F.char_length("text") - F.lit(window), F.lit(0)) + 1
    stretch = F.col("text").substr((F.pmod("h", room) + 1).cast("int"), F.lit(window))
    # At most two times per_label rows.
    found = texts.join(F.broadcast(chosen), "id").groupBy("id", "y").agg(F.min(stretch).alias("stretch")).collect()
    if not found:
        return None
    found = sorted((r["id"], r["y"], r["stretch"]) for r in found)
    text = next(blocks(pa.array([s for _, _, s in found], pa.large_string()), 1 << 40))
    chunks = Chunks(text)
    size = chunks.end - chunks.start
    target = np.array([y for _, y, _ in found])
    network = Network().fit(_padded(text.data, chunks.start, size, CHUNK), size, chunks.first, target, steps=steps)
    drawn = np.bincount(target, minlength=2)
    if drawn.all():
        network.bias += np.float32(np.log(counts[1] / counts[0]) - np.log(drawn[1] / drawn[0]))
    return network


def quality(text: Column, network: Network | None) -> Column:
    """Probability that a text has label 1; 0.5 without a network."""
    if network is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        parts = [network.scores(part) for part in blocks(column, 1 << 18)]
        return pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64())

    return run(text)


def scored(docs: DataFrame, labels: DataFrame, least: float = 0.3, network: Network | None = None) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one per row of ``docs`` (columns doc_id, text; others are ignored).

    Without a network one is trained on the rows of ``labels`` (doc_id, quality) first; without any label all scores are 0.5. ``predicted``
    is 1 from a score of ``least`` on. A null or empty text is scored like zeros, so it has a score like any other. Texts of any length
    are read whole. A null doc_id is never learned from and has held_out null; of rows that repeat a doc_id one is learned from, and each
    is scored; an empty table gives no rows.
    """
    network = network or train(docs, labels)
    doc_id = F.col("doc_id").cast("long")
    out = docs.select(doc_id.alias("doc_id"), (~training_fold(doc_id)).alias("held_out"), quality(F.col("text").cast("string"), network).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= least).cast("int"))
