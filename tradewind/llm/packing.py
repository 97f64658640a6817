"""Packing along a space-filling curve: neighbouring documents share sequences, and only the last sequence is padded.

1. Each document is tokenised once; its hashed word vector is projected to a few dimensions and gets a Hilbert key.
   Rows are written with a row number that no retry can change.
2. The narrow rows (row number, key, tokens) are range-sorted by (key, row number), so that many documents with one key
   are spread over partitions. Token counts are summed inside each partition; one total per partition
   reaches the driver, and gives every document its place in one long line of tokens.
3. The line is cut at every multiple of the sequence length; the tokens join their place by row number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.arrays import BYTE_CODE, U64, Text, blocks, mix, prefix_sums, span_hashes, written

DIMENSIONS, LEVELS = 4, 8
#: Different words (with their spaces) whose tokens one Python worker remembers; beyond it, those not met for longest are forgotten.
REMEMBERED = 600_000
_BLOCK = 2 << 20


def hilbert_key(points: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Position on the Hilbert curve of whole-number points (n, dimensions) below 2^levels.

    Coordinates are turned from the highest bit down, so that each sub-cube is entered where the one before was left,
    Gray-coded across dimensions, and their bits interleaved.
    """
    x = points.astype(np.int64).copy()
    n = x.shape[1]
    for level in range(levels - 1, 0, -1):
        q = 1 << level
        for i in range(n):
            high = (x[:, i] & q) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & (q - 1))
            x[:, 0] = np.where(high, x[:, 0] ^ (q - 1), x[:, 0] ^ swap)
            x[:, i] ^= swap
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    for level in range(levels - 1, 0, -1):
        flip ^= np.where(x[:, n - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for level in range(levels - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[:, i] >> level) & 1)
    return key


def curve_keys(text: Text, dimensions: int = DIMENSIONS, levels: int = LEVELS) -> np.ndarray:
    """Hilbert keys of texts: signed sums of word hashes in each dimension, scaled to unit variance, cut into 2^levels steps."""
    words = text.words(lower=True)
    counts = np.diff(words.first)
    sums = np.zeros((text.rows, dimensions))
    full = np.flatnonzero(counts)
    signs = mix(words.hash)
    for d in range(dimensions):
        sign = ((signs >> U64(d)) & U64(1)).astype(np.int64) * 2 - 1
        if len(full):
            sums[full, d] = np.add.reduceat(sign, words.first[:-1][full])
    scaled = sums / np.sqrt(np.maximum(counts, 1))[:, None]
    steps = np.floor((np.clip(scaled, -4, 4) + 4) / 8 * (1 << levels)).clip(0, (1 << levels) - 1)
    return hilbert_key(steps.astype(np.int64), levels)


#: What may not follow the space before a word: white space, or the first byte of a code point that may be some.
_NO_WORD = np.zeros(256, bool)
_NO_WORD[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = True


class Encoder:
    """Token ids of texts; the tokens of a word, with the space before it, are computed once and remembered.

    A space followed by anything but white space always starts a new pre-token in byte-level vocabularies of this
    family, so a text is the line of its words cut there. A text with other spaces, or with a special token, which the tokenizer looks for
    first, is encoded as a whole. Words are told apart by 64-bit hashes.
    """

    def __init__(self, path: str | None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        self.tokenizer = Tokenizer.from_file(path)
        self.width = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Sorted hashes of the words known, where their tokens begin in ``tokens``, how many they are, and the block that had the word last.
        self.keys, self.first, self.size, self.used = np.zeros(0, U64), *np.zeros((3, 0), np.int64)
        self.tokens = np.zeros(0, self.width)
        self.block = 0

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width).tobytes()

    def _tokens(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words that follow a space, one word after another, and how many each has; from few calls.

        Words are set side by side; a token that starts with a space starts the next word.
        """
        length = end - start + 1
        edges = np.concatenate([[0], np.cumsum(length)])
        raw = data[np.repeat(start - 1 - edges[:-1], length) + np.arange(edges[-1])].tobytes()
        cuts = [*range(0, len(start), 2000), len(start)]
        lines = self.tokenizer.encode_batch_fast([raw[edges[a] : edges[b]].decode() for a, b in zip(cuts, cuts[1:])], add_special_tokens=False)
        ids, sizes = [np.zeros(0, self.width)], [np.zeros(0, np.int64)]
        for line, a, b in zip(lines, cuts, cuts[1:]):
            got = np.array(line.ids, np.int64)
            heads = np.flatnonzero(self.spaced[got])
            if len(heads) == b - a:
                ids.append(got.astype(self.width))
                sizes.append(np.diff(heads, append=len(got)))
                continue
            for i in range(a, b):
                ids.append(np.frombuffer(self._ids(raw[edges[i] : edges[i + 1]].decode()), self.width))
                sizes.append(np.array([len(ids[-1])]))
        return np.concatenate(ids), np.concatenate(sizes)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return at, (self.keys[at] == keys) if len(self.keys) else np.zeros(len(keys), bool)

    def _remember(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places of different words among those known, given their sorted hashes; new ones are added."""
        self.block += 1
        if len(self.keys) > REMEMBERED:
            kept = self.used > np.median(self.used)
            n = self.size[kept]
            self.tokens = _gathered(self.tokens, self.first[kept], n)
            self.keys, self.size, self.used, self.first = self.keys[kept], n, self.used[kept], np.cumsum(n) - n
        at, known = self._places(keys)
        if not known.all():
            new = ~known
            tokens, size = self._tokens(data, start[new], end[new])
            first = len(self.tokens) + np.cumsum(size) - size
            self.tokens = np.concatenate([self.tokens, tokens])
            keys_now = np.concatenate([self.keys, keys[new]])
            order = np.argsort(keys_now, kind="stable")
            self.keys = keys_now[order]
            self.first, self.size = np.concatenate([self.first, first])[order], np.concatenate([self.size, size])[order]
            self.used = np.concatenate([self.used, np.zeros(len(size), np.int64)])[order]
            at, _ = self._places(keys)
        self.used[at] = self.block
        return at

    def encode(self, text: Text) -> list[bytes]:
        """Ids of each row as bytes."""
        data, offsets = text.data, text.offsets
        if not len(data):
            return [b""] * text.rows
        space = data == 0x20
        last = offsets[1:][np.diff(offsets) > 0] - 1
        odd = space & np.append(_NO_WORD[data[1:]], True)
        odd[last] = space[last]
        whole = np.diff(np.concatenate([[0], np.cumsum(odd)])[offsets]) > 0
        raw = data.tobytes()
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                whole[np.searchsorted(offsets, at, "right") - 1] = True
                at = raw.find(token, at + 1)
        row = np.searchsorted(offsets, np.flatnonzero(space), "right") - 1
        start = np.flatnonzero(space)[~whole[row]] + 1
        row = row[~whole[row]]
        end = np.minimum(np.append(start[1:] - 1, len(data)), offsets[1:][row])
        hashes = span_hashes(prefix_sums(BYTE_CODE[data]), start, end) + mix((end - start).astype(U64))
        keys, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        place = self._remember(keys, data, start[at], end[at])[which]
        ids = _gathered(self.tokens, self.first[place], self.size[place])
        edges = np.concatenate([[0], np.cumsum(self.size[place])])[np.searchsorted(row, np.arange(text.rows + 1))].tolist()
        heads = np.concatenate([start - 1, [len(data)]])[np.searchsorted(start, offsets[:-1] + 1)]
        heads = np.minimum(heads, offsets[1:]).tolist()
        out = []
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            if whole[i]:
                out.append(self._ids(raw[a:b].decode()))
            else:
                head = self._ids(raw[a : heads[i]].decode()) if heads[i] > a else b""
                out.append(head + ids[edges[i] : edges[i + 1]].tobytes())
        return out


def _gathered(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Stretches of an array one after another."""
    before = np.cumsum(size) - size
    return values[np.repeat(first - before, size) + np.arange(size.sum())]


_ENCODERS: dict[str | None, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    """One encoder for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _tokenise(path: str | None, end: int):
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from_text = encoder(path)
        tail = np.array([end], from_text.width).tobytes()
        for batch in batches:
            for part in blocks(batch.column(1), _BLOCK):
                ids = [x + tail for x in from_text.encode(part)]
                counts = np.array([len(x) // from_text.width.itemsize for x in ids])
                doc_id = batch.column(0).slice(part.first, part.rows).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([doc_id, pa.array(curve_keys(part)), pa.array(counts), pa.array(ids, pa.binary())], schema=schema)

    return run, "doc_id long, key long, tokens long, ids binary"


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens before each row inside its sorted partition."""
    total = 0
    for batch in batches:
        tokens = batch.column(1).to_numpy()
        after = total + np.cumsum(tokens)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(after - tokens), pa.array(after)], names=["row", "before", "after"])
        total = int(after[-1]) if len(after) else total


def _cut(length: int):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = pa.schema([(n, pa.int64()) for n in names] + [("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                doc, tokens, place, data = (batch.column(i).slice(first, 500) for i in range(4))
                rows: list[tuple] = []
                lines = [np.zeros(0, "<u4")]
                for i, (d, n, p) in enumerate(zip(doc.to_pylist(), tokens.to_pylist(), place.to_pylist())):
                    raw = data[i].as_buffer()
                    ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                    lines.append(ids)
                    at = 0
                    while at < n:
                        sequence, offset = divmod(p + at, length)
                        size = min(length - offset, n - at)
                        rows.append((d, at, size, zlib.crc32(ids[at : at + size].tobytes()), n, sequence, offset))
                        at += size
                # Pieces follow each other without a gap, so their ids are the documents' lines end to end.
                ends = np.cumsum([0] + [r[2] for r in rows]).astype(np.int32)
                pieces = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lines).astype(np.int32)))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 7
                yield pa.RecordBatch.from_arrays([*columns, pieces], schema=schema)

    return run, ", ".join(f"{n} long" for n in names) + ", ids array<int>"


def packed(docs: DataFrame, length: int = 2048, tokenizer: str | None = None, end: int = 1) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids): every piece of every document.

    ``ids`` are the piece's token ids, ``ids_crc32`` the CRC of them as 32-bit little-endian numbers; a sequence is the ids of its
    pieces in the order of ``offset``. A document is its tokens and the id ``end``; its pieces follow each other in neighbouring sequences of ``length`` tokens, of
    which only the very last may be short. ``tokenizer`` is the path of a byte-level vocabulary that all executors can read (the
    public 50k one by default). A null or empty text is the end token alone; repeated rows are packed again; a null doc_id stays
    null; other columns are ignored; an empty table gives no rows.
    """
    run, schema = _tokenise(tokenizer, end)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tokens = written(texts.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "tokens")
    line = tokens.select("key", "row", "tokens").repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    line = line.select("row", "tokens").mapInArrow(_running, "row long, before long, after long")
    line = written(line.withColumn("part", F.spark_partition_id()), "line")
    offsets, total = [], 0
    for part, n in sorted(line.groupBy("part").agg(F.max("after").alias("n")).collect()):
        offsets.append((part, total))
        total += n
    places = docs.sparkSession.createDataFrame(offsets, "part int, earlier long")
    line = line.join(F.broadcast(places), "part").select("row", (F.col("earlier") + F.col("before")).alias("place"))
    run, schema = _cut(length)
    return tokens.drop("key").join(line, "row").select("doc_id", "tokens", "place", "ids").mapInArrow(run, schema)
