"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE_WORDS words. A passage is read as its words and its
runs of three bytes, each hashed to a bucket with an embedding, and as shares of character
classes, word lengths and repetition (of words inside it, of word pairs from earlier in the
document). The embeddings, weighted by how often a bucket occurs, add up to the passage code
h through a tanh. Only documents have labels; gated attention, a softmax over
w . (tanh(V h) * sigmoid(U h)), learns which passages decide, and a logistic layer scores
the weighted sum of passage codes. Embeddings, attention and score are fitted together.

The model is fitted on at most TRAIN_DOCS labelled documents with at most TRAIN_BYTES of text
together, those with the least hash of their id, whose passages are encoded in tasks; only the
codes come to the driver. Scoring encodes every passage of every whole text, a bounded number of
texts at a time and one at least, so a very long text needs memory for all its passages.

Null and empty texts are one passage of zeros and get its score. Labels of repeated rows are
averaged, null labels are ignored. Without any label every score is 0.5. Repeated rows of
documents are scored each; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import runs, text_of
from chatlake.session import lookup

PASSAGE_WORDS = 64
TRAIN_DOCS = 4000
TRAIN_BYTES = 12 << 20
HIDDEN, GATES = 16, 8
EPOCHS, RATE, DECAY = 300, 0.02, 1e-4
SLICE_BYTES = 1 << 20

# Classes of bytes; letters beyond ASCII count as small letters.
_GROUPS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\x0b\x0c\r", "\n", ".,;:?", "'\"-()", "!", "#", "$", "%", "&", "*", "|", "<>=+/\\@_^~`[]{}"]
_KINDS = len(_GROUPS)
_KIND = np.zeros(256, np.uint8)
for _i, _chars in enumerate(_GROUPS):
    _KIND[np.frombuffer(_chars.encode(), np.uint8)] = _i
_COUNTS = _KINDS + 5
# Buckets of words and of byte runs.
BUCKETS = 256
WIDTH = _COUNTS + 2 * BUCKETS
_RUN = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


class _Buckets(dict):
    """Bucket of every word; emptied when it holds many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        self[word] = zlib.crc32(word) % BUCKETS
        return self[word]


_bucket_of = _Buckets()


def encode(text: bytes) -> np.ndarray:
    """One row of WIDTH features per passage."""
    words = text.split()
    if not words:
        return np.zeros((1, WIDTH), np.float32)
    data = np.frombuffer(text, np.uint8)
    kinds = _KIND[data]
    solid = (kinds != 3) & (kinds != 4)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    starts = np.flatnonzero(first)[::PASSAGE_WORDS]
    starts[0] = 0
    n = len(starts)
    sizes = np.diff(np.append(starts, len(data)))
    counts = np.bincount(np.repeat(np.arange(n) * _KINDS, sizes) + kinds, minlength=n * _KINDS).reshape(n, _KINDS)
    out = np.empty((n, WIDTH), np.float32)
    out[:, :_KINDS] = np.sqrt(counts / sizes[:, None])
    letters = np.maximum(1, counts[:, 0] + counts[:, 1])
    out[:, _KINDS] = counts[:, 1] / letters
    own = np.array(list(map(_bucket_of.__getitem__, words)))
    part = np.arange(len(words)) // PASSAGE_WORDS
    found = np.bincount(part * BUCKETS + own, minlength=n * BUCKETS).reshape(n, BUCKETS)
    out[:, _COUNTS : _COUNTS + BUCKETS] = np.sqrt(found / np.bincount(part)[:, None])
    three = np.zeros(len(data), np.uint32)
    three[:-2] = data[:-2] * _RUN[0] + data[1:-1] * _RUN[1] + data[2:] * _RUN[2] if len(data) > 2 else 0
    found = np.bincount(np.repeat(np.arange(n) * BUCKETS, sizes) + (three >> np.uint32(24)), minlength=n * BUCKETS).reshape(n, BUCKETS)
    out[:, _COUNTS + BUCKETS :] = np.sqrt(found / sizes[:, None])
    seen: set = set()
    for p in range(n):
        own = words[p * PASSAGE_WORDS : (p + 1) * PASSAGE_WORDS]
        pairs = set(zip(own, own[1:]))
        out[p, _KINDS + 1] = sum(map(len, own)) / len(own) / 10
        out[p, _KINDS + 2] = len(set(own)) / len(own)
        out[p, _KINDS + 3] = len(pairs & seen) / max(1, len(pairs))
        out[p, _KINDS + 4] = len(pairs) / max(1, len(own) - 1)
        seen |= pairs
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Gated attention over passage codes."""

    def __init__(self) -> None:
        draw = np.random.default_rng(7)
        self.mean, self.scale = np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32)
        self.p = {
            "E": draw.normal(0, WIDTH**-0.5, (WIDTH, HIDDEN)),
            "e": np.zeros(HIDDEN),
            "V": draw.normal(0, HIDDEN**-0.5, (HIDDEN, GATES)),
            "U": draw.normal(0, HIDDEN**-0.5, (HIDDEN, GATES)),
            "w": draw.normal(0, GATES**-0.5, GATES),
            "o": np.zeros(HIDDEN),
            "b": np.zeros(1),
        }

    def _forward(self, x: np.ndarray, starts: np.ndarray) -> tuple:
        p = self.p
        h = np.tanh(x @ p["E"].astype(x.dtype) + p["e"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        a = (t * g) @ p["w"]
        sizes = np.diff(np.append(starts, len(x)))
        a = np.exp(a - np.repeat(np.maximum.reduceat(a, starts), sizes))
        a /= np.repeat(np.add.reduceat(a, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        return h, t, g, a, z, sizes, _sigmoid(z @ p["o"] + p["b"])

    def _gradient(self, x: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy of the labels."""
        p = self.p
        h, t, g, a, z, sizes, y = self._forward(x, starts)
        dy = (y - labels) / len(labels)
        grad = {"o": z.T @ dy, "b": dy.sum(keepdims=True)}
        dz = np.repeat(dy[:, None] * p["o"], sizes, axis=0)
        along = (dz * h).sum(1)
        da = a * (along - np.repeat(np.add.reduceat(a * along, starts), sizes))
        grad["w"] = (t * g).T @ da
        dt, dg = da[:, None] * p["w"] * g * (1 - t * t), da[:, None] * p["w"] * t * g * (1 - g)
        grad["V"], grad["U"] = h.T @ dt, h.T @ dg
        dh = (a[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
        grad["E"], grad["e"] = x.T @ dh.astype(x.dtype), dh.sum(0)
        return grad

    def fit(self, bags: list[np.ndarray], labels: np.ndarray) -> None:
        x = np.concatenate(bags)
        self.mean, self.scale = x.mean(0, dtype=np.float64).astype(np.float32), (x.std(0, dtype=np.float64) + 0.02).astype(np.float32)
        # all buckets of a kind together weigh as much as the counts
        self.scale[_COUNTS:] *= np.float32((BUCKETS / _COUNTS) ** 0.5)
        x -= self.mean
        x /= self.scale
        starts = np.cumsum([0] + [len(b) for b in bags[:-1]])
        p, steps = self.p, {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        for epoch in range(1, EPOCHS + 1):
            grad = self._gradient(x, starts, labels)
            for k, v in grad.items():
                v = v + DECAY * p[k]
                m, s = steps[k]
                m += 0.1 * (v - m)
                s += 0.01 * (v * v - s)
                p[k] = p[k] - RATE * (m / (1 - 0.9**epoch)) / (np.sqrt(s / (1 - 0.99**epoch)) + 1e-8)

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        starts = np.cumsum([0] + [len(b) for b in bags[:-1]])
        found = self._forward((np.concatenate(bags) - self.mean) / self.scale, starts)[-1]
        return found.round(9)  # sums differ in the last bits with the place in the batch


def learn(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model | None:
    """Fit on the ``allowed`` rows of ``labels`` (a condition on the id); None without labels."""
    known = labels.where(allowed & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.avg(F.col(label_col).cast("double")).alias("label"))
    total = known.count()
    if not total:
        return None
    ticket = F.crc32(F.concat(F.lit("sample-"), F.col("id").cast("string")).cast("binary"))
    drawn = known.withColumn("ticket", ticket).where(F.col("ticket") < int((1 << 32) * min(1.0, TRAIN_DOCS / total)) + 1)
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(lookup(drawn), "id").select("id", "text", "ticket", "label")
    # a few thousand numbers: how far the documents go in the order of their tickets
    sizes = sorted(texts.select("ticket", F.octet_length("text")).collect())
    reached = np.cumsum([size for _, size in sizes])
    last = [t for (t, _), n in zip(sizes, reached) if n <= TRAIN_BYTES]
    texts = texts.where((F.col("ticket") <= (last[-1] if last else -1)) & (F.octet_length("text") <= TRAIN_BYTES))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [encode(x.as_buffer().to_pybytes()).tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), pa.array(codes, pa.binary())], ["ticket", "label", "codes"])

    rows = texts.mapInArrow(work, "ticket long, label double, codes binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["ticket"], r["codes"]))
    model = Model()
    model.fit([np.frombuffer(r["codes"], np.float32).reshape(-1, WIDTH) for r in rows], np.array([r["label"] for r in rows]))
    return model


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` per row."""
    if model is None:
        return docs.select(id_col, F.lit(0.5).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            column = batch.column(1)
            for a, b in runs(pc.binary_length(column).to_pylist(), SLICE_BYTES):
                bags = [encode(column[i].as_buffer().to_pybytes()) for i in range(a, b)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(own.score(bags), pa.float64())], [id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_of(text_col).alias("text")).mapInArrow(work, f"`{id_col}` {kind}, score double")
