"""Quality by a byte-level convolutional network in NumPy.

Bytes are embedded; learned filters run over overlapping chunks (16 bytes, every 8) that cover the whole document; each filter's
maximum over all chunks goes into a logistic unit. The network is trained on the driver from a bounded sample of labelled
documents (``PER_CLASS`` rows of each class, and of a text over ``MAX_BYTES`` bytes ``WINDOWS`` even windows of as many
together; only its maxima carry gradients), and scores every document in the tasks, long ones in parts of ``PART`` chunks.

Defined cases: null and empty texts score as one chunk of zeros; repeated rows give repeated results; without labelled
documents of both classes the score is their share of good ones (0.5 if there are none); other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.text import doc_texts, flat_bytes, labelled_sample, learnable, mapped, steps

CHUNK, HOP, EMBEDDED, FILTERS = 16, 8, 8, 32
PER_CLASS, MAX_BYTES, WINDOWS, EPOCHS, BATCH = 2000, 4096, 16, 12, 64
#: Chunks that one step works on.
PART = 1 << 17
PREDICT = 0.7


def laid_out(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, first chunk of each text): texts padded with zeros so that each begins a chunk and none reaches the next."""
    size = np.diff(offsets)
    chunks = np.maximum(1, -(-size // HOP))
    room = (chunks + CHUNK // HOP - 1) * HOP
    begin = np.cumsum(room) - room
    out = np.zeros(int(room.sum()), np.uint8)
    out[np.repeat(begin - offsets[:-1], size) + np.arange(len(flat))] = flat
    return out, begin // HOP


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {
            "embed": r.normal(0, 0.5, (256, EMBEDDED)).astype(np.float32),
            "filter": r.normal(0, (CHUNK * EMBEDDED) ** -0.5, (CHUNK * EMBEDDED, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "out": r.normal(0, 0.3, FILTERS).astype(np.float32),
            "base": np.zeros(1, np.float32),
        }
        self.constant: float | None = None

    def responses(self, padded: np.ndarray) -> np.ndarray:
        """Filter responses of every chunk; some belong to padding."""
        embedded = self.p["embed"][padded].reshape(-1, HOP * EMBEDDED)
        parts = CHUNK // HOP
        n = len(embedded) - parts + 1
        w = self.p["filter"].reshape(parts, HOP * EMBEDDED, FILTERS)
        out = embedded[:n] @ w[0]
        for k in range(1, parts):
            out += embedded[k : n + k] @ w[k]
        return out

    def pooled(self, padded: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The maximum of each filter over each text's own chunks; those that begin in the padding after a text are passed over."""
        if len(first) == 1:
            parts = range(0, max(1, len(padded) // HOP - CHUNK // HOP + 1), PART)
            return np.max([self.responses(padded[p * HOP : (p + PART - 1) * HOP + CHUNK]).max(axis=0) for p in parts], axis=0)[None]
        r = self.responses(padded)
        spare = CHUNK // HOP - 1
        bounds = np.stack([first, np.append(first[1:] - spare, len(r))], axis=1).ravel()
        return np.maximum.reduceat(r, bounds[:-1], axis=0)[::2]

    def probability(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(offsets) - 1, self.constant)
        top = np.maximum(self.pooled(*laid_out(flat, offsets)) + self.p["bias"], 0)
        return 1 / (1 + np.exp(-(top @ self.p["out"] + self.p["base"]).astype(np.float64)))

    def fit(self, texts: list[str], labels: np.ndarray, seed: int = 7) -> Network:
        if not 0 < labels.sum() < len(labels):
            self.constant = float(labels.mean()) if len(labels) else 0.5
            return self
        raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
        weight = np.where(labels == 1, len(labels) / labels.sum(), len(labels) / (len(labels) - labels.sum())) / 2
        r = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(EPOCHS):
            order = r.permutation(len(raw))
            for i in range(0, len(order), BATCH):
                step += 1
                chosen = order[i : i + BATCH]
                grads = self.gradients([raw[k] for k in chosen], labels[chosen], weight[chosen])
                rate = 0.01 * (1 - epoch / EPOCHS) + 0.001
                for k, g in grads.items():
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.999 * square[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def gradients(self, raw: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        padded, first = laid_out(np.concatenate(raw), offsets)
        r = self.responses(padded)
        ends = np.append(first[1:], len(r) + 1) - 1
        best = np.stack([a + r[a : max(b, a + 1)].argmax(axis=0) for a, b in zip(first, ends, strict=True)])
        top = r[best, np.arange(FILTERS)]
        z = top + self.p["bias"]
        a = np.maximum(z, 0)
        d = (weight * (1 / (1 + np.exp(-(a @ self.p["out"] + self.p["base"]))) - y) / len(raw)).astype(np.float32)
        dz = d[:, None] * self.p["out"] * (z > 0)
        bytes_ = padded[(best * HOP)[:, :, None] + np.arange(CHUNK)]  # texts x filters x chunk
        seen = self.p["embed"][bytes_].reshape(len(raw), FILTERS, -1)
        de = np.zeros_like(self.p["embed"])
        np.add.at(de, bytes_, dz[:, :, None, None] * self.p["filter"].T.reshape(FILTERS, CHUNK, EMBEDDED))
        return {"embed": de, "filter": np.einsum("df,dfx->xf", dz, seen) + 1e-4 * self.p["filter"], "bias": dz.sum(axis=0), "out": a.T @ d + 1e-4 * self.p["out"], "base": np.array([d.sum()], np.float32)}


def trained(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Network:
    return Network().fit(*labelled_sample(docs, labels, label, PER_CLASS, drawn))


def drawn(text: str) -> str:
    """The text, or even windows of a long one."""
    if len(text) * 4 <= MAX_BYTES or len(raw := text.encode()) <= MAX_BYTES:
        return text
    size = MAX_BYTES // WINDOWS
    return b"".join(raw[p : p + size] for p in np.linspace(0, len(raw) - size, WINDOWS).astype(int).tolist()).decode(errors="ignore")


def scored(docs: DataFrame, network: Network) -> DataFrame:
    """doc_id, held_out, score, predicted of each document."""
    shared = docs.sparkSession.sparkContext.broadcast((network.p, network.constant))
    own = doc_texts(docs).withColumn("held_out", ~learnable(F.col("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network()
        model.p, model.constant = shared.value
        for batch in batches:
            flat, offsets = flat_bytes(batch.column("text"))
            parts = [model.probability(flat[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in steps(offsets)]
            score = np.concatenate([np.zeros(0), *parts])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= PREDICT).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return mapped(own.select("doc_id", "text", "held_out"), run, "doc_id long, held_out boolean, score double, predicted int")
