"""Quality classifier: gated attention-based multiple-instance learning.

A document is a bag of passages of ``passage_bytes`` UTF-8 bytes. Every passage is
encoded by hashed byte-pair counts and a few shape counts, then by a learned ``tanh``
layer ``h``. Gated attention ``a = softmax(w . (tanh(V h) * sigmoid(U h)))`` weighs the
passages of a bag, and a logistic unit scores the weighted sum ``sum a h``. All
weights are learned from document labels alone.

Bounded fit: at most ``max_fit`` labelled documents per class (smallest hashes of the
id), with every passage of their whole texts; their features are held on the driver as half floats. Scoring covers every passage of every
document, in place, without a shuffle.

Edge cases: a null or empty text is a bag of one empty passage and gets a score like
any other. A null id has a row with a null id. Repeated rows are scored each. Null
labels are not used; if a document has several labels, the largest counts. If a class has
no labelled document, every score is the share of label 1 (0.5 if there is none).
An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fit_sample, slices

PAIRS = 512  # hashed byte pairs
SHAPES = 8


def passages(text: bytes, size: int) -> np.ndarray:
    """One row of features for each ``size`` bytes of a text."""
    n = max(1, -(-len(text) // size))
    raw = np.zeros(n * size, np.uint8)
    raw[: len(text)] = np.frombuffer(text, np.uint8)
    rows = raw.reshape(n, size)
    used = np.full(n, size, np.float32)
    used[-1] = max(1, len(text) - (n - 1) * size)
    here = np.repeat(np.arange(n, dtype=np.int64) * PAIRS, size - 1)
    pair = (rows[:, :-1].astype(np.uint32) * 31 + rows[:, 1:].astype(np.uint32) * 2047) % PAIRS
    counts = np.bincount(here + pair.reshape(-1), minlength=n * PAIRS).reshape(n, PAIRS)
    shapes = np.empty((n, SHAPES), np.float32)
    shapes[:, 0] = ((rows >= 65) & (rows <= 90)).sum(1) / used
    shapes[:, 1] = ((rows >= 97) & (rows <= 122)).sum(1) / used
    shapes[:, 2] = ((rows >= 48) & (rows <= 57)).sum(1) / used
    shapes[:, 3] = ((rows > 32) & (rows < 48)).sum(1) / used
    shapes[:, 4] = (rows == 32).sum(1) / used
    shapes[:, 5] = (rows >= 128).sum(1) / used
    shapes[:, 6] = (counts > 0).sum(1) / np.minimum(used, PAIRS)  # variety: low if words repeat
    shapes[:, 7] = np.log(used) / 10
    return np.hstack([np.log1p(counts * (100 / used[:, None])).astype(np.float32), shapes])


@dataclass
class MilModel:
    """Weights of the encoder, the gated attention and the classifier."""

    size: int
    mean: np.ndarray
    scale: np.ndarray
    params: dict[str, np.ndarray]
    constant: float | None = None

    def logits(self, feats: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One logit for each bag; ``starts`` are the bags' first rows."""
        return _forward(self.params, (feats - self.mean) * self.scale, starts)[0]

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        out, bags, rows = np.empty(len(texts)), [], 0
        first = 0
        for k, t in enumerate(texts):  # about 4,000 passages at a time
            bags.append(passages(t, self.size))
            rows += len(bags[-1])
            if rows >= 4000 or k == len(texts) - 1:
                starts = np.cumsum([0, *map(len, bags[:-1])])
                out[first : k + 1] = 1 / (1 + np.exp(-np.clip(self.logits(np.vstack(bags), starts), -30, 30)))
                first, bags, rows = k + 1, [], 0
        return out


def _forward(p: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray):
    h = np.tanh(x @ p["W"] + p["b"])
    t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
    e = (t * g) @ p["w"]
    sizes = np.diff(np.append(starts, len(x)))
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
    a = e / np.repeat(np.add.reduceat(e, starts), sizes)
    z = np.add.reduceat(a[:, None] * h, starts)
    return z @ p["c"] + p["d"][0], (h, t, g, a, z, sizes)


def _gradient(p: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    logit, (h, t, g, a, z, sizes) = _forward(p, x, starts)
    dl = weight * (1 / (1 + np.exp(-logit)) - y) / weight.sum()
    dz = np.repeat(dl[:, None] * p["c"], sizes, axis=0)
    da = (dz * h).sum(1)
    de = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
    dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
    dh = (a[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
    return {"c": z.T @ dl, "d": np.array([dl.sum()]), "w": (t * g).T @ de, "V": h.T @ dt, "U": h.T @ dg, "W": x.T @ dh, "b": dh.sum(0)}


def train(bags: list[np.ndarray], labels: np.ndarray, size: int, hidden: int = 24, gate: int = 12, epochs: int = 25, seed: int = 7) -> MilModel:
    """Adam on the class-balanced log loss."""
    rng = np.random.default_rng(seed)
    total = sum(len(b) for b in bags)
    mean = sum(b.sum(0, dtype=np.float64) for b in bags) / total
    var = sum(((b[i : i + 1024] - mean) ** 2).sum(0) for b in bags for i in range(0, len(b), 1024)) / total
    mean, scale = mean.astype(np.float32), (1 / np.sqrt(var + 1e-4)).astype(np.float32)
    d = len(mean)
    p = {
        "W": rng.normal(0, d**-0.5, (d, hidden)), "b": np.zeros(hidden), "V": rng.normal(0, hidden**-0.5, (hidden, gate)),
        "U": rng.normal(0, hidden**-0.5, (hidden, gate)), "w": rng.normal(0, gate**-0.5, gate), "c": rng.normal(0, 0.1, hidden), "d": np.zeros(1),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), 128):
            pick = order[at : at + 128]
            x = (np.vstack([bags[i] for i in pick]).astype(np.float32) - mean) * scale
            starts = np.cumsum([0, *(len(bags[i]) for i in pick[:-1])])
            grad = _gradient(p, x, starts, labels[pick], weight[pick])
            step += 1
            for k in p:
                gk = grad[k] + (1e-4 * p[k] if k == "W" else 0)
                m[k] = 0.9 * m[k] + 0.1 * gk
                v[k] = 0.999 * v[k] + 0.001 * gk * gk
                p[k] = (p[k] - 0.003 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return MilModel(size, mean, scale, p)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    usable: Column | None = None,
    passage_bytes: int = 512,
    max_fit: int = 2000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> MilModel:
    """Learn from the labelled rows for which ``usable`` holds."""
    sample = fit_sample(docs, labels, label_col, usable, max_fit, id_col, text_col)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = [passages((t or "").encode(), passage_bytes).astype("<f2").tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("label"), pa.array(rows, pa.binary())], ["key", "label", "feats"])

    got = sample.mapInArrow(encode, "key long, label int, feats binary").toPandas().sort_values(["key", "label", "feats"])
    y = got["label"].to_numpy(np.float32)
    if len(set(y)) < 2:
        empty = np.zeros(0, np.float32)
        return MilModel(passage_bytes, empty, empty, {}, float(y.mean()) if len(y) else 0.5)
    # half floats, made whole a mini-batch at a time
    bags = [np.frombuffer(b, "<f2").reshape(-1, PAIRS + SHAPES) for b in got["feats"]]
    return train(bags, y, passage_bytes)


def score(docs: DataFrame, model: MilModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            s = model.score([(t or "").encode() for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(s, pa.float64()), pa.array(s >= 0.5).cast(pa.int32())], ["doc_id", "score", "predicted"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")
