"""Toxicity by nearest labelled examples under exact TF-IDF cosine, found in a block-max inverted index.

Terms are words (runs of letters and of characters beyond ASCII, lower case) and their beginnings of five letters, so that
inflected and compound forms meet; a form that stands in a text twice or three times is a further
term (``form@2``, ``form@3``), as a word may be harmless once. A weight is ``(1 + ln tf) * idf * gain``, and rows have unit
length over all their terms, known or not. ``idf`` comes from the sampled examples, the two classes weighted by their shares among
the labelled rows; a term of no example has the largest. ``gain`` is ``1 + sqrt(chi2)`` of a term that is likelier in label 1
of the sample, else 1, so that a topic does not hide a few telling words.
The forms, the gain and k were chosen by four folds of rows that may be learned from.

All sampled examples of both labels are indexed. They are laid out by their most frequent term, label and heaviest term, so
that like ones share a block of ``block`` rows. The long lists, of the ``common`` most frequent terms, are cut into these blocks, with
the largest weight of each term in each block; within a block they are a dense matrix. The short lists of the other terms are summed
first. A text's bound for a block is the product of its weights with the block's maxima and the largest sum of the short lists there. Texts take
their blocks in descending order of the bound, in rounds of growing size, and stop as soon as the next bound is below the k-th
cosine found; all blocks after that are skipped. The neighbours are exact (cosines to six decimals, ties to the smaller id).

The votes of the neighbours, weighted by ``1 / (1 - cosine + 0.1)``, and ``prior_weight`` votes of the
base rate give a raw share; a logistic curve fitted to the examples' own shares (each left out
of its vote) calibrates it. ``evidence`` lists the nearest examples with label 1.

Bounded fit: at most ``max_fit`` labelled documents per class (smallest hashes of the id), whole texts; vocabulary, weights and
index are made of these alone and go along with each task. Scoring is one pass over all whole texts without a shuffle.

Edge cases: a null or empty text, or one without a known term, has no neighbour and gets
the calibrated base rate. A null id has a row with a null id. Repeated rows are scored
each. If a class has no labelled document, every score is the share of label 1 (0 if there
is none). An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, fit_sample, slices, text_hash

_ROOM = 1 << 18  # distinct terms counted at a time in a task
_POSTINGS = 1 << 20  # entries of short lists gathered at a time
_SLACK = 1e-5  # above the rounding of cosines
REPEATS = (2, 3)
BEGINNING = 5
_BLANK = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))


def words(text: str | None) -> list[str]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_BLANK).decode("utf-8", "surrogatepass").split() if text else []


def forms(word: str) -> list[str]:
    """The word and its beginning (marked by a hyphen)."""
    return [word, word[:BEGINNING] + "-"] if len(word) >= BEGINNING else [word]


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + size - 1`` of each pair, one after another."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


class BlockMaxIndex:
    """Unit rows of the examples by term. ``example``, ``term`` and ``weight`` are the entries; terms below ``common``
    are the most frequent ones. ``visited`` and ``skipped`` count blocks over all searches."""

    def __init__(self, example: np.ndarray, term: np.ndarray, weight: np.ndarray, labels: np.ndarray, ids: np.ndarray, terms: int, common: int = 2048, block: int = 64) -> None:
        self.labels, self.ids, self.block, self.common = labels, ids, block, min(common, terms)
        self.blocks = -(-len(ids) // block)
        order = np.lexsort((example, term))
        self.example = example[order].astype(np.min_scalar_type(len(ids)))
        self.weight = weight[order].astype(np.float32)
        self.ends = np.cumsum(np.bincount(term, minlength=terms)).astype(np.uint32)
        self._fill()

    def _fill(self) -> None:
        c = self.common
        n = int(self.ends[c - 1]) if c else 0
        self.rows = np.zeros((self.blocks * self.block, c), np.float32)
        self.rows[self.example[:n], np.repeat(np.arange(c), np.diff(self.ends[:c].astype(np.int64), prepend=0))] = self.weight[:n]
        self.most = np.ascontiguousarray(self.rows.reshape(self.blocks, self.block, c).max(axis=1).T)
        self.visited = self.skipped = 0

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("rows", "most")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._fill()

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, but: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """Positions and cosines of the k nearest rows with a positive cosine, for each query (ascending terms,
        weights); ``but`` names a position for each query that is left out."""
        nq, width = len(queries), self.block
        dense = np.zeros((nq, self.common), np.float32)
        sparse = []
        for i, (at, w) in enumerate(queries):
            n = np.searchsorted(at, self.common)
            dense[i, at[:n]] = w[:n]
            sparse.append((at[n:], w[n:]))
        # the short lists of the less frequent terms, as a whole, a bounded number of entries at a time
        short = np.zeros((nq, self.blocks, width), np.float32)
        load = np.cumsum([self._entries(at)[1].sum() for at, _ in sparse])
        begin = 0
        while begin < nq:
            done = load[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(load, done + _POSTINGS, "right")))
            short[begin:end] = self._short(sparse[begin:end])
            begin = end
        bound = dense @ self.most + short.max(axis=2)
        order = np.argsort(-bound, axis=1, kind="stable")
        ranked = np.take_along_axis(bound, order, 1)
        cos = np.zeros((nq, self.blocks, width), np.float32)
        best = np.zeros((nq, k), np.float32)
        begin, step, visited = 0, 4, 0
        while begin < self.blocks:
            # a block that cannot reach the k-th cosine found so far is skipped, and so are all after it
            wanted = ranked[:, begin : begin + step] > np.maximum(best.min(axis=1) - _SLACK, 0)[:, None]
            if not wanted.any():
                break
            who, which = np.nonzero(wanted)
            block = order[who, begin + which]
            by = np.argsort(block, kind="stable")
            for part in np.split(by, np.flatnonzero(np.diff(block[by])) + 1):
                b, q = block[part[0]], who[part]
                cos[q, b] = dense[q] @ self.rows[b * width : (b + 1) * width].T + short[q, b]
            if but is not None:
                cos.reshape(nq, -1)[np.arange(nq), but] = 0
            fresh = np.zeros((nq, wanted.shape[1], width), np.float32)
            fresh[who, which] = cos[who, block]
            best = np.partition(np.concatenate([best, fresh.reshape(nq, -1)], axis=1), -k, axis=1)[:, -k:]
            visited += len(who)
            begin, step = begin + step, step * 2
        self.visited += visited
        self.skipped += nq * self.blocks - visited
        # nothing further than rounding below the k-th cosine can be among the first k
        who, row = np.nonzero(cos.reshape(nq, -1) > np.maximum(best.min(axis=1) - _SLACK, 0)[:, None])
        value = np.round(cos.reshape(nq, -1)[who, row].astype(float), 6)
        near = np.lexsort((self.ids[row], -value, who))
        near = near[value[near] > 0]
        parts = np.split(near, np.searchsorted(who[near], np.arange(1, nq)))
        return [(row[p[:k]], value[p[:k]]) for p in parts]

    def _entries(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First entry and number of entries of the lists of these terms."""
        at = at.astype(np.int64)
        start = np.where(at > 0, self.ends[at - 1], 0).astype(np.int64) if len(at) else at
        return start, self.ends[at].astype(np.int64) - start

    def _short(self, sparse: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Sums of the short lists: the part of each example's cosine, for each query (terms, weights)."""
        nq, width = len(sparse), self.block
        start, size = self._entries(np.concatenate([t for t, _ in sparse]))
        posting = _spans(start, size)
        row = np.repeat(np.repeat(np.arange(nq), [len(t) for t, _ in sparse]) * (self.blocks * width), size) + self.example[posting]
        value = np.repeat(np.concatenate([w for _, w in sparse]).astype(np.float32), size) * self.weight[posting]
        return np.bincount(row, value, nq * self.blocks * width).astype(np.float32).reshape(nq, self.blocks, width)


def layout(example: np.ndarray, term: np.ndarray, tf: np.ndarray, weight: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """An order of the examples in which like ones are neighbours: by most frequent term, label and heaviest term."""
    n = len(labels)

    def leading(by: np.ndarray) -> np.ndarray:
        out = np.full(n, -1)
        last = np.lexsort((-term, by))
        out[example[last]] = term[last]  # the largest is written last
        return out

    return np.lexsort((leading(weight), labels, leading(tf)))


def _listed(names: list[str]) -> bytes:
    return zlib.compress("\n".join(names).encode("utf-8", "surrogatepass"))


def _terms(listed: bytes) -> dict[str, int]:
    names = zlib.decompress(listed).decode("utf-8", "surrogatepass").split("\n") if listed else []
    return {t: i for i, t in enumerate(names) if t}


def repeated(found: list[str]) -> dict[str, int]:
    """Terms of a text with their counts; ``form@r`` counts from the r-th occurrence."""
    plain: Counter = Counter()
    for w, n in Counter(found).items():
        for f in forms(w):
            plain[f] += n
    return {term: n - r + 1 for f, n in plain.items() for r in (1, *REPEATS) if n >= r for term in [f if r == 1 else f"{f}@{r}"]}


class TermFinder:
    """Counts of terms in texts."""

    def __init__(self, terms: dict[str, int]) -> None:
        self.word: dict[str, int] = {}
        self.begin: dict[str, int] = {}
        of, times, at = array("i"), array("i"), array("i")
        for term, place in terms.items():
            form, _, r = term.partition("@")
            known, form = (self.begin, form[:-1]) if form.endswith("-") else (self.word, form)
            of.append(known.setdefault(form, len(self.word) + len(self.begin)))
            times.append(int(r or 1) - 1)
            at.append(place)
        self.size = len(self.word) + len(self.begin)
        self.place = np.full((self.size + 1, 1 + len(REPEATS)), -1, np.int32)  # the last row is for forms of no example
        self.place[of, times] = at

    def count(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ascending vocabulary positions, their counts, and the counts of the other terms."""
        found = words(text)
        form, total = [], []
        for known, counted in ((self.word, Counter(found)), (self.begin, Counter([w[:BEGINNING] for w in found if len(w) >= BEGINNING]))):
            form.append(np.fromiter(map(known.get, counted, repeat(self.size)), np.int64, len(counted)))
            total.append(np.fromiter(counted.values(), np.int64, len(counted)))
        form, total = np.concatenate(form), np.concatenate(total)
        at, tf, other = [], [], []
        for r in (1, *REPEATS):
            if r > 1:
                form, total = form[total >= r], total[total >= r]
            n, place = total - (r - 1), self.place[form, r - 1]
            at.append(place[place >= 0])
            tf.append(n[place >= 0])
            other.append(n[place < 0])
        at, tf = np.concatenate(at), np.concatenate(tf)
        order = np.argsort(at)
        return at[order], tf[order], np.concatenate(other)

    def find(self, text: str | None) -> dict[int, int]:
        """Occurrences of each term, by position in the vocabulary."""
        at, tf, _ = self.count(text)
        return dict(zip(at.tolist(), tf.tolist(), strict=True))


@dataclass
class KnnModel:
    """Vocabulary (the most frequent terms first), weights, index and calibration."""

    listed: bytes  # the terms in the order of their positions, packed
    idf: np.ndarray
    gain: np.ndarray
    index: BlockMaxIndex | None
    rate: float
    unseen: float = 1.0  # idf of a term of no example
    k: int = 15
    prior_weight: float = 1.0
    slope: float = 1.0
    offset: float = 0.0

    @property
    def terms(self) -> dict[str, int]:
        return _terms(self.listed)

    def vector(self, at: np.ndarray, tf: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of a text; its length is 1 together with the terms of no example."""
        x = (1 + np.log(tf)) * self.idf[at] * self.gain[at]
        rest = (1 + np.log(other)) * self.unseen
        return at, x / max(np.sqrt((x * x).sum() + (rest * rest).sum()), 1e-12)

    def share(self, cos: np.ndarray, y: np.ndarray) -> float:
        """Raw share of label 1 of neighbours with these cosines and labels."""
        votes = 1 / (1.1 - np.minimum(cos, 1))
        return float(((votes * y).sum() + self.prior_weight * self.rate) / (votes.sum() + self.prior_weight))

    def calibrated(self, share: float) -> float:
        share = min(max(share, 1e-4), 1 - 1e-4)
        return 1 / (1 + np.exp(-(self.slope * np.log(share / (1 - share)) + self.offset)))


def _logistic(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted logistic fit (Newton steps, slightly held at 1 and 0)."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * z + b)))
        g = np.array([(weight * (p - y) * z).sum() + (a - 1), (weight * (p - y)).sum() + b])
        v = weight * p * (1 - p)
        h = np.array([[(v * z * z).sum() + 1, (v * z).sum()], [(v * z).sum(), v.sum() + 1]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def _form_counts(texts: DataFrame) -> DataFrame:
    """``(term, label, n)``: texts of each label that hold a word form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def flush() -> pa.RecordBatch:
            keys = list(total)
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in keys], pa.string()), pa.array([y for _, y in keys], pa.int32()), pa.array(list(total.values()), pa.int64())],
                ["term", "label", "n"],
            )

        for b in slices(batches):
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist(), strict=True):
                total.update((term, label) for term in repeated(words(text)))
                if len(total) > _ROOM:
                    yield flush()
                    total.clear()
        yield flush()

    return texts.select("text", "label").mapInArrow(run, "term string, label int, n long").groupBy("term", "label").agg(F.sum("n").alias("n"))


def fit(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    usable: Column | None = None,
    max_fit: int = 3000,
    common: int = 2048,
    block: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> KnnModel:
    """The model of the labelled rows for which ``usable`` (a condition on ``key``) holds."""
    scratch = Scratch(spark)
    sample = scratch.keep(fit_sample(docs, labels, label_col, usable, max_fit, id_col, text_col), "toxic-sample")
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    all_labels = labels.where(F.col(label_col).isin(0, 1))
    if usable is not None:
        all_labels = all_labels.withColumn("key", F.col(id_col).cast("long")).where(usable)
    rate = float(all_labels.agg(F.avg(F.col(label_col).cast("double"))).first()[0] or 0.0)
    if not n0 or not n1:
        scratch.drop("toxic-sample")
        return KnnModel(b"", np.zeros(0), np.zeros(0), None, rate)
    # at most the terms of 2 * max_fit texts
    counted = _form_counts(sample).groupBy("term").pivot("label", [0, 1]).agg(F.sum("n")).na.fill(0)
    found = counted.orderBy(F.desc(F.col("0") + F.col("1")), "term").toArrow()
    listed, size = _listed(found.column("term").to_pylist()), len(found)
    p0, p1 = found.column("0").to_numpy() / n0, found.column("1").to_numpy() / n1
    del found
    n = n0 + n1
    # chi-square of the two shares of texts, of the terms that are likelier in label 1
    pooled = (p0 * n0 + p1 * n1) / n
    chi = np.maximum(p1 - p0, 0) ** 2 / (pooled * (1 - pooled) + 1e-12) * (n0 * n1 / n)
    idf = np.log((1 + n) / (1 + n * ((1 - rate) * p0 + rate * p1))) + 1
    model = KnnModel(listed, idf, 1 + np.sqrt(chi), None, rate, float(np.log(1 + n) + 1))

    got = _vectors(sample, listed).toArrow()  # at most 2 * max_fit rows
    scratch.drop("toxic-sample")
    ids, y = got.column("key").to_numpy(), got.column("label").to_numpy()
    at, tf = (got.column(c).combine_chunks() for c in ("at", "tf"))
    example = np.repeat(np.arange(n, dtype=np.int32), np.asarray(pa.compute.list_value_length(at)))
    at, tf = np.asarray(at.flatten()), np.asarray(tf.flatten())
    del got
    x = ((1 + np.log(tf)) * idf[at] * model.gain[at]).astype(np.float32)
    norm = np.maximum(np.sqrt(np.bincount(example, x.astype(float) ** 2, minlength=n)), 1e-12)
    x /= norm[example]
    order = layout(example, at, tf, x, y)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    model.index = BlockMaxIndex(place[example], at, x, y[order], ids[order], size, common, block)
    # entries lie by example, so a run of examples is a slice
    first = np.searchsorted(example, np.arange(n + 1))
    share = np.zeros(n)
    for i in range(0, n, 128):
        part = np.arange(i, min(i + 128, n))
        near = model.index.search([(at[first[j] : first[j + 1]], x[first[j] : first[j + 1]]) for j in part], model.k, place[part])
        share[part] = [model.share(cos, model.index.labels[rows]) for rows, cos in near]
    share = np.clip(share, 1e-4, 1 - 1e-4)
    weight = np.where(y == 1, rate / n1, (1 - rate) / n0) * n
    model.slope, model.offset = _logistic(np.log(share / (1 - share)), y, weight)
    return model


@lru_cache(maxsize=1)
def _finder(listed: bytes) -> TermFinder:
    """One for all tasks of a Python worker."""
    return TermFinder(_terms(listed))


def _vectors(sample: DataFrame, listed: bytes) -> DataFrame:
    """``(key, label, at, tf)`` of the sampled examples: ascending positions of their terms, and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(listed)
        for b in slices(batches):
            found = [finder.count(t) for t in b.column("text").to_pylist()]
            got = [pa.array([f[i] for f in found], pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("label"), *got], ["key", "label", "at", "tf"])

    return sample.select("key", "label", "text").mapInArrow(run, "key long, label int, at array<int>, tf array<int>").orderBy("key")


def score(docs: DataFrame, model: KnnModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, score, predicted, evidence)`` of each row, in one pass over the texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    if model.index is None:
        rate = F.lit(model.rate)
        return rows.select("doc_id", "text_hash", rate.alias("score"), (rate >= 0.5).cast("int").alias("predicted"), F.array().cast("array<long>").alias("evidence"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, index = _finder(model.listed), model.index
        for b in slices(batches):
            near = index.search([model.vector(*finder.count(t)) for t in b.column("text").to_pylist()], model.k)
            s = np.array([model.calibrated(model.share(cos, index.labels[rows])) for rows, cos in near])
            evidence = [index.ids[rows[index.labels[rows] == 1][:3]] for rows, _ in near]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(s, pa.float64()), pa.array(s >= 0.5).cast(pa.int32()), pa.array(evidence, pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "score", "predicted", "evidence"],
            )

    return rows.mapInArrow(run, "doc_id long, text_hash long, score double, predicted int, evidence array<long>")
