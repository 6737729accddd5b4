"""Language ID by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (seeded by its code point). A three-letter
gram binds the vectors of its letters, the first rotated by two places and the second by
one, into one vector; a text bundles (adds) the vectors of all its grams. Runs of other
characters count as one blank. A language's prototype bundles the unit vectors of its
sample documents. A document gets the language whose prototype has the largest cosine
with it, both taken relative to the mean prototype; ``score`` is a softmax over the cosines.

``keep_known`` rejects a text that lies too far from every prototype: its plain cosine with the nearest one is below
``MARGIN`` times the least that any usable document with a language has (``least_cosines``, over all of them), both of
``2 ** (SETTLED - 1)`` letters or more. Shorter texts have too few grams for that and are rejected only if they have no letter.

Bounded fit of the prototypes: about ``max_fit`` documents per language (those with the smallest hashes of
the id), whole texts, of every language. Calibration and prediction cover every whole text in place, without a shuffle.

Edge cases: a null text or one without a letter gets ``und`` with score 0, as does
everything if no language was learned. A null id has a row with a null id. Repeated rows
are predicted each. Null languages are not learned. An empty table gives no rows. Other columns
of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, slices, small_side

UNKNOWN = "und"
MARGIN = 0.7
SETTLED = 8  # bits of the number of letters from which a text is judged by its cosine
_DIRECT = 1 << 21  # gram codes up to here are looked up in a table, else sorted
_CHUNK = 300_000  # characters bundled at a time
_LETTERS: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def letter_vector(code: int, dims: int) -> np.ndarray:
    return np.random.default_rng([code, dims]).integers(0, 2, dims, np.int8) * 2 - 1


@dataclass
class Bundler:
    """Adds up gram vectors of texts."""

    dims: int = 1024
    known: dict[int, np.ndarray] = field(default_factory=dict)

    def _vectors(self, codes: np.ndarray) -> np.ndarray:
        for c in codes.tolist():
            if c not in self.known:
                self.known[c] = letter_vector(c, self.dims)
        return np.stack([self.known[c] for c in codes.tolist()])

    def bundle(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One row for each text, and whether it has a letter."""
        out, has = np.zeros((len(texts), self.dims), np.float32), np.zeros(len(texts), bool)
        first, size = 0, 0
        for k, t in enumerate(texts):
            size += len(t)
            if size >= _CHUNK or k == len(texts) - 1:
                self._some([f" {x.lower()} " for x in texts[first : k + 1]], out[first : k + 1], has[first : k + 1])
                first, size = k + 1, 0
        return out, has

    def _some(self, texts: list[str], out: np.ndarray, has: np.ndarray) -> None:
        code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(t) for t in texts])
        doc = np.repeat(np.arange(len(texts)), sizes)
        letter = _is_letter()[code]
        has[np.unique(doc[letter])] = True
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first blank after a letter
        keep[np.cumsum(sizes) - sizes] = True  # the blank before each text
        code, doc = np.where(letter, code, 32)[keep], doc[keep]
        seen = np.zeros(0x110000, bool)
        seen[code] = True
        used = np.flatnonzero(seen)
        compact = np.zeros(0x110000, np.int64)
        compact[used] = np.arange(len(used))
        c, a = compact[code], len(used)
        inside = doc[2:] == doc[:-2]
        gram, doc = ((c[:-2] * a + c[1:-1]) * a + c[2:])[inside], doc[2:][inside]
        if a**3 <= _DIRECT:
            flag = np.zeros(a**3, bool)
            flag[gram] = True
            grams = np.flatnonzero(flag)
            at = np.zeros(a**3, np.int32)
            at[grams] = np.arange(len(grams))
            gram = at[gram]
        else:
            grams, gram = np.unique(gram, return_inverse=True)
        vectors = self._vectors(used)
        for lo in range(0, len(grams), 4096):
            g = grams[lo : lo + 4096]
            bound = np.roll(vectors, 2, 1)[g // (a * a)] * np.roll(vectors, 1, 1)[g // a % a] * vectors[g % a]
            here = (gram >= lo) & (gram < lo + len(g))
            d, j = doc[here], gram[here] - lo
            for top in range(0, len(texts), 256):
                rows = slice(*np.searchsorted(d, [top, top + 256]))
                n = min(256, len(texts) - top)
                counts = np.bincount((d[rows] - top) * len(g) + j[rows], minlength=n * len(g)).reshape(n, len(g))
                out[top : top + n] += counts.astype(np.float32) @ bound.astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


@dataclass
class Profiles:
    """Prototypes of the learned languages."""

    langs: list[str]
    vectors: np.ndarray
    sharpness: float = 12.0
    least: dict[int, float] = field(default_factory=dict)  # by the bits of the number of letters

    def nearest(self, texts: list[str], bundler: Bundler) -> tuple[np.ndarray, np.ndarray]:
        """The plain cosine of each text with its nearest prototype, and the bits of its number of letters."""
        sums, _ = bundler.bundle(texts)
        code = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        letters = [int(_is_letter()[c].sum()) for c in code]
        return (_unit(sums) @ _unit(self.vectors).T).max(1), np.array([n.bit_length() for n in letters])

    def known(self, texts: list[str], bundler: Bundler) -> np.ndarray:
        """Whether each text is near enough to a learned language; all are if none was learned."""
        if not self.langs:
            return np.ones(len(texts), bool)
        cos, bits = self.nearest(texts, bundler)
        least = min((c for k, c in self.least.items() if k >= SETTLED), default=-1.0)
        low = min(least, MARGIN * least)  # a negative least has its margin above it
        return (bits > 0) & ((bits < SETTLED) | (cos >= low))

    def predict(self, texts: list[str], bundler: Bundler) -> tuple[list[str], np.ndarray]:
        sums, has = bundler.bundle(texts)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        unit = _unit(self.vectors)
        center = unit.mean(0) if len(unit) > 1 else np.zeros(unit.shape[1])
        cos = _unit(_unit(sums) - center) @ _unit(unit - center).T
        best = cos.argmax(1)
        e = np.exp(self.sharpness * (cos - cos.max(1, keepdims=True)))
        score = np.where(has, 1 / e.sum(1), 0.0)
        return [self.langs[b] if h else UNKNOWN for b, h in zip(best, has, strict=True)], score


def fit(
    docs: DataFrame,
    usable: Column | None = None,
    dims: int = 1024,
    max_fit: int = 1500,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    calibrate: bool = False,
) -> Profiles:
    """Learn from the rows for which ``usable`` (a condition on ``key``) holds; ``calibrate`` also learns how near
    all of them are to the prototypes, sampled or not, which ``keep_known`` asks for."""
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where("lang is not null and text is not null")
    if usable is not None:
        rows = rows.where(usable)
    found = rows.groupBy("lang").count()
    share = found.select("lang", F.least(F.lit(1.0), F.lit(max_fit) / F.col("count")).alias("share"))
    place = F.pmod(F.xxhash64("key", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.join(small_side(share), "lang").where(place < F.col("share")).select("key", "lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler, total = Bundler(dims), {}
        for b in slices(batches):
            sums, has = bundler.bundle(b.column("text").to_pylist())
            unit, langs = _unit(sums).astype(np.float64), np.array(b.column("lang").to_pylist(), object)
            for lang in set(langs[has]):
                total[lang] = total.get(lang, 0) + unit[has & (langs == lang)].sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["lang", "bundle"]
        )

    # the sample is bounded, so it may be dealt to a fixed number of tasks, each giving a row a language
    got: dict[str, np.ndarray] = {}
    for r in sample.repartition(12, "key").mapInArrow(run, "lang string, bundle binary").orderBy("lang", "bundle").collect():
        got[r["lang"]] = got.get(r["lang"], 0) + np.frombuffer(r["bundle"])
    langs = sorted(got)
    profiles = Profiles(langs, np.stack([got[x] for x in langs]) if langs else np.zeros((0, dims)))
    if calibrate and langs:
        profiles.least = least_cosines(rows, profiles)
    return profiles


def least_cosines(rows: DataFrame, profiles: Profiles) -> dict[int, float]:
    """By the bits of the number of letters: the least cosine of any of the ``rows`` with its nearest prototype. A least value
    over a sample lies above that of the corpus, the more so the larger the corpus. At most 64 sizes."""
    dims = profiles.vectors.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler, low = Bundler(dims), {}
        for b in slices(batches):
            for cos, size in zip(*profiles.nearest(b.column("text").to_pylist(), bundler), strict=True):
                low[int(size)] = min(low.get(int(size), 2.0), float(cos))
        yield pa.RecordBatch.from_arrays([pa.array(list(low), pa.int32()), pa.array(list(low.values()), pa.float64())], ["size", "cos"])

    found = rows.select("text").mapInArrow(run, "size int, cos double").groupBy("size").agg(F.min("cos").alias("cos")).collect()
    return {r["size"]: r["cos"] for r in found if r["size"]}


def predict(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every whole text."""
    dims = profiles.vectors.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler = Bundler(dims)
        for b in slices(batches):
            langs, score = profiles.predict([t or "" for t in b.column("text").to_pylist()], bundler)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(langs, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, whose text has a letter and is near a learned language; all rows if none was learned."""

    def make():
        bundler = Bundler(profiles.vectors.shape[1])
        return lambda texts: profiles.known([t or "" for t in texts], bundler)

    return keep_rows(docs, text_col, make)
