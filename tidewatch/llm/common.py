"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import release, work_path

__all__ = ["Scratch", "crc_fold", "fit_sample", "keep_rows", "load", "planned", "slices", "small_side", "stage", "text_hash", "without"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(spark: SparkSession, df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage at
    files that every executor can read again after a loss."""
    path = path or work_path(spark, "llm", name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Staged tables of one operator call, released as soon as they are not needed."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = work_path(self.spark, "llm", name)
        out = stage(self.spark, df, name, path)
        self.paths.setdefault(name, []).append(path)
        return out

    def drop(self, name: str) -> None:
        for path in self.paths.pop(name, []):
            release(self.spark, path)


def crc_fold(id_col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the text ''."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def fit_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, usable: Column | None, max_fit: int, id_col: str, text_col: str
) -> DataFrame:
    """``(key, label, text)`` of at most ``max_fit`` labelled documents per class: those of ``docs`` with
    the smallest hashes of the id, so the choice follows neither order nor partitioning. Rows that repeat an id
    are one document with the largest of their texts. ``usable`` is a condition on the column ``key``.
    The chosen ids are at most ``2 * max_fit`` rows, so they are broadcast and no other text is shuffled."""
    rows = labels.select(F.col(id_col).cast("long").alias("key"), F.col(label_col).cast("int").alias("label"))
    rows = rows.where("key is not null and label in (0, 1)")
    if usable is not None:
        rows = rows.where(usable)
    texts = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    rows = rows.groupBy("key").agg(F.max("label").alias("label")).join(texts.select("key"), "key", "left_semi")
    ranked = [rows.where(F.col("label") == k).orderBy(F.xxhash64("key"), "key").limit(max_fit) for k in (0, 1)]
    chosen = ranked[0].union(ranked[1])
    return texts.join(F.broadcast(chosen), "key").groupBy("key", "label").agg(F.max("text").alias("text"))


BROADCAST_IDS = 1_000_000  # more ids than this are joined by a shuffle


def small_side(ids: DataFrame) -> DataFrame:
    """``ids`` (one long a row) for a join, broadcast if their count is proven small, else shuffled."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids.hint("merge")


def planned(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` for a join, left to the planner if at most ``most`` are proven, else shuffled: the planner takes the size of
    their files, in which ids are packed far below what a broadcast of them takes."""
    return rows if rows.limit(most + 1).count() <= most else rows.hint("merge")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts are Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def text_hash(text: Column) -> Column:
    """Names a row's text together with its id; null for null."""
    return F.when(text.isNotNull(), F.xxhash64(text))


def without(spark: SparkSession, docs: DataFrame, rejected: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that are not among ``rejected``. If that names rows by ``(doc_id, text_hash)``, each row's own
    decision counts, a null id or text included; if by ``doc_id`` alone, rows of an id go together and those without one stay."""
    by_text = "text_hash" in rejected.columns
    named = rejected.select("doc_id", "text_hash") if by_text else rejected.where("doc_id is not null").select("doc_id")
    scratch = Scratch(spark)
    gone = small_side(scratch.keep(named.distinct(), "rejected"))
    same = F.col(f"_d.`{id_col}`").eqNullSafe(F.col("_r.doc_id"))
    if by_text:
        same = same & text_hash(F.col(f"_d.`{text_col}`")).eqNullSafe(F.col("_r.text_hash"))
    return docs.alias("_d").join(gone.alias("_r"), same, "left_anti").select(*[F.col(f"_d.`{c}`") for c in docs.columns])


def keep_rows(docs: DataFrame, text_col: str, make: Callable[[], Callable[[list], np.ndarray]]) -> DataFrame:
    """Rows of ``docs`` for which the function that ``make`` gives each task says so of the text."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = make()
        for b in slices(batches):
            yield b.filter(pa.array(np.asarray(judge(b.column(place).to_pylist()), bool)))

    return docs.mapInArrow(run, docs.schema)
