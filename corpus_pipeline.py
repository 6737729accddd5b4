"""Corpus pipeline: language ID, toxicity, near-dedup, decontamination, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all that its predecessor kept; all but
the last return the columns of ``docs``. ``run`` writes each stage's rows as Parquet in the
shared folder and reads them again as the next one's ``docs``.

Rows leave by decision only: texts without a letter or too far from every learned language, documents that the toxicity
model predicts toxic, all but the smallest id of a near-duplicate group (five-word shingles,
similarity 0.8), and contaminated documents. The last stage returns the packed pieces.

Edge cases are those of the operators. Language, toxicity and contamination are decided for each row by its own text,
also where ids are null or repeated; without any learned language the language stage keeps all rows. Near-dedup takes rows
that repeat an id for one document, of which one row, with the largest text, stays; it keeps rows with a null id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import decontaminate, langid, neardup, packing, toxicity
from tidewatch.llm.common import load, stage, without

# SQL can express neither the learned stages nor best-fit packing; tests/llm hold the stages
# against brute force, held-out labels and invariants instead.
ORACLE_SQL: str | None = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in a learned language; a text without a letter, or far from all that was learned, is rejected."""
    return langid.keep_known(docs, langid.fit(docs, calibrate=True))


def nontoxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows not predicted toxic by a model of the labelled ones."""
    model = toxicity.fit(spark, docs, load(spark, sf_dir, "labels"), "toxic")
    return without(spark, docs, toxicity.score(docs, model).where("predicted = 1"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    found = neardup.near_duplicates(spark, docs, shingle=5, percent=80)
    return neardup.one_row_each(without(spark, docs, found.where("not kept")))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without benchmark contamination."""
    found = decontaminate.contamination(spark, docs, load(spark, sf_dir, "benchmark"))
    return without(spark, docs, found.where("contaminated"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in bins of the permitted lengths."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("nontoxic", nontoxic),
    ("near_dedup", near_dedup),
    ("decontaminated", decontaminated),
    ("packed", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(spark, step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
