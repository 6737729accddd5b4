"""Label dictionary: distinct labels, frequency index, dictionary row.

The index orders values by count descending, then value ascending -- the
order a frequency-ordered string indexer assigns. The un-partitioned
ranking window runs over the grouped rows (one per distinct value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import LABEL_COLUMN


def distinct_labels(df: DataFrame, col: str = LABEL_COLUMN) -> DataFrame:
    return df.select(F.col(col).alias("label")).distinct()


def label_index(df: DataFrame, col: str = LABEL_COLUMN) -> DataFrame:
    """``(idx bigint, label, count)``: 0 = most frequent value; NULLs skipped."""
    counts = (
        df.select(F.col(col).alias("label"))
        .filter(F.col("label").isNotNull())
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    w = Window.orderBy(F.desc("count"), F.asc("label"))
    return counts.select((F.row_number().over(w) - 1).cast("bigint").alias("idx"), "label", "count")


def label_dictionary(df: DataFrame, col: str = LABEL_COLUMN, generated_at=None) -> DataFrame:
    """One row: both maps, the label count, the column name and a timestamp.

    Columns are in key order, as a dict-built row writes them to JSON.
    """
    idx = label_index(df, col)
    entries = F.array_sort(F.collect_list(F.struct(F.col("idx"), F.col("label"))))
    ts = generated_at if generated_at is not None else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    )
    return idx.agg(entries.alias("_e"), F.count(F.lit(1)).alias("total_labels")).select(
        ts.alias("generated_timestamp"),
        F.map_from_entries("_e").alias("index_to_label"),
        F.lit(col).alias("label_column"),
        F.map_from_arrays(F.col("_e.label"), F.col("_e.idx")).alias("label_to_index"),
        F.col("total_labels").cast("bigint").alias("total_labels"),
    )


def explode_dictionary(d: DataFrame) -> DataFrame:
    """Dictionary row to ``(idx, label, back_index, total_labels, label_column)``;
    ``back_index`` is the label looked up in the inverted map."""
    return d.select(
        F.explode("index_to_label").alias("idx", "label"), "label_to_index", "total_labels", "label_column"
    ).select(
        F.col("idx").cast("bigint").alias("idx"),
        "label",
        F.element_at("label_to_index", F.col("label")).alias("back_index"),
        "total_labels",
        "label_column",
    )
