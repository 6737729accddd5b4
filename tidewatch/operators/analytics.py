"""Prediction analytics: label decoding, counts, top-k, summary, last-N.

Every operator is a DataFrame-to-DataFrame function. Aggregations use
Spark's partial (map-side) aggregation, so a label holding a third of all
rows costs one counter per task, never a hot task. Global orderings only
ever run over already-aggregated rows (one row per distinct label).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import attack_category, category_colour, is_benign, percent1, traffic_status
from ..plans.strategy import DEFAULT_BROADCAST_ROWS, fits

UNKNOWN = "Unknown"


def decode_label(
    df: DataFrame,
    labels: DataFrame,
    col: str = "predicted_label",
    out: str = "label",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    small: bool | None = None,
) -> DataFrame:
    """Add ``out``: the dictionary name of ``col``.

    Numeric values are truncated to an int index; text values must equal an
    index's text exactly. Values without an entry keep their own text
    (``34.0``); a missing value decodes to ``Unknown``. ``labels`` is an
    ``(idx, label)`` table, broadcast only when its size is checked small
    (``small`` passes the answer of an earlier check).
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        key = F.col(col)
        lk = labels.select(F.col("idx").cast("string").alias("_k"), F.col("label").alias("_name"))
    else:
        key = F.col(col).try_cast("int").cast("bigint")
        lk = labels.select(F.col("idx").cast("bigint").alias("_k"), F.col("label").alias("_name"))
    lk = lk.dropDuplicates(["_k"])
    side = F.broadcast(lk) if (fits(lk, max_broadcast_rows) if small is None else small) else lk
    joined = df.withColumn("_k", key).join(side, "_k", "left")
    return joined.withColumn(
        out, F.coalesce(F.col("_name"), F.col(col).cast("string"), F.lit(UNKNOWN))
    ).drop("_k", "_name")


def label_counts(df: DataFrame, labels: DataFrame, col: str = "predicted_label") -> DataFrame:
    """Predictions per decoded label, ``(label, count)``.

    Grouped after decoding, so two raw values naming the same label add up.
    """
    decoded = decode_label(df.select(col), labels, col)
    return decoded.groupBy("label").agg(F.count(F.lit(1)).alias("count"))


def top_labels(df: DataFrame, labels: DataFrame, k: int = 15, col: str = "predicted_label") -> DataFrame:
    """The ``k`` most frequent labels, ``(rank, label, count, category, colour)``,
    plus ``axis_max``: the largest displayed count."""
    top = label_counts(df, labels, col).orderBy(F.desc("count"), F.asc("label")).limit(k)
    w = Window.orderBy(F.desc("count"), F.asc("label"))
    return top.select(
        F.row_number().over(w).alias("rank"),
        "label",
        "count",
        attack_category("label").alias("category"),
        category_colour("label").alias("colour"),
        F.max("count").over(Window.partitionBy(F.lit(1))).alias("axis_max"),
    )


def topk_remainder(df: DataFrame, labels: DataFrame, k: int = 15, col: str = "predicted_label") -> DataFrame:
    """Labels beyond the top ``k``: their number and summed count (one row): all labels less the top ones."""
    counts = label_counts(df, labels, col)
    both = [F.count(F.lit(1)).alias("labels"), F.coalesce(F.sum("count"), F.lit(0)).alias("n")]
    top = counts.orderBy(F.desc("count"), F.asc("label")).limit(k).agg(*both).select((-F.col("labels")).alias("labels"), (-F.col("n")).alias("n"))
    # two rows
    return counts.agg(*both).unionByName(top).agg(F.sum("labels").alias("more_labels"), F.sum("n").alias("more_count"))


def traffic_summary(df: DataFrame, labels: DataFrame, col: str = "predicted_label") -> DataFrame:
    """Total / benign / attack counts and the attack rate (one row).

    Benign iff the decoded label is ``BENIGN`` in any case. The rate is only
    given when there is at least one prediction.
    """
    decoded = decode_label(df.select(col), labels, col)
    agg = decoded.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_benign("label")).alias("benign"),
    )
    rate = F.col("attack") / F.nullif(F.col("total"), F.lit(0)) * F.lit(100.0)
    return agg.select(
        "total",
        "benign",
        (F.col("total") - F.col("benign")).alias("attack"),
    ).select("*", rate.alias("attack_rate"), percent1(rate).alias("attack_rate_text"))


def last_n(df: DataFrame, n: int = 1000, ts: str = "prediction_timestamp", tiebreak: str = "pred_id") -> DataFrame:
    """The ``n`` most recent rows (a bounded buffer; n is 100..5000 in the UI).
    Planned as a per-partition top-n plus a merge (TakeOrderedAndProject)."""
    return df.orderBy(F.desc(ts), F.desc(tiebreak)).limit(n)


def recent(
    df: DataFrame,
    labels: DataFrame,
    n: int = 10,
    ts: str = "prediction_timestamp",
    tiebreak: str = "pred_id",
) -> DataFrame:
    """The ``n`` newest predictions, newest first, decoded, with ``Unknown``
    for missing fields and a benign/attack status."""
    newest = last_n(df, n, ts, tiebreak)
    small = fits(labels)
    dec = decode_label(newest, labels, "predicted_label", "predicted_name", small=small)
    dec = decode_label(dec, labels, "actual_label", "actual_name", small=small)
    w = Window.orderBy(F.desc(ts), F.desc(tiebreak))
    return dec.select(
        F.row_number().over(w).alias("position"),
        F.col(tiebreak),
        "predicted_name",
        "actual_name",
        F.coalesce(F.col("rate"), F.lit(UNKNOWN)).alias("rate"),
        F.coalesce(F.col("protocol_type").cast("string"), F.lit(UNKNOWN)).alias("protocol_type"),
        F.coalesce(F.col(ts).cast("string"), F.lit(UNKNOWN)).alias("prediction_time"),
        traffic_status("predicted_name").alias("status"),
        category_colour("predicted_name").alias("colour"),
    )


def categorize(df: DataFrame, labels: DataFrame, col: str = "predicted_label") -> DataFrame:
    """Decoded label with its attack category, colour and status."""
    dec = decode_label(df, labels, col)
    return dec.withColumns(
        {
            "category": attack_category("label"),
            "colour": category_colour("label"),
            "status": traffic_status("label"),
        }
    )


def category_counts(df: DataFrame, labels: DataFrame, col: str = "predicted_label") -> DataFrame:
    """Predictions per attack category."""
    dec = decode_label(df.select(col), labels, col)
    return dec.groupBy(attack_category("label").alias("category")).agg(F.count(F.lit(1)).alias("count"))
