"""File sources and sinks: CSV, JSON, text, Parquet, label dictionary."""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LABEL_DICTIONARY_SCHEMA, LABELS, TRAINING_CSV_SCHEMA
from ..session import work_path

log = logging.getLogger(__name__)


def read_traffic_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = TRAINING_CSV_SCHEMA,
    infer: bool = False,
) -> DataFrame:
    """Headered traffic CSV.

    Default: an explicit schema (no inference job over the file), with the
    lower-case ``inf`` spellings read as infinities. ``infer=True`` reproduces
    schema inference; ``schema=None, infer=False`` reads every column as text.
    """
    reader = spark.read.option("header", "true")
    if infer:
        reader = reader.option("inferSchema", "true")
    elif schema is not None:
        reader = (
            reader.schema(schema)
            .option("positiveInf", "inf")
            .option("negativeInf", "-inf")
            .option("mode", "PERMISSIVE")
        )
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", "true").csv(path)


def timestamped_name(prefix: str, suffix: str, now: _dt.datetime | None = None) -> str:
    """``prefix-YYYY-mm-dd-HH-MM-SS.suffix`` file name."""
    now = now or _dt.datetime.now()
    return f"{prefix}-{now.strftime('%Y-%m-%d-%H-%M-%S')}.{suffix}"


def write_timestamped_csv(df: DataFrame, folder: str, prefix: str = "traffic", now: _dt.datetime | None = None) -> str:
    """Headered CSV below ``folder`` under a name of its time; returns the path. A name in use is an error."""
    path = f"{folder.rstrip('/')}/{timestamped_name(prefix, 'csv', now)}"
    write_csv(df, path)
    return path


def write_json(df: DataFrame, path: str) -> None:
    """Single-file JSON, overwrite. Only for one-row / tiny frames (summaries)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def one_row(spark: SparkSession, row: dict, schema: T.StructType | str | None = None) -> DataFrame:
    """A one-row DataFrame from a dict (summaries, metadata)."""
    if schema is None:
        return spark.createDataFrame([row])
    return spark.createDataFrame([row], schema=schema)


def label_table(spark: SparkSession, labels: list[str] | None = None) -> DataFrame:
    """The fixed label dictionary as an ``(idx bigint, label string)`` table."""
    names = LABELS if labels is None else labels
    return spark.createDataFrame(
        list(enumerate(names)), schema="idx bigint, label string"
    )


def read_label_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Label dictionary JSON (as written by ``label_dictionary``) exploded to
    an ``(idx bigint, label string)`` lookup. A missing file gives an empty
    lookup (and a warning), so decoding falls back to the raw value; any other
    failure is raised."""
    try:
        raw = spark.read.schema(LABEL_DICTIONARY_SCHEMA).json(path)
        out = raw.select(F.explode("index_to_label").alias("k", "label")).select(
            F.col("k").try_cast("bigint").alias("idx"), "label"
        )
        out.schema  # resolve now: a missing path fails here
        return out.filter(F.col("idx").isNotNull())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no label dictionary at %s: labels stay undecoded", path)
        return spark.createDataFrame([], schema="idx bigint, label string")


# Lines are written with a control-character delimiter and no quoting, so a
# line's commas never need quotes and the CSV reader/writer only adds/drops
# the header line of each file.
_LINE_OPTS = {"delimiter": "\u0001", "quote": "\u0000", "escape": "\u0000",
              "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_headered_lines(df: DataFrame, column: str, path: str, header: str = "line") -> None:
    """Text lines under a one-line header (per file), like an exported CSV."""
    df.select(F.col(column).alias(header)).write.mode("overwrite").options(**_LINE_OPTS).option(
        "header", "true"
    ).csv(path)


def replay_lines(spark: SparkSession, path: str) -> DataFrame:
    """One message per data line of headered text files: the first line of each
    file is skipped, surrounding whitespace stripped, blank lines kept. The paced form is ``line_replay.replay_stream``."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("place"),
    )
    # places hold for one scan only, so both uses read the same written copy
    numbered = work_path(spark, "replay-lines")
    lines.write.parquet(numbered)
    lines = spark.read.schema(lines.schema).parquet(numbered)
    # the first row of the block at 0 of each file: one row a file
    heads = lines.groupBy("file").agg(F.min("place").alias("head"))
    body = lines.join(heads, "file").where(F.coalesce(F.col("place") != F.col("head"), F.lit(True)))
    return body.select(F.trim("value").alias("value"))
