"""Structured Streaming jobs: parse, score and publish traffic; live summary.

Sources are any stream of Kafka-shaped rows (``value`` binary/text plus
``timestamp``): the Kafka source in production, a Parquet/text folder in
tests. Every query runs with a checkpoint in the shared checkpoint folder,
so a restarted query resumes where it stopped instead of skipping input.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators import analytics as A
from ..operators import ml as M
from ..operators import parse as P
from ..schema import TOPIC_ROW_SCHEMA
from ..session import hadoop_path, work_path
from .models import ModelStore

log = logging.getLogger(__name__)


def stage_topic_rows(df: DataFrame, path: str, files: int | None = None) -> str:
    """Write Kafka-shaped rows as Parquet files, a replayable stand-in for a
    topic: one file per topic partition (default 4 per core), read
    ``files_per_trigger`` at a time."""
    files = files or 4 * df.sparkSession.sparkContext.defaultParallelism
    df.repartition(files).write.mode("overwrite").parquet(path)
    return path


def topic_rows(df: DataFrame, value: str, offset: str, ts: str | None = None, topic: str = "network-traffic") -> DataFrame:
    """Shape any table as Kafka rows: ``value`` text, ``offset`` id, ``timestamp``."""
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode(F.col(value), "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col(offset).cast("bigint").alias("offset"),
        (F.col(ts).cast("timestamp") if ts else F.current_timestamp()).alias("timestamp"),
    )


def read_topic_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream Kafka-shaped rows from a folder of Parquet files; each
    micro-batch takes one file per core (like one task per topic partition)."""
    n = files_per_trigger or spark.sparkContext.defaultParallelism
    return spark.readStream.schema(TOPIC_ROW_SCHEMA).option("maxFilesPerTrigger", n).parquet(path)


@contextmanager
def state_partitions(spark: SparkSession, most: int | None = None) -> Iterator[None]:
    """Queries first started inside keep their state in at most ``most`` partitions (default: two a core) instead of the
    session's shuffle partitions; each partition of a stateful query costs a worker and a state store in every batch."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), most or 2 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def trigger_args(trigger: str | None) -> dict:
    """``None``/'available-now' drain what is there and stop; otherwise a
    processing-time interval such as '5 seconds'."""
    if trigger in (None, "available-now", "availableNow"):
        return {"availableNow": True}
    return {"processingTime": trigger}


def run_for(query: StreamingQuery, seconds: float | None) -> StreamingQuery:
    """Wait for the query to finish, or stop it after ``seconds``."""
    if seconds is None:
        query.awaitTermination()
    else:
        if not query.awaitTermination(seconds):
            query.stop()
    return query


def parse_stream(source: DataFrame, complete: bool = False, rate_numeric: bool = True, origin: bool = False) -> DataFrame:
    """Topic rows to typed traffic records (split, width filter, projection),
    keeping the message offset as ``line_id`` (with ``origin`` also as ``ORIGIN_FIELDS``); ``complete`` also drops
    records with an unparseable feature (one filter on the split line)."""
    lines = source.select(
        F.col("offset").alias("line_id"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("value").cast("string").alias("csv_line"),
        *[F.col(name.removeprefix("source_")).alias(name) for name in (P.ORIGIN_FIELDS if origin else ())],
    )
    keep = ("line_id", "kafka_timestamp", *(P.ORIGIN_FIELDS if origin else ()))
    return P.parse_lines(lines, keep=keep, complete=complete, rate_numeric=rate_numeric)


def to_files(df: DataFrame, path: str, checkpoint: str, trigger: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Append a stream to files (exactly-once with the checkpoint)."""
    return (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_args(trigger))
        .start()
    )


def to_console(df: DataFrame, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    return (
        df.writeStream.format("console").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**trigger_args(trigger)).start()
    )


def observe_progress(df: DataFrame, name: str = "progress") -> DataFrame:
    """Count the rows flowing through ``df`` without an extra job: the count
    per micro-batch appears in ``query.lastProgress['observedMetrics'][name]``
    (for a batch DataFrame pass a ``pyspark.sql.Observation`` as ``name``)."""
    if df.isStreaming:
        row_totals(df.sparkSession)
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


class RowTotals(StreamingQueryListener):
    """Adds up observed rows over every batch of every query (``recentProgress``
    forgets all but the last hundred batches), and reports each time a total passes another ``every`` rows."""

    def __init__(self, every: int = 100, report: Callable[[str, int], None] | None = None) -> None:
        self.rows: dict[tuple[str, str], int] = {}
        self.last: dict[str, int] = {}
        self.every, self.report = every, report or (lambda name, total: log.info("%s: %d rows processed", name, total))

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        run = str(p.runId)
        for name, row in (p.observedMetrics or {}).items():
            if "rows" in row.asDict():
                before = self.rows.get((run, name), 0)
                total = self.rows[run, name] = before + int(row["rows"])
                if total // self.every > before // self.every:
                    self.report(name, total)
        self.last[run] = p.batchId


_TOTALS: dict[str, RowTotals] = {}


def row_totals(spark: SparkSession) -> RowTotals:
    """The session's listener, added at the first call (before the query starts)."""
    key = spark.sparkContext.applicationId
    if key not in _TOTALS:
        _TOTALS[key] = RowTotals()
        spark.streams.addListener(_TOTALS[key])
    return _TOTALS[key]


def processed_total(query: StreamingQuery, name: str = "progress", wait_s: float = 10.0) -> int:
    """Running total of the rows that ``observe_progress`` counted in this run,
    however many batches it had. Waits until the listener has seen the last batch; if it has not
    after ``wait_s``, that is an error, not a smaller total."""
    totals, run = row_totals(SparkSession.active()), str(query.runId)
    until = time.monotonic() + wait_s
    while query.lastProgress and totals.last.get(run, -1) < query.lastProgress["batchId"]:
        if time.monotonic() > until:
            raise TimeoutError(f"batch {query.lastProgress['batchId']} not reported within {wait_s} s")
        time.sleep(0.05)
    return totals.rows.get((run, name), 0)


def score_stream(source: DataFrame, trained: M.Trained, observe: str | None = "progress") -> DataFrame:
    """Parsed stream scored by the pre-fitted serving model, as the JSON
    envelope (prediction time = processing time). No Python on the path."""
    parsed = parse_stream(source, complete=True, rate_numeric=not trained.params.rate_as_category)
    if observe:
        parsed = observe_progress(parsed, observe)
    scored = M.predict(trained, parsed, decode=False, assume_complete=True)
    return P.encode_predictions(scored, keep=("line_id",))


def run_monitor(
    spark: SparkSession,
    source: DataFrame,
    trained: M.Trained | ModelStore,
    sink: Callable[[DataFrame, int], None] | None = None,
    checkpoint: str | None = None,
    trigger: str | None = "5 seconds",
    out_path: str | None = None,
) -> StreamingQuery:
    """Score the traffic stream every trigger and publish the envelopes.

    With ``sink`` (e.g. a Kafka publish) batches go through ``foreachBatch``;
    empty micro-batches are skipped. Otherwise the envelopes are appended to
    ``out_path``. Given a ``ModelStore``, every batch is scored by the version that is current when it begins,
    and every envelope carries that version and the record's origin, by which a reader drops what a repeated batch
    publishes again (``read_published``); without ``sink`` a batch is a folder of ``out_path`` that a repetition replaces.
    """
    checkpoint = checkpoint or work_path(spark, "monitor-checkpoint")
    out_path = out_path or work_path(spark, "monitor-out")
    versioned = isinstance(trained, ModelStore)
    out = source if versioned else score_stream(source, trained)
    if sink is None and not versioned:
        return to_files(out, out_path, checkpoint, trigger)
    put = sink or (lambda rows, batch_id: rows.write.mode("overwrite").parquet(f"{out_path}/batch-{batch_id:012d}"))

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = score_published(batch, trained) if versioned else batch
        rows.persist()  # scored once, though looked at twice
        try:
            if not rows.isEmpty():
                put(rows, batch_id)
        finally:
            rows.unpersist()

    return (
        out.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(**trigger_args(trigger)).start()
    )


def score_published(batch: DataFrame, store: ModelStore) -> DataFrame:
    """Topic rows of one batch to envelopes with their origin and the version of the model."""
    version, trained = store.current()
    parsed = parse_stream(batch, complete=True, rate_numeric=not trained.params.rate_as_category, origin=True)
    scored = M.predict(trained, parsed, decode=False, assume_complete=True).withColumn("model_version", F.lit(version))
    return P.encode_predictions(scored, keep=("line_id",), extra=(*P.ORIGIN_FIELDS, "model_version"))


def read_published(source: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Predictions of a stream of topic rows, each once: what a repeated batch published again within ``delay`` of
    the record time is dropped by its origin. Envelopes without an origin are all kept."""
    rows = source.select(F.col("timestamp"), F.col("value").cast("string").alias("value")).withWatermark("timestamp", delay)
    preds = P.read_predictions(rows, schema=P.PUBLISHED_SCHEMA)
    known = F.col("source_topic").isNotNull() & F.col("source_partition").isNotNull() & F.col("source_offset").isNotNull()
    return preds.where(known).dropDuplicatesWithinWatermark(list(P.ORIGIN_FIELDS)).unionByName(preds.where(~known))


def prediction_windows_stream(source: DataFrame, labels: DataFrame, window: str = "1 minute", delay: str = "30 seconds") -> DataFrame:
    """Predictions per decoded label and tumbling window of their own time: ``(start, end, label, count)``, to be run in
    update mode. State is kept for windows that the watermark has not passed; what comes later is dropped and counted by Spark.
    Predictions without a time are in no window."""
    preds = P.read_predictions(source.select(F.col("value").cast("string").alias("value")))
    preds = preds.select("prediction_timestamp", "predicted_label").withWatermark("prediction_timestamp", delay)
    decoded = A.decode_label(preds, labels)
    counts = decoded.groupBy(F.window("prediction_timestamp", window), "label").agg(F.count(F.lit(1)).alias("count"))
    return counts.select("window.start", "window.end", "label", "count")


def run_windows(counts: DataFrame, path: str, checkpoint: str, trigger: str | None = None, keep: int = 20) -> StreamingQuery:
    """Keep the newest count of every window below ``path``. A batch's changes are a folder; whenever there are more than
    ``keep`` of them they are merged with the base into a new base. A repeated batch replaces its own folder."""

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch-{batch_id:012d}")
        done, bases = _summary_batches(spark, path), _summary_batches(spark, path, "base-")
        if len(done) > keep:
            _newest(spark.read.parquet(*bases[-1:], *done)).write.mode("overwrite").parquet(f"{path}/base-{batch_id:012d}")
            for old in done + bases:
                if not old.endswith(f"base-{batch_id:012d}"):
                    release_folder(spark, old)

    return (
        counts.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(**trigger_args(trigger)).start()
    )


def _newest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("start", "end", "label").agg(F.max_by("count", "batch").alias("count"), F.max("batch").alias("batch"))


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """``(start, end, label, count)`` as ``run_windows`` last left them."""
    found = _summary_batches(spark, path, "base-")[-1:] + _summary_batches(spark, path)
    if not found:
        raise FileNotFoundError(f"no window counts below {path} yet")
    return _newest(spark.read.parquet(*found)).drop("batch")


def prediction_summary_stream(source: DataFrame, labels: DataFrame) -> DataFrame:
    """Live predictions per decoded label from a stream of JSON envelopes
    (stream-static join with the label dictionary, then a running count)."""
    preds = P.read_predictions(source.select(F.col("value").cast("string").alias("value")))
    return A.label_counts(preds, labels)


def _summary_batches(spark: SparkSession, path: str, prefix: str = "batch-") -> list[str]:
    """Complete batch folders below ``path``, oldest first."""
    fs, top = hadoop_path(spark, path)
    if not fs.exists(top):
        return []
    found = [str(x.getPath()) for x in fs.listStatus(top) if x.isDirectory() and x.getPath().getName().startswith(prefix)]
    return sorted(p for p in found if fs.exists(hadoop_path(spark, f"{p}/_SUCCESS")[1]))


def release_folder(spark: SparkSession, path: str) -> None:
    fs, at = hadoop_path(spark, path)
    fs.delete(at, True)


def _replace(rows: DataFrame, batch_id: int, path: str, keep: int) -> None:
    """Write a batch's folder, then delete all but the last ``keep``."""
    rows.write.mode("overwrite").parquet(f"{path}/batch-{batch_id:012d}")
    for old in _summary_batches(rows.sparkSession, path)[:-keep]:
        release_folder(rows.sparkSession, old)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete summary that ``run_summary`` has written."""
    batches = _summary_batches(spark, path)
    if not batches:
        raise FileNotFoundError(f"no summary below {path} yet")
    return spark.read.parquet(batches[-1])


def run_summary(
    df: DataFrame, path: str, checkpoint: str, trigger: str | None = None, keep: int = 3, output_mode: str = "complete"
) -> StreamingQuery:
    """Keep the summary below ``path``: a folder for each batch, of which the last
    ``keep`` stay. A reader takes the newest complete one, so it never
    meets a half-written or missing folder."""

    def each(batch: DataFrame, batch_id: int) -> None:
        _replace(batch, batch_id, path, keep)

    return (
        df.writeStream.outputMode(output_mode).foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(**trigger_args(trigger)).start()
    )


def run_recent_summary(
    source: DataFrame, labels: DataFrame, path: str, checkpoint: str, n: int = 1000, trigger: str | None = "1 second", keep: int = 3
) -> StreamingQuery:
    """Live summary of the ``n`` most recent predictions: each batch merges its newest
    ``n`` with those kept by the last one, and replaces both the kept rows and the summary."""
    preds = P.read_predictions(source.select(F.col("value").cast("string").alias("value"), F.col("offset").alias("pred_id")))

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = [p for p in _summary_batches(spark, f"{path}/rows") if not p.endswith(f"batch-{batch_id:012d}")]
        rows = batch.unionByName(spark.read.parquet(kept[-1])) if kept else batch
        _replace(A.last_n(rows, n), batch_id, f"{path}/rows", keep)
        newest = spark.read.parquet(f"{path}/rows/batch-{batch_id:012d}")
        _replace(A.label_counts(newest, labels), batch_id, f"{path}/summary", keep)

    return preds.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**trigger_args(trigger)).start()
