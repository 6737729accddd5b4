"""Replay-safe publishing, model versions, and window counts by event time."""

import collections
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import analytics as A
from tidewatch.operators import ml as M
from tidewatch.operators import parse as P
from tidewatch.schema import TOPIC_ROW_SCHEMA
from tidewatch.session import work_path
from tidewatch.sources.files import label_table
from tidewatch.sources.fixtures import traffic_lines
from tidewatch.streaming import monitor as S
from tidewatch.streaming.models import ModelStore

SF = "/root/testdata/sf0.001"


def topic(spark, files):
    rows = S.topic_rows(traffic_lines(spark, SF), "csv_line", "line_id")
    # the fixture repeats line ids, a topic has one offset a record
    rows = rows.withColumn("offset", F.monotonically_increasing_id())
    path = work_path(spark, "pub-src")
    rows.write.parquet(f"{path}-all")
    spark.read.parquet(f"{path}-all").repartition(files, "offset").write.parquet(path)
    return path


@pytest.fixture(scope="module")
def trained(spark):
    rows = P.parse_lines(traffic_lines(spark, SF), keep=("line_id",))
    return M.train(rows, M.ForestParams(num_trees=2, max_depth=2))


def test_a_repeated_batch_is_read_once(spark, trained):
    store = ModelStore(spark, work_path(spark, "models"))
    version = store.publish(trained)
    src, out, ckpt = topic(spark, 3), work_path(spark, "pub-out"), work_path(spark, "pub-ckpt")
    failed = []

    def sink(rows, batch_id):
        n = len(failed)
        stamped = S.topic_rows(rows, "value", "line_id", topic="network-predictions")
        stamped.write.parquet(f"{out}/batch={batch_id}-{n}")
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("the job dies after it has published")

    def run():
        q = S.run_monitor(spark, S.read_topic_files(spark, src, 1), store, sink=sink, checkpoint=ckpt, trigger=None)
        q.awaitTermination()

    with pytest.raises(Exception, match="dies after"):
        run()
    run()
    sent = spark.read.schema(TOPIC_ROW_SCHEMA).parquet(f"{out}/*")
    want = P.parse_lines(traffic_lines(spark, SF), keep=("line_id",), complete=True).count()
    assert sent.count() > want
    got = work_path(spark, "pub-read")
    stream = S.read_published(spark.readStream.schema(TOPIC_ROW_SCHEMA).parquet(f"{out}/*"))
    S.to_files(stream, got, work_path(spark, "pub-read-ckpt")).awaitTermination()
    rows = spark.read.parquet(got)
    assert rows.count() == want == rows.select(*P.ORIGIN_FIELDS).distinct().count()
    assert [r[0] for r in rows.select("model_version").distinct().collect()] == [version]


def test_envelopes_without_an_origin_are_kept(spark):
    src, got = work_path(spark, "old-src"), work_path(spark, "old-read")
    value = '{"predicted_label":1.0}'
    df = spark.createDataFrame([(value,)] * 3 + [('{"predicted_label":2.0,"source_topic":"t","source_partition":0,"source_offset":9007199254740993}',)] * 2, "v string")
    S.topic_rows(df.withColumn("o", F.lit(1)), "v", "o").write.parquet(src)
    S.to_files(S.read_published(spark.readStream.schema(TOPIC_ROW_SCHEMA).parquet(src)), got, work_path(spark, "old-ckpt")).awaitTermination()
    assert sorted((r.predicted_label, r.source_offset or 0) for r in spark.read.parquet(got).collect()) == [(1.0, 0)] * 3 + [(2.0, 9007199254740993)]


def test_a_stream_takes_up_a_new_version_and_is_never_without_one(spark, trained):
    store = ModelStore(spark, work_path(spark, "models"))
    with pytest.raises(FileNotFoundError):
        store.version()
    versions = [store.publish(trained)]
    src, out = topic(spark, 4), work_path(spark, "ver-out")
    used = {}

    def sink(rows, batch_id):
        got = P.read_predictions(rows, schema=P.PUBLISHED_SCHEMA)
        used[batch_id] = {r[0] for r in got.select("model_version").distinct().collect()}
        rows.write.parquet(f"{out}/{batch_id}")
        if batch_id in (0, 2):
            versions.append(store.publish(trained))  # while the stream runs

    S.run_monitor(spark, S.read_topic_files(spark, src, 1), store, sink=sink, trigger=None).awaitTermination()
    assert used == {0: {versions[0]}, 1: {versions[1]}, 2: {versions[1]}, 3: {versions[2]}}
    assert spark.read.parquet(f"{out}/*").count() == P.parse_lines(traffic_lines(spark, SF), complete=True).count()
    assert store.prune(keep=1) == versions[:2] and store.version() == versions[2]
    assert ModelStore(spark, store.root).current()[1].labels.labels == trained.labels.labels


T0 = dt.datetime(2024, 1, 1)


def envelopes(spark, rows):
    """``(seconds, label)`` as topic rows."""
    df = spark.createDataFrame([(T0 + dt.timedelta(seconds=s) if s is not None else None, float(y), i) for i, (s, y) in enumerate(rows)], "t timestamp, y double, i long")
    js = F.to_json(F.struct(F.col("y").alias("predicted_label"), F.col("t").alias("prediction_timestamp")), P.JSON_OPTIONS)
    return S.topic_rows(df.withColumn("value", js), "value", "i")


def test_window_counts_equal_the_batch_count_and_state_stays_small(spark):
    src, path = work_path(spark, "win-src"), work_path(spark, "win")
    everything, batches = [], 30
    for b in range(batches):  # one minute a batch, some rows up to 50 s behind
        rows = [(60 * b + s - (50 if s % 7 == 0 and b else 0), (b + s) % 5) for s in range(0, 60, 2)] + [(None, 1)]
        everything += rows
        envelopes(spark, rows).coalesce(1).write.mode("append").parquet(src)
    late = [(5, 3)] * 4
    envelopes(spark, late).coalesce(1).write.mode("append").parquet(src)
    stream = S.prediction_windows_stream(S.read_topic_files(spark, src, 1), label_table(spark), "1 minute", "2 minutes")
    q = S.run_windows(stream, path, work_path(spark, "win-ckpt"), keep=4)
    q.awaitTermination()
    got = {(r.start, r.label): r["count"] for r in S.read_windows(spark, path).collect()}
    names = {r.y: r.label for r in A.decode_label(spark.createDataFrame([(float(k), float(k)) for k in range(5)], "y double, predicted_label double"), label_table(spark)).collect()}
    want = collections.Counter((T0 + dt.timedelta(minutes=s // 60), names[float(y)]) for s, y in everything if s is not None)
    assert got == want and sum(got.values()) == 30 * batches
    states = [p["stateOperators"][0] for p in q.recentProgress]
    assert max(int(x["numRowsTotal"]) for x in states) <= 5 * 5  # windows not passed yet, five labels
    assert sum(int(x["numRowsDroppedByWatermark"]) for x in states) > 0
    assert len(S._summary_batches(spark, path)) <= 5 and len(S._summary_batches(spark, path, "base-")) == 1
