"""Streams: restart from a checkpoint loses and repeats nothing; builders."""

from pyspark.sql import functions as F

from tidewatch.session import object_store_conf, work_path
from tidewatch.sources import kafka as K
from tidewatch.sources.fixtures import traffic_lines
from tidewatch.streaming import monitor as S

SF = "/root/testdata/sf0.001"


def test_restart_from_checkpoint_exactly_once(spark):
    lines = traffic_lines(spark, SF)
    rows = S.topic_rows(lines, "csv_line", "line_id")
    src_dir = work_path(spark, "t-src")
    out, ckpt = work_path(spark, "t-out"), work_path(spark, "t-ckpt")
    half = rows.filter(F.col("offset") % 2 == 0)
    rest = rows.filter(F.col("offset") % 2 == 1)
    half.coalesce(1).write.mode("append").parquet(src_dir)
    S.to_files(S.parse_stream(S.read_topic_files(spark, src_dir)).drop("kafka_timestamp"), out, ckpt).awaitTermination()
    first = spark.read.parquet(out).count()
    rest.coalesce(1).write.mode("append").parquet(src_dir)
    # same checkpoint: only the new file is processed
    S.to_files(S.parse_stream(S.read_topic_files(spark, src_dir)).drop("kafka_timestamp"), out, ckpt).awaitTermination()
    got = spark.read.parquet(out)
    from tidewatch.operators.parse import parse_lines

    want = parse_lines(lines, keep=("line_id",))
    assert first == parse_lines(lines.filter(F.col("line_id") % 2 == 0), keep=("line_id",)).count()
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_kafka_option_builders():
    o = K.topic_options("b:9092", "network-traffic")
    assert o == {"kafka.bootstrap.servers": "b:9092", "subscribe": "network-traffic", "startingOffsets": "latest"}
    assert K.sink_options("b:9092", "network-predictions")["topic"] == "network-predictions"


def test_object_store_conf(monkeypatch):
    monkeypatch.setenv("S3_ACCESS_KEY", "a")
    monkeypatch.setenv("S3_SECRET_KEY", "s")
    conf = object_store_conf(endpoint="http://store:9000")
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "a"
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.threads.max"] == "10"


def test_range_count_smoke(spark):
    assert spark.range(1, 101).count() == 100


def test_observed_progress_counts_rows(spark):
    from tidewatch.operators.parse import parse_lines

    lines = traffic_lines(spark, SF)
    src_dir = work_path(spark, "o-src")
    S.topic_rows(lines, "csv_line", "line_id").coalesce(2).write.parquet(src_dir)
    parsed = S.observe_progress(S.parse_stream(S.read_topic_files(spark, src_dir)), "progress")
    q = S.to_files(parsed.drop("kafka_timestamp"), work_path(spark, "o-out"), work_path(spark, "o-ckpt"))
    q.awaitTermination()
    assert S.processed_total(q) == parse_lines(lines, keep=("line_id",)).count()


def test_flow_stream_drops_late_packets(spark):
    from tidewatch.schema import PACKET_SCHEMA
    from tidewatch.streaming.flow_state import flow_features_stream

    def pk(i, t):
        return (i, int(t * 1e6), "10.0.0.1", "10.0.0.2", 1000, 80, 6, 5, 64, 0x10, 100)

    src = work_path(spark, "late-src")
    spark.createDataFrame([pk(1, 10), pk(2, 11)], PACKET_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame([pk(3, 5), pk(4, 12)], PACKET_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(PACKET_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    out = work_path(spark, "late-out")
    dropped = spark.sparkContext.accumulator(0)
    S.to_files(flow_features_stream(stream, 60, late="drop", dropped=dropped), out, work_path(spark, "late-ckpt")).awaitTermination()
    got = {r.packet_id: r.Number for r in spark.read.parquet(out).collect()}
    assert got == {2: 2, 4: 3}  # packet 3 (t=5 < 11) is late and dropped
    assert dropped.value == 1
    # by default every arrival is processed, in its place in time
    out = work_path(spark, "late-kept")
    S.to_files(flow_features_stream(stream, 60), out, work_path(spark, "kept-ckpt")).awaitTermination()
    got = {r.packet_id: (r.Number, r.Rate) for r in spark.read.parquet(out).collect()}
    assert got == {2: (2, 2.0), 4: (4, 4 / 7)}


def test_monitor_publishes_every_complete_record(spark):
    from tidewatch.operators import ml as M
    from tidewatch.operators.parse import parse_lines

    lines = traffic_lines(spark, SF)
    trained = M.train(parse_lines(lines, keep=("line_id",)))
    src_dir = work_path(spark, "m-src")
    S.topic_rows(lines, "csv_line", "line_id").coalesce(2).write.parquet(src_dir)
    seen = []

    def sink(batch, batch_id):
        seen.append(batch.count())

    q = S.run_monitor(spark, S.read_topic_files(spark, src_dir), trained, sink=sink, trigger=None)
    S.run_for(q, None)
    assert sum(seen) == parse_lines(lines, keep=("line_id",), complete=True).count()


def test_batch_and_stream_predict_the_same(spark):
    """Train/serve agreement: one saved model, same prediction per record."""
    from tidewatch.operators import ml as M
    from tidewatch.operators.parse import parse_lines, read_predictions

    lines = traffic_lines(spark, SF)
    parsed = parse_lines(lines, keep=("line_id",))
    path = work_path(spark, "agree-model")
    M.train(parsed.filter(M.hash_split("line_id"))).save(path)
    trained = M.Trained.load(path)
    batch = M.predict(trained, parsed, decode=False).select("line_id", F.col("prediction").alias("batch_pred"))
    src_dir = work_path(spark, "agree-src")
    S.topic_rows(lines, "csv_line", "line_id").coalesce(2).write.parquet(src_dir)
    out = work_path(spark, "agree-out")
    S.run_for(S.run_monitor(spark, S.read_topic_files(spark, src_dir), trained, trigger=None, out_path=out), None)
    streamed = read_predictions(spark.read.parquet(out)).select("line_id", F.col("predicted_label").alias("stream_pred"))
    # line_id is not unique in the fixture: compare (line_id, prediction) multisets
    b = batch.withColumnRenamed("batch_pred", "p")
    s = streamed.withColumnRenamed("stream_pred", "p")
    assert b.count() == s.count()
    assert b.exceptAll(s).count() == 0 and s.exceptAll(b).count() == 0
