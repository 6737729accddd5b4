"""Edge rows and plans that earlier rounds got wrong."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tidewatch import session as SE
from tidewatch.operators import analytics as A
from tidewatch.operators import flows as FL
from tidewatch.operators import ml as M
from tidewatch.operators import parse as P
from tidewatch.plans.strategy import plan_text
from tidewatch.schema import LABELS, PACKET_SCHEMA, TRAFFIC_FIELDS
from tidewatch.session import work_path
from tidewatch.sources import files as IO
from tidewatch.streaming import monitor as S


def line(rate="1.5", label="BENIGN", **over):
    values = {n: ("1" if k != "string" else rate) for n, k in TRAFFIC_FIELDS} | {"Label": label} | over
    return ",".join(values[n] for n, _ in TRAFFIC_FIELDS)


def test_prediction_reader_keeps_objects_and_drops_the_rest(spark):
    rows = [
        '{"predicted_label":"10"}', '{"header_length":"x","predicted_label":3.0}', '{"protocol_type":6.0,"rate":7}', "{}",
        "", "   ", None, "null", "[1]", '"a"', "12", '{"predicted_label":1',
        '{"predicted_label":3.0} tail', '{"predicted_label":3.0}{"predicted_label":4.0}', "{'predicted_label':3.0}", '{"predicted_label":3.0}]', '{"rate":"x"}, "y"',
        '{"predicted_label":3.0}}', ' {"rate":"} \\" {","x":{"y":[{},{"z":"{"}]}} \t', '{"x":{"y":1}} {}', '{"rate":"a"} "',
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, value string")
    got = {r.i: r for r in P.read_predictions(df).collect()}
    assert sorted(got) == [0, 1, 2, 3, 18] and got[18].rate == '} " {'
    assert got[0].predicted_label == 10.0
    assert (got[1].header_length, got[1].predicted_label) == (None, 3.0)
    assert (got[2].protocol_type, got[2].rate) == (6, "7")
    named = A.decode_label(P.read_predictions(df), IO.label_table(spark)).collect()
    assert {r.i: r.label for r in named}[0] == LABELS[10]


def test_training_csv_keeps_fractional_counts_and_trains(spark):
    path = work_path(spark, "t-csv")
    names = [n for n, _ in TRAFFIC_FIELDS]
    lines = [line(rate=r, label=y, ack_count="0.500000", IAT=str(i)) for i, (r, y) in enumerate([("inf", "A"), ("2.5", "B"), ("-inf", "A"), ("abc", "B")] * 5)]
    df = spark.createDataFrame([tuple(x.split(",")) for x in lines], ", ".join(f"`{n}` string" for n in names))
    IO.write_csv(df, path)
    got = IO.read_traffic_csv(spark, path)
    assert {r[0] for r in got.select("ack_count").collect()} == {0.5}
    model = M.train(got, M.ForestParams(num_trees=2, max_depth=2))
    assert sorted(model.labels.labels) == ["A", "B"]
    assert M.predict(model, got).count() == 15  # the unreadable rate is no number
    assert M.train(got, M.ForestParams(num_trees=1, max_fit_rows=8)).params.max_fit_rows == 8
    inferred = IO.read_traffic_csv(spark, path, infer=True)
    assert dict(inferred.dtypes)["ack_count"] == "double" and dict(inferred.dtypes)["Rate"] == "string"
    assert {t for _, t in IO.read_traffic_csv(spark, path, schema=None).dtypes} == {"string"}


def test_replay_keeps_blank_lines_and_header_twins(spark):
    path = work_path(spark, "t-replay")
    rows = [(0, "line"), (0, "a,b"), (0, ""), (0, "  "), (0, "line"), (0, " c "), (1, "line"), (1, ""), (1, "d")]
    for part in (0, 1):
        text = spark.createDataFrame([(v,) for p, v in rows if p == part], "value string").coalesce(1)
        text.write.mode("append").text(path)
    got = sorted(r.value for r in IO.replay_lines(spark, path).collect())
    assert got == ["", "", "", "a,b", "c", "d", "line"]


def test_attack_rate_divides_first(spark):
    rows = [(10.0 if i >= 23 else 0.0,) for i in range(80)]
    got = A.traffic_summary(spark.createDataFrame(rows, "predicted_label double"), IO.label_table(spark)).first()
    assert (got.attack, got.attack_rate, got.attack_rate_text) == (23, 23 / 80 * 100, "%.1f%%" % (23 / 80 * 100))


def test_only_infinite_rates_are_replaced(spark):
    def rows(*rates):
        df = spark.createDataFrame([(line(rate=r, label=y),) for r, y in rates], "csv_line string")
        return P.parse_lines(df)

    train = rows(("-500", "A"), ("100", "B"), ("inf", "A"), ("-inf", "B"))
    assert M.rate_bounds(train) == (-500.0, 100.0)
    model = M.train(train, M.ForestParams(num_trees=1))
    seen = {r.Rate: r.rate_capped for r in M.predict(model, rows(("-700", "A"), ("inf", "A"), ("-inf", "A"), ("3", "A"))).collect()}
    assert seen == {"-700": -700.0, "inf": 100.0, "-inf": -500.0, "3": 3.0}


def test_categorical_rates_need_no_number(spark):
    df = spark.createDataFrame([(i, line(rate="abc" if i % 2 else "5", label="AB"[i % 2])) for i in range(40)], "offset long, value string")
    rows = P.parse_lines(df.withColumnRenamed("value", "csv_line"), keep=("offset",))
    model = M.train(rows, M.ForestParams(num_trees=1, rate_as_category=True))
    path = work_path(spark, "t-category")
    model.save(path)
    model = M.Trained.load(path)
    assert model.params.rate_as_category and M.predict(model, rows).count() == 40
    topic = df.select("offset", "value", F.current_timestamp().alias("timestamp"))
    assert S.score_stream(topic, model, observe=None).count() == 40


def test_running_total_outlives_recent_progress(spark):
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "2")
    try:
        src = work_path(spark, "t-total")
        S.topic_rows(spark.range(60).select(F.col("id"), F.lit("x").alias("v")), "v", "id").repartition(6).write.parquet(src)
        stream = S.observe_progress(S.read_topic_files(spark, src, files_per_trigger=1))
        q = S.to_files(stream, work_path(spark, "t-total-o"), work_path(spark, "t-total-c"))
        q.awaitTermination()
        assert len(q.recentProgress) < 6 and S.processed_total(q) == 60
    finally:
        spark.conf.unset(key)


def test_recent_summary_covers_the_newest_only(spark):
    src, out = work_path(spark, "t-recent"), work_path(spark, "t-recent-o")
    labels, ckpt = IO.label_table(spark), work_path(spark, "t-recent-c")
    for k, name in enumerate([0, 10, 10]):
        stamp = dt.datetime(2024, 1, 1, 0, k).isoformat() + ".000000Z"
        rows = [(100 * k + i, '{"predicted_label":%d.0,"prediction_timestamp":"%s"}' % (name, stamp)) for i in range(8)]
        S.topic_rows(spark.createDataFrame(rows, "id long, v string"), "v", "id").write.mode("append").parquet(src)
        S.run_recent_summary(S.read_topic_files(spark, src), labels, out, ckpt, n=12, trigger=None).awaitTermination()
        got = {r.label: r["count"] for r in S.read_summary(spark, f"{out}/summary").collect()}
        assert got == [{LABELS[0]: 8}, {LABELS[0]: 4, LABELS[10]: 8}, {LABELS[10]: 12}][k]


def test_missing_dictionary_only_is_forgiven(spark, tmp_path):
    assert IO.read_label_dictionary(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        IO.read_label_dictionary(spark, "nosuch://x/y").count()


def test_no_local_folder_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        SE.ensure_checkpoint_dir(Session)
    with pytest.raises(ValueError):
        SE.release(spark, "/somewhere/else")


def test_metrics_mapping_is_the_fitted_one(spark):
    rows = spark.createDataFrame([("x", 0.0), ("x", 1.0), ("y", 1.0)], "Label string, prediction double")
    fitted = M.fit_label_indexer(rows)
    got = M.metrics_summary(fitted.transform(rows), fitted).first()
    assert got.label_mapping == {0: "x", 1: "y"}


def test_category_index_numbers_by_frequency(spark):
    rows = [("b",), ("a",), ("a",), ("c",), ("b",), (None,), ("d",)]
    got = {r.v: r.v_indexed for r in M.category_index(spark.createDataFrame(rows, "v string"), "v").collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 2.0, "d": 3.0}


def test_lines_are_split_once(spark):
    df = spark.createDataFrame([(line(),)], "a string").select(F.concat_ws(",", "a").alias("csv_line"))
    plan = plan_text(P.parse_lines(df, complete=True).filter("`Min` > 0"), "extended").split("== Optimized Logical Plan ==")[1]
    optimized = plan.split("== Physical Plan ==")[0]
    assert optimized.count("split(") == 1 and optimized.count("concat_ws(") == 1


def packets(spark, n, gap_us):
    return spark.range(n).selectExpr(
        "id as packet_id", f"id * {gap_us} as ts_us", "'1.1.1.1' src_ip", "'2.2.2.2' dst_ip", "1 src_port", "80 dst_port", "6 proto", "5 ihl",
        "64 ttl", "cast(id % 256 as int) flags", "cast(40 + id * 7919 % 1461 as int) length",
    )


def test_encode_then_parse_plan_is_bounded(spark):
    plan = plan_text(P.parse_lines(FL.encode_traffic(FL.flow_features(packets(spark, 4, 10), 60)), keep=("packet_id",)), "extended")
    assert len(plan) < 400_000


def test_dense_window_is_linear(spark):
    features = FL.flow_features(packets(spark, 100_000, 500), 60)
    physical = plan_text(features, "simple")
    assert not [f for f in physical.split("specifiedwindowframe(")[1:] if f.startswith("RangeFrame") and "unboundedpreceding" not in f.split(")")[0]]
    began = time.monotonic()
    last = features.orderBy(F.desc("packet_id")).first()
    assert time.monotonic() - began < 60
    assert (last.Number, last.Min, last.Max) == (100_000, 40, 1500)


def test_dense_stream_equals_batch(spark):
    from tidewatch.streaming.flow_state import flow_features_stream

    src, out, ckpt = work_path(spark, "t-dense"), work_path(spark, "t-dense-o"), work_path(spark, "t-dense-c")
    rows = packets(spark, 6_000, 25_000)
    for k in range(3):
        rows.where(f"packet_id >= {2000 * k} and packet_id < {2000 * (k + 1)}").select(*[F.col(f.name).cast(f.dataType) for f in PACKET_SCHEMA]).write.mode("append").parquet(src)
        stream = flow_features_stream(spark.readStream.schema(PACKET_SCHEMA).parquet(src), 60)
        S.to_files(stream, out, ckpt).awaitTermination()
    batch = FL.flow_features(rows, 60)
    got = spark.read.parquet(out).select(*batch.columns)
    assert got.count() == batch.count() == 5_999 and got.exceptAll(batch).count() == 0


def test_idle_flows_expire(spark):
    from tidewatch.streaming.flow_state import flow_features_stream

    src, out = work_path(spark, "t-idle"), work_path(spark, "t-idle-o")
    typed = [F.col(f.name).cast(f.dataType) for f in PACKET_SCHEMA]
    packets(spark, 2, 1000).select(*typed).coalesce(1).write.parquet(src)
    q = S.to_files(flow_features_stream(spark.readStream.schema(PACKET_SCHEMA).parquet(src), 60, idle_ttl_s=1), out, work_path(spark, "t-idle-c"), trigger="500 milliseconds")
    try:
        until = time.monotonic() + 40
        while time.monotonic() < until and spark.read.schema(FL_SCHEMA()).parquet(out).count() < 1:
            time.sleep(0.5)
        time.sleep(6)
        packets(spark, 4, 1000).where("packet_id >= 2").select(*typed).coalesce(1).write.mode("append").parquet(src)
        while time.monotonic() < until + 40 and spark.read.schema(FL_SCHEMA()).parquet(out).count() < 2:
            time.sleep(0.5)
    finally:
        q.stop()
    got = {r.packet_id: r.Number for r in spark.read.parquet(out).collect()}
    assert got == {1: 2, 3: 2}  # without expiry packet 2 would make a record and packet 3 count 4


def FL_SCHEMA():
    from tidewatch.streaming.flow_state import output_schema

    return output_schema()
