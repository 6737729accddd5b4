"""The paced line source: lines a trigger, restart, headers by position; and the other small sources and sinks."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import ml as M
from tidewatch.operators import parse as P
from tidewatch.session import work_path
from tidewatch.sources import files as IO
from tidewatch.sources import line_replay as LR
from tidewatch.streaming import monitor as S


def put(path, **texts):
    import os

    path = path.removeprefix("file:")
    os.makedirs(path, exist_ok=True)
    for name, text in texts.items():
        with open(f"{path}/{name}.csv", "wb") as f:
            f.write(text.encode())


LINES = {
    "a": "line\nline\n\n  x \ntwo,é中\nline\n",
    "b": "head\r\nb1\r\nb2\r\nb3",  # no end of the last line
    "c": "only a header\n",
    "d": "",
    "e": "head\n" + "".join(f"e{i}\n" for i in range(23)),
}
WANT = ["line", "", "x", "two,é中", "line", "b1", "b2", "b3", *[f"e{i}" for i in range(23)]]


def drained(spark, path, out, ckpt, n, trigger="0 seconds"):
    q = S.to_files(LR.replay_stream(spark, path, n), out, ckpt, trigger=trigger)
    q.processAllAvailable()
    q.stop()
    return q


def test_lines_a_trigger_restart_and_header_twins(spark):
    path, out, ckpt = (work_path(spark, f"lr-{x}") for x in ("in", "out", "ckpt"))
    put(path, a=LINES["a"], b=LINES["b"], _SUCCESS="no data\nat all\n")
    q = drained(spark, path, out, ckpt, 3)
    put(path, **{k: LINES[k] for k in "cde"})  # later files, after a restart and under another pace
    again = drained(spark, path, out, ckpt, 10)
    rows = spark.read.parquet(out).orderBy("file", "at").collect()
    assert [r.value for r in rows] == WANT
    batches = {}
    for r in spark.read.parquet(out).select("value", F.input_file_name().alias("f")).collect():
        batches[r.f] = batches.get(r.f, 0) + 1
    assert sorted(batches.values()) == [2, 3, 3, 3, 10, 10]
    assert q.lastProgress["batchId"] < again.lastProgress["batchId"]


def test_a_batch_is_read_again_between_its_offsets():
    import tempfile

    path = tempfile.mkdtemp()
    put(path, **LINES)
    for n in (1, 2, 5, 100):
        reader, at, whole = LR.LineReader(path, n), {"file": "", "at": 0}, []
        while True:
            segments, end = reader.read(at)
            segments = list(segments)
            if not segments:
                break
            lines = read(path, segments)
            assert lines == read(path, list(LR.LineReader(path, 7).readBetweenOffsets(at, end)))
            assert len(lines) == min(n, len(WANT) - len(whole))
            whole, at = whole + lines, end
        assert [x.strip() for x in whole] == WANT
        assert list(reader.readBetweenOffsets(at, at)) == []


def read(path, segments):
    import pyarrow as pa

    batch = pa.record_batch([pa.array([s[i] for s in segments]) for i in range(3)], ["file", "start", "stop"])
    return [v for b in LR.segment_lines(path, iter([batch])) for v in b.column("value").to_pylist()]


def test_paced_replay_with_a_timed_trigger(spark):
    path, out = work_path(spark, "t-paced"), work_path(spark, "t-paced-out")
    put(path, a="h\na\nb\nc\n")
    q = S.to_files(LR.replay_stream(spark, path, 1), out, work_path(spark, "t-paced-c"), trigger="1 second")
    q.processAllAvailable()
    began = time.monotonic()
    S.run_for(q, 2)
    assert not q.isActive and time.monotonic() - began >= 2
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]
    batches = [p for p in q.recentProgress if p["numInputRows"]]
    starts = [dt.datetime.fromisoformat(p["timestamp"]) for p in batches]
    assert len(batches) == 3 and (starts[-1] - starts[0]).total_seconds() >= 1.5  # not one burst
    with pytest.raises(Exception, match="lines_per_trigger"):
        LR.replay_stream(spark, path, 0)


def test_timestamped_csv(spark):
    now = dt.datetime(2024, 3, 5, 6, 7, 8)
    df = spark.createDataFrame([(1, "a,b")], "x int, y string")
    path = IO.write_timestamped_csv(df, work_path(spark, "stamped"), "run", now)
    assert path.endswith("/run-2024-03-05-06-07-08.csv")
    assert [tuple(r) for r in IO.read_traffic_csv(spark, path, schema=df.schema).collect()] == [(1, "a,b")]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        IO.write_timestamped_csv(df, path.rsplit("/", 1)[0], "run", now)


def test_small_helpers(spark):
    row = IO.one_row(spark, {"a": 1, "b": None}, "a int, b string")
    assert [tuple(r) for r in row.collect()] == [(1, None)]
    df = spark.createDataFrame([(1.0, "x", "y", "z")], "n double, s string, Label string, kafka_timestamp string")
    assert P.string_features(df) == ["s"] and P.feature_columns(df) == ["n", "s_indexed"]
    P.require_column(df, "s")
    with pytest.raises(ValueError, match="'nope' not found"):
        P.require_column(df, "nope")
    a, b = M.random_split(spark.range(1000))
    assert a.count() + b.count() == 1000 and 700 < a.count() < 900 and not a.intersect(b).count()
    src = work_path(spark, "console-src")
    spark.createDataFrame([("to the console",)], "v string").write.parquet(src)
    q = S.to_console(spark.readStream.schema("v string").parquet(src), work_path(spark, "console-ckpt"))
    q.awaitTermination()
    shown = [p for p in q.recentProgress if p["numInputRows"] == 1]
    assert len(shown) == 1 and "Console" in shown[0]["sink"]["description"]


def test_totals_are_reported_and_a_missing_report_is_an_error():
    said = []
    totals = S.RowTotals(every=100, report=lambda name, n: said.append((name, n)))

    class Event:
        def __init__(self, batch, rows):
            from pyspark.sql import Row

            self.progress = type("P", (), {"runId": "r", "batchId": batch, "observedMetrics": {"progress": Row(rows=rows)}})

    for i, n in enumerate([60, 30, 20, 300, 5]):
        totals.onQueryProgress(Event(i, n))
    assert said == [("progress", 110), ("progress", 410)] and totals.rows["r", "progress"] == 415


def test_a_total_that_is_not_reported_is_an_error(spark):
    query = type("Q", (), {"runId": "never", "lastProgress": {"batchId": 3}})()
    with pytest.raises(TimeoutError, match="batch 3"):
        S.processed_total(query, wait_s=0.2)
