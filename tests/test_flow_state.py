"""Stateful flow features: event-time order, equal times, timers, and what a batch writes."""

import random

import numpy as np
import pandas as pd
import pytest

from tidewatch.operators import flows as FL
from tidewatch.schema import PACKET_SCHEMA
from tidewatch.session import work_path
from tidewatch.streaming import flow_state as FS
from tidewatch.streaming import monitor as S


T0 = 1_700_000_000_000_000  # the watermark of a stream starts at the epoch


def pk(i, t_s, flow=1, length=100, flags=0x10):
    return (i, T0 + int(round(t_s * 1e6)), f"10.0.0.{flow}", "10.0.1.1", 1000, 80, 6, 5, 64, flags, length)


def stream(spark, batches, **kw):
    """Records of the stream that brings ``batches`` one by one, and its query."""
    src, out = work_path(spark, "fs-src"), work_path(spark, "fs-out")
    for rows in batches:
        spark.createDataFrame(rows, PACKET_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    source = spark.readStream.schema(PACKET_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    q = S.to_files(FS.flow_features_stream(source, 60, **kw), out, work_path(spark, "fs-ckpt"))
    q.awaitTermination()
    return spark.read.schema(FS.output_schema()).parquet(out), q


def records(df):
    return sorted(tuple(r) for r in df.collect())


def two_partitions(seed):
    """Packets of three flows with equal times, in two topic partitions that are each in order."""
    rng = random.Random(seed)
    rows, t = [], 0.0
    for i in range(120):
        t += rng.choice([0, 0, 0.5, 3, 59.999999, 60]) if i % 7 == 0 else rng.choice([0, 0.25, 1])
        rows.append(pk(i, t, flow=rng.randrange(1, 4), length=rng.randrange(40, 1500), flags=rng.randrange(256)))
    return rows, [r for r in rows if r[0] % 2], [r for r in rows if not r[0] % 2]


@pytest.mark.parametrize("lead", [15, 40])
def test_any_interleaving_of_partitions_gives_the_batch_records(spark, lead):
    rows, odd, even = two_partitions(lead)
    ahead = [odd[k : k + lead] for k in range(0, len(odd), lead)]
    behind = [[]] + [even[k : k + lead] for k in range(0, len(even), lead)]  # one batch late
    batches = [(ahead[k] if k < len(ahead) else []) + (behind[k] if k < len(behind) else []) for k in range(max(len(ahead), len(behind)))]
    beat = [[pk(9000 + k, 10_000 + 2000 * k, flow=200)] for k in range(2)]  # time goes on, in a flow of its own
    got, q = stream(spark, [b[::-1] for b in batches if b] + beat, delay_s=1000)
    want = FL.flow_features(spark.createDataFrame(rows, PACKET_SCHEMA), 60)
    assert records(got) == records(want.select(*got.columns)) and want.count() > 80
    assert FS.late_packets(q) == 0


def test_packets_behind_the_watermark_are_counted_and_silent_flows_are_emitted(spark):
    batches = [[pk(1, 10), pk(2, 11), pk(3, 11)], [pk(4, 500, flow=2)], [pk(6, 501, flow=2)], [pk(5, 12), pk(10, 502, flow=2)], [pk(7, 2000, flow=3)], [pk(8, 2001, flow=3)]]
    got, q = stream(spark, batches, delay_s=30)
    # flow 1 is emitted by its timer, though nothing more of it comes in time: packet 5 is 470 s behind
    assert {r.packet_id: r.Number for r in got.collect()} == {2: 2, 3: 3, 6: 2, 10: 3}
    assert FS.late_packets(q) == 1


def test_batch_and_stream_agree_on_equal_times(spark):
    rows = [pk(i, 5 + i // 4, length=40 + 7 * i, flags=i) for i in range(16)]
    want = records(FL.flow_features(spark.createDataFrame(rows, PACKET_SCHEMA), 60).select(*FS.output_schema().names))
    assert records(stream(spark, [rows[::-1]])[0]) == want
    assert records(stream(spark, [rows[8:], rows[:8], [pk(99, 9000, flow=9)], [pk(98, 9001, flow=9)]], delay_s=100)[0].where("packet_id < 90")) == want


class FakeList:
    def __init__(self):
        self.rows, self.written = [], 0

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows, self.written = list(rows), self.written + len(rows)

    def appendList(self, rows):
        self.rows, self.written = self.rows + list(rows), self.written + len(rows)

    def clear(self):
        self.rows = []


class FakeValue:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class FakeHandle:
    def __init__(self):
        self.timers = set()

    def getValueState(self, *_):
        return FakeValue()

    def getListState(self, *_):
        return FakeList()

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Clock:
    def __init__(self, ms=0):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getCurrentProcessingTimeInMs = getCurrentWatermarkInMs


class Count:
    value = 0

    def add(self, n):
        self.value += n


def processor(**kw):
    p = FS.FlowProcessor(60_000_000, **{"late": "accept", "idle_ttl_ms": None, "event_time": False, **kw})
    p.init(FakeHandle())
    return p


def feed(p, rows, clock=None):
    pdf = pd.DataFrame([(int(t * 1e6), i, 100, 5, 6, 64, 0) for i, t in rows], columns=FS.PACKET_FIELDS)
    return [x for out in p.handleInputRows(("f",), iter([pdf]), clock or Clock()) for x in zip(out["packet_id"], out["Number"], strict=True)]


def test_a_batch_writes_what_is_new_not_its_window():
    p = processor()
    seen = 0
    for k in range(400):  # 10 packets a batch, 300 of them in the window
        out = feed(p, [(10 * k + j, 2 * k + j / 5) for j in range(10)])
        seen += len(out)
    assert seen == 3999 and out[-1] == (3999, 300)
    assert p.packets.written <= 2.2 * 4000 and len(p.packets.rows) <= 2 * 300 + 20


def test_late_packets_with_a_trimmed_window_are_counted():
    short = Count()
    p = processor(short=short)
    feed(p, [(k, k) for k in range(300)])
    assert feed(p, [(900, 299)]) == [(900, 61)] and short.value == 0
    feed(p, [(901, 250.5)])
    assert short.value == 1


def test_idle_state_is_deleted_by_its_timer():
    p = processor(idle_ttl_ms=5000)
    feed(p, [(1, 1), (2, 2)], Clock(1000))
    assert p.handle.timers == {6000}
    feed(p, [(3, 3)], Clock(4000))
    assert p.handle.timers == {9000}
    assert list(p.handleExpiredTimer(("f",), Clock(9000), None)) == [] and not p.totals.exists() and not p.packets.rows
    p = processor(idle_ttl_ms=5000, event_time=True)
    assert feed(p, [(2, 2), (1, 1)], Clock(500)) == [] and p.handle.timers == {1000}
    out = list(p.handleExpiredTimer(("f",), Clock(3000), None))
    assert [int(n) for df in out for n in df["Number"]] == [2] and p.handle.timers == {7000}
    assert list(p.handleExpiredTimer(("f",), Clock(7000), None)) == [] and not p.totals.exists()


def test_extremes_of_runs():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 50, 40)
    first = rng.integers(0, 40, 60)
    last = np.minimum(first + rng.integers(0, 20, 60), 39)
    low, high = FS._extremes(v, first, last)
    assert all((a, b) == (v[i : j + 1].min(), v[i : j + 1].max()) for a, b, i, j in zip(low, high, first, last, strict=True))


@pytest.mark.parametrize("kw", [{}, {"late": "drop"}, {"idle_ttl_ms": 40_000}, {"event_time": True}, {"event_time": True, "idle_ttl_ms": 90_000}])
def test_a_group_of_flows_gives_what_each_flow_alone_gives(kw):
    rng = np.random.default_rng(3)
    group = FS.FlowGroupProcessor(60_000_000, **{"late": "accept", "idle_ttl_ms": None, "event_time": False, **kw})
    group.init(FakeHandle())
    alone, got, want, calls = {}, [], [], 0

    def fire(p, key, clock, sink):
        due = [t for t in p.handle.timers if t < clock.ms]
        for t in due:
            sink.extend(p.handleExpiredTimer((key,), clock, None))
            p.handle.timers.discard(t)

    for k in range(40):
        n = int(rng.integers(1, 60))
        late = 0 if kw.get("event_time") else 25 * (rng.random(n) < 0.1)
        t = ((30 * k + rng.integers(0, 30, n) - late) * 1e6).astype(np.int64) + 100_000_000
        pdf = pd.DataFrame({name: rng.integers(1, 1000, n) for name in FS.PACKET_FIELDS} | {"ts_us": t, "packet_id": np.arange(n) + 100 * k})
        pdf.insert(0, "flow", [f"f{i}" for i in rng.integers(0, 3 + k // 4, n)])
        clock = Clock(100_000 + 30_000 * k - 10_000)
        got.extend(group.handleInputRows((0,), iter([pdf]), clock))
        calls += 1
        for flow, rows in pdf.groupby("flow"):
            if flow not in alone:
                alone[flow] = processor(**kw)
            want.extend(alone[flow].handleInputRows((flow,), iter([rows]), clock))
        fire(group, 0, clock, got)
        for flow, p in alone.items():
            fire(p, flow, clock, want)
    got, want = (pd.concat(x).sort_values(["flow", "packet_id"], ignore_index=True) for x in (got, want))
    pd.testing.assert_frame_equal(got[want.columns], want)
    assert len(want) > 300 and calls == 40
    # one list entry a batch at most, and no more packets than twice those that the flows keep
    assert len(group.chunks.rows) <= 40 and group.chunks.written <= 80
    if not kw:
        held = sum(len(c) for (c,) in group.chunks.rows) // (8 * (1 + len(FS.PACKET_FIELDS)))
        assert held <= 2 * sum(len(p.packets.rows) for p in alone.values())


def test_the_stream_groups_its_flows(spark):
    rows = [pk(i, i // 20, flow=i % 20) for i in range(200)]
    plan = FS.flow_features_stream(spark.createDataFrame(rows, PACKET_SCHEMA), 60, groups=4)._jdf.queryExecution().logical().toString()
    assert "flow_group" in plan
