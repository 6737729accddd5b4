"""Stateful streaming flow features (the per-packet extractor, incrementally).

Packets are decoded with JVM expressions (key, flag bits, protocol indicators); only the per-flow state
update runs in Python, a ``StatefulProcessor`` on groups of flows (a hash of the flow key), since a call and its state cost
tens of milliseconds however few packets it brings. Arithmetic matches
``operators.flows.flow_features`` exactly (integer sums, then the same double operations).

State of a flow:

* a value: first and last time, whole-life counters, how far packets were emitted and trimmed, the timer;
* a list of packets, to which a batch only appends what is new. Packets that left the last ``W`` are
  trimmed when they are more than half of the list, so each is written at most about twice.

A group keeps the values of its flows as one row of arrays, and the packets of a batch as one binary list entry
(with the place of their flow in the group). What a flow trims is passed over from then on, and leaves the list when
it is more than half of it. One timer stands for the earliest of the group's flows.

Two orders of emission:

* Arrival order (``delay_s=None``, the extractor's own notion: arrival time is event time). A packet is
  emitted in the batch that brings it. A packet older than the newest one of its flow is late: it takes its place
  in time among the packets kept, and ``short`` counts those whose window reaches back behind what was
  trimmed. ``late='drop'`` leaves late packets out and counts them.
* Event-time order (``delay_s``). Packets wait in the list until the watermark, ``delay_s`` behind the newest packet
  of the stream, has passed them; then no earlier packet can come, and they are emitted in the order of ``(ts_us,
  packet_id)``. So however topic partitions interleave within the delay, the records are those of the batch operator.
  An event-time timer at the oldest waiting packet emits it when its flow stays silent. Spark drops packets behind the watermark
  and counts them (``late_packets``). Packets newer than the watermark wait when the stream ends.

``idle_ttl_s`` deletes the state of flows idle that long (processing time, or event time with ``delay_s``), which
restarts their counters; ``None`` keeps state forever.

A micro-batch of a flow is worked on as arrays: binary search for window starts,
prefix sums for counts, sums and squares, and tables of run extremes for minimum and maximum, so
the work does not grow with the packets per window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.flows import FLAG_NAMES, FLOW_FEATURE_NAMES, PROTOCOL_FLAGS, _counters, flow_key, packet_marks
from ..schema import DEFAULT_WINDOW_S, UNKNOWN_LABEL

_INT_FIELDS = {
    "Header_Length", "Protocol_Type", "Time_To_Live", "Min", "Max", "Number", "IGMP", "IPv", "LLC",
    *[f"{n.lower()}_flag_number" for n in FLAG_NAMES], *PROTOCOL_FLAGS,
}
_LONG_FIELDS = {"Tot_sum", "Tot_size"}


def output_schema() -> T.StructType:
    fields = [
        T.StructField("flow", T.StringType()),
        T.StructField("packet_id", T.LongType()),
        T.StructField("ts_us", T.LongType()),
    ]
    for name in FLOW_FEATURE_NAMES:
        if name == "Label":
            t = T.StringType()
        elif name in _LONG_FIELDS:
            t = T.LongType()
        elif name in _INT_FIELDS:
            t = T.IntegerType()
        else:
            t = T.DoubleType()
        fields.append(T.StructField(name, t))
    return T.StructType(fields)


PACKET_FIELDS = ["ts_us", "packet_id", "length", "ihl", "proto", "ttl", "marks"]
LIST_SCHEMA = ", ".join(f"{name} bigint" for name in PACKET_FIELDS)
TOTALS = ["first_us", "last_us", "emitted_us", "trimmed_us", "timer_ms"]
TOTALS_SCHEMA = ", ".join(f"{name} bigint" for name in TOTALS) + ", counters array<bigint>"
GROUPS = 1024
GROUP_SCHEMA = "flows array<string>, totals binary, counters binary, timer_ms bigint"
CHUNK_SCHEMA = "packets binary"
_NONE = np.iinfo(np.int64).min  # a total that is not set
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _extremes(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum of ``values[first..last]`` for every pair, from tables of
    the extremes of all runs of a power of two."""
    size = last - first + 1
    level = np.floor(np.log2(size)).astype(int)
    lows, highs = [values], [values]
    for k in range(level.max(initial=0)):
        step = 1 << k
        lows.append(np.minimum(lows[-1][:-step], lows[-1][step:]))
        highs.append(np.maximum(highs[-1][:-step], highs[-1][step:]))
    low, high = np.empty(len(first), np.int64), np.empty(len(first), np.int64)
    for k in range(len(lows)):
        at = level == k
        a, b = first[at], last[at] - (1 << k) + 1
        low[at], high[at] = np.minimum(lows[k][a], lows[k][b]), np.maximum(highs[k][a], highs[k][b])
    return low, high


def _running(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(x, dtype=np.int64)])


def _records(flow: str, packets: dict[str, np.ndarray], new: np.ndarray, counters: np.ndarray, first_us: np.ndarray, w_us: int) -> dict | None:
    """Columns of the feature rows of the new packets, if there are any. ``packets`` are all retained ones in
    time order, ``new`` the places of the new ones among them, ``counters`` their
    whole-life counters. All integer, then the batch operator's double operations."""
    ts, length = packets["ts_us"], packets["length"]
    start = np.searchsorted(ts, ts[new] - w_us, "right")
    keep = new - start >= 1
    new, start, counters, first_us = new[keep], start[keep], counters[keep], first_us[keep]
    if not len(new):
        return None
    n = new - start + 1
    s1 = _running(length)[new + 1] - _running(length)[start]
    s2 = _running(length * length)[new + 1] - _running(length * length)[start]
    low, high = _extremes(length, start, new)
    # squared gaps, in two 20-bit parts so that sums stay exact; a gap of W or more never counts
    gap = np.diff(ts, prepend=ts[0])
    gap = np.where(gap < w_us, gap, 0)
    hi, lo = gap >> 20, gap & 0xFFFFF
    parts = [_running(x)[new + 1] - _running(x)[start + 1] for x in (hi * hi, hi * lo, lo * lo)]
    q = [(int(a) << 40) + (int(b) << 21) + int(c) for a, b, c in zip(*parts, strict=True)]
    span = ts[new] - ts[start]
    nd, m = n.astype(float), n - 1
    md = m.astype(float)
    length_num = np.array([float(int(k) * int(b) - int(a) * int(a)) for k, a, b in zip(n, s1, s2, strict=True)])
    gap_num = np.array([float(int(k) * x - int(d) * int(d)) for k, x, d in zip(m, q, span, strict=True)])
    cnt = {c: counters[:, i] for i, c in enumerate(_counters())}
    return {
        "flow": flow, "packet_id": packets["packet_id"][new], "ts_us": ts[new],
        "Header_Length": packets["ihl"][new] * 4, "Protocol_Type": packets["proto"][new], "Time_To_Live": packets["ttl"][new],
        "Rate": nd / np.maximum((ts[new] - first_us).astype(float) / 1e6, 1.0),
        **{f"{name.lower()}_flag_number": cnt[f"f_{name}"] for name in FLAG_NAMES},
        **{f"{name.lower()}_count": cnt[f"f_{name}"].astype(float) / nd for name in ("ACK", "SYN", "FIN", "RST")},
        **{name: (cnt[f"p_{name}"] > 0).astype(int) for name in PROTOCOL_FLAGS},
        "IGMP": 0, "IPv": 1, "LLC": 0, "Tot_sum": s1, "Min": low, "Max": high, "AVG": s1.astype(float) / nd,
        "Std": np.sqrt(length_num / (nd * md)), "Tot_size": s1, "IAT": span.astype(float) / md / 1e6, "Number": n,
        "Variance": np.where(m > 1, gap_num / (md * md) / 1e12, 0.0), "Label": UNKNOWN_LABEL,
    }


def _frame(parts: list[dict]) -> pd.DataFrame:
    """The rows of several flows as one frame."""
    sizes = [len(part["packet_id"]) for part in parts]

    def column(name: str) -> np.ndarray:
        if isinstance(parts[0][name], np.ndarray):
            return np.concatenate([part[name] for part in parts])
        return np.repeat(np.array([part[name] for part in parts]), sizes)

    return pd.DataFrame({f.name: column(f.name) for f in output_schema().fields})


class FlowProcessor(StatefulProcessor):
    """The state of one flow and its update (see the module's text)."""

    def __init__(self, w_us: int, late: str, idle_ttl_ms: int | None, event_time: bool, dropped=None, short=None) -> None:
        self.w_us, self.late, self.idle_ttl_ms, self.event_time = w_us, late, idle_ttl_ms, event_time
        self.dropped, self.short = dropped, short

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", TOTALS_SCHEMA)
        self.packets = handle.getListState("packets", LIST_SCHEMA)

    def close(self) -> None: ...

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat([pdf[PACKET_FIELDS] for pdf in rows], ignore_index=True).sort_values(["ts_us", "packet_id"], kind="stable")
        yield from self.update(key[0], new.to_numpy(np.int64), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.update(key[0], np.empty((0, len(PACKET_FIELDS)), np.int64), timerValues)

    def update(self, flow: str, new: np.ndarray, timers) -> Iterator[pd.DataFrame]:
        state = self.totals.get() if self.totals.exists() else None
        if state is None and not len(new):
            return
        total = dict(zip(TOTALS, state[:-1], strict=True)) if state else dict.fromkeys(TOTALS)
        counters = np.array(state[-1] if state else [0] * len(_counters()), np.int64)
        if not len(new) and self._idle(total, timers):
            self.totals.clear()
            self.packets.clear()
            return
        old = np.array(list(self.packets.get()), np.int64).reshape(-1, len(PACKET_FIELDS)) if state else new[:0]
        timer = total["timer_ms"]
        out, counters, new, kept = self.advance(flow, total, counters, old, new, timers)
        if out:
            yield _frame([out])
        if kept is not None:
            self.packets.put([tuple(r) for r in np.concatenate([old, new])[kept].tolist()])
        elif len(new):
            self.packets.appendList([tuple(r) for r in new.tolist()])
        self._move_timer(timer, total["timer_ms"])
        self.totals.update((*(total[name] for name in TOTALS), counters.tolist()))

    def advance(self, flow: str, total: dict, counters: np.ndarray, old: np.ndarray, new: np.ndarray, timers) -> tuple:
        """One flow's batch: the columns of its records (or None), its counters, the new packets that are not left out, and,
        if it is trimmed, which of ``old`` and these stay. ``total`` is brought up to date."""
        if self.late == "drop" and not self.event_time and total["last_us"] is not None:
            on_time = new[:, 0] >= total["last_us"]
            if self.dropped is not None:
                self.dropped.add(int((~on_time).sum()))
            new = new[on_time]
        rows = np.concatenate([old, new])
        emitted = total["emitted_us"]
        if self.event_time:
            safe = timers.getCurrentWatermarkInMs() * 1000  # Spark drops what is not beyond it from now on
            fresh = (rows[:, 0] <= safe) & (rows[:, 0] > (emitted if emitted is not None else np.iinfo(np.int64).min))
            waits = rows[:, 0] > safe
            rank = np.lexsort((rows[:, 1], rows[:, 0]))
        else:
            fresh, waits = np.arange(len(rows)) >= len(old), np.zeros(len(rows), bool)
            rank = np.argsort(rows[:, 0], kind="stable")  # late packets take their place among the retained ones
        out = None
        if fresh.any():
            ready = rank[~waits[rank]]
            window = rows[ready]
            at = np.flatnonzero(fresh[ready])
            packets = {name: window[:, i] for i, name in enumerate(PACKET_FIELDS)}
            times = window[at, 0]
            if self.short is not None and total["trimmed_us"] is not None:
                self.short.add(int((times - self.w_us < total["trimmed_us"]).sum()))
            bits = (packets["marks"][at][:, None] >> np.arange(len(counters))) & 1
            running = np.cumsum(bits, axis=0) + counters
            first = np.minimum.accumulate(times if total["first_us"] is None else np.minimum(times, total["first_us"]))
            out = _records(flow, packets, at, running, first, self.w_us)
            counters = running[-1]
            total["first_us"], total["last_us"] = int(first[-1]), int(max(window[-1, 0], total["last_us"] or window[-1, 0]))
        if self.event_time:
            total["emitted_us"] = safe if emitted is None else max(emitted, safe)
        dead = ~waits & ~(rows[:, 0] > (total["last_us"] or 0) - self.w_us) if total["last_us"] is not None else np.zeros(len(rows), bool)
        kept = None
        if 2 * dead.sum() > len(rows):
            total["trimmed_us"] = int(max(rows[dead, 0].max(), total["trimmed_us"] if total["trimmed_us"] is not None else rows[dead, 0].max()))
            kept = ~dead
        total["timer_ms"] = self._timer(total, rows[waits, 0], timers)
        return out, counters, new, kept

    def _now(self, total: dict, timers) -> int:
        return timers.getCurrentWatermarkInMs() if self.event_time else timers.getCurrentProcessingTimeInMs()

    def _idle(self, total: dict, timers) -> bool:
        """The flow's timer fired and nothing waits: in event time all of it is older than the time to live."""
        if not self.idle_ttl_ms:
            return False
        if not self.event_time:
            return True  # a batch of the flow moves the timer
        return total["last_us"] is not None and total["last_us"] // 1000 + self.idle_ttl_ms <= self._now(total, timers)

    def _timer(self, total: dict, waiting: np.ndarray, timers) -> int | None:
        """When a flow is due: the oldest waiting packet, else the end of its idle time."""
        if len(waiting):
            return -(-int(waiting.min()) // 1000)
        if self.idle_ttl_ms and (not self.event_time or total["last_us"] is not None):
            return (total["last_us"] // 1000 if self.event_time else self._now(total, timers)) + self.idle_ttl_ms
        return None

    def _move_timer(self, before: int | None, at: int | None) -> None:
        if at != before:
            if before is not None:
                self.handle.deleteTimer(before)
            if at is not None:
                self.handle.registerTimer(at)


class FlowGroupProcessor(FlowProcessor):
    """The flows of a group: each goes on as in ``FlowProcessor``, with one state and one frame for all (see the module's text)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.group = handle.getValueState("group", GROUP_SCHEMA)
        self.chunks = handle.getListState("chunks", CHUNK_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat([pdf[["flow", *PACKET_FIELDS]] for pdf in rows], ignore_index=True)
        yield from self.update_group(new["flow"].to_numpy(), new[PACKET_FIELDS].to_numpy(np.int64), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.update_group(np.empty(0, object), np.empty((0, len(PACKET_FIELDS)), np.int64), timerValues)

    def _load(self) -> tuple:
        """Names, totals and counters of the flows, the group's timer, and the packets (flow, fields) with the list entry of each."""
        width = 1 + len(PACKET_FIELDS)
        if not self.group.exists():
            return [], np.empty((0, len(TOTALS) + 1), np.int64), np.empty((0, len(_counters())), np.int64), None, np.empty((0, width), np.int64), np.empty(0, np.int64), 0
        flows, totals, counters, timer = self.group.get()
        chunks = [np.frombuffer(c, np.int64).reshape(-1, width) for (c,) in self.chunks.get()]
        packets = np.concatenate(chunks) if chunks else np.empty((0, width), np.int64)
        totals, counters = np.frombuffer(totals, np.int64).reshape(len(flows), -1), np.frombuffer(counters, np.int64).reshape(len(flows), -1)
        return list(flows), totals, counters, timer, packets, np.repeat(np.arange(len(chunks)), [len(c) for c in chunks]), len(chunks)

    def update_group(self, names: np.ndarray, new: np.ndarray, timers) -> Iterator[pd.DataFrame]:
        # a flow's last total is the number of list entries that its last trimming passed over
        flows, totals, counters, timer, packets, entry, entries = self._load()
        known = {flow: i for i, flow in enumerate(flows)}
        of = np.fromiter((known.setdefault(name, len(known)) for name in names), np.int64, len(names))
        flows, fresh = list(known), len(known) - len(flows)
        totals = np.concatenate([totals, np.repeat([[_NONE] * len(TOTALS) + [0]], fresh, axis=0)])
        counters = np.concatenate([counters, np.zeros((fresh, counters.shape[1]), np.int64)])
        # what is trimmed: older than its flow's mark, in an entry before it
        trimmed = totals[:, TOTALS.index("trimmed_us")]
        alive = (packets[:, 1] > trimmed[packets[:, 0]]) | (entry >= totals[packets[:, 0], -1])
        old = packets[alive]
        old = old[np.argsort(old[:, 0], kind="stable")]
        order = np.lexsort((new[:, 1], new[:, 0], of))
        of, new = of[order], new[order]
        places = np.arange(len(flows) + 1)
        old_at, new_at = np.searchsorted(old[:, 0], places), np.searchsorted(of, places)
        due = np.diff(new_at) > 0
        if not len(new):
            at = totals[:, TOTALS.index("timer_ms")]
            due = (at != _NONE) & (at <= (timers.getCurrentWatermarkInMs() if self.event_time else timers.getCurrentProcessingTimeInMs()))
        out, added, gone = [], [], np.zeros(len(flows), bool)
        left = np.diff(old_at)  # packets of each flow that stay in the list
        for i in np.flatnonzero(due):
            total = {name: None if x == _NONE else x for name, x in zip(TOTALS, totals[i].tolist(), strict=False)}
            mine, more = old[old_at[i] : old_at[i + 1], 1:], new[new_at[i] : new_at[i + 1]]
            if not len(more) and self._idle(total, timers):
                gone[i], left[i] = True, 0
                continue
            got, counters[i], more, kept = self.advance(flows[i], total, counters[i], mine, more, timers)
            if got:
                out.append(got)
            if kept is not None:
                left[i], more = kept[: len(mine)].sum(), more[kept[len(mine) :]]
                totals[i, -1] = entries
            totals[i, :-1] = [_NONE if total[name] is None else total[name] for name in TOTALS]
            added.append(np.column_stack([np.full(len(more), i), more]))
        if out:
            yield _frame(out)
        added = np.concatenate(added) if added else packets[:0]
        if gone.all():
            self.chunks.clear()
            self.group.clear()
            self._move_timer(timer, None)
            return
        if gone.any() or 2 * (len(packets) - left.sum()) > len(packets) + len(added):
            # written anew without what is trimmed, the flows that are gone, and their places
            passed = (packets[:, 1] <= totals[packets[:, 0], TOTALS.index("trimmed_us")]) & (entry < totals[packets[:, 0], -1])
            rest = np.concatenate([packets[~passed], added])
            rest = rest[~gone[rest[:, 0]]]
            rest[:, 0] = (np.cumsum(~gone) - 1)[rest[:, 0]]
            flows = [flow for flow, lost in zip(flows, gone, strict=True) if not lost]
            totals, counters = totals[~gone], counters[~gone]
            totals[:, -1] = 0
            self.chunks.put([(rest.tobytes(),)])
        elif len(added):
            self.chunks.appendList([(added.tobytes(),)])
        at = totals[:, TOTALS.index("timer_ms")]
        at = int(at[at != _NONE].min()) if (at != _NONE).any() else None
        if not len(new) and at is not None and at == timer:
            at += 1  # the timer that fired is deleted behind this call
        self._move_timer(timer, at)
        self.group.update((flows, totals.tobytes(), counters.tobytes(), at))


def flow_features_stream(
    packets: DataFrame,
    window_s: float = DEFAULT_WINDOW_S,
    idle_ttl_s: float | None = None,
    late: str = "accept",
    dropped=None,
    delay_s: float | None = None,
    short=None,
    groups: int = GROUPS,
) -> DataFrame:
    """Streaming per-packet flow records from a stream of packet rows. ``dropped`` and ``short`` (Spark
    accumulators) count the packets that ``late='drop'`` leaves out, and late ones with a shortened window.
    With ``delay_s`` records come in event-time order. ``groups`` is the number of groups of flows; a checkpoint keeps to its own."""
    if late not in ("accept", "drop"):
        raise ValueError(f"late must be 'accept' or 'drop', not {late!r}")
    packets.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)  # list state and timers need it
    packets = packets.where(F.col("ts_us").isNotNull())
    if delay_s is not None:
        packets = packets.withColumn("event_time", F.timestamp_micros("ts_us")).withWatermark("event_time", f"{int(delay_s * 1000)} milliseconds")
    kept = ["event_time"] if delay_s is not None else []
    numbers = [F.col(c).cast("bigint").alias(c) for c in PACKET_FIELDS if c != "marks"]
    d = flow_key(packets).select(F.pmod(F.xxhash64("flow"), F.lit(groups)).alias("flow_group"), "flow", *kept, *numbers, packet_marks().cast("bigint").alias("marks"))
    processor = FlowGroupProcessor(int(round(window_s * 1_000_000)), late, int(idle_ttl_s * 1000) if idle_ttl_s else None, delay_s is not None, dropped, short)
    mode = "EventTime" if delay_s is not None else "ProcessingTime" if idle_ttl_s else "None"
    return d.groupBy("flow_group").transformWithStateInPandas(processor, output_schema(), "append", mode)


def late_packets(query: StreamingQuery) -> int:
    """Packets that Spark dropped behind the watermark, over the batches that ``query`` still reports."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])
