"""Flow features: edge rows, an independent row-by-row model, plan shape."""

import math
import statistics

from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.operators import flows as FL
from tidewatch.plans.strategy import count_nodes

SCHEMA = (
    "packet_id long, ts_us long, src_ip string, dst_ip string, src_port int, dst_port int, "
    "proto int, ihl int, ttl int, flags int, length int"
)


def pk(i, t_s, src="10.0.0.1", dst="10.0.0.2", sp=1000, dp=80, proto=6, flags=0x10, length=100):
    return (i, int(round(t_s * 1e6)), src, dst, sp, dp, proto, 5, 64, flags, length)


def run(spark, rows, w=60, parts=4):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.packet_id: r for r in FL.flow_features(df, w, parts).collect()}


def test_single_packet_no_output(spark):
    assert run(spark, [pk(1, 0.0)]) == {}


def test_gap_of_exactly_w_drops_first(spark):
    assert run(spark, [pk(1, 0.0), pk(2, 60.0)]) == {}
    out = run(spark, [pk(1, 0.0), pk(2, 59.999999)])
    assert list(out) == [2] and out[2].Number == 2 and out[2].Variance == 0.0


def test_bidirectional_one_key_and_string_order(spark):
    rows = [pk(1, 0, src="10.0.0.9", dst="10.0.0.10", sp=5, dp=6), pk(2, 1, src="10.0.0.10", dst="10.0.0.9", sp=6, dp=5)]
    out = run(spark, rows)
    assert out[2].flow == "10.0.0.10:6-10.0.0.9:5-6"


def test_icmp_ports_zero_and_non_ip_dropped(spark):
    rows = [pk(1, 0, proto=1, sp=7, dp=8), pk(2, 1, proto=1, sp=9, dp=10), (3, 2_000_000, None, None, 1, 2, 6, 5, 64, 0, 60)]
    out = run(spark, rows)
    assert list(out) == [2] and out[2].flow == "10.0.0.1:0-10.0.0.2:0-1" and out[2].ICMP == 1


def model(rows, w_s):
    """Row-by-row reference model of the per-packet record (numbers only)."""
    flows, out = {}, {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        pid, ts, src, dst, sp, dp, proto, ihl, ttl, flags, length = r
        if proto not in (6, 17):
            sp = dp = 0
        key = f"{src}:{sp}-{dst}:{dp}-{proto}" if (src, sp) < (dst, dp) else f"{dst}:{dp}-{src}:{sp}-{proto}"
        f = flows.setdefault(key, {"t": [], "b": [], "ack": 0, "first": ts})
        f["t"].append(ts)
        f["b"].append(length)
        if proto == 6 and flags & 0x10:
            f["ack"] += 1
        keep = [i for i, t in enumerate(f["t"]) if t > ts - w_s * 1_000_000]
        f["t"] = [f["t"][i] for i in keep]
        f["b"] = [f["b"][i] for i in keep]
        n = len(f["t"])
        if n < 2:
            continue
        iats = [(f["t"][i] - f["t"][i - 1]) / 1e6 for i in range(1, n)]
        out[pid] = dict(
            Number=n,
            Tot_sum=sum(f["b"]),
            Min=min(f["b"]),
            Max=max(f["b"]),
            Std=statistics.stdev(f["b"]),
            IAT=statistics.mean(iats),
            Variance=statistics.pvariance(iats) if len(iats) > 1 else 0.0,
            ack_count=f["ack"] / n,
            Rate=n / max((ts - f["first"]) / 1e6, 1),
        )
    return out


packets_strategy = st.lists(
    st.tuples(
        st.integers(0, 2),  # flow choice
        st.integers(0, 400),  # seconds
        st.integers(40, 1500),
        st.integers(0, 255),
    ),
    min_size=2,
    max_size=60,
    unique_by=lambda t: (t[0], t[1]),
)


@settings(max_examples=4, deadline=None)
@given(packets_strategy)
def test_matches_row_model(spark, items):
    rows = []
    for i, (fl, t, length, flags) in enumerate(items):
        rows.append(pk(i, t + fl * 0.001, src=f"10.0.0.{fl + 1}", dst="10.0.1.1", sp=2000 + fl, length=length, flags=flags))
    got = run(spark, rows, w=60, parts=2)
    want = model(rows, 60)
    assert set(got) == set(want)
    for pid, exp in want.items():
        g = got[pid]
        for key, v in exp.items():
            assert math.isclose(getattr(g, key), v, rel_tol=1e-9, abs_tol=1e-6), (pid, key, getattr(g, key), v)


def check(got, want):
    assert set(got) == set(want)
    for pid, exp in want.items():
        for key, v in exp.items():
            assert math.isclose(getattr(got[pid], key), v, rel_tol=1e-9, abs_tol=1e-6), (pid, key, getattr(got[pid], key), v)


ties_strategy = st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0, 1, 59, 60, 61, 119, 120, 180, 400]), st.integers(40, 1500), st.integers(0, 255)), min_size=2, max_size=40)


@settings(max_examples=4, deadline=None)
@given(ties_strategy, st.randoms(use_true_random=False), st.sampled_from([1, 3, 9]))
def test_equal_times_have_one_result_in_any_input_order(spark, items, rng, parts):
    rows = [pk(i, t, src=f"10.0.0.{fl + 1}", sp=2000 + fl, length=length, flags=flags) for i, (fl, t, length, flags) in enumerate(items)]
    want = model(rows, 60)
    mixed = rows[:]
    rng.shuffle(mixed)
    check(run(spark, mixed, 60, parts), want)


def test_three_packets_of_one_microsecond(spark):
    rows = [pk(i, 5.0, length=n) for i, n in ((1, 100), (2, 200), (3, 300))]
    for mixed in (rows, rows[::-1], [rows[1], rows[2], rows[0]]):
        out = run(spark, mixed)
        assert {i: (r.Number, r.Tot_sum, r.Min, r.Max, r.ack_flag_number) for i, r in out.items()} == {2: (2, 300, 100, 200, 2), 3: (3, 600, 100, 300, 3)}


def flood(spark, n):
    """One flow, all packets inside one window, many of them at equal times."""
    cols = ["id AS packet_id", "id div 3 AS ts_us", "'10.0.0.1' AS src_ip", "'10.0.0.2' AS dst_ip", "1000 AS src_port", "80 AS dst_port", "6 AS proto", "5 AS ihl", "64 AS ttl"]
    return spark.range(n).selectExpr(*cols, "CAST(id % 64 AS INT) AS flags", "CAST(40 + id * 7919 % 1461 AS INT) AS length")


def test_one_hot_flow_is_spread_over_the_partitions(spark):
    n, parts = 60_000, 16
    sizes = [r["count"] for r in FL._scanned(FL.flow_events(flood(spark, n), 60_000_000), 60_000_000, parts).groupBy("part").count().collect()]
    assert len(sizes) == parts and max(sizes) < 3 * statistics.median(sizes)
    sums = "sum(Number), sum(Tot_sum), sum(Min), sum(Max), sum(syn_flag_number), sum(CAST(Variance * 1e15 AS DECIMAL(38,0))), count(1)"
    spread = FL.flow_features(flood(spark, n), 60, parts).selectExpr(sums.split(", ")[0], *sums.split(", ")[1:]).first()
    assert spread == FL.flow_features(flood(spark, n), 60, 1).selectExpr(sums.split(", ")[0], *sums.split(", ")[1:]).first()
    assert spread[0] == n * (n + 1) // 2 - 1 and spread[6] == n - 1


def test_partitions_are_scanned_without_further_shuffles(spark):
    df = spark.createDataFrame([pk(1, 0.0), pk(2, 1.0)], SCHEMA)
    plan = FL._scanned(FL.flow_events(df, 60_000_000), 60_000_000, 4)
    # one to deal the events by range, one to name the partitions; every window works inside them
    assert count_nodes(plan, "Exchange") == 2
    features = FL.flow_features(df, 60)
    assert count_nodes(features, "Exchange") == 0 and count_nodes(features, "BroadcastExchange") == 1
    for p in (plan, features):
        assert count_nodes(p, "BatchEvalPython") == 0
        assert count_nodes(p, "ArrowEvalPython") == 0


@settings(max_examples=3, deadline=None)
@given(packets_strategy)
def test_encode_then_parse_is_identity(spark, items):
    """Wire line of a flow record parses back to the record (floats to %.6f,
    the four ratio fields truncated to int as the serving cast does)."""
    from pyspark.sql import functions as F

    from tidewatch.operators.parse import parse_lines
    from tidewatch.schema import TRAFFIC_FIELDS

    rows = [pk(i, t + fl * 0.001, src=f"10.0.0.{fl + 1}", dst="10.0.1.1", length=ln, flags=fg)
            for i, (fl, t, ln, fg) in enumerate(items)]
    feats = FL.flow_features(spark.createDataFrame(rows, SCHEMA), 60, 2)
    enc = FL.encode_traffic(feats)
    back = {r.packet_id: r for r in parse_lines(enc, keep=("packet_id",)).collect()}
    orig = {r.packet_id: r for r in feats.collect()}
    assert set(back) == set(orig)
    for pid, o in orig.items():
        b = back[pid]
        for (wire, kind), prod in zip(TRAFFIC_FIELDS, FL.FLOW_FEATURE_NAMES):
            ov, bv = getattr(o, prod), b[wire]
            if kind == "string":
                if wire == "Rate":
                    assert bv == "%.6f" % ov
                else:
                    assert bv == ov
            elif kind == "int":
                assert bv == int(ov)
            else:
                assert abs(bv - float("%.6f" % ov)) < 1e-9
