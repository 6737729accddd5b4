"""Hand-written edge rows: parsing, decoding, categories, index ties, JSON."""

import math

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.scalar import attack_category, fixed, to_int
from tidewatch.operators import analytics as A
from tidewatch.operators import labels as L
from tidewatch.operators import parse as P
from tidewatch.sources.files import label_table


def _line(fields):
    return ",".join(fields)


BASE = ["20", "6", "64", "10.5"] + ["0"] * 35 + ["BENIGN"]


def test_width_filter_edges(spark):
    lines = [
        _line(BASE[:39]),
        _line(BASE),
        _line(BASE + ["x"]),
        "",
        _line(BASE[:39]) + ",",  # trailing comma -> 40 fields, empty label
    ]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "line_id long, csv_line string")
    widths = {r.line_id: r.width for r in P.split_line(df).select("line_id", F.size("values").alias("width")).collect()}
    assert widths == {0: 39, 1: 40, 2: 41, 3: 1, 4: 40}
    kept = {r.line_id for r in P.valid_width(P.split_line(df)).collect()}
    assert kept == {1, 4}
    summary = P.width_summary(df).first()
    assert (summary.lines, summary.bad_lines, summary.all_good) == (5, 3, False)


def test_numeric_parsing(spark):
    rows = []
    for i, (dbl, cnt) in enumerate([("inf", "0.500000"), ("-inf", "6.9"), ("nan", "1e3"), ("", "x"), ("x", "inf")]):
        f = list(BASE)
        f[0] = dbl
        f[11] = cnt
        rows.append((i, _line(f)))
    df = spark.createDataFrame(rows, "line_id long, csv_line string")
    out = {r.line_id: r for r in P.parse_lines(df, keep=("line_id",)).collect()}
    assert out[0].Header_Length == math.inf and out[0].ack_count == 0
    assert out[1].Header_Length == -math.inf and out[1].ack_count == 6
    assert math.isnan(out[2].Header_Length) and out[2].ack_count == 1000
    assert out[3].Header_Length is None and out[3].ack_count is None
    assert out[4].Header_Length is None and out[4].ack_count is None
    assert out[0].Rate == "10.5" and out[0].rate_value == 10.5
    wide = P.parse_lines(df, keep=("line_id",), wide_counts=True).filter("line_id = 0").first()
    assert wide.ack_count == 0.5


def test_to_int_truncates(spark):
    df = spark.createDataFrame([("0.500000",), ("6.9",), ("-6.9",), ("inf",), ("99999999999",)], "s string")
    assert [r[0] for r in df.select(to_int("s")).collect()] == [0, 6, -6, None, None]


def test_decode_label(spark):
    labels = label_table(spark)
    df = spark.createDataFrame([(1, 10.0), (2, 10.7), (3, 34.0), (4, None), (5, 0.0)], "id int, p double")
    got = {r.id: r.label for r in A.decode_label(df, labels, "p").collect()}
    assert got == {1: "BENIGN", 2: "BENIGN", 3: "34.0", 4: "Unknown", 5: "DDOS-ICMP_FLOOD"}
    sdf = spark.createDataFrame([(1, "10"), (2, "10.0"), (3, "BENIGN")], "id int, p string")
    got = {r.id: r.label for r in A.decode_label(sdf, labels, "p").collect()}
    assert got == {1: "BENIGN", 2: "10.0", 3: "BENIGN"}


def test_counts_group_after_decoding(spark):
    """10.0 and 10.9 name the same label: counted together."""
    df = spark.createDataFrame([(10.0,), (10.9,), (1.0,)], "predicted_label double")
    got = {r.label: r["count"] for r in A.label_counts(df, label_table(spark)).collect()}
    assert got == {"BENIGN": 2, "DDOS-UDP_FLOOD": 1}


@pytest.mark.parametrize(
    "label,category",
    [
        ("BENIGN", "benign"),
        ("benign", "benign"),
        ("DDOS-X", "ddos"),
        ("DOS-UDP_FLOOD", "dos"),
        ("DNS_SPOOFING", "mitm_spoofing"),
        ("SQLINJECTION", "injection"),
        ("BACKDOOR_MALWARE", "malware"),
        ("BROWSERHIJACKING", "hijacking"),
        ("34.0", "other"),
    ],
)
def test_attack_category(spark, label, category):
    df = spark.createDataFrame([(label,)], "l string")
    assert df.select(attack_category("l")).first()[0] == category


def test_index_ties_alphabetical(spark):
    df = spark.createDataFrame([(x,) for x in "babcb"] + [("a",)], "Label string")
    got = {r.label: r.idx for r in L.label_index(df).collect()}
    assert got == {"b": 0, "a": 1, "c": 2}


def test_index_matches_string_indexer(spark):
    from tidewatch.operators.ml import fit_label_indexer

    df = spark.createDataFrame([(x,) for x in "bacbabd"], "Label string")
    rel = [r.label for r in L.label_index(df).orderBy("idx").collect()]
    assert rel == list(fit_label_indexer(df).labels)


def test_summary_attack_rate(spark):
    df = spark.createDataFrame([(10.0,), (1.0,), (2.0,)], "predicted_label double")
    s = A.traffic_summary(df, label_table(spark)).first()
    assert (s.total, s.benign, s.attack, s.attack_rate_text) == (3, 1, 2, "66.7%")
    empty = spark.createDataFrame([], "predicted_label double")
    e = A.traffic_summary(empty, label_table(spark)).first()
    assert e.total == 0 and e.attack_rate is None


def test_topk_remainder(spark):
    rows = [(float(i),) for i in range(20) for _ in range(20 - i)]
    df = spark.createDataFrame(rows, "predicted_label double")
    r = A.topk_remainder(df, label_table(spark), k=15).first()
    assert (r.more_labels, r.more_count) == (5, 5 + 4 + 3 + 2 + 1)


def test_prediction_json_round_trip(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-01-01 00:00:01.5' AS kafka_timestamp, CAST(NULL AS STRING) AS Label, "
        "10.0 AS prediction, 'inf' AS Rate, 20.0 AS Header_Length, 6 AS `Protocol Type`"
    )
    enc = P.encode_predictions(df, F.col("kafka_timestamp"))
    value = enc.first().value
    assert '"actual_label"' not in value  # NULLs omitted
    bad = spark.createDataFrame([("not json",), ('{"predicted_label": 3.0}',)], "value string")
    both = enc.unionByName(bad)
    got = P.read_predictions(both, schema=P.predictions_ntz_schema()).collect()
    assert len(got) == 2
    assert sorted(r.predicted_label for r in got) == [3.0, 10.0]


def test_fixed_matches_python(spark):
    vals = [5741.4489335, 1 / 128, 3 / 128, 0.1234565, 2.5e-7, 66.65, 0.05, 1e16 + 2, 123.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(fixed("v", 6)).collect()]
    assert got == ["%.6f" % v for v in vals]
    got1 = [r[0] for r in df.select(fixed("v", 1)).collect()]
    assert got1 == ["%.1f" % v for v in vals]
