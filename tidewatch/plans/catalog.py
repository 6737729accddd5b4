"""Registered queries and their DuckDB oracles.

``QUERIES[name](spark, sf_dir)`` builds the Spark DataFrame; ``ORACLES[name]``
is independent SQL over the driver's tables (DuckDB views). Every query reads
the whole driver tables (through the derived views in ``sources.fixtures``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import traffic_status
from ..operators import analytics as A
from ..sources import fixtures as FX
from ..sources.files import label_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def with_views(*names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({FX.DUCKDB_VIEWS[n]})" for n in names) + "\n"


# Oracle fragments ---------------------------------------------------------

DECODED_SQL = with_views("predictions", "label_map") + """,
decoded AS (
  SELECT p.*, coalesce(m.label, CAST(p.predicted_label AS VARCHAR), 'Unknown') AS label
  FROM predictions p LEFT JOIN label_map m ON m.idx = TRY_CAST(trunc(p.predicted_label) AS BIGINT)
),
counts AS (SELECT label, count(*) AS count FROM decoded GROUP BY label),
ranked AS (SELECT *, row_number() OVER (ORDER BY count DESC, label ASC) AS rank FROM counts)
"""


def _category_sql(col: str) -> str:
    from ..schema import BENIGN, BENIGN_CATEGORY, CATEGORY_RULES, OTHER_CATEGORY

    parts = [f"WHEN upper({col}) = '{BENIGN}' THEN '{BENIGN_CATEGORY[0]}'"]
    for name, _colour, words in CATEGORY_RULES:
        cond = " OR ".join(f"contains(upper({col}), '{w}')" for w in words)
        parts.append(f"WHEN {cond} THEN '{name}'")
    return "CASE " + " ".join(parts) + f" ELSE '{OTHER_CATEGORY[0]}' END"


def _colour_sql(col: str) -> str:
    from ..schema import BENIGN, BENIGN_CATEGORY, CATEGORY_RULES, OTHER_CATEGORY

    parts = [f"WHEN upper({col}) = '{BENIGN}' THEN '{BENIGN_CATEGORY[1]}'"]
    for _name, colour, words in CATEGORY_RULES:
        cond = " OR ".join(f"contains(upper({col}), '{w}')" for w in words)
        parts.append(f"WHEN {cond} THEN '{colour}'")
    return "CASE " + " ".join(parts) + f" ELSE '{OTHER_CATEGORY[1]}' END"


# Analytics over predictions (JN1, AG5-AG9, TK1-TK4, SC1-SC2) -------------


@register(
    "decode_label",
    DECODED_SQL + "SELECT pred_id, predicted_label, label FROM decoded",
)
def q_decode_label(spark, sf):
    p = FX.predictions(spark, sf).select("pred_id", "predicted_label")
    return A.decode_label(p, label_table(spark))


@register("label_counts", DECODED_SQL + "SELECT label, count FROM counts")
def q_label_counts(spark, sf):
    return A.label_counts(FX.predictions(spark, sf), label_table(spark))


@register(
    "top_labels",
    DECODED_SQL
    + f"""SELECT rank, label, count, {_category_sql('label')} AS category, {_colour_sql('label')} AS colour,
  max(count) OVER () AS axis_max FROM ranked WHERE rank <= 15""",
)
def q_top_labels(spark, sf):
    return A.top_labels(FX.predictions(spark, sf), label_table(spark), k=15)


@register(
    "topk_remainder",
    DECODED_SQL
    + """SELECT CAST(count(*) FILTER (WHERE rank > 15) AS BIGINT) AS more_labels,
  CAST(coalesce(sum(count) FILTER (WHERE rank > 15), 0) AS BIGINT) AS more_count FROM ranked""",
)
def q_topk_remainder(spark, sf):
    return A.topk_remainder(FX.predictions(spark, sf), label_table(spark), k=15)


@register(
    "traffic_summary",
    DECODED_SQL
    + """SELECT total, benign, total - benign AS attack,
  CAST(total - benign AS DOUBLE) / CAST(nullif(total, 0) AS DOUBLE) * 100.0 AS attack_rate,
  printf('%.1f', CAST(total - benign AS DOUBLE) / CAST(nullif(total, 0) AS DOUBLE) * 100.0) || '%' AS attack_rate_text
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE upper(label) = 'BENIGN') AS benign FROM decoded) s""",
)
def q_traffic_summary(spark, sf):
    return A.traffic_summary(FX.predictions(spark, sf), label_table(spark))


@register(
    "last_n",
    with_views("predictions")
    + "SELECT * FROM predictions ORDER BY prediction_timestamp DESC, pred_id DESC LIMIT 1000",
)
def q_last_n(spark, sf):
    return A.last_n(FX.predictions(spark, sf), 1000)


@register(
    "recent",
    with_views("predictions", "label_map")
    + """, newest AS (SELECT * FROM predictions ORDER BY prediction_timestamp DESC, pred_id DESC LIMIT 10),
dec AS (
  SELECT n.*, coalesce(m.label, CAST(n.predicted_label AS VARCHAR), 'Unknown') AS predicted_name,
    coalesce(a.label, n.actual_label, 'Unknown') AS actual_name
  FROM newest n
  LEFT JOIN label_map m ON m.idx = TRY_CAST(trunc(n.predicted_label) AS BIGINT)
  LEFT JOIN label_map a ON CAST(a.idx AS VARCHAR) = n.actual_label
)
SELECT row_number() OVER (ORDER BY prediction_timestamp DESC, pred_id DESC) AS position, pred_id,
  predicted_name, actual_name, coalesce(rate, 'Unknown') AS rate,
  coalesce(CAST(protocol_type AS VARCHAR), 'Unknown') AS protocol_type,
  coalesce(strftime(prediction_timestamp, '%Y-%m-%d %H:%M:%S.%f'), 'Unknown') AS prediction_time,
  CASE WHEN upper(predicted_name) = 'BENIGN' THEN 'benign' ELSE 'attack' END AS status,
  """
    + _colour_sql("predicted_name")
    + " AS colour FROM dec",
)
def q_recent(spark, sf):
    out = A.recent(FX.predictions(spark, sf), label_table(spark), 10)
    # fixed-width microsecond text, identical in both engines
    return out.withColumn(
        "prediction_time",
        F.when(F.col("prediction_time") == "Unknown", F.col("prediction_time")).otherwise(
            F.date_format(F.col("prediction_time").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        ),
    )


@register(
    "attack_category",
    DECODED_SQL
    + f"""SELECT pred_id, label, {_category_sql('label')} AS category, {_colour_sql('label')} AS colour,
  CASE WHEN upper(label) = 'BENIGN' THEN 'benign' ELSE 'attack' END AS status FROM decoded""",
)
def q_attack_category(spark, sf):
    p = FX.predictions(spark, sf).select("pred_id", "predicted_label")
    return A.categorize(p, label_table(spark)).select("pred_id", "label", "category", "colour", "status")


@register(
    "category_counts",
    DECODED_SQL + f"SELECT {_category_sql('label')} AS category, count(*) AS count FROM decoded GROUP BY 1",
)
def q_category_counts(spark, sf):
    return A.category_counts(FX.predictions(spark, sf), label_table(spark))


@register(
    "traffic_status",
    DECODED_SQL
    + """SELECT CASE WHEN upper(label) = 'BENIGN' THEN 'benign' ELSE 'attack' END AS status, count(*) AS count
FROM decoded GROUP BY 1""",
)
def q_traffic_status(spark, sf):
    dec = A.decode_label(FX.predictions(spark, sf).select("predicted_label"), label_table(spark))
    return dec.groupBy(traffic_status("label").alias("status")).agg(F.count(F.lit(1)).alias("count"))


# Parsing and validation over traffic lines (PRJ1-3, FLT1-2, FLT5, SC3, SC6, SC9) ----

from ..operators import labels as L  # noqa: E402
from ..operators import parse as P  # noqa: E402
from ..schema import TRAFFIC_FIELDS  # noqa: E402


def _duck_parsed_columns() -> str:
    out = []
    for i, (name, kind) in enumerate(TRAFFIC_FIELDS, start=1):
        item = f"v[{i}]"
        if kind == "double":
            expr = f"TRY_CAST({item} AS DOUBLE)"
        elif kind == "int":
            expr = f"TRY_CAST(trunc(TRY_CAST({item} AS DOUBLE)) AS INTEGER)"
        else:
            expr = item
        out.append(f'{expr} AS "{name}"')
    out.append("TRY_CAST(v[4] AS DOUBLE) AS rate_value")
    return ",\n  ".join(out)


PARSED_SQL = with_views("traffic_lines") + f""",
split_lines AS (SELECT line_id, csv_line, string_split(csv_line, ',') AS v FROM traffic_lines),
valid AS (SELECT * FROM split_lines WHERE len(v) = 40 AND v[1] IS NOT NULL),
parsed AS (SELECT line_id,
  {_duck_parsed_columns()}
  FROM valid)
"""


def _parsed(spark, sf):
    return P.parse_lines(FX.traffic_lines(spark, sf), keep=("line_id",))


@register(
    "split_width",
    PARSED_SQL
    + """SELECT line_id, CAST(len(v) AS INTEGER) AS width, v[1] AS first_field, v[len(v)] AS last_field
FROM split_lines""",
)
def q_split_width(spark, sf):
    df = P.split_line(FX.traffic_lines(spark, sf))
    return df.select(
        "line_id",
        P.width().alias("width"),
        F.get(F.col("values"), 0).alias("first_field"),
        F.element_at("values", -1).alias("last_field"),
    )


@register("valid_width", PARSED_SQL + "SELECT line_id, csv_line FROM valid")
def q_valid_width(spark, sf):
    return P.valid_width(P.split_line(FX.traffic_lines(spark, sf))).select("line_id", "csv_line")


@register(
    "check_width",
    PARSED_SQL + "SELECT line_id, csv_line, CAST(len(v) AS INTEGER) AS width FROM split_lines WHERE len(v) <> 40",
)
def q_check_width(spark, sf):
    return P.check_width(FX.traffic_lines(spark, sf)).select("line_id", "csv_line", "width")


@register(
    "width_summary",
    PARSED_SQL
    + """SELECT count(*) AS lines, count(*) FILTER (WHERE len(v) <> 40) AS bad_lines,
  count(*) FILTER (WHERE len(v) <> 40) = 0 AS all_good FROM split_lines""",
)
def q_width_summary(spark, sf):
    return P.width_summary(FX.traffic_lines(spark, sf))


@register("parse_traffic", PARSED_SQL + "SELECT * FROM parsed")
def q_parse_traffic(spark, sf):
    return _parsed(spark, sf)


def _feature_names() -> list[str]:
    return [n for n, k in TRAFFIC_FIELDS if k != "string"]


def _duck_complete_cond() -> str:
    conds = ['TRY_CAST("Rate" AS DOUBLE) IS NOT NULL AND NOT isnan(TRY_CAST("Rate" AS DOUBLE))']
    for n, k in TRAFFIC_FIELDS:
        if k == "double":
            conds.append(f'"{n}" IS NOT NULL AND NOT isnan("{n}")')
        elif k == "int":
            conds.append(f'"{n}" IS NOT NULL')
    return " AND ".join(conds)


@register(
    "complete_rows",
    PARSED_SQL + f'SELECT line_id, "Label", rate_value FROM parsed WHERE {_duck_complete_cond()}',
)
def q_complete_rows(spark, sf):
    parsed = P.parse_lines(FX.traffic_lines(spark, sf), keep=("line_id",), complete=True)
    return parsed.select("line_id", "Label", "rate_value")


@register(
    "decode_topic",
    with_views("traffic_lines")
    + """SELECT TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(line_id) AS kafka_timestamp,
  csv_line FROM traffic_lines""",
)
def q_decode_topic(spark, sf):
    lines = FX.traffic_lines(spark, sf)
    topic_rows = lines.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode("csv_line", "UTF-8").alias("value"),
        F.lit("network-traffic").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("line_id").alias("offset"),
        F.timestamp_add("MICROSECOND", F.col("line_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias(
            "timestamp"
        ),
    )
    return P.decode_topic(topic_rows)


# Label dictionary (AG2-AG4, ML1, ML12, SC7) -------------------------------

LABEL_INDEX_SQL = PARSED_SQL + """,
label_index AS (
  SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, "Label" ASC) - 1 AS BIGINT) AS idx,
    "Label" AS label, count(*) AS count
  FROM parsed WHERE "Label" IS NOT NULL GROUP BY "Label")
"""


@register("distinct_labels", PARSED_SQL + 'SELECT DISTINCT "Label" AS label FROM parsed')
def q_distinct_labels(spark, sf):
    return L.distinct_labels(_parsed(spark, sf))


@register("label_index", LABEL_INDEX_SQL + "SELECT idx, label, count FROM label_index")
def q_label_index(spark, sf):
    return L.label_index(_parsed(spark, sf))


@register(
    "label_dictionary",
    LABEL_INDEX_SQL
    + """SELECT idx, label, idx AS back_index, (SELECT count(*) FROM label_index) AS total_labels,
  'Label' AS label_column FROM label_index""",
)
def q_label_dictionary(spark, sf):
    return L.explode_dictionary(L.label_dictionary(_parsed(spark, sf)))


@register(
    "index_to_label",
    LABEL_INDEX_SQL
    + """SELECT p.line_id, CAST(i.idx AS DOUBLE) AS label_indexed, i.label AS label_name
FROM parsed p JOIN label_index i ON p."Label" = i.label""",
)
def q_index_to_label(spark, sf):
    """Index the label with a fitted indexer, then map indices back to names."""
    from ..operators import ml as M

    parsed = _parsed(spark, sf)
    model = M.fit_label_indexer(parsed)
    indexed = model.transform(parsed)
    return M.index_to_string(indexed, model, "label_indexed", "label_name").select(
        "line_id", "label_indexed", "label_name"
    )


# Flow features over packets (FL1-FL16, PRJ4) --------------------------------

from ..operators import flows as FL  # noqa: E402
from ..schema import TCP_FLAG_BITS as _FLAG_BITS  # noqa: E402

FLOW_WINDOW_S = 86_400  # the driver's events are sparse: a day-long window
_W_US = FLOW_WINDOW_S * 1_000_000
_P40 = 1099511627776


def _duck_exact(x: str) -> str:
    return f"(CAST(({x}) - ({x}) % {_P40} AS DOUBLE) + CAST(({x}) % {_P40} AS DOUBLE))"


def _flow_oracle() -> str:
    flag_cols = ",\n    ".join(
        f"CASE WHEN proto = 6 AND (flags & {bit}) <> 0 THEN 1 ELSE 0 END AS f_{name}" for name, bit in _FLAG_BITS
    )
    app = """CASE
      WHEN proto = 6 AND (dst_port = 80 OR src_port = 80) THEN 'HTTP'
      WHEN proto = 6 AND (dst_port = 443 OR src_port = 443) THEN 'HTTPS'
      WHEN proto = 6 AND (dst_port = 53 OR src_port = 53) THEN 'DNS'
      WHEN proto = 6 AND (dst_port = 23 OR src_port = 23) THEN 'Telnet'
      WHEN proto = 6 AND (dst_port = 25 OR src_port = 25) THEN 'SMTP'
      WHEN proto = 6 AND (dst_port = 22 OR src_port = 22) THEN 'SSH'
      WHEN proto = 6 AND (dst_port = 194 OR src_port = 194) THEN 'IRC'
      WHEN proto = 17 AND (dst_port = 53 OR src_port = 53) THEN 'DNS'
      WHEN proto = 17 AND (dst_port IN (67, 68) OR src_port IN (67, 68)) THEN 'DHCP' END"""
    counters = [f"f_{n}" for n, _ in _FLAG_BITS] + [f"p_{n}" for n in FL.PROTOCOL_FLAGS]
    cum = ",\n    ".join(f"sum({c}) OVER cum AS {c}" for c in counters)
    apps = ", ".join(
        f"CASE WHEN app = '{a}' THEN 1 ELSE 0 END AS p_{a}"
        for a in ["HTTP", "HTTPS", "DNS", "Telnet", "SMTP", "SSH", "IRC", "DHCP"]
    )
    return with_views("packets") + f""",
ported AS (
  SELECT *, CASE WHEN proto IN (6, 17) THEN src_port ELSE 0 END AS sp,
    CASE WHEN proto IN (6, 17) THEN dst_port ELSE 0 END AS dp
  FROM packets WHERE src_ip IS NOT NULL AND dst_ip IS NOT NULL),
keyed AS (
  SELECT *,
    CASE WHEN src_ip < dst_ip OR (src_ip = dst_ip AND sp < dp)
      THEN src_ip || ':' || CAST(sp AS VARCHAR) || '-' || dst_ip || ':' || CAST(dp AS VARCHAR) || '-' || CAST(proto AS VARCHAR)
      ELSE dst_ip || ':' || CAST(dp AS VARCHAR) || '-' || src_ip || ':' || CAST(sp AS VARCHAR) || '-' || CAST(proto AS VARCHAR)
    END AS flow,
    {flag_cols},
    CASE WHEN proto = 6 THEN 1 ELSE 0 END AS p_TCP, CASE WHEN proto = 17 THEN 1 ELSE 0 END AS p_UDP,
    CASE WHEN proto = 1 THEN 1 ELSE 0 END AS p_ICMP, 0 AS p_ARP,
    {app} AS app
  FROM ported),
ind AS (SELECT *, {apps} FROM keyed),
lagged AS (SELECT *, ts_us - lag(ts_us) OVER (PARTITION BY flow ORDER BY ts_us) AS iat FROM ind),
stats AS (
  SELECT flow, packet_id, ts_us, ihl, proto, ttl,
    count(*) OVER win AS n,
    CAST(sum(length) OVER win AS BIGINT) AS len_sum,
    CAST(sum(CAST(length AS BIGINT) * length) OVER win AS BIGINT) AS len_sq,
    min(length) OVER win AS len_min, max(length) OVER win AS len_max,
    min(ts_us) OVER win AS win_start,
    coalesce(sum(CAST(iat AS HUGEINT) * iat) OVER win, 0)
      - coalesce(CAST(first_value(iat) OVER win AS HUGEINT) * first_value(iat) OVER win, 0) AS iat_sq,
    min(ts_us) OVER (PARTITION BY flow) AS first_us,
    {cum}
  FROM lagged
  WINDOW win AS (PARTITION BY flow ORDER BY ts_us RANGE BETWEEN {_W_US - 1} PRECEDING AND CURRENT ROW),
         cum AS (PARTITION BY flow ORDER BY ts_us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
emitted AS (SELECT *, n - 1 AS m,
    CAST(n AS HUGEINT) * len_sq - CAST(len_sum AS HUGEINT) * len_sum AS len_num,
    CAST(n - 1 AS HUGEINT) * iat_sq - CAST(ts_us - win_start AS HUGEINT) * (ts_us - win_start) AS iat_num
  FROM stats WHERE n >= 2),
flow_features AS (
  SELECT flow, packet_id, ts_us,
    CAST(ihl * 4 AS INTEGER) AS Header_Length, CAST(proto AS INTEGER) AS Protocol_Type,
    CAST(ttl AS INTEGER) AS Time_To_Live,
    CAST(n AS DOUBLE) / greatest(CAST(ts_us - first_us AS DOUBLE) / 1e6, 1.0) AS Rate,
    CAST(f_FIN AS INTEGER) AS fin_flag_number, CAST(f_SYN AS INTEGER) AS syn_flag_number,
    CAST(f_RST AS INTEGER) AS rst_flag_number, CAST(f_PSH AS INTEGER) AS psh_flag_number,
    CAST(f_ACK AS INTEGER) AS ack_flag_number, CAST(f_ECE AS INTEGER) AS ece_flag_number,
    CAST(f_CWR AS INTEGER) AS cwr_flag_number,
    CAST(f_ACK AS DOUBLE) / CAST(n AS DOUBLE) AS ack_count, CAST(f_SYN AS DOUBLE) / CAST(n AS DOUBLE) AS syn_count,
    CAST(f_FIN AS DOUBLE) / CAST(n AS DOUBLE) AS fin_count, CAST(f_RST AS DOUBLE) / CAST(n AS DOUBLE) AS rst_count,
    CAST(p_HTTP > 0 AS INTEGER) AS HTTP, CAST(p_HTTPS > 0 AS INTEGER) AS HTTPS, CAST(p_DNS > 0 AS INTEGER) AS DNS,
    CAST(p_Telnet > 0 AS INTEGER) AS Telnet, CAST(p_SMTP > 0 AS INTEGER) AS SMTP, CAST(p_SSH > 0 AS INTEGER) AS SSH,
    CAST(p_IRC > 0 AS INTEGER) AS IRC, CAST(p_TCP > 0 AS INTEGER) AS TCP, CAST(p_UDP > 0 AS INTEGER) AS UDP,
    CAST(p_DHCP > 0 AS INTEGER) AS DHCP, CAST(p_ARP > 0 AS INTEGER) AS ARP, CAST(p_ICMP > 0 AS INTEGER) AS ICMP,
    0 AS IGMP, 1 AS IPv, 0 AS LLC,
    len_sum AS Tot_sum, CAST(len_min AS INTEGER) AS Min, CAST(len_max AS INTEGER) AS Max,
    CAST(len_sum AS DOUBLE) / CAST(n AS DOUBLE) AS AVG,
    sqrt({_duck_exact('len_num')} / (CAST(n AS DOUBLE) * CAST(m AS DOUBLE))) AS Std,
    len_sum AS Tot_size,
    CAST(ts_us - win_start AS DOUBLE) / CAST(m AS DOUBLE) / 1e6 AS IAT,
    CAST(n AS INTEGER) AS Number,
    CASE WHEN m > 1 THEN {_duck_exact('iat_num')} / (CAST(m AS DOUBLE) * CAST(m AS DOUBLE)) / 1e12 ELSE 0.0 END AS Variance,
    'UNKNOWN' AS Label
  FROM emitted)
"""


FLOW_SQL = _flow_oracle()
FLOW_GROUPS: dict[str, list[str]] = {
    "flow_flag_counts": [f"{n.lower()}_flag_number" for n, _ in _FLAG_BITS],
    "flow_protocols": ["HTTP", "HTTPS", "DNS", "Telnet", "SMTP", "SSH", "IRC", "TCP", "UDP", "DHCP", "ARP", "ICMP",
                       "IGMP", "IPv", "LLC"],
    "windowed_packets": ["Number", "Label"],
    "header_features": ["Header_Length", "Protocol_Type", "Time_To_Live"],
    "flow_rate": ["Rate"],
    "flag_ratios": ["ack_count", "syn_count", "fin_count", "rst_count"],
    "byte_stats": ["Tot_sum", "Min", "Max", "AVG", "Std", "Tot_size"],
    "iat_stats": ["IAT", "Variance"],
}


def _flow_features(spark, sf):
    return FL.flow_features(FX.packets(spark, sf), FLOW_WINDOW_S)


def _make_flow_query(cols: list[str]):
    def q(spark, sf):
        return _flow_features(spark, sf).select("flow", "packet_id", "ts_us", *cols)

    return q


for _name, _cols in FLOW_GROUPS.items():
    register(_name, FLOW_SQL + "SELECT flow, packet_id, ts_us, " + ", ".join(_cols) + " FROM flow_features")(
        _make_flow_query(_cols)
    )


@register("flow_features", FLOW_SQL + "SELECT * FROM flow_features")
def q_flow_features(spark, sf):
    return _flow_features(spark, sf)


@register(
    "flow_key",
    FLOW_SQL.split(",\nind AS")[0] + "\nSELECT packet_id, flow FROM keyed",
)
def q_flow_key(spark, sf):
    return FL.flow_key(FX.packets(spark, sf)).select("packet_id", "flow")


@register(
    "tcp_flags",
    FLOW_SQL.split(",\nind AS")[0]
    + "\nSELECT packet_id, "
    + ", ".join(f"f_{n}" for n, _ in _FLAG_BITS)
    + " FROM keyed",
)
def q_tcp_flags(spark, sf):
    return FL.tcp_flags(FX.packets(spark, sf)).select("packet_id", *[f"f_{n}" for n, _ in _FLAG_BITS])


@register(
    "transport",
    FLOW_SQL.split(",\nind AS")[0] + "\nSELECT packet_id, p_TCP, p_UDP, p_ICMP FROM keyed",
)
def q_transport(spark, sf):
    return FL.transport(FX.packets(spark, sf)).select("packet_id", "p_TCP", "p_UDP", "p_ICMP")


@register(
    "app_protocol",
    FLOW_SQL.split(",\nind AS")[0] + "\nSELECT packet_id, app FROM keyed",
)
def q_app_protocol(spark, sf):
    return FL.app_protocol(FX.packets(spark, sf)).select("packet_id", "app")


@register(
    "encode_traffic",
    FLOW_SQL
    + """SELECT flow, packet_id, concat_ws(',',
  CAST(Header_Length AS VARCHAR), CAST(Protocol_Type AS VARCHAR), CAST(Time_To_Live AS VARCHAR), printf('%.6f', Rate),
  CAST(fin_flag_number AS VARCHAR), CAST(syn_flag_number AS VARCHAR), CAST(rst_flag_number AS VARCHAR),
  CAST(psh_flag_number AS VARCHAR), CAST(ack_flag_number AS VARCHAR), CAST(ece_flag_number AS VARCHAR),
  CAST(cwr_flag_number AS VARCHAR),
  printf('%.6f', ack_count), printf('%.6f', syn_count), printf('%.6f', fin_count), printf('%.6f', rst_count),
  CAST(HTTP AS VARCHAR), CAST(HTTPS AS VARCHAR), CAST(DNS AS VARCHAR), CAST(Telnet AS VARCHAR), CAST(SMTP AS VARCHAR),
  CAST(SSH AS VARCHAR), CAST(IRC AS VARCHAR), CAST(TCP AS VARCHAR), CAST(UDP AS VARCHAR), CAST(DHCP AS VARCHAR),
  CAST(ARP AS VARCHAR), CAST(ICMP AS VARCHAR), CAST(IGMP AS VARCHAR), CAST(IPv AS VARCHAR), CAST(LLC AS VARCHAR),
  CAST(Tot_sum AS VARCHAR), CAST(Min AS VARCHAR), CAST(Max AS VARCHAR),
  CASE WHEN Tot_sum % Number = 0 THEN CAST(Tot_sum // Number AS VARCHAR) ELSE printf('%.6f', AVG) END,
  printf('%.6f', Std), CAST(Tot_size AS VARCHAR), printf('%.6f', IAT), CAST(Number AS VARCHAR),
  CASE WHEN Number = 2 THEN '0' ELSE printf('%.6f', Variance) END, Label) AS csv_line
FROM flow_features""",
)
def q_encode_traffic(spark, sf):
    return FL.encode_traffic(_flow_features(spark, sf))


# Prediction envelope and its reader (PRJ5, SRC5, SC8) ------------------------

_ENVELOPE_SQL = """'{' || concat_ws(',',
  '"original_timestamp":"' || strftime(prediction_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '"',
  '"actual_label":"' || actual_label || '"',
  '"predicted_label":' || CAST(predicted_label AS VARCHAR),
  '"rate":"' || rate || '"',
  '"header_length":' || CAST(header_length AS VARCHAR),
  '"protocol_type":' || CAST(protocol_type AS VARCHAR),
  '"prediction_timestamp":"' || strftime(prediction_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '"') || '}'"""


def _scored_rows(spark, sf):
    """Predictions fixture in the scored-traffic column layout."""
    return FX.predictions(spark, sf).select(
        "pred_id",
        F.col("prediction_timestamp").alias("kafka_timestamp"),
        F.col("actual_label").alias("Label"),
        F.col("predicted_label").alias("prediction"),
        F.col("rate").alias("Rate"),
        F.col("header_length").alias("Header_Length"),
        F.col("protocol_type").alias("Protocol Type"),
        "prediction_timestamp",
    )


@register("encode_predictions", with_views("predictions") + f"SELECT pred_id, {_ENVELOPE_SQL} AS value FROM predictions")
def q_encode_predictions(spark, sf):
    rows = _scored_rows(spark, sf)
    return P.encode_predictions(rows, F.col("prediction_timestamp"), keep=("pred_id",))


@register(
    "read_predictions",
    with_views("predictions")
    + """SELECT pred_id, prediction_timestamp AS original_timestamp, actual_label, predicted_label, rate,
  header_length, protocol_type, prediction_timestamp FROM predictions WHERE pred_id % 13 <> 0""",
)
def q_read_predictions(spark, sf):
    enc = P.encode_predictions(_scored_rows(spark, sf), F.col("prediction_timestamp"), keep=("pred_id",))
    # every 13th message arrives damaged: its opening brace lost, text or a second object behind it, or other quotes
    ways = [F.expr("substr(value, 2)"), F.concat("value", F.lit(" tail")), F.concat("value", "value"), F.replace("value", F.lit('"'), F.lit("'"))]
    way = F.pmod(F.floor(F.col("pred_id") / 13), F.lit(4)) + 1
    damaged = enc.withColumn("value", F.when(F.col("pred_id") % 13 == 0, F.element_at(F.array(*ways), way.cast("int"))).otherwise(F.col("value")))
    return P.read_predictions(damaged, schema=P.predictions_ntz_schema())


# Evaluation over scored rows (ML7-ML11) ---------------------------------------

from ..operators import ml as M  # noqa: E402
from ..schema import LABELS as _LABELS  # noqa: E402

_METRICS_SQL = with_views("scored") + """,
conf AS (SELECT label, prediction, count(*) AS count FROM scored GROUP BY label, prediction),
pc AS (SELECT class, sum(n) AS n, sum(tp) AS tp, sum(np) AS np FROM (
    SELECT label AS class, count AS n, CASE WHEN label = prediction THEN count ELSE 0 END AS tp, 0 AS np FROM conf
    UNION ALL SELECT prediction AS class, 0 AS n, 0 AS tp, count AS np FROM conf) u
  GROUP BY class HAVING sum(n) > 0),
t AS (SELECT class, tp, n,
    CAST(n AS DOUBLE) / CAST((SELECT sum(n) FROM pc) AS DOUBLE) AS w,
    CASE WHEN np > 0 THEN CAST(tp AS DOUBLE) / CAST(np AS DOUBLE) ELSE 0.0 END AS p,
    CAST(tp AS DOUBLE) / CAST(n AS DOUBLE) AS r FROM pc),
t2 AS (SELECT *, CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END AS f FROM t),
m AS (SELECT CAST(sum(tp) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS accuracy,
    list_reduce(list(w * p ORDER BY class), lambda a, b: a + b) AS weighted_precision,
    list_reduce(list(w * r ORDER BY class), lambda a, b: a + b) AS weighted_recall,
    list_reduce(list(w * f ORDER BY class), lambda a, b: a + b) AS f1
  FROM t2)
"""


@register(
    "confusion_matrix",
    with_views("scored") + "SELECT label, prediction, count(*) AS count FROM scored GROUP BY label, prediction",
)
def q_confusion_matrix(spark, sf):
    return M.confusion(FX.scored(spark, sf), "label", "prediction")


@register("classification_metrics", _METRICS_SQL + "SELECT * FROM m")
def q_classification_metrics(spark, sf):
    return M.metrics(FX.scored(spark, sf), "label", "prediction")


for _metric in ("accuracy", "weighted_precision", "weighted_recall", "f1"):

    def _q(spark, sf, _m=_metric):
        return M.metrics(FX.scored(spark, sf), "label", "prediction").select(_m)

    register(_metric, _METRICS_SQL + f"SELECT {_metric} FROM m")(_q)


def _mapping_json_sql() -> str:
    body = ",".join(f'"{i}":"{n}"' for i, n in enumerate(_LABELS))
    return "{" + body + "}"


@register(
    "metrics_summary",
    _METRICS_SQL
    + f"""SELECT accuracy, f1 AS f1_score, '{_mapping_json_sql()}' AS label_mapping,
  weighted_precision AS precision, weighted_recall AS recall FROM m""",
)
def q_metrics_summary(spark, sf):
    out = M.metrics_summary(FX.scored(spark, sf), _LABELS, "label", "prediction")
    return out.withColumn("label_mapping", F.to_json("label_mapping"))


# Split, string index, category filter, counts (ML2, ML4, FLT6, AG1) -----------------


@register(
    "hash_split",
    with_views("traffic_lines")
    + "SELECT line_id, ((line_id % 1000003) * 7919) % 100 < 80 AS is_train FROM traffic_lines",
)
def q_hash_split(spark, sf):
    return FX.traffic_lines(spark, sf).select("line_id", M.hash_split("line_id").alias("is_train"))


_RATE_INDEX_SQL = PARSED_SQL + """,
rate_index AS (
  SELECT "Rate", CAST(row_number() OVER (ORDER BY count(*) DESC, "Rate" ASC) - 1 AS DOUBLE) AS "Rate_indexed"
  FROM parsed WHERE "Rate" IS NOT NULL GROUP BY "Rate")
"""


@register("string_index", _RATE_INDEX_SQL + 'SELECT "Rate", "Rate_indexed" FROM rate_index')
def q_string_index(spark, sf):
    return M.category_index(_parsed(spark, sf), "Rate")


@register(
    "category_filter",
    _RATE_INDEX_SQL + 'SELECT p.line_id, p."Rate", r."Rate_indexed" FROM parsed p JOIN rate_index r ON p."Rate" = r."Rate"',
)
def q_category_filter(spark, sf):
    parsed = _parsed(spark, sf).select("line_id", "Rate")
    return parsed.join(M.category_index(parsed, "Rate"), "Rate").select("line_id", "Rate", "Rate_indexed")


@register(
    "rate_class_shares",
    LABEL_INDEX_SQL
    + """, n AS (SELECT "Rate", "Label" AS label, count(*)::DOUBLE AS n FROM parsed WHERE "Rate" IS NOT NULL AND "Label" IS NOT NULL GROUP BY ALL),
total AS (SELECT "Rate", sum(n) AS n FROM n GROUP BY "Rate"),
prior AS (SELECT label, idx, sum(n) / (SELECT sum(n) FROM n) AS p FROM n JOIN label_index USING (label) GROUP BY label, idx)
SELECT t."Rate", prior.label, (coalesce(n.n, 0) + prior.p) / (t.n + 1) AS share
FROM total t CROSS JOIN prior LEFT JOIN n ON n."Rate" = t."Rate" AND n.label = prior.label""",
)
def q_rate_class_shares(spark, sf):
    """The class statistics of every rate, as a model that was saved and loaded gives them to scoring rows."""
    from pyspark.ml.functions import vector_to_array

    from ..operators import categories as C

    parsed = _parsed(spark, sf)
    labels = M.fit_label_indexer(parsed)
    stats = C.ClassStatistics(inputCol="Rate", outputCol="shares", labelCol=M.LABEL_INDEXED, classes=len(labels.labels)).fit(labels.transform(parsed))
    path = work_path(spark, "class-statistics-model")
    stats.write().save(path)
    shares = C.ClassStatisticsModel.load(path).transform(parsed.select("Rate").distinct())
    spread = shares.select("Rate", F.posexplode(vector_to_array("shares")).alias("at", "share"))
    return spread.select("Rate", F.get(F.array(*[F.lit(x) for x in labels.labels]), F.col("at")).alias("label"), "share")


@register("traffic_count", PARSED_SQL + "SELECT count(*) AS count FROM parsed")
def q_traffic_count(spark, sf):
    return _parsed(spark, sf).agg(F.count(F.lit(1)).alias("count"))


# Round trips through files (SRC1-2, SNK1-2, SNK5, SRC6) ---------------------------

from ..session import work_path  # noqa: E402
from ..sources import files as IO  # noqa: E402
from ..sources import line_replay as LR  # noqa: E402
from ..streaming import monitor as S  # noqa: E402


@register("csv_round_trip", PARSED_SQL + "SELECT * FROM parsed")
def q_csv_round_trip(spark, sf):
    """Typed rows written as headered CSV and read back with their schema."""
    parsed = _parsed(spark, sf)
    path = IO.write_timestamped_csv(parsed, work_path(spark, "csv"))
    return IO.read_traffic_csv(spark, path, schema=parsed.schema)


@register("json_round_trip", LABEL_INDEX_SQL + "SELECT idx, label FROM label_index")
def q_json_round_trip(spark, sf):
    """Label dictionary written as one JSON file and loaded as a lookup."""
    path = work_path(spark, "label-mapping")
    IO.write_json(L.label_dictionary(_parsed(spark, sf)), path)
    return IO.read_label_dictionary(spark, path)


@register("replay_lines", with_views("traffic_lines") + "SELECT trim(csv_line) AS value FROM traffic_lines")
def q_replay_lines(spark, sf):
    """A headered line file replayed as one message per data line."""
    path = work_path(spark, "replay")
    IO.write_headered_lines(FX.traffic_lines(spark, sf), "csv_line", path)
    return IO.replay_lines(spark, path)


@register("replay_paced", with_views("traffic_lines") + "SELECT trim(csv_line) AS value FROM traffic_lines")
def q_replay_paced(spark, sf):
    """The same lines as a paced stream, a quarter of them a trigger."""
    lines = FX.traffic_lines(spark, sf)
    path, out, ckpt = (work_path(spark, f"paced-{x}") for x in ("in", "out", "ckpt"))
    IO.write_headered_lines(lines, "csv_line", path)
    q = S.to_files(LR.replay_stream(spark, path, lines.count() // 4 + 1).select("value"), out, ckpt, trigger="0 seconds")
    q.processAllAvailable()
    q.stop()
    return spark.read.schema("value string").parquet(out)


# ML training and scoring, rows-only (ML3, ML5, ML6, ML12, SNK6) ------------------


def _trained_sql(split: str) -> str:
    """Complete rows with their split flag, and the label index of the training rows."""
    return PARSED_SQL + f""",
complete AS (SELECT *, (({split} % 1000003) * 7919) % 100 < 80 AS is_train FROM parsed WHERE {_duck_complete_cond()}),
trained AS (
  SELECT "Label" AS name, CAST(row_number() OVER (ORDER BY count(*) DESC, "Label" ASC) - 1 AS DOUBLE) AS label_indexed
  FROM complete WHERE is_train AND "Label" IS NOT NULL GROUP BY "Label")
"""


def _in_range(trained: M.Trained, prediction: str = "prediction"):
    """Whether a prediction is the index of a learned class."""
    return F.col(prediction).isin([float(i) for i in range(len(trained.labels.labels))])


def _train_and_score(spark, sf) -> tuple[DataFrame, M.Trained]:
    """Fit on the hash-split training rows, save, reload, score the rest.

    The parsed rows are cached once and shared by training and scoring; the
    completeness filter runs above the cache. Predictions are written to the
    shared folder before the cache is released.
    """
    from pyspark import StorageLevel

    parsed = P.parse_lines(FX.traffic_lines(spark, sf), keep=("line_id",)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        rows = P.complete_rows(parsed, M.model_features())
        is_train = M.hash_split("line_id")
        trained = M.train(rows.filter(is_train), persist=False)
        path = work_path(spark, "model")
        trained.save(path)
        reloaded = M.Trained.load(path)
        test = reloaded.labels.transform(rows.filter(~is_train))
        scored = M.predict(reloaded, test, assume_complete=True).select(
            "line_id", "Label", "label_indexed", "prediction", "predicted_label"
        )
        out = work_path(spark, "predictions")
        scored.write.parquet(out)
    finally:
        parsed.unpersist()
    return spark.read.parquet(out), reloaded


@register(
    "train_predict",
    _trained_sql("line_id")
    + """SELECT line_id, "Label", label_indexed, TRUE AS in_range
FROM complete JOIN trained ON "Label" = name WHERE NOT is_train""",
)
def q_train_predict(spark, sf):
    """The held-out rows with their label index; the forest's choice is one of its classes."""
    scored, trained = _train_and_score(spark, sf)
    named = F.element_at(F.array(*[F.lit(x) for x in trained.labels.labels]), F.col("prediction").cast("int") + 1)
    return scored.select("line_id", "Label", "label_indexed", (_in_range(trained) & (F.col("predicted_label") == named)).alias("in_range"))


@register(
    "train_csv",
    _trained_sql('CAST("Number" AS BIGINT)')
    + """SELECT "Label", label_indexed, CAST("Number" AS DOUBLE) AS "Number", rate_value, TRUE AS in_range
FROM complete JOIN trained ON "Label" = name WHERE NOT is_train""",
)
def q_train_csv(spark, sf):
    """Batch training end to end: headered CSV to split to model to metrics to saved JSON."""
    path = work_path(spark, "train-csv")
    names = [n for n, _ in TRAFFIC_FIELDS]
    IO.write_csv(_parsed(spark, sf).select(*[F.col(f"`{n}`") for n in names]), f"{path}/csv")
    rows = M.with_rate_value(IO.read_traffic_csv(spark, f"{path}/csv"))
    is_train = M.hash_split(F.col("Number").cast("bigint"))
    trained = M.train(rows.filter(is_train))
    trained.save(f"{path}/model")
    scored = M.predict(trained, trained.labels.transform(rows.filter(~is_train)))
    scored.select("Label", "label_indexed", "Number", "rate_value", "prediction").write.parquet(f"{path}/scored")
    scored = spark.read.parquet(f"{path}/scored")
    IO.write_json(M.metrics_summary(scored, trained.labels), f"{path}/metrics")
    return scored.select("Label", "label_indexed", "Number", "rate_value", _in_range(trained).alias("in_range"))


@register("model_metrics")
def q_model_metrics(spark, sf):
    """Held-out accuracy / weighted precision / recall / F1 of the forest."""
    return M.metrics(_train_and_score(spark, sf)[0])


# Streaming (ST1-ST4, ST6, FLT4, SRC3 shape) ----------------------------------------


def _stage_traffic_topic(spark, sf) -> str:
    rows = S.topic_rows(FX.traffic_lines(spark, sf), "csv_line", "line_id")
    return S.stage_topic_rows(rows, work_path(spark, "topic-traffic"))


@register("parse_stream", PARSED_SQL + "SELECT * FROM parsed")
def q_parse_stream(spark, sf):
    """Kafka-shaped traffic stream -> typed records, drained with availableNow
    into a Parquet sink (checkpointed), then read back."""
    src = S.read_topic_files(spark, _stage_traffic_topic(spark, sf))
    out, ckpt = work_path(spark, "parse-out"), work_path(spark, "parse-ckpt")
    S.to_files(S.parse_stream(src).drop("kafka_timestamp"), out, ckpt).awaitTermination()
    return spark.read.parquet(out)


@register("summary_stream", DECODED_SQL + "SELECT label, count FROM counts")
def q_summary_stream(spark, sf):
    """Running predictions-per-label over a stream of JSON envelopes."""
    enc = P.encode_predictions(_scored_rows(spark, sf), F.col("prediction_timestamp"), keep=("pred_id",))
    rows = S.topic_rows(enc, "value", "pred_id", topic="network-predictions")
    src = S.read_topic_files(spark, S.stage_topic_rows(rows, work_path(spark, "topic-predictions")))
    out, ckpt = work_path(spark, "summary-out"), work_path(spark, "summary-ckpt")
    with S.state_partitions(spark):
        S.run_summary(S.prediction_summary_stream(src, label_table(spark)), out, ckpt).awaitTermination()
    return S.read_summary(spark, out)


def _prediction_topic(spark, sf, *extra: str) -> DataFrame:
    rows = _scored_rows(spark, sf).withColumns({"source_topic": F.lit("network-traffic"), "source_partition": F.lit(0), "source_offset": F.col("pred_id")})
    enc = P.encode_predictions(rows, F.col("prediction_timestamp"), keep=("pred_id", "prediction_timestamp"), extra=extra)
    return S.topic_rows(enc, "value", "pred_id", "prediction_timestamp", topic="network-predictions")


@register(
    "window_counts_stream",
    DECODED_SQL
    + """SELECT strftime(time_bucket(INTERVAL 1 HOUR, prediction_timestamp), '%Y-%m-%d %H:%M:%S') AS window_start, label, count(*) AS count
FROM decoded WHERE prediction_timestamp IS NOT NULL GROUP BY ALL""",
)
def q_window_counts_stream(spark, sf):
    """Predictions per label and hour of their own time, kept up to date by a stream that is resumed after each quarter of the time."""
    rows = _prediction_topic(spark, sf)
    path, out, ckpt = (work_path(spark, f"windows-{x}") for x in ("in", "out", "ckpt"))
    lo, hi = rows.select(F.unix_micros("timestamp").alias("us")).agg(F.min("us"), F.max("us")).first()
    rows.limit(0).write.parquet(path)
    for i in range(4 if lo is not None else 0):
        part = F.floor((F.unix_micros("timestamp") - lo) * 4 / F.lit(hi - lo + 1))
        rows.where(part == i).write.mode("append").parquet(path)
        counts = S.prediction_windows_stream(S.read_topic_files(spark, path, 100_000), label_table(spark), "1 hour", "10 minutes")
        with S.state_partitions(spark):
            S.run_windows(counts, out, ckpt, keep=2).awaitTermination()
    return S.read_windows(spark, out).select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "label", "count")


@register("published_once", with_views("predictions") + "SELECT pred_id AS source_offset, predicted_label, rate FROM predictions")
def q_published_once(spark, sf):
    """Envelopes of which a third were published again by a repeated batch, read once each."""
    rows = _prediction_topic(spark, sf, *P.ORIGIN_FIELDS)
    path, out, ckpt = (work_path(spark, f"published-{x}") for x in ("in", "out", "ckpt"))
    S.stage_topic_rows(rows.unionByName(rows.where(F.col("offset") % 3 == 0)), path)
    with S.state_partitions(spark):
        S.to_files(S.read_published(S.read_topic_files(spark, path), "100000 days"), out, ckpt).awaitTermination()
    return spark.read.parquet(out).select("source_offset", "predicted_label", "rate")


@register(
    "monitor_stream",
    _trained_sql("line_id")
    + """SELECT line_id, "Label" AS actual_label, "Rate" AS rate, "Header_Length" AS header_length,
  "Protocol Type" AS protocol_type, TRUE AS in_range FROM complete""",
)
def q_monitor_stream(spark, sf):
    """Train once, score the traffic stream, publish JSON envelopes, and read them back."""
    from pyspark import StorageLevel

    parsed = P.parse_lines(FX.traffic_lines(spark, sf), keep=("line_id",)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        rows = P.complete_rows(parsed, M.model_features())
        trained = M.train(rows.filter(M.hash_split("line_id")), persist=False)
    finally:
        parsed.unpersist()
    src = S.read_topic_files(spark, _stage_traffic_topic(spark, sf))
    out = work_path(spark, "monitor-out")
    S.run_for(S.run_monitor(spark, src, trained, trigger=None, out_path=out), None)
    got = P.read_predictions(spark.read.parquet(out))
    return got.select("line_id", "actual_label", "rate", "header_length", "protocol_type", _in_range(trained, "predicted_label").alias("in_range"))


# Stateful streaming flow features (FL15, ST5) -----------------------------------

from ..schema import PACKET_SCHEMA  # noqa: E402
from ..streaming import flow_state as FS  # noqa: E402


@register("flow_features_stream", FLOW_SQL + "SELECT * FROM flow_features")
def q_flow_features_stream(spark, sf):
    """The batch flow records, produced incrementally: packets arrive in four time
    ranges, each written in parallel, and the stream is resumed from its checkpoint after each."""
    packets = FX.packets(spark, sf)
    path, out, ckpt = work_path(spark, "topic-packets"), work_path(spark, "flows-out"), work_path(spark, "flows-ckpt")
    lo, hi = packets.agg(F.min("ts_us"), F.max("ts_us")).first()
    packets.limit(0).write.parquet(path)
    for i in range(4):
        if lo is not None:
            part = F.least(F.floor((F.col("ts_us") - lo) * 4 / F.lit(hi - lo + 1)), F.lit(3))
            packets.filter(part == i).write.mode("append").parquet(path)
        src = spark.readStream.schema(PACKET_SCHEMA).parquet(path)
        with S.state_partitions(spark):
            S.to_files(FS.flow_features_stream(src, FLOW_WINDOW_S), out, ckpt).awaitTermination()
    return spark.read.schema(FS.output_schema()).parquet(out)
