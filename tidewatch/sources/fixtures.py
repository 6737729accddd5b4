"""Network-shaped views derived from the driver's tables.

The driver ships TPC-H-like tables, not traffic captures, so the traffic,
packet, prediction and scored views are derived from ``events`` and
``lineitem`` by integer arithmetic that Spark and DuckDB evaluate the same
way. The SQL text is shared by the Spark side (tables bound as DataFrames
through ``spark.sql(..., events=df)``) and the DuckDB oracle (tables are
views there); only the epoch-microsecond expression differs.

Every view grows with its source table: no sampling, no row caps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import LABELS

SPARK_US = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
DUCKDB_US = "epoch_us(ts)"

PACKETS_SQL = """
SELECT event_id AS packet_id, {us} AS ts_us,
  CASE WHEN event_id % 2 = 0 THEN client_ip ELSE '192.168.0.1' END AS src_ip,
  CASE WHEN event_id % 2 = 0 THEN '192.168.0.1' ELSE client_ip END AS dst_ip,
  CAST(CASE WHEN event_id % 2 = 0 THEN client_port ELSE server_port END AS INT) AS src_port,
  CAST(CASE WHEN event_id % 2 = 0 THEN server_port ELSE client_port END AS INT) AS dst_port,
  CAST(CASE WHEN user_id % 9 = 7 OR user_id % 18 = 2 THEN 17 WHEN user_id % 25 = 24 THEN 1 ELSE 6 END AS INT) AS proto,
  CAST(5 + event_id % 3 AS INT) AS ihl, CAST(64 - event_id % 5 AS INT) AS ttl,
  CAST(event_id * 37 % 256 AS INT) AS flags, CAST(40 + event_id * 7919 % 1461 AS INT) AS length
FROM (SELECT event_id, ts, user_id,
  concat('10.0.', CAST(CAST(floor(user_id / 256) AS INT) AS VARCHAR(9)), '.', CAST(user_id % 256 AS VARCHAR(9))) AS client_ip,
  20000 + user_id AS client_port,
  CASE user_id % 9 WHEN 0 THEN 80 WHEN 1 THEN 443 WHEN 2 THEN 53 WHEN 3 THEN 23 WHEN 4 THEN 25
    WHEN 5 THEN 22 WHEN 6 THEN 194 WHEN 7 THEN 67 ELSE 9999 END AS server_port
  FROM {events}) e
"""

TRAFFIC_LINES_SQL = """
SELECT line_id, CASE WHEN line_id % 97 = 0 THEN body WHEN line_id % 89 = 0 THEN concat(body, ',', label, ',x')
  ELSE concat(body, ',', label) END AS csv_line
FROM (SELECT line_id,
  CASE CAST(floor(q / 9) AS INT) WHEN 0 THEN 'BENIGN' WHEN 1 THEN 'DDOS-ICMP_FLOOD' WHEN 2 THEN 'DOS-UDP_FLOOD'
    WHEN 3 THEN 'MIRAI-UDPPLAIN' WHEN 4 THEN 'RECON-PORTSCAN' ELSE 'XSS' END AS label,
  concat_ws(',',
    CAST(20 + q % 5 * 4 AS VARCHAR(9)), CASE WHEN q % 2 = 0 THEN '6' ELSE '17' END, '64',
    CASE WHEN line_id % 50 = 0 THEN 'inf' ELSE concat(CAST(q * 10 AS VARCHAR(9)), '.5') END,
    CAST(q % 2 AS VARCHAR(9)), CAST(q % 3 AS VARCHAR(9)), '0', CAST(q % 4 AS VARCHAR(9)), CAST(q % 5 AS VARCHAR(9)), '0', '0',
    CASE WHEN line_id % 7 = 0 THEN '0.500000' ELSE CAST(q % 3 AS VARCHAR(9)) END, CAST(q % 2 AS VARCHAR(9)), '0.750000', '0',
    CASE WHEN q % 3 = 0 THEN '1' ELSE '0' END, CASE WHEN q % 3 = 1 THEN '1' ELSE '0' END, CASE WHEN q % 3 = 2 THEN '1' ELSE '0' END,
    '0', '0', '0', '0', CASE WHEN q % 2 = 0 THEN '1' ELSE '0' END, CASE WHEN q % 2 = 0 THEN '0' ELSE '1' END,
    '0', '0', '0', '0', '1', '0',
    CAST(q * 100 AS VARCHAR(9)), CAST(q * 2 AS VARCHAR(9)), CAST(q * 30 AS VARCHAR(9)),
    concat(CAST(q * 10 AS VARCHAR(9)), '.250000'), concat(CAST(q AS VARCHAR(9)), '.500000'), CAST(q * 100 AS VARCHAR(9)),
    CASE WHEN line_id % 101 = 0 THEN '' ELSE '0.001000' END, CAST(q AS VARCHAR(9)), concat(CAST(q AS VARCHAR(9)), '.125000')) AS body
  FROM (SELECT l_orderkey * 10 + l_linenumber AS line_id, CAST(floor(l_quantity) AS INT) AS q FROM {lineitem}) a) b
"""

PREDICTIONS_SQL = """
SELECT event_id AS pred_id, ts AS prediction_timestamp,
  CAST(CAST(floor(value / 8) AS INT) % 36 AS DOUBLE) AS predicted_label,
  CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'BENIGN' ELSE 'UNKNOWN' END AS actual_label,
  CASE WHEN event_id % 50 = 0 THEN 'inf' ELSE CAST(event_id % 500 AS VARCHAR(9)) END AS rate,
  CAST(20 + event_id % 5 * 4 AS DOUBLE) AS header_length,
  CAST(CASE WHEN event_id % 2 = 0 THEN 6 ELSE 17 END AS INT) AS protocol_type
FROM {events}
"""

SCORED_SQL = """
SELECT event_id AS row_id, CAST(user_id % 7 AS DOUBLE) AS label,
  CAST(CASE WHEN event_id % 4 = 0 THEN event_id % 6 ELSE user_id % 7 END AS DOUBLE) AS prediction FROM {events}
"""


def _labels_values_sql() -> str:
    rows = ", ".join(f"({i}, '{name}')" for i, name in enumerate(LABELS))
    return f"(VALUES {rows}) AS t(idx, label)"


# DuckDB text of the same views, used by ``oracle_sql()``.
DUCKDB_VIEWS: dict[str, str] = {
    "packets": PACKETS_SQL.replace("{us}", DUCKDB_US).replace("{events}", "events"),
    "traffic_lines": TRAFFIC_LINES_SQL.replace("{lineitem}", "lineitem"),
    "predictions": PREDICTIONS_SQL.replace("{events}", "events"),
    "scored": SCORED_SQL.replace("{events}", "events"),
    "label_map": f"SELECT CAST(idx AS BIGINT) AS idx, label FROM {_labels_values_sql()}",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table (column pruning / filters push down)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PACKETS_SQL.replace("{us}", SPARK_US), events=load(spark, sf_dir, "events"))


def traffic_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TRAFFIC_LINES_SQL, lineitem=load(spark, sf_dir, "lineitem"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PREDICTIONS_SQL, events=load(spark, sf_dir, "events"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SCORED_SQL, events=load(spark, sf_dir, "events"))
