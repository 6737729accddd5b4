"""Record layouts and the fixed values the traffic format depends on.

Everything in this module is data, not logic: the wire order of the 40
traffic fields, the types they are cast to when served, the prediction
envelope, the packet table the flow extractor reads, and the label
dictionary / category rules that downstream reports decode with.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# The 40 traffic fields in wire order with their serving type.
# "string" fields stay text (Rate is kept as its raw text, Label is the class).
# --------------------------------------------------------------------------
TRAFFIC_FIELDS: list[tuple[str, str]] = [
    ("Header_Length", "double"),
    ("Protocol Type", "int"),
    ("Time_To_Live", "double"),
    ("Rate", "string"),
    ("fin_flag_number", "double"),
    ("syn_flag_number", "double"),
    ("rst_flag_number", "double"),
    ("psh_flag_number", "double"),
    ("ack_flag_number", "double"),
    ("ece_flag_number", "double"),
    ("cwr_flag_number", "double"),
    ("ack_count", "int"),
    ("syn_count", "int"),
    ("fin_count", "int"),
    ("rst_count", "int"),
    ("HTTP", "double"),
    ("HTTPS", "double"),
    ("DNS", "double"),
    ("Telnet", "double"),
    ("SMTP", "double"),
    ("SSH", "double"),
    ("IRC", "double"),
    ("TCP", "double"),
    ("UDP", "double"),
    ("DHCP", "double"),
    ("ARP", "double"),
    ("ICMP", "double"),
    ("IGMP", "double"),
    ("IPv", "double"),
    ("LLC", "double"),
    ("Tot sum", "int"),
    ("Min", "int"),
    ("Max", "int"),
    ("AVG", "double"),
    ("Std", "double"),
    ("Tot size", "double"),
    ("IAT", "double"),
    ("Number", "int"),
    ("Variance", "double"),
    ("Label", "string"),
]
TRAFFIC_WIDTH = 40
LABEL_COLUMN = "Label"
UNKNOWN_LABEL = "UNKNOWN"

_SPARK_TYPES = {"double": T.DoubleType(), "int": T.IntegerType(), "string": T.StringType()}

TRAFFIC_SCHEMA = T.StructType(
    [T.StructField(name, _SPARK_TYPES[kind], True) for name, kind in TRAFFIC_FIELDS]
)

# Schema for reading a headered training CSV without a type-inference pass.
# Every number is a double (counts may be ratios such as 0.500000);
# ``positiveInf``/``negativeInf`` options map the lower-case ``inf`` spellings
# that would otherwise force a string column.
TRAINING_CSV_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType() if name == LABEL_COLUMN else T.DoubleType(), True)
        for name, kind in TRAFFIC_FIELDS
    ]
)

# Prediction envelope published for every scored record.
PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("original_timestamp", T.TimestampType(), True),
        T.StructField("actual_label", T.StringType(), True),
        T.StructField("predicted_label", T.DoubleType(), True),
        T.StructField("rate", T.StringType(), True),
        T.StructField("header_length", T.DoubleType(), True),
        T.StructField("protocol_type", T.IntegerType(), True),
        T.StructField("prediction_timestamp", T.TimestampType(), True),
    ]
)

# Packet table read by the flow-feature extractor (one row per captured packet).
PACKET_SCHEMA = T.StructType(
    [
        T.StructField("packet_id", T.LongType(), False),
        T.StructField("ts_us", T.LongType(), False),
        T.StructField("src_ip", T.StringType(), True),
        T.StructField("dst_ip", T.StringType(), True),
        T.StructField("src_port", T.IntegerType(), True),
        T.StructField("dst_port", T.IntegerType(), True),
        T.StructField("proto", T.IntegerType(), True),
        T.StructField("ihl", T.IntegerType(), True),
        T.StructField("ttl", T.IntegerType(), True),
        T.StructField("flags", T.IntegerType(), True),
        T.StructField("length", T.IntegerType(), True),
    ]
)

# Kafka-shaped rows, as the Kafka source produces them.
TOPIC_ROW_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

# One-row label dictionary as written by the dictionary job.
LABEL_DICTIONARY_SCHEMA = T.StructType(
    [
        T.StructField("generated_timestamp", T.StringType(), True),
        T.StructField("index_to_label", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("label_column", T.StringType(), True),
        T.StructField("label_to_index", T.MapType(T.StringType(), T.LongType()), True),
        T.StructField("total_labels", T.LongType(), True),
    ]
)

# --------------------------------------------------------------------------
# The 34-class label dictionary, index order (BENIGN = 10).
# --------------------------------------------------------------------------
LABELS: list[str] = [
    "DDOS-ICMP_FLOOD",
    "DDOS-UDP_FLOOD",
    "DDOS-TCP_FLOOD",
    "DDOS-PSHACK_FLOOD",
    "DDOS-RSTFINFLOOD",
    "DDOS-SYN_FLOOD",
    "DDOS-SYNONYMOUSIP_FLOOD",
    "DOS-UDP_FLOOD",
    "DOS-TCP_FLOOD",
    "DOS-SYN_FLOOD",
    "BENIGN",
    "MIRAI-GREETH_FLOOD",
    "MIRAI-UDPPLAIN",
    "MIRAI-GREIP_FLOOD",
    "DDOS-ICMP_FRAGMENTATION",
    "VULNERABILITYSCAN",
    "MITM-ARPSPOOFING",
    "DDOS-ACK_FRAGMENTATION",
    "DDOS-UDP_FRAGMENTATION",
    "DNS_SPOOFING",
    "RECON-HOSTDISCOVERY",
    "RECON-OSSCAN",
    "RECON-PORTSCAN",
    "DOS-HTTP_FLOOD",
    "DDOS-HTTP_FLOOD",
    "DDOS-SLOWLORIS",
    "DICTIONARYBRUTEFORCE",
    "BROWSERHIJACKING",
    "SQLINJECTION",
    "COMMANDINJECTION",
    "XSS",
    "BACKDOOR_MALWARE",
    "RECON-PINGSWEEP",
    "UPLOADING_ATTACK",
]
BENIGN = "BENIGN"

# --------------------------------------------------------------------------
# Attack categories, first matching rule wins. Each rule is
# (category, colour, keywords); the first rule matches the exact label, the
# others match when the upper-cased label contains any keyword.
# --------------------------------------------------------------------------
BENIGN_CATEGORY = ("benign", "#2E8B57")
CATEGORY_RULES: list[tuple[str, str, tuple[str, ...]]] = [
    ("ddos", "#DC143C", ("DDOS",)),
    ("dos", "#B22222", ("DOS",)),
    ("mirai", "#8B0000", ("MIRAI",)),
    ("recon", "#FF8C00", ("RECON",)),
    ("vulnerability", "#FF4500", ("VULNERABILITY",)),
    ("mitm_spoofing", "#9932CC", ("MITM", "SPOOFING")),
    ("bruteforce", "#4B0082", ("BRUTEFORCE",)),
    ("injection", "#8B008B", ("INJECTION",)),
    ("xss", "#DA70D6", ("XSS",)),
    ("hijacking", "#9370DB", ("HIJACKING",)),
    ("malware", "#800080", ("BACKDOOR", "MALWARE")),
    ("uploading", "#20B2AA", ("UPLOADING",)),
]
OTHER_CATEGORY = ("other", "#696969")

# --------------------------------------------------------------------------
# Packet decoding for the flow extractor.
# --------------------------------------------------------------------------
PROTO_ICMP, PROTO_TCP, PROTO_UDP = 1, 6, 17
# TCP flag bits counted per flow (URG, 0x20, is not counted).
TCP_FLAG_BITS: list[tuple[str, int]] = [
    ("FIN", 0x01),
    ("SYN", 0x02),
    ("RST", 0x04),
    ("PSH", 0x08),
    ("ACK", 0x10),
    ("ECE", 0x40),
    ("CWR", 0x80),
]
# Application protocol by port, first match on either port wins.
TCP_APP_PORTS: list[tuple[str, tuple[int, ...]]] = [
    ("HTTP", (80,)),
    ("HTTPS", (443,)),
    ("DNS", (53,)),
    ("Telnet", (23,)),
    ("SMTP", (25,)),
    ("SSH", (22,)),
    ("IRC", (194,)),
]
UDP_APP_PORTS: list[tuple[str, tuple[int, ...]]] = [
    ("DNS", (53,)),
    ("DHCP", (67, 68)),
]
DEFAULT_WINDOW_S = 60
