"""Per-flow sliding-window traffic features from a packet table.

A flow is the bidirectional ``ip:port-ip:port-proto`` key. For every packet
the extractor emits one 40-field record once the flow has at least two
packets in the last ``W`` seconds (``t > now - W``):

* windowed: packet count, byte sum/min/max/mean/sample stdev, inter-arrival
  mean and population variance;
* whole-life (never windowed): TCP flag counters, protocol presence, and the
  first-seen time used by the rate.

Packets of a flow are in the total order of ``(ts_us, packet_id)``; a packet's window holds only
packets up to itself in that order, so packets of one microsecond have one result in any input order.
Packets without a time are dropped.

Plan (batch): a segmented prefix scan. Every packet is two events, its arrival at ``ts`` and its expiry
at ``ts + W``. Events are range partitioned by ``(flow, time, kind, packet_id)``, so a flow with all its packets
in one window is spread over as many partitions as its size asks for, and each partition is scanned by itself:

* forward, running sums that add at arrivals and subtract at expiries (count, bytes, squares, squared gaps), running
  sums of the whole-life counters, and the extremes of the arrivals in the current block of ``W``;
* backward, the time of the next expiry (the window starts with its packet) and the extremes of the expiries still to
  come in the block, which are those of the packets of the block before that are still in the window.

What a scan lacks is the state at its partition's ends. Only the first and the last flow of a partition can go on in
another one, so this state is at most four rows a partition. They are summed up in the order of the
partitions, and the result, at most two rows a partition, is broadcast and added to the rows.

Statistics come from exact integer aggregates (``long`` sums; squared gaps in two 20-bit parts) followed by a
fixed, short sequence of double operations, so the result does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import fixed, once
from ..schema import (
    DEFAULT_WINDOW_S,
    PROTO_ICMP,
    PROTO_TCP,
    PROTO_UDP,
    TCP_APP_PORTS,
    TCP_FLAG_BITS,
    TRAFFIC_FIELDS,
    UDP_APP_PORTS,
    UNKNOWN_LABEL,
)
from ..session import work_path

# Producer spelling of the 40 names (underscores instead of spaces).
FLOW_FEATURE_NAMES = [n.replace(" ", "_") for n, _ in TRAFFIC_FIELDS]
PROTOCOL_FLAGS = ["HTTP", "HTTPS", "DNS", "Telnet", "SMTP", "SSH", "IRC", "TCP", "UDP", "DHCP", "ARP", "ICMP"]
FLAG_NAMES = [name for name, _ in TCP_FLAG_BITS]
_2P40 = 1 << 40
PART_PACKETS = 10_000  # so that small tables are not cut into many tiny tasks


# Row-wise packet decoding (FL1-FL4) ----------------------------------------


def transport_ports(df: DataFrame) -> tuple[Column, Column]:
    """Ports as the flow key sees them: 0 unless TCP or UDP."""
    has_ports = F.col("proto").isin(PROTO_TCP, PROTO_UDP)
    sport = F.when(has_ports, F.col("src_port")).otherwise(F.lit(0))
    dport = F.when(has_ports, F.col("dst_port")).otherwise(F.lit(0))
    return sport, dport


def flow_key(df: DataFrame, out: str = "flow") -> DataFrame:
    """Bidirectional key, smaller ``(ip text, port)`` endpoint first.
    Packets without IPv4 addresses have no key and are dropped."""
    sport, dport = transport_ports(df)
    a = F.concat_ws(":", F.col("src_ip"), sport.cast("string"))
    b = F.concat_ws(":", F.col("dst_ip"), dport.cast("string"))
    src_first = F.struct(F.col("src_ip"), sport) < F.struct(F.col("dst_ip"), dport)
    proto = F.col("proto").cast("string")
    key = F.when(src_first, F.concat_ws("-", a, b, proto)).otherwise(F.concat_ws("-", b, a, proto))
    return df.filter(F.col("src_ip").isNotNull() & F.col("dst_ip").isNotNull()).withColumn(out, key)


def tcp_flags(df: DataFrame) -> DataFrame:
    """0/1 per counted TCP flag bit (TCP packets only)."""
    tcp = F.col("proto") == PROTO_TCP
    return df.withColumns(
        {
            f"f_{name}": F.when(tcp & ((F.col("flags").bitwiseAND(bit)) != 0), F.lit(1)).otherwise(F.lit(0))
            for name, bit in TCP_FLAG_BITS
        }
    )


def transport(df: DataFrame) -> DataFrame:
    """0/1 transport class: TCP, UDP, ICMP."""
    return df.withColumns(
        {
            "p_TCP": (F.col("proto") == PROTO_TCP).cast("int"),
            "p_UDP": (F.col("proto") == PROTO_UDP).cast("int"),
            "p_ICMP": (F.col("proto") == PROTO_ICMP).cast("int"),
        }
    )


def _port_match(ports: tuple[int, ...]) -> Column:
    cond = None
    for p in ports:
        c = (F.col("dst_port") == p) | (F.col("src_port") == p)
        cond = c if cond is None else (cond | c)
    return cond


def app_protocol(df: DataFrame, out: str = "app") -> DataFrame:
    """Application class from either port, first matching rule wins."""
    expr = None
    for proto, rules in ((PROTO_TCP, TCP_APP_PORTS), (PROTO_UDP, UDP_APP_PORTS)):
        for name, ports in rules:
            cond = (F.col("proto") == proto) & _port_match(ports)
            expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn(out, expr)


def packet_marks() -> Column:
    """The 0/1 indicators of a packet (flags, transport, application) as bits, in the order of ``_counters``.
    ARP frames carry no IP header, so that bit is never set."""
    bit = {name: 1 << i for i, name in enumerate(_counters())}
    tcp, udp, icmp = (F.col("proto") == p for p in (PROTO_TCP, PROTO_UDP, PROTO_ICMP))
    flags = sum((F.when(F.col("flags").bitwiseAND(mask) != 0, bit[f"f_{name}"]).otherwise(0) for name, mask in TCP_FLAG_BITS), F.lit(0))

    def app(rules) -> Column:
        return F.coalesce(*(F.when(_port_match(ports), bit[f"p_{name}"]) for name, ports in rules), F.lit(0))

    return (
        F.when(tcp, F.coalesce(flags, F.lit(0)) + bit["p_TCP"] + app(TCP_APP_PORTS))
        .when(udp, bit["p_UDP"] + app(UDP_APP_PORTS))
        .when(icmp, F.lit(bit["p_ICMP"]))
        .otherwise(0)
    )


# Windowed + cumulative features (FL5-FL16) -----------------------------------


def _counters() -> list[str]:
    return [f"f_{n}" for n in FLAG_NAMES] + [f"p_{n}" for n in PROTOCOL_FLAGS]


SUMS = ["n_in", "n_out", "len_sum", "len_sq", "gap_hh", "gap_hl", "gap_ll", *_counters()]


def flow_events(packets: DataFrame, w_us: int) -> DataFrame:
    """Two rows a packet: ``kind`` 1 arrives at ``at``, 0 expires. An expiry comes before an arrival of the same
    time, as a packet sees only what is younger than ``W``. The 0/1 indicators are bits of ``marks``."""
    d = flow_key(packets).where(F.col("ts_us").isNotNull()).select(
        "flow", "packet_id", F.col("ts_us").cast("bigint").alias("ts_us"), "ihl", "proto", "ttl", F.col("length").cast("bigint").alias("length"), packet_marks().alias("marks")
    )
    kinds = F.array(F.struct(F.col("ts_us").alias("at"), F.lit(1).alias("kind")), F.struct((F.col("ts_us") + w_us).alias("at"), F.lit(0).alias("kind")))
    events = d.withColumn("e", F.explode(kinds)).select("flow", "e.at", "e.kind", "packet_id", "ihl", "proto", "ttl", "length", "marks")
    return events.withColumn("block", F.floor(F.col("at") / F.lit(w_us)).cast("bigint"))


def _scanned(events: DataFrame, w_us: int, parts: int) -> DataFrame:
    """Each partition of ``events`` scanned by itself: all arrivals, and the ends of every flow in a partition."""
    order = ["flow", "at", "kind", "packet_id"]
    dealt = events.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()).repartitionById(parts, "part")

    arrives, expires = F.col("kind") == 1, F.col("kind") == 0
    forward = Window.partitionBy("flow", "part").orderBy("block", "at", "kind", "packet_id")
    before, upto = forward.rowsBetween(Window.unboundedPreceding, -1), forward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last_of_kind = F.when(arrives, F.max(F.when(arrives, F.col("at"))).over(before)).otherwise(F.max(F.when(expires, F.col("at"))).over(before))
    rows = dealt.withColumn("gap", F.col("at") - last_of_kind).withColumn("first", F.row_number().over(forward) == 1)
    gap = F.when(F.col("gap") < w_us, F.col("gap")).otherwise(F.lit(0))  # a gap of W or more never counts
    high, low = F.shiftright(gap, 20), gap.bitwiseAND(0xFFFFF)
    sign, length = F.col("kind") * 2 - 1, F.col("length")
    steps = {
        "n_in": F.col("kind"), "n_out": 1 - F.col("kind"), "len_sum": sign * length, "len_sq": sign * length * length,
        "gap_hh": sign * high * high, "gap_hl": sign * high * low, "gap_ll": sign * low * low,
        **{c: F.when(arrives, F.shiftright(F.col("marks"), i).bitwiseAND(1)).otherwise(0) for i, c in enumerate(_counters())},
    }
    in_block = Window.partitionBy("flow", "part", "block")
    so_far = in_block.orderBy("at", "kind", "packet_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select(
        "*",
        *[F.sum(step).over(upto).alias(f"r_{name}") for name, step in steps.items()],
        *[f(F.when(k, F.col("at"))).over(upto).alias(name) for name, f, k in (("first_in", F.min, arrives), ("last_in", F.max, arrives), ("first_out", F.min, expires), ("last_out", F.max, expires))],
        F.min(F.when(arrives, length)).over(so_far).alias("lo"),
        F.max(F.when(arrives, length)).over(so_far).alias("hi"),
    )
    backward = Window.partitionBy("flow", "part").orderBy(F.desc("block"), F.desc("at"), F.desc("kind"), F.desc("packet_id"))
    to_come = in_block.orderBy(F.desc("at"), F.desc("kind"), F.desc("packet_id")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "*",
        (F.row_number().over(backward) == 1).alias("last"),
        F.min(F.when(expires, F.col("at"))).over(backward.rowsBetween(Window.unboundedPreceding, -1)).alias("next_out"),
        F.min(F.when(expires, length)).over(to_come).alias("rest_lo"),
        F.max(F.when(expires, length)).over(to_come).alias("rest_hi"),
    )
    return rows.where(arrives | F.col("first") | F.col("last")).drop("marks", "gap")


def _least(*values):
    return min((v for v in values if v is not None), default=None)


def _greatest(*values):
    return max((v for v in values if v is not None), default=None)


CARRY_SCHEMA = "flow string, part int, " + ", ".join(
    f"c_{name} bigint"
    for name in [*SUMS, "first_in", "last_out", "next_out", "out_hh", "out_hl", "out_ll", "from_block", "from_lo", "from_hi", "to_block", "to_lo", "to_hi"]
)


def carried(ends: list[dict], w_us: int) -> list[tuple]:
    """Rows of ``CARRY_SCHEMA``: what the other partitions add to each of ``ends``, the first and last event of a
    flow in a partition. ``c_out_*`` is the gap before a partition's first expiry, which counts from there on."""
    parts: dict[str, dict[int, dict]] = {}
    for r in ends:
        of = parts.setdefault(r["flow"], {}).setdefault(r["part"], {})
        if r["first"]:
            of["head"] = r
        if r["last"]:
            of["tail"] = r
    out = []
    for flow, of in parts.items():
        if len(of) < 2:
            continue
        rows = {part: dict.fromkeys(("from_block", "from_lo", "from_hi", "to_block", "to_lo", "to_hi", "next_out")) for part in of}
        total, seen, block, lo, hi = dict.fromkeys(SUMS, 0), dict.fromkeys(("first_in", "last_in", "last_out")), None, None, None
        for part in sorted(of):
            head, tail, row = of[part]["head"], of[part]["tail"], rows[part]
            gap_in, gap_out = (_squares(tail[f"first_{k}"], seen[f"last_{k}"], w_us) for k in ("in", "out"))
            for name, g in zip(("gap_hh", "gap_hl", "gap_ll"), gap_in, strict=True):
                total[name] += g
            row |= total | {"first_in": seen["first_in"], "last_out": seen["last_out"]} | dict(zip(("out_hh", "out_hl", "out_ll"), gap_out, strict=True))
            if block == head["block"]:
                row |= {"from_block": block, "from_lo": lo, "from_hi": hi}
            for name in SUMS:
                total[name] += tail[f"r_{name}"]
            for name, g in zip(("gap_hh", "gap_hl", "gap_ll"), gap_out, strict=True):
                total[name] -= g
            seen = {
                "first_in": _least(seen["first_in"], tail["first_in"]), "last_in": _greatest(seen["last_in"], tail["last_in"]),
                "last_out": _greatest(seen["last_out"], tail["last_out"]),
            }
            whole = block == head["block"] == tail["block"]  # the block began before this partition
            block, lo, hi = tail["block"], _least(tail["lo"], lo if whole else None), _greatest(tail["hi"], hi if whole else None)
        next_out, block, lo, hi = None, None, None, None
        for part in sorted(of, reverse=True):
            head, tail, row = of[part]["head"], of[part]["tail"], rows[part]
            row["next_out"] = next_out
            if block == tail["block"]:
                row |= {"to_block": block, "to_lo": lo, "to_hi": hi}
            own = head["length"] if head["kind"] == 0 else None
            whole = block == tail["block"] == head["block"]
            block = head["block"]
            lo, hi = _least(own, head["rest_lo"], lo if whole else None), _greatest(own, head["rest_hi"], hi if whole else None)
            next_out = _least(tail["first_out"], next_out)
        names = [f.split()[0][2:] for f in CARRY_SCHEMA.split(", ")[2:]]
        out += [(flow, part, *(row[n] for n in names)) for part, row in rows.items()]
    return out


def _squares(now: int | None, before: int | None, w_us: int) -> tuple[int, int, int]:
    gap = now - before if now is not None and before is not None and now - before < w_us else 0
    high, low = gap >> 20, gap & 0xFFFFF
    return high * high, high * low, low * low


def flow_window_stats(packets: DataFrame, window_s: float = DEFAULT_WINDOW_S, parts: int | None = None) -> DataFrame:
    """Per packet: windowed aggregates, whole-life counters, first-seen time. Integer-valued;
    ``flow_features`` derives the doubles. ``parts`` is the number of range partitions (default: one for every
    ``PART_PACKETS`` packets, up to the session's shuffle partitions). The scanned rows are written to the shared folder once, for the ends and the result."""
    spark = packets.sparkSession
    w_us = int(round(window_s * 1_000_000))
    if not parts:
        most = int(spark.conf.get("spark.sql.shuffle.partitions"))
        parts = max(1, min(most, -(-packets.count() // PART_PACKETS)))
    scanned = _scanned(flow_events(packets, w_us), w_us, parts)
    path = work_path(spark, "flow-scan")
    scanned.write.parquet(path)
    rows = spark.read.schema(scanned.schema).parquet(path)

    # at most four rows a partition: the ends of its first and its last flow
    outer = rows.where("first or last").groupBy("part").agg(F.min("flow").alias("low_flow"), F.max("flow").alias("high_flow"))
    ends = rows.where("first or last").join(F.broadcast(outer), "part").where("flow = low_flow or flow = high_flow")
    carry = spark.createDataFrame(carried([r.asDict() for r in ends.collect()], w_us), CARRY_SCHEMA)

    joined = rows.where("kind = 1").join(F.broadcast(carry), ["flow", "part"], "left")

    def total(name: str) -> Column:
        return F.col(f"r_{name}") + F.coalesce(F.col(f"c_{name}"), F.lit(0))

    def squares(high2: Column, both: Column, low2: Column) -> Column:
        parts_of = ((high2, 1 << 40), (both, 1 << 21), (low2, 1))
        return sum((x.cast("decimal(38,0)") * F.lit(k).cast("decimal(38,0)") for x, k in parts_of), F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)")

    # the gap before the window's first packet is still in the sum
    next_out, last_out = F.coalesce("next_out", "c_next_out"), F.greatest("last_out", "c_last_out")
    lead = next_out - last_out
    lead = F.when(lead < w_us, lead).otherwise(F.lit(0))
    high, low = F.shiftright(lead, 20), lead.bitwiseAND(0xFFFFF)

    def gaps(name: str, leading: Column) -> Column:
        late = F.when(F.col("r_n_out") > 0, F.coalesce(F.col(f"c_out_{name}"), F.lit(0))).otherwise(F.lit(0))
        return total(f"gap_{name}") - late - leading

    came, goes = F.col("block") == F.col("c_from_block"), F.col("block") == F.col("c_to_block")
    return joined.select(
        "flow", "packet_id", F.col("at").alias("ts_us"), "ihl", "proto", "ttl",
        (total("n_in") - total("n_out")).alias("n"), total("len_sum").alias("len_sum"), total("len_sq").alias("len_sq"),
        F.least("lo", "rest_lo", F.when(came, F.col("c_from_lo")), F.when(goes, F.col("c_to_lo"))).alias("len_min"),
        F.greatest("hi", "rest_hi", F.when(came, F.col("c_from_hi")), F.when(goes, F.col("c_to_hi"))).alias("len_max"),
        (next_out - w_us).alias("win_start_us"),
        squares(gaps("hh", high * high), gaps("hl", high * low), gaps("ll", low * low)).alias("iat_sq"),
        F.least("first_in", "c_first_in").alias("first_us"),
        *[total(c).alias(c) for c in _counters()],
    )


def _exact_double(x: Column) -> Column:
    """Non-negative exact integer (decimal) to the correctly rounded double:
    two parts that each convert exactly, then one rounded addition."""
    lo = F.pmod(x, F.lit(_2P40).cast("decimal(38,0)"))
    return (x - lo).cast("double") + lo.cast("double")


def flow_features(packets: DataFrame, window_s: float = DEFAULT_WINDOW_S, parts: int | None = None) -> DataFrame:
    """The full 40-field record per emitted packet, plus ``flow``,
    ``packet_id``, ``ts_us``. Emitted when at least 2 packets are in the
    window. Integer-valued fields are ints, the others doubles."""
    s = flow_window_stats(packets, window_s, parts).filter(F.col("n") >= 2)
    n = F.col("n")
    m = n - 1
    nd = n.cast("double")
    span_us = F.col("ts_us") - F.col("win_start_us")  # sum of the n-1 IATs
    life_us = F.col("ts_us") - F.col("first_us")
    # sample variance of lengths: (n*S2 - S1^2) / (n (n-1)), exact numerator
    len_num = n.cast("decimal(38,0)") * F.col("len_sq").cast("decimal(38,0)") - F.col("len_sum").cast(
        "decimal(38,0)"
    ) * F.col("len_sum").cast("decimal(38,0)")
    std = F.sqrt(_exact_double(len_num) / (nd * m.cast("double")))
    # population variance of the IATs: (m*Q - D^2) / m^2, exact numerator
    iat_num = m.cast("decimal(38,0)") * F.col("iat_sq") - span_us.cast("decimal(38,0)") * span_us.cast(
        "decimal(38,0)"
    )
    iat_var = F.when(m > 1, _exact_double(iat_num) / (m.cast("double") * m.cast("double")) / F.lit(1e12)).otherwise(
        F.lit(0.0)
    )
    values = {
        "Header_Length": (F.col("ihl") * 4).cast("int"),
        "Protocol_Type": F.col("proto").cast("int"),
        "Time_To_Live": F.col("ttl").cast("int"),
        "Rate": nd / F.greatest(life_us.cast("double") / F.lit(1e6), F.lit(1.0)),
        "fin_flag_number": F.col("f_FIN").cast("int"),
        "syn_flag_number": F.col("f_SYN").cast("int"),
        "rst_flag_number": F.col("f_RST").cast("int"),
        "psh_flag_number": F.col("f_PSH").cast("int"),
        "ack_flag_number": F.col("f_ACK").cast("int"),
        "ece_flag_number": F.col("f_ECE").cast("int"),
        "cwr_flag_number": F.col("f_CWR").cast("int"),
        "ack_count": F.col("f_ACK").cast("double") / nd,
        "syn_count": F.col("f_SYN").cast("double") / nd,
        "fin_count": F.col("f_FIN").cast("double") / nd,
        "rst_count": F.col("f_RST").cast("double") / nd,
        **{name: (F.col(f"p_{name}") > 0).cast("int") for name in PROTOCOL_FLAGS[:11]},
        "ICMP": (F.col("p_ICMP") > 0).cast("int"),
        "IGMP": F.lit(0),
        "IPv": F.lit(1),
        "LLC": F.lit(0),
        "Tot_sum": F.col("len_sum").cast("bigint"),
        "Min": F.col("len_min").cast("int"),
        "Max": F.col("len_max").cast("int"),
        "AVG": F.col("len_sum").cast("double") / nd,
        "Std": std,
        "Tot_size": F.col("len_sum").cast("bigint"),
        "IAT": span_us.cast("double") / m.cast("double") / F.lit(1e6),
        "Number": n.cast("int"),
        "Variance": iat_var,
        "Label": F.lit(UNKNOWN_LABEL),
    }
    # exact integer mean/sum needed by the encoder
    return s.select("flow", "packet_id", "ts_us", *[values[name].alias(name) for name in FLOW_FEATURE_NAMES])


# Wire encoding (PRJ4) ---------------------------------------------------------

# Fields the producer emits as floats (``%.6f``); the rest print as integers.
_FLOAT_FIELDS = {"Rate", "ack_count", "syn_count", "fin_count", "rst_count", "Std", "IAT"}


def encode_traffic(features: DataFrame, keep: tuple[str, ...] = ("flow", "packet_id")) -> DataFrame:
    """40-field CSV line per record: floats ``%.6f``, integers as digits,
    missing values ``0``. The mean prints as an integer when exact, the IAT
    variance as ``0`` when there is a single IAT (as the producer's types do)."""
    parts = []
    for name in FLOW_FEATURE_NAMES:
        c = F.col(name)
        if name == "AVG":
            exact = (F.col("Tot_sum") % F.col("Number")) == 0
            txt = F.when(exact, (F.col("Tot_sum") / F.col("Number")).cast("bigint").cast("string")).otherwise(
                fixed("AVG")
            )
        elif name == "Variance":
            txt = F.when(F.col("Number") == 2, F.lit("0")).otherwise(fixed("Variance"))
        elif name in _FLOAT_FIELDS:
            txt = fixed(name)
        else:
            txt = c.cast("string")
        parts.append(F.coalesce(txt, F.lit("0")))
    kept = [k for k in keep if k in features.columns]
    return once(features, "csv_line", F.concat_ws(",", *parts)).select(*kept, "csv_line")
