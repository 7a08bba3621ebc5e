"""Packets to flow records, one per endpoint pair, protocol and time slice.

Everything is an algebraic aggregate, combined before the shuffle: a conversation
that holds a third of all packets still reaches the reducer as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper packet sizes of the five size buckets, in order of their columns.
SIZE_BUCKETS = [
    ("num_pkts_up_to_128_bytes", 0, 128),
    ("num_pkts_128_to_256_bytes", 128, 256),
    ("num_pkts_256_to_512_bytes", 256, 512),
    ("num_pkts_512_to_1024_bytes", 512, 1024),
    ("num_pkts_1024_to_1514_bytes", 1024, 1514),
]


def normalize_packets(packets: DataFrame) -> DataFrame:
    """Per-packet CSV columns under plain names, whichever transport gave the ports."""
    return packets.select(
        F.timestamp_micros(F.round(F.col("`frame.time_epoch`") * 1000000).cast("bigint")).alias("ts"),
        F.col("`ip.src`").alias("src_ip"),
        F.col("`ip.dst`").alias("dst_ip"),
        F.coalesce("`tcp.srcport`", "`udp.srcport`").alias("src_port"),
        F.coalesce("`tcp.dstport`", "`udp.dstport`").alias("dst_port"),
        F.col("`ip.proto`").alias("protocol"),
        F.col("`frame.len`").alias("pkt_len"),
        F.coalesce("`tcp.flags`", F.lit(0)).alias("tcp_flags"),
    )


def _throughput(octets: Column, millis: Column) -> Column:
    whole = F.floor(octets / F.greatest(millis, F.lit(1)))
    return (whole * 8000).cast("double")


def _side(prefix: str, mask: Column) -> list[Column]:
    def only(value: Column) -> Column:
        return F.when(mask, value)

    return [
        F.coalesce(F.sum(only(F.col("pkt_len"))), F.lit(0)).cast("bigint").alias(f"{prefix}_bytes"),
        F.count(only(F.lit(1))).alias(f"{prefix}_pkts"),
        F.coalesce(F.bit_or(only(F.col("tcp_flags"))), F.lit(0)).alias(f"{prefix}_flags"),
        F.min(only(F.col("ts"))).alias(f"{prefix}_first"),
        F.max(only(F.col("ts"))).alias(f"{prefix}_last"),
    ]


def _millis(first: Column, last: Column) -> Column:
    span = F.floor((F.unix_micros(last) - F.unix_micros(first)) / 1000)
    return F.coalesce(span, F.lit(0)).cast("bigint")


_ENDS = ("a_ip", "a_port", "b_ip", "b_port", "protocol")


def _by_ends(packets: DataFrame, bidirectional: bool) -> DataFrame:
    """Packets under the pair of their endpoints, the smaller first, with their direction."""
    here = F.struct(F.col("src_ip").alias("ip"), F.col("src_port").alias("port"))
    there = F.struct(F.col("dst_ip").alias("ip"), F.col("dst_port").alias("port"))
    forward = here <= there if bidirectional else F.lit(True)
    keyed = packets.select(
        "ts", "pkt_len", "tcp_flags", "protocol",
        forward.alias("fwd"),
        F.when(forward, here).otherwise(there).alias("a"),
        F.when(forward, there).otherwise(here).alias("b"),
    )
    return keyed.select(
        "*", F.col("a.ip").alias("a_ip"), F.col("a.port").alias("a_port"),
        F.col("b.ip").alias("b_ip"), F.col("b.port").alias("b_port"),
    ).drop("a", "b")


def _measures() -> list[Column]:
    return [
        *_side("a", F.col("fwd")),
        *_side("b", ~F.col("fwd")),
        F.min("ts").alias("first"),
        F.max("ts").alias("last"),
        F.min("pkt_len").alias("shortest_flow_pkt"),
        F.max("pkt_len").alias("longest_flow_pkt"),
        *[
            F.count_if((F.col("pkt_len") > low) & (F.col("pkt_len") <= high)).alias(name)
            for name, low, high in SIZE_BUCKETS
        ],
    ]


def assemble_flows(
    packets: DataFrame, slice: str = "60 seconds", bidirectional: bool = True
) -> DataFrame:
    """Flow records from packets (ts, 5-tuple, pkt_len, tcp_flags).

    Bidirectional: both directions of a conversation form one record, whose source
    is the sender of its first packet. Otherwise each direction is its own record
    and the out columns are 0.
    """
    keyed = _by_ends(packets, bidirectional).withColumn(
        "slice_start", F.window("ts", slice).start
    )
    return _directed(keyed.groupBy(*_ENDS, "slice_start").agg(*_measures()))


def assemble_sessions(
    packets: DataFrame, idle: str = "15 seconds", active: str = "30 minutes",
    bidirectional: bool = True, watermark: str | None = None,
) -> DataFrame:
    """Flow records as assemble_flows() gives them, which end with the conversation.

    A record ends when no packet of either direction came for ``idle``, and at every full
    ``active`` of the clock, so no record is longer and one task never holds more of a hot
    conversation. On a stream, ``watermark`` bounds how late a packet may come: a record is out
    once the watermark has passed its end, and its state goes.
    """
    if watermark is not None:
        packets = packets.withWatermark("ts", watermark)
    keyed = _by_ends(packets, bidirectional)
    # The slice as a plain number: a stream takes one time window per aggregate.
    length = F.expr(f"unix_micros(TIMESTAMP '1970-01-01 00:00:00Z' + INTERVAL {active})")
    sliced = keyed.withColumn("slice", F.floor(F.unix_micros("ts") / length))
    grouped = sliced.groupBy(*_ENDS, "slice", F.session_window("ts", idle)).agg(*_measures())
    return _directed(grouped)


def _directed(grouped: DataFrame) -> DataFrame:
    """Records of endpoint pairs as records of source and destination."""
    # The first sender is the source; on a tie the smaller endpoint.
    a_first = F.coalesce(F.col("a_first") <= F.col("b_first"), F.col("b_first").isNull())

    def source(a: str, b: str) -> Column:
        return F.when(a_first, F.col(a)).otherwise(F.col(b))

    directed = grouped.select(
        source("a_ip", "b_ip").alias("src_ip"),
        source("b_ip", "a_ip").alias("dst_ip"),
        source("a_port", "b_port").alias("src_port"),
        source("b_port", "a_port").alias("dst_port"),
        "protocol",
        F.col("first").alias("flow_start_time"),
        source("a_bytes", "b_bytes").alias("in_bytes"),
        source("a_pkts", "b_pkts").alias("in_pkts"),
        source("b_bytes", "a_bytes").alias("out_bytes"),
        source("b_pkts", "a_pkts").alias("out_pkts"),
        source("a_flags", "b_flags").alias("client_tcp_flags"),
        source("b_flags", "a_flags").alias("server_tcp_flags"),
        _millis(F.col("first"), F.col("last")).alias("duration_ms"),
        _millis(source("a_first", "b_first"), source("a_last", "b_last")).alias("duration_in"),
        _millis(source("b_first", "a_first"), source("b_last", "a_last")).alias("duration_out"),
        "shortest_flow_pkt", "longest_flow_pkt",
        *[name for name, _, _ in SIZE_BUCKETS],
    )
    return directed.withColumns({
        "tcp_flags": F.col("client_tcp_flags").bitwiseOR(F.col("server_tcp_flags")),
        "min_ip_pkt_len": F.col("shortest_flow_pkt"),
        "max_ip_pkt_len": F.col("longest_flow_pkt"),
        "src_to_dst_second_bytes": F.col("in_bytes").cast("double"),
        "dst_to_src_second_bytes": F.col("out_bytes").cast("double"),
        "src_to_dst_avg_throughput": _throughput(F.col("in_bytes"), F.col("duration_in")),
        "dst_to_src_avg_throughput": _throughput(F.col("out_bytes"), F.col("duration_out")),
    })
