"""Every table, message and feature set of the engine, declared once.

Addresses held as integers are unsigned 32-bit values, so they are longs here.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_STRING, _INT, _LONG, _DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()


def _struct(fields: dict[str, DataType]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


# The numeric columns of the labelled flow CSV, in file order.
# They are also the features of the wide model.
RAW_41 = [
    "L4_SRC_PORT", "L4_DST_PORT", "PROTOCOL", "L7_PROTO",
    "IN_BYTES", "IN_PKTS", "OUT_BYTES", "OUT_PKTS",
    "TCP_FLAGS", "CLIENT_TCP_FLAGS", "SERVER_TCP_FLAGS",
    "FLOW_DURATION_MILLISECONDS", "DURATION_IN", "DURATION_OUT",
    "MIN_TTL", "MAX_TTL",
    "LONGEST_FLOW_PKT", "SHORTEST_FLOW_PKT", "MIN_IP_PKT_LEN", "MAX_IP_PKT_LEN",
    "SRC_TO_DST_SECOND_BYTES", "DST_TO_SRC_SECOND_BYTES",
    "RETRANSMITTED_IN_BYTES", "RETRANSMITTED_IN_PKTS",
    "RETRANSMITTED_OUT_BYTES", "RETRANSMITTED_OUT_PKTS",
    "SRC_TO_DST_AVG_THROUGHPUT", "DST_TO_SRC_AVG_THROUGHPUT",
    "NUM_PKTS_UP_TO_128_BYTES", "NUM_PKTS_128_TO_256_BYTES", "NUM_PKTS_256_TO_512_BYTES",
    "NUM_PKTS_512_TO_1024_BYTES", "NUM_PKTS_1024_TO_1514_BYTES",
    "TCP_WIN_MAX_IN", "TCP_WIN_MAX_OUT",
    "ICMP_TYPE", "ICMP_IPV4_TYPE",
    "DNS_QUERY_ID", "DNS_QUERY_TYPE", "DNS_TTL_ANSWER",
    "FTP_COMMAND_RET_CODE",
]

# The labelled flow CSV: 45 columns, read as text.
RAW_COLUMNS = [
    "IPV4_SRC_ADDR", RAW_41[0], "IPV4_DST_ADDR", *RAW_41[1:], "Label", "Attack",
]
RAW = _struct(dict.fromkeys(RAW_COLUMNS, _STRING))

# Canonical measure -> (raw column, type).
MEASURES: dict[str, tuple[str, DataType]] = {
    "src_port": ("L4_SRC_PORT", _INT),
    "dst_port": ("L4_DST_PORT", _INT),
    "protocol": ("PROTOCOL", _INT),
    "l7_proto": ("L7_PROTO", _DOUBLE),
    "in_bytes": ("IN_BYTES", _LONG),
    "out_bytes": ("OUT_BYTES", _LONG),
    "in_pkts": ("IN_PKTS", _LONG),
    "out_pkts": ("OUT_PKTS", _LONG),
    "duration_ms": ("FLOW_DURATION_MILLISECONDS", _LONG),
    "tcp_flags": ("TCP_FLAGS", _INT),
    "client_tcp_flags": ("CLIENT_TCP_FLAGS", _INT),
    "server_tcp_flags": ("SERVER_TCP_FLAGS", _INT),
    "src_to_dst_avg_throughput": ("SRC_TO_DST_AVG_THROUGHPUT", _DOUBLE),
    "dst_to_src_avg_throughput": ("DST_TO_SRC_AVG_THROUGHPUT", _DOUBLE),
    "num_pkts_up_to_128_bytes": ("NUM_PKTS_UP_TO_128_BYTES", _LONG),
    "num_pkts_128_to_256_bytes": ("NUM_PKTS_128_TO_256_BYTES", _LONG),
    "num_pkts_256_to_512_bytes": ("NUM_PKTS_256_TO_512_BYTES", _LONG),
    "num_pkts_512_to_1024_bytes": ("NUM_PKTS_512_TO_1024_BYTES", _LONG),
    "num_pkts_1024_to_1514_bytes": ("NUM_PKTS_1024_TO_1514_BYTES", _LONG),
}

# The 19 measures are the features of the default model, in this order.
CANONICAL_19 = list(MEASURES)

_ADDRESSES: dict[str, DataType] = {
    "src_ip": _STRING, "dst_ip": _STRING, "src_ip_int": _LONG, "dst_ip_int": _LONG,
}
_MEASURE_TYPES = {name: dtype for name, (_, dtype) in MEASURES.items()}

# Canonical flow table, 27 columns.
FLOW = _struct({
    "flow_id": _LONG,
    **_ADDRESSES,
    **_MEASURE_TYPES,
    "flow_start_time": TimestampType(),
    "label": _INT,
    "attack_type": _STRING,
})
FLOW_COLUMNS = FLOW.names
FLOW_KEY = ["src_ip_int", "flow_start_time", "flow_id"]

# Flow message, 24 fields, as its consumers see it ...
MESSAGE = _struct({**_ADDRESSES, **_MEASURE_TYPES, "attack_type": _STRING})

# ... and as it may arrive: producers write long fields as 1234 or 1234.0, so
# the wire type of every long measure is double. Addresses stay exact longs.
MESSAGE_WIRE = _struct({
    f.name: _DOUBLE if f.dataType == _LONG and f.name not in _ADDRESSES else f.dataType
    for f in MESSAGE.fields
})

PREDICTION = _struct({
    "src_ip_int": _LONG, "dst_ip_int": _LONG,
    "src_port": _INT, "dst_port": _INT, "protocol": _INT,
    "in_bytes": _LONG, "out_bytes": _LONG, "duration_ms": _LONG,
    "ingestion_time": TimestampType(),
    "is_anomaly": _INT, "anomaly_score": _DOUBLE,
})
PREDICTION_COLUMNS = PREDICTION.names
# All rows of one micro-batch share an ingestion time, so the flow id is part of
# the key: (source, time) alone would let flows of one batch replace each other.
PREDICTION_KEY = ["src_ip_int", "ingestion_time", "flow_id"]

ALERT = _struct({
    "src_ip": _STRING, "dst_ip": _STRING,
    "src_port": _INT, "dst_port": _INT, "protocol": _INT,
    "in_bytes": _LONG, "out_bytes": _LONG, "duration_ms": _LONG,
    "anomaly_score": _DOUBLE, "ingestion_time": TimestampType(),
})
ALERT_COLUMNS = ALERT.names

LEGACY_MESSAGE_DDL = (
    "src_ip STRING, dest_ip STRING, protocol STRING, bytes_in BIGINT, bytes_out BIGINT"
)
LEGACY_FLOW = _struct({
    "id": _STRING, "src_ip": _STRING, "dest_ip": _STRING,
    "src_port": _INT, "dest_port": _INT, "protocol": _INT,
    "bytes_in": _LONG, "bytes_out": _LONG, "num_pkts_in": _LONG, "num_pkts_out": _LONG,
})

# Per-packet CSV. Length, protocol and flags feed the byte, size and flag columns
# of the assembled flows.
PACKET_CSV = _struct({
    "frame.time_epoch": _DOUBLE, "ip.src": _STRING, "ip.dst": _STRING,
    "tcp.srcport": _INT, "tcp.dstport": _INT, "udp.srcport": _INT, "udp.dstport": _INT,
    "ip.proto": _INT, "frame.len": _INT, "tcp.flags": _INT,
})

TOPIC_VALUE = StructType([StructField("value", BinaryType(), True)])

FIVE_TUPLE = ["src_ip", "dst_ip", "src_port", "dst_port", "protocol"]

# Feature subsets by meaning, over the raw names.
FEATURE_GROUPS: dict[str, list[str]] = {
    "volume": ["IN_BYTES", "OUT_BYTES", "IN_PKTS", "OUT_PKTS"],
    "duration": ["FLOW_DURATION_MILLISECONDS", "DURATION_IN", "DURATION_OUT"],
    "ttl_ip": ["MIN_TTL", "MAX_TTL", "MIN_IP_PKT_LEN", "MAX_IP_PKT_LEN"],
    "tcp": [
        "TCP_FLAGS", "CLIENT_TCP_FLAGS", "SERVER_TCP_FLAGS", "TCP_WIN_MAX_IN", "TCP_WIN_MAX_OUT",
    ],
    "rate": ["SRC_TO_DST_AVG_THROUGHPUT", "DST_TO_SRC_AVG_THROUGHPUT"],
    "size_buckets": [c for c in RAW_41 if c.startswith("NUM_PKTS_")],
    "l7": [
        "L7_PROTO", "DNS_QUERY_ID", "DNS_QUERY_TYPE", "DNS_TTL_ANSWER",
        "ICMP_TYPE", "ICMP_IPV4_TYPE", "FTP_COMMAND_RET_CODE",
    ],
}
