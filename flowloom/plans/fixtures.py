"""Flow-shaped inputs derived from the given ``events`` table.

Every expression reads the same in Spark SQL and in the checking engine, so one text
feeds both. Blemishes are planted on purpose: null, malformed and padded addresses,
a non-numeric protocol, messages that are not JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from flowloom.operators.cleaning import clean_flows
from flowloom.schemas import FLOW_COLUMNS, MEASURES, MESSAGE, RAW_COLUMNS


def _text(expression: str) -> str:
    return f"cast({expression} AS string)"


_IN_BYTES = "cast(floor(value * 100) AS bigint)"
_OUT_BYTES = "cast(floor(value * 37) AS bigint)"
_LONGEST, _SHORTEST = _text("60 + event_id % 1455"), _text("40 + user_id % 20")
_ON_DNS = "event_type = 'error'"
_IS_SSH = "event_type = 'signup' AND event_id % 3 = 0"

RAW_EXPRESSIONS: dict[str, str] = {
    "IPV4_SRC_ADDR": (
        "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'bad-ip' "
        "WHEN event_id % 83 = 0 THEN '  192.168.' || cast(user_id % 256 AS string) || '.' "
        "|| cast(user_id % 254 + 1 AS string) || ' ' "
        "ELSE '192.168.' || cast(user_id % 256 AS string) || '.' "
        "|| cast(user_id % 254 + 1 AS string) END"
    ),
    "L4_SRC_PORT": _text("1024 + event_id % 64512"),
    "IPV4_DST_ADDR": (
        "CASE WHEN event_id % 101 = 0 THEN NULL ELSE '10.0.' || cast(event_id % 4 AS string) "
        "|| '.' || cast(event_id % 20 + 1 AS string) END"
    ),
    "L4_DST_PORT": (
        "CASE event_type WHEN 'view' THEN '80' WHEN 'click' THEN '443' WHEN 'signup' THEN '22' "
        "WHEN 'purchase' THEN '443' ELSE '53' END"
    ),
    "PROTOCOL": (
        "CASE WHEN event_id % 71 = 0 THEN 'x' WHEN event_type = 'error' THEN '17' ELSE '6' END"
    ),
    "L7_PROTO": _text("event_id % 120") + " || '.0'",
    "IN_BYTES": _text(_IN_BYTES),
    "IN_PKTS": _text("1 + event_id % 23"),
    "OUT_BYTES": _text(_OUT_BYTES),
    "OUT_PKTS": _text("1 + event_id % 17"),
    "TCP_FLAGS": _text("(user_id % 32) | (event_id % 32)"),
    "CLIENT_TCP_FLAGS": _text("user_id % 32"),
    "SERVER_TCP_FLAGS": _text("event_id % 32"),
    "FLOW_DURATION_MILLISECONDS": _text("(event_id * 7919) % 5000"),
    "DURATION_IN": _text("(event_id * 31) % 700"),
    "DURATION_OUT": _text("(event_id * 17) % 900"),
    "MIN_TTL": _text("32 + user_id % 97"),
    "MAX_TTL": _text("32 + user_id % 97 + event_id % 64"),
    "LONGEST_FLOW_PKT": _LONGEST,
    "SHORTEST_FLOW_PKT": _SHORTEST,
    "MIN_IP_PKT_LEN": _SHORTEST,
    "MAX_IP_PKT_LEN": _LONGEST,
    "SRC_TO_DST_SECOND_BYTES": _text(_IN_BYTES) + " || '.0'",
    "DST_TO_SRC_SECOND_BYTES": _text(_OUT_BYTES) + " || '.0'",
    "RETRANSMITTED_IN_BYTES": _text("event_id % 400"),
    "RETRANSMITTED_IN_PKTS": _text("event_id % 4"),
    "RETRANSMITTED_OUT_BYTES": _text("event_id % 300"),
    "RETRANSMITTED_OUT_PKTS": _text("event_id % 3"),
    "SRC_TO_DST_AVG_THROUGHPUT": _text(f"{_IN_BYTES} * 8000"),
    "DST_TO_SRC_AVG_THROUGHPUT": _text(f"{_OUT_BYTES} * 8000"),
    "NUM_PKTS_UP_TO_128_BYTES": _text("event_id % 5"),
    "NUM_PKTS_128_TO_256_BYTES": _text("event_id % 7"),
    "NUM_PKTS_256_TO_512_BYTES": _text("event_id % 11"),
    "NUM_PKTS_512_TO_1024_BYTES": _text("event_id % 3"),
    "NUM_PKTS_1024_TO_1514_BYTES": _text("event_id % 2"),
    "TCP_WIN_MAX_IN": _text("(event_id * 13) % 65536"),
    "TCP_WIN_MAX_OUT": _text("(event_id * 29) % 65536"),
    "ICMP_TYPE": _text("(event_id % 9) * 256"),
    "ICMP_IPV4_TYPE": _text("event_id % 9"),
    "DNS_QUERY_ID": f"CASE WHEN {_ON_DNS} THEN {_text('event_id % 65536')} ELSE '0' END",
    "DNS_QUERY_TYPE": f"CASE WHEN {_ON_DNS} THEN '1' ELSE '0' END",
    "DNS_TTL_ANSWER": f"CASE WHEN {_ON_DNS} THEN {_text('event_id % 300')} ELSE '0' END",
    "FTP_COMMAND_RET_CODE": (
        "CASE WHEN event_type = 'signup' AND event_id % 5 = 0 THEN '530.0' "
        "WHEN event_type = 'signup' THEN '230.0' ELSE '0' END"
    ),
    "Label": f"CASE WHEN event_type = 'error' THEN '1' WHEN {_IS_SSH} THEN '1' ELSE '0' END",
    "Attack": (
        "CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'DDoS attacks-LOIC-HTTP' "
        f"WHEN event_type = 'error' THEN 'DoS attacks-Hulk' WHEN {_IS_SSH} "
        "THEN 'SSH-Bruteforce' ELSE 'Benign' END"
    ),
}

# Collector export: header spellings with spaces, protocol names, flag letters.
EXPORT_EXPRESSIONS: dict[str, str] = {
    "Src Addr": RAW_EXPRESSIONS["IPV4_SRC_ADDR"],
    "DstAddr": RAW_EXPRESSIONS["IPV4_DST_ADDR"],
    "Src Port": RAW_EXPRESSIONS["L4_SRC_PORT"],
    "DstPort": RAW_EXPRESSIONS["L4_DST_PORT"],
    "Prot": (
        "CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'x' "
        "WHEN event_id % 7 = 0 THEN '1' WHEN event_type = 'error' THEN 'UDP' ELSE 'TCP' END"
    ),
    "Bytes": "CASE WHEN event_id % 19 = 0 THEN NULL ELSE cast(value * 100 AS string) END",
    "Packets": _text("1 + event_id % 23"),
    "Duration": (
        "cast((event_id * 7919) % 50 AS string) || '.' "
        "|| lpad(cast(event_id % 1000 AS string), 3, '0')"
    ),
    "Flags": (
        "CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 5 = 0 THEN '0x1b' "
        "WHEN event_id % 3 = 0 THEN cast(event_id % 64 AS string) ELSE "
        "CASE WHEN event_id & 32 > 0 THEN 'U' ELSE '.' END "
        "|| CASE WHEN event_id & 16 > 0 THEN 'A' ELSE '.' END "
        "|| CASE WHEN event_id & 8 > 0 THEN 'P' ELSE '.' END "
        "|| CASE WHEN event_id & 4 > 0 THEN 'R' ELSE '.' END "
        "|| CASE WHEN event_id & 2 > 0 THEN 'S' ELSE '.' END "
        "|| CASE WHEN event_id & 1 > 0 THEN 'F' ELSE '.' END END"
    ),
}

# Packets of a few conversations; every third goes from server to client.
_CLIENT = "'192.168.0.' || cast(user_id % 8 + 1 AS string)"
_SERVER = "'10.0.0.' || cast(event_id % 2 + 1 AS string)"
_CLIENT_PORT = "cast(40000 + user_id % 2 AS int)"
_REPLY = "event_id % 3 = 0"
PACKET_EXPRESSIONS: dict[str, str] = {
    "ts": "ts",
    "src_ip": f"CASE WHEN {_REPLY} THEN {_SERVER} ELSE {_CLIENT} END",
    "dst_ip": f"CASE WHEN {_REPLY} THEN {_CLIENT} ELSE {_SERVER} END",
    "src_port": f"CASE WHEN {_REPLY} THEN 80 ELSE {_CLIENT_PORT} END",
    "dst_port": f"CASE WHEN {_REPLY} THEN {_CLIENT_PORT} ELSE 80 END",
    "protocol": "CASE WHEN event_id % 2 = 0 THEN 6 ELSE 17 END",
    "pkt_len": "cast(40 + (event_id * 37) % 1475 AS int)",
    "tcp_flags": "cast(event_id % 32 AS int)",
}

# A fixed score and verdict, so scored operators have one right answer.
SCORE_EXPRESSION = "cast(src_port * 37 % 100 + 30 * label AS double) / 130"

# One message per flow, written by hand: durations as 1234.0, every 61st not JSON.
_NUMERIC = [
    f.name for f in MESSAGE.fields
    if f.name in MEASURES or f.name.endswith("_int")
]


_SENT_AS_DOUBLE = [
    "duration_ms", "l7_proto", "src_to_dst_avg_throughput", "dst_to_src_avg_throughput",
]


def _json_field(name: str) -> str:
    # Whole numbers only, as the engines print large doubles differently.
    value = f"coalesce(cast(cast({name} AS bigint) AS string), 'null')"
    if name in _SENT_AS_DOUBLE:
        value += " || '.0'"
    return f"'\"{name}\":' || {value}"


MESSAGE_EXPRESSION = (
    "CASE WHEN flow_id % 61 = 0 THEN 'not json' ELSE '{\"src_ip\":\"' || src_ip "
    "|| '\",\"dst_ip\":\"' || dst_ip || '\",' || "
    + " || ',' || ".join(_json_field(n) for n in _NUMERIC)
    + " || ',\"attack_type\":\"' || attack_type || '\"}' END"
)


def _select(expressions: dict[str, str], quote: str) -> list[str]:
    return [f"{e} AS {quote}{name}{quote}" for name, e in expressions.items()]


# Larger rows for benches: line items renamed as events. Ids repeat here.
LINEITEM_AS_EVENTS = {
    "event_id": "l_orderkey * 8 + l_linenumber",
    "ts": "l_shipdate",
    "user_id": "l_suppkey",
    "event_type": (
        "CASE l_linenumber % 5 WHEN 0 THEN 'error' WHEN 1 THEN 'view' WHEN 2 THEN 'click' "
        "WHEN 3 THEN 'signup' ELSE 'purchase' END"
    ),
    "value": "l_extendedprice / 100",
}


def events(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return rows if table == "events" else rows.selectExpr(*_select(LINEITEM_AS_EVENTS, "`"))


def derive(rows: DataFrame, expressions: dict[str, str], *keep: str) -> DataFrame:
    return rows.selectExpr(*keep, *_select(expressions, "`"))


def raw_flows(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    return derive(events(spark, sf_dir, table), RAW_EXPRESSIONS, "event_id", "ts")


def flows(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    return clean_flows(
        raw_flows(spark, sf_dir, table), F.col("event_id"), F.col("ts").cast("timestamp")
    )


def fixed_scorer(flow_rows: DataFrame) -> DataFrame:
    """Stands in for a model: the same three columns, from a fixed rule."""
    return flow_rows.withColumn("anomaly_score", F.expr(SCORE_EXPRESSION)).withColumns({
        "prediction": (F.col("anomaly_score") >= 0.5).cast("double"),
        "is_anomaly": (F.col("anomaly_score") >= 0.5).cast("int"),
    })


def scored_flows(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    return fixed_scorer(flows(spark, sf_dir, table))


def message_values(flow_rows: DataFrame) -> DataFrame:
    """One binary ``value`` per flow."""
    return flow_rows.select(F.expr(MESSAGE_EXPRESSION).cast("binary").alias("value"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_values(flows(spark, sf_dir))


def flow_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(events(spark, sf_dir), EXPORT_EXPRESSIONS)


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = derive(events(spark, sf_dir), PACKET_EXPRESSIONS)
    return typed.withColumn("ts", F.col("ts").cast("timestamp"))


# --- the same inputs for the checking engine ---------------------------------


def ip_sql(ip: str) -> str:
    octets = [f"try_cast(split_part({ip}, '.', {i}) AS bigint)" for i in (1, 2, 3, 4)]
    value = " + ".join(f"{o} * {w}" for o, w in zip(octets, (16777216, 65536, 256, 1)))
    return (
        f"CASE WHEN regexp_full_match({ip}, '[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}') "
        f"AND greatest({', '.join(octets)}) <= 255 THEN {value} ELSE 0 END"
    )


def measure_sql(name: str) -> str:
    source, dtype = MEASURES[name]
    if isinstance(dtype, DoubleType):
        target = "double"
    else:
        target = "integer" if isinstance(dtype, IntegerType) else "bigint"
    return f'try_cast("{source}" AS {target})'


_FLOW_SQL = {
    "flow_id": "event_id",
    "src_ip": "trim(IPV4_SRC_ADDR)",
    "dst_ip": "trim(IPV4_DST_ADDR)",
    "src_ip_int": ip_sql("trim(IPV4_SRC_ADDR)"),
    "dst_ip_int": ip_sql("trim(IPV4_DST_ADDR)"),
    **{name: measure_sql(name) for name in MEASURES},
    "flow_start_time": "ts",
    "label": "CASE WHEN Label IN ('0', 'Benign') THEN 0 ELSE 1 END",
    "attack_type": "Attack",
}
FLOW_SELECT = ", ".join(f"{_FLOW_SQL[c]} AS {c}" for c in FLOW_COLUMNS)

_CTES = {
    "raw_flows": (
        "SELECT event_id, ts, " + ", ".join(_select(RAW_EXPRESSIONS, '"')) + " FROM events"
    ),
    "flows": (
        f"SELECT {FLOW_SELECT} FROM raw_flows "
        "WHERE IPV4_SRC_ADDR IS NOT NULL AND IPV4_DST_ADDR IS NOT NULL"
    ),
    "scored": (
        f"SELECT *, cast(anomaly_score >= 0.5 AS double) AS prediction, "
        f"cast(anomaly_score >= 0.5 AS integer) AS is_anomaly "
        f"FROM (SELECT *, {SCORE_EXPRESSION} AS anomaly_score FROM flows)"
    ),
    "sent": "SELECT * FROM flows WHERE flow_id % 61 <> 0",
    "messages": f"SELECT {MESSAGE_EXPRESSION} AS json FROM flows",
    "flow_export": "SELECT " + ", ".join(_select(EXPORT_EXPRESSIONS, '"')) + " FROM events",
    "packets": "SELECT " + ", ".join(_select(PACKET_EXPRESSIONS, '"')) + " FROM events",
}
_NEEDS = {
    "raw_flows": [], "flows": ["raw_flows"], "scored": ["flows"], "sent": ["flows"],
    "messages": ["flows"], "flow_export": [], "packets": [],
}


def oracle(body: str, *inputs: str) -> str:
    """``body`` over the named inputs, with whatever they build on."""
    needed: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS[name]:
            add(other)
        if name not in needed:
            needed.append(name)

    for name in inputs:
        add(name)
    ctes = ", ".join(f"{n} AS ({_CTES[n]})" for n in needed)
    return f"WITH {ctes} {body}" if ctes else body


RAW_LIST = ", ".join(f'"{c}"' for c in RAW_COLUMNS)
FLOW_LIST = ", ".join(FLOW_COLUMNS)
MESSAGE_LIST = ", ".join(MESSAGE.names)

