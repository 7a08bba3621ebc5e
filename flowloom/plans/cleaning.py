"""Queries over the cleaning, normalizing and training-set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions import fields, labels
from flowloom.functions.addresses import ipv4_to_long as to_long
from flowloom.operators import cleaning, normalize, training_data
from flowloom.plans import fixtures as fx
from flowloom.plans.fixtures import oracle
from flowloom.plans.registry import query
from flowloom.schemas import CANONICAL_19, FEATURE_GROUPS, FLOW_COLUMNS, MEASURES, RAW_41

_BOTH_IPS = "IPV4_SRC_ADDR IS NOT NULL AND IPV4_DST_ADDR IS NOT NULL"


@query(oracle(
    f"SELECT event_id, IPV4_SRC_ADDR, IPV4_DST_ADDR FROM raw_flows WHERE {_BOTH_IPS}", "raw_flows"
))
def drop_missing_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.raw_flows(spark, sf_dir).transform(cleaning.drop_missing_ips)
    return rows.select("event_id", "IPV4_SRC_ADDR", "IPV4_DST_ADDR")


@query(oracle(
    "SELECT event_id, trim(IPV4_SRC_ADDR) AS src_ip, trim(IPV4_DST_ADDR) AS dst_ip FROM raw_flows",
    "raw_flows",
))
def trim_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.raw_flows(spark, sf_dir).transform(cleaning.trim_ips)
    return rows.select("event_id", "src_ip", "dst_ip")


@query(oracle(
    f"SELECT event_id, {fx.ip_sql('trim(IPV4_SRC_ADDR)')} AS src_ip_int, "
    f"{fx.ip_sql('IPV4_SRC_ADDR')} AS untrimmed_int, "
    f"{fx.ip_sql('IPV4_DST_ADDR')} AS dst_ip_int FROM raw_flows",
    "raw_flows",
))
def ipv4_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.raw_flows(spark, sf_dir).select(
        "event_id",
        to_long(F.trim("IPV4_SRC_ADDR")).alias("src_ip_int"),
        to_long(F.col("IPV4_SRC_ADDR")).alias("untrimmed_int"),
        to_long(F.col("IPV4_DST_ADDR")).alias("dst_ip_int"),
    )


@query(oracle(
    "SELECT event_id, " + ", ".join(f"{fx.measure_sql(m)} AS {m}" for m in MEASURES)
    + " FROM raw_flows",
    "raw_flows",
))
def cast_flow_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.raw_flows(spark, sf_dir).transform(cleaning.cast_flow_types)
    return rows.select("event_id", *MEASURES)


@query(oracle(
    "SELECT event_id, CASE WHEN Label IN ('0', 'Benign') THEN 0 ELSE 1 END AS label "
    "FROM raw_flows",
    "raw_flows",
))
def derive_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.raw_flows(spark, sf_dir).transform(cleaning.label_flows)
    return rows.select("event_id", F.col("label").alias("label"))


@query(oracle("SELECT event_id, Attack AS attack_type FROM raw_flows", "raw_flows"))
def rename_attack(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.raw_flows(spark, sf_dir).transform(cleaning.rename_attack)
    return rows.select("event_id", "attack_type")


@query(oracle(
    "SELECT flow_id, ts AS ingestion_time FROM (SELECT flow_id, "
    "TIMESTAMP '2024-06-01 12:00:00' AS ts FROM flows)",
    "flows",
))
def stamp_ingestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    clock = F.lit("2024-06-01 12:00:00").cast("timestamp")
    rows = fx.flows(spark, sf_dir).select("flow_id")
    return cleaning.stamp_ingestion(rows, clock=clock)


@query(oracle(
    "SELECT count(*) AS rows, count(*) AS ids, cast(0 AS bigint) AS without FROM flows", "flows"
))
def assign_flow_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.flows(spark, sf_dir).drop("flow_id").transform(cleaning.assign_flow_id)
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("flow_id").alias("ids"),
        F.count_if(F.col("flow_id").isNull()).alias("without"),
    )


@query(oracle(
    "SELECT count(*) AS rows, count(*) AS ids, count(*) AS well_formed FROM flows", "flows"
))
def assign_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.flows(spark, sf_dir).transform(cleaning.assign_uuid)
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("id").alias("ids"),
        F.count_if(F.col("id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias(
            "well_formed"
        ),
    )


@query(oracle(f"SELECT {fx.FLOW_LIST} FROM flows", "flows"))
def canonical_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    shuffled = fx.flows(spark, sf_dir).select(*reversed(FLOW_COLUMNS), F.lit(1).alias("extra"))
    return cleaning.canonical_projection(shuffled)


@query(oracle(f"SELECT {fx.FLOW_LIST} FROM flows", "flows"))
def clean_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.flows(spark, sf_dir)


_ANONYMOUS = ", ".join(c for c in FLOW_COLUMNS if c not in training_data.IDENTIFIERS)


@query(oracle(f"SELECT {_ANONYMOUS} FROM flows", "flows"))
def drop_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_data.drop_identifiers(fx.flows(spark, sf_dir))


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in FLOW_COLUMNS)


@query(oracle(f"SELECT {fx.FLOW_LIST} FROM flows WHERE {_COMPLETE}", "flows"))
def drop_any_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_data.drop_any_null(fx.flows(spark, sf_dir))


_TARGET_SQL = f"CASE WHEN attack_type = 'Benign' THEN 0 ELSE 1 END AS {training_data.TARGET}"


@query(oracle(f"SELECT flow_id, {_TARGET_SQL} FROM flows", "flows"))
def binary_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.flows(spark, sf_dir).select("flow_id", "attack_type")
    return training_data.add_target(rows)


@query(oracle(f"SELECT {', '.join(CANONICAL_19)}, {_TARGET_SQL} FROM flows", "flows"))
def select_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_data.add_target(fx.flows(spark, sf_dir))
    return training_data.select_features(rows)


TRAINING_SQL = f"SELECT {', '.join(CANONICAL_19)}, {_TARGET_SQL} FROM flows WHERE {_COMPLETE}"


@query(oracle(TRAINING_SQL, "flows"))
def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_data.training_set(fx.flows(spark, sf_dir))


@query(oracle(
    "SELECT event_id, " + ", ".join(f'try_cast("{c}" AS double) AS "{c}"' for c in RAW_41)
    + " FROM raw_flows",
    "raw_flows",
))
def raw_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_data.raw_features(fx.raw_flows(spark, sf_dir), "event_id")


def _group_sql(group: str, names: list[str]) -> str:
    total = " + ".join(f'sum(cast(try_cast("{c}" AS double) AS bigint))' for c in names)
    return (
        f"SELECT '{group}' AS feature_group, {len(names)} AS features, "
        f"cast({total} AS bigint) AS total FROM raw_flows WHERE \"PROTOCOL\" <> 'x'"
    )


@query(oracle(" UNION ALL ".join(_group_sql(g, n) for g, n in FEATURE_GROUPS.items()), "raw_flows"))
def feature_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each group's columns summed over all rows, every group from the same scan."""
    numbers = fields.drop_incomplete(
        training_data.raw_features(fx.raw_flows(spark, sf_dir)), ["PROTOCOL"]
    )
    sums = numbers.agg(*[
        sum(
            (F.sum(F.col(c).cast("bigint"))
             for c in training_data.feature_group(numbers, group).columns),
            F.lit(0),
        ).alias(group)
        for group in FEATURE_GROUPS
    ])
    sizes = F.create_map(*[
        F.lit(x) for g, names in FEATURE_GROUPS.items() for x in (g, len(names))
    ])
    long = sums.unpivot([], list(FEATURE_GROUPS), "feature_group", "total")
    return long.select("feature_group", sizes[F.col("feature_group")].alias("features"), "total")


# --- collector exports --------------------------------------------------------

_PROTOCOL_SQL = (
    "CASE WHEN contains(upper(\"Prot\"), 'TCP') THEN 6 WHEN contains(upper(\"Prot\"), 'UDP') "
    "THEN 17 ELSE coalesce(cast(trunc(try_cast(\"Prot\" AS double)) AS integer), 0) END"
)
_BITS = {"F": 1, "S": 2, "R": 4, "P": 8, "A": 16, "U": 32, "E": 64, "C": 128}
_FLAGS_SQL = (
    "CASE WHEN \"Flags\" IS NULL THEN 0 "
    "WHEN starts_with(\"Flags\", '0x') THEN cast(cast(\"Flags\" AS bigint) AS integer) "
    "WHEN regexp_full_match(\"Flags\", '[0-9]+') THEN cast(\"Flags\" AS integer) ELSE "
    + " + ".join(
        f"CASE WHEN contains(\"Flags\", '{letter}') THEN {bit} ELSE 0 END"
        for letter, bit in _BITS.items()
    )
    + " END"
)
_DURATION_SQL = "cast(floor(try_cast(\"Duration\" AS decimal(24,6)) * 1000) AS bigint)"
_BYTES_SQL = "coalesce(cast(trunc(try_cast(\"Bytes\" AS double)) AS bigint), 0)"


@query(oracle(
    f'SELECT "Prot" AS text, {_PROTOCOL_SQL} AS protocol FROM flow_export', "flow_export"
))
def protocol_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.flow_export(spark, sf_dir).select(
        F.col("Prot").alias("text"), fields.protocol_number(F.col("Prot")).alias("protocol")
    )


@query(oracle(
    f'SELECT "Flags" AS text, {_FLAGS_SQL} AS tcp_flags FROM flow_export', "flow_export"
))
def decode_tcp_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.flow_export(spark, sf_dir).select(
        F.col("Flags").alias("text"), fields.decode_tcp_flags(F.col("Flags")).alias("tcp_flags")
    )


@query(oracle(
    f'SELECT "Duration" AS text, {_DURATION_SQL} AS duration_ms FROM flow_export', "flow_export"
))
def duration_to_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.flow_export(spark, sf_dir).select(
        F.col("Duration").alias("text"),
        fields.duration_to_ms(F.col("Duration")).alias("duration_ms"),
    )


@query(oracle(
    f"SELECT cast(\"Src Port\" AS integer) AS src_port, {_BYTES_SQL} AS bytes FROM flow_export",
    "flow_export",
))
def coerce_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.flow_export(spark, sf_dir).select(
        fields.coerce_number(F.col("Src Port")).cast("int").alias("src_port"),
        fields.coerce_number(F.col("Bytes")).alias("bytes"),
    )


_EXPORT_IP = {
    "src_ip": "coalesce(nullif(trim(\"Src Addr\"), ''), '')",
    "dst_ip": "coalesce(nullif(trim(\"DstAddr\"), ''), '')",
}
_ZERO_LONGS = ["out_bytes", "out_pkts", *(m for m in MEASURES if m.startswith("num_pkts"))]
EXPORT_SQL = (
    f"SELECT {_EXPORT_IP['src_ip']} AS src_ip, {_EXPORT_IP['dst_ip']} AS dst_ip, "
    f"{fx.ip_sql(_EXPORT_IP['src_ip'])} AS src_ip_int, "
    f"{fx.ip_sql(_EXPORT_IP['dst_ip'])} AS dst_ip_int, "
    "cast(\"Src Port\" AS integer) AS src_port, cast(\"DstPort\" AS integer) AS dst_port, "
    f"{_PROTOCOL_SQL} AS protocol, cast(7.0 AS double) AS l7_proto, "
    f"{_BYTES_SQL} AS in_bytes, cast(\"Packets\" AS bigint) AS in_pkts, "
    f"{_DURATION_SQL} AS duration_ms, {_FLAGS_SQL} AS tcp_flags, "
    "0 AS client_tcp_flags, 0 AS server_tcp_flags, "
    "cast(0 AS double) AS src_to_dst_avg_throughput, "
    "cast(0 AS double) AS dst_to_src_avg_throughput, "
    + ", ".join(f"cast(0 AS bigint) AS {c}" for c in _ZERO_LONGS)
    + ", 'Benign' AS attack_type FROM flow_export"
)


@query(oracle(EXPORT_SQL, "flow_export"))
def normalize_flow_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize_flow_export(fx.flow_export(spark, sf_dir))


@query(oracle(
    "SELECT flow_id, CASE WHEN prediction = 0 THEN 'Benign' ELSE 'Attaque' END AS verdict "
    "FROM scored",
    "scored",
))
def decode_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.scored_flows(spark, sf_dir).select(
        "flow_id", labels.decode_prediction(F.col("prediction")).alias("verdict")
    )
