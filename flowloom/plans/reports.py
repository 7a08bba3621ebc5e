"""Queries over lookups, reports, packet assembly, enrichment, sampling and metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from flowloom.functions.fields import number_from_text
from flowloom.operators import enrichment, lookups, metrics, reports, sampling, training_data
from flowloom.operators import packets as packet_ops
from flowloom.operators import upsert
from flowloom.plans import fixtures as fx
from flowloom.plans.fixtures import oracle
from flowloom.plans.messages import received_texts
from flowloom.plans.registry import query
from flowloom.plans.stored import flows_table, scored_table
from flowloom.schemas import FLOW_COLUMNS, MEASURES, RAW_COLUMNS
from flowloom.sources.tables import clustered_order as in_cluster_order

_FLOWS = f"SELECT {fx.FLOW_LIST} FROM flows"
_SCORED = f"SELECT {fx.FLOW_LIST}, anomaly_score, prediction, is_anomaly FROM scored"
_SCORED_COLUMNS = [*FLOW_COLUMNS, "anomaly_score", "prediction", "is_anomaly"]
_SINCE, _UNTIL = datetime(2024, 1, 8), datetime(2024, 1, 22)
_PERIOD = (
    "flow_start_time >= TIMESTAMP '2024-01-08 00:00:00' "
    "AND flow_start_time < TIMESTAMP '2024-01-22 00:00:00'"
)
# 192.168.8.9, the address of user 8.
_SOURCE = 192 * 16777216 + 168 * 65536 + 8 * 256 + 9


# --- lookups ------------------------------------------------------------------


@query(oracle(f"{_SCORED} WHERE prediction = 1", "scored"))
def filter_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.filter_alerts(scored_table(spark, sf_dir)).select(*_SCORED_COLUMNS)


@query(oracle(f"{_FLOWS} WHERE label = 1", "flows"))
def flows_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.flows_by_label(flows_table(spark, sf_dir), 1).select(*FLOW_COLUMNS)


@query(oracle(f"{_FLOWS} WHERE attack_type = 'SSH-Bruteforce'", "flows"))
def flows_by_attack_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookups.flows_by_attack_type(flows_table(spark, sf_dir), "SSH-Bruteforce")
    return rows.select(*FLOW_COLUMNS)


@query(oracle(
    f"{_FLOWS} WHERE src_ip_int = {_SOURCE} AND {_PERIOD} "
    "ORDER BY flow_start_time DESC, flow_id LIMIT 20",
    "flows",
))
def latest_flows_for_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookups.latest_flows_for_source(
        flows_table(spark, sf_dir), _SOURCE, _SINCE, _UNTIL, 20
    )
    return rows.select(*FLOW_COLUMNS)


@query(oracle(
    "SELECT src_ip_int, flow_start_time AS ingestion_time, flow_id, is_anomaly, anomaly_score "
    f"FROM scored WHERE src_ip_int = {_SOURCE} "
    "ORDER BY flow_start_time DESC, flow_id LIMIT 20",
    "scored",
))
def latest_predictions_for_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = scored_table(spark, sf_dir).withColumnRenamed("flow_start_time", "ingestion_time")
    rows = lookups.latest_predictions_for_source(stored, _SOURCE, n=20)
    return rows.select("src_ip_int", "ingestion_time", "flow_id", "is_anomaly", "anomaly_score")


@query(oracle(
    f"SELECT *, CASE WHEN anomaly_score < 0.5 THEN 'low' WHEN anomaly_score < 0.8 THEN 'medium' "
    f"ELSE 'high' END AS severity FROM ({_SCORED}) WHERE src_ip IN ('192.168.8.9', "
    f"'192.168.46.47') AND {_PERIOD} AND anomaly_score >= 0.5",
    "scored",
))
def dashboard_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookups.dashboard_filter(
        scored_table(spark, sf_dir), ["192.168.8.9", "192.168.46.47"], _SINCE, _UNTIL,
        ["medium", "high"],
    )
    return rows.select(*_SCORED_COLUMNS, "severity")


# --- aggregates ---------------------------------------------------------------

_TRAIN_BUCKET = "cast('0x' || substr(md5(cast({id} AS string) || '-42'), 1, 8) AS bigint) % 100"
_CLEANED = " AND ".join(f"{m} IS NOT NULL" for m in MEASURES)


def _stage(name: str, condition: str, source: str = "flows") -> str:
    return f"SELECT '{name}' AS stage, count(*) AS rows FROM {source} WHERE {condition}"


@query(oracle(
    " UNION ALL ".join([
        _stage("raw", "true", "raw_flows"),
        _stage("ready", "true"),
        _stage("cleaned", _CLEANED),
        _stage("train", f"{_CLEANED} AND {_TRAIN_BUCKET.format(id='flow_id')} < 80"),
        _stage("test", f"{_CLEANED} AND {_TRAIN_BUCKET.format(id='flow_id')} >= 80"),
    ]),
    "raw_flows", "flows",
))
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.row_counts(fx.raw_flows(spark, sf_dir), F.col("event_id"))


@query(oracle(
    "SELECT \"Label_Binaire\", count(*) AS rows, "
    "round(cast(100 AS double) * count(*) / sum(count(*)) OVER (), 6) AS percent FROM ("
    "SELECT CASE WHEN attack_type = 'Benign' THEN 0 ELSE 1 END AS \"Label_Binaire\" FROM flows "
    f"WHERE {_CLEANED}) GROUP BY 1",
    "flows",
))
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.class_distribution(
        training_data.training_set(flows_table(spark, sf_dir).select(*FLOW_COLUMNS))
    )


@query(oracle(
    "SELECT attack_type, count(*) AS rows FROM flows GROUP BY 1 "
    "ORDER BY rows DESC, attack_type LIMIT 10",
    "flows",
))
def top_attack_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_attack_types(flows_table(spark, sf_dir))


@query(oracle(
    "SELECT name AS attack_type, cast(sum(n) AS bigint) AS rows, "
    "round(cast(100 AS double) * sum(n) / (SELECT count(*) FROM flows), 6) AS percent FROM ("
    "SELECT CASE WHEN row_number() OVER (ORDER BY n DESC, attack_type) <= 2 THEN attack_type "
    "ELSE 'others' END AS name, n FROM (SELECT attack_type, count(*) AS n FROM flows "
    "WHERE attack_type <> 'Benign' GROUP BY 1)) GROUP BY 1",
    "flows",
))
def attack_breakdown_with_others(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.attack_breakdown_with_others(flows_table(spark, sf_dir), 2)


@query(oracle(
    "SELECT protocol, cast(sum(in_bytes) AS bigint) AS in_bytes, "
    "cast(sum(out_bytes) AS bigint) AS out_bytes, "
    "cast(sum(in_bytes + out_bytes) AS bigint) AS total_bytes, count(*) AS flows "
    "FROM flows GROUP BY 1",
    "flows",
))
def volume_by_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.volume_by_protocol(flows_table(spark, sf_dir))


@query(oracle(
    "SELECT src_ip, count(*) AS alerts, round(avg(anomaly_score), 6) AS mean_score FROM scored "
    "WHERE prediction = 1 GROUP BY 1 ORDER BY alerts DESC, mean_score DESC, src_ip LIMIT 10",
    "scored",
))
def top_suspicious_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_suspicious_ips(scored_table(spark, sf_dir))


_AUTH = (
    "SELECT {day} AS period_start, count(*) AS auth_flows, "
    "cast(sum(CASE WHEN try_cast(\"FTP_COMMAND_RET_CODE\" AS double) = 530 "
    "OR regexp_matches(lower(\"Attack\"), 'brute *force') THEN 1 ELSE 0 END) AS bigint) "
    "AS failed_flows FROM raw_flows WHERE \"L4_DST_PORT\" IN ('21', '22', '23', '3389') "
    "AND IPV4_SRC_ADDR IS NOT NULL AND IPV4_DST_ADDR IS NOT NULL {group}"
)


@query(oracle(
    "SELECT *, round(failed_flows / auth_flows, 6) AS failure_rate FROM ("
    + _AUTH.format(day="time_bucket(interval '1 day', ts)", group="GROUP BY 1")
    + " UNION ALL " + _AUTH.format(day="cast(NULL AS timestamp)", group="") + ")",
    "raw_flows",
))
def auth_failure_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_flows(spark, sf_dir)
    ready = raw.filter(F.col("IPV4_SRC_ADDR").isNotNull() & F.col("IPV4_DST_ADDR").isNotNull())
    flows = ready.select(
        number_from_text(F.col("L4_DST_PORT"), IntegerType()).alias("dst_port"),
        F.col("Attack").alias("attack_type"),
        F.col("ts").cast("timestamp").alias("flow_start_time"),
        number_from_text(F.col("FTP_COMMAND_RET_CODE"), IntegerType()).alias(
            "ftp_command_ret_code"
        ),
    )
    return reports.auth_failure_rate(flows)


@query(oracle(
    "SELECT time_bucket(interval '1 hour', flow_start_time) AS bucket_start, "
    "count(*) AS alerts FROM scored WHERE prediction = 1 GROUP BY 1",
    "scored",
))
def alert_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.alert_trend(scored_table(spark, sf_dir))


@query(oracle(
    " UNION ALL ".join(
        f"SELECT {i + 1} AS position, '{c}' AS column, 'string' AS type, count(*) AS rows, "
        f'count(*) - count("{c}") AS nulls FROM raw_flows'
        for i, c in enumerate(RAW_COLUMNS)
    ).replace("AS column", 'AS "column"'),
    "raw_flows",
))
def dataset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.dataset_profile(fx.raw_flows(spark, sf_dir).select(*RAW_COLUMNS))


@query(oracle(f"{_FLOWS} ORDER BY flow_id LIMIT 5", "flows"))
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.preview(flows_table(spark, sf_dir).select(*FLOW_COLUMNS), ["flow_id"])


@query(oracle(_FLOWS, "flows"))
def clustered_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_cluster_order(fx.flows(spark, sf_dir))


# --- packets and enrichment ---------------------------------------------------

_BUCKET_SQL = ", ".join(
    f"count(*) FILTER (WHERE pkt_len > {low} AND pkt_len <= {high}) AS {name}"
    for name, low, high in packet_ops.SIZE_BUCKETS
)
_SPAN = "cast(floor((epoch_us({b}) - epoch_us({a})) / 1000) AS bigint)"
_BUCKET_NAMES = ", ".join(name for name, _, _ in packet_ops.SIZE_BUCKETS)


def _direction_sql(side: str, mask: str) -> str:
    return (
        f"cast(coalesce(sum(pkt_len) FILTER (WHERE {mask}), 0) AS bigint) AS {side}_bytes, "
        f"count(*) FILTER (WHERE {mask}) AS {side}_pkts, "
        f"coalesce(bit_or(tcp_flags) FILTER (WHERE {mask}), 0) AS {side}_flags, "
        f"min(ts) FILTER (WHERE {mask}) AS {side}_first, "
        f"max(ts) FILTER (WHERE {mask}) AS {side}_last"
    )


def _throughput_sql(octets: str, millis: str) -> str:
    return f"cast({octets} // greatest({millis}, 1) * 8000 AS double)"


# The conversation's opener is found with a window over its packets, another way
# than the operator's.
ASSEMBLED_SQL = (
    "SELECT *, cast(in_bytes AS double) AS src_to_dst_second_bytes, "
    "cast(out_bytes AS double) AS dst_to_src_second_bytes, "
    f"{_throughput_sql('in_bytes', 'duration_in')} AS src_to_dst_avg_throughput, "
    f"{_throughput_sql('out_bytes', 'duration_out')} AS dst_to_src_avg_throughput FROM ("
    "SELECT first_src AS src_ip, first_dst AS dst_ip, first_sp AS src_port, first_dp AS dst_port, "
    "protocol, least(in_first, coalesce(out_first, in_first)) AS flow_start_time, "
    "in_bytes, in_pkts, out_bytes, out_pkts, in_flags AS client_tcp_flags, "
    "out_flags AS server_tcp_flags, in_flags | out_flags AS tcp_flags, "
    f"{_SPAN.format(a='first_ts', b='last_ts')} AS duration_ms, "
    f"{_SPAN.format(a='in_first', b='in_last')} AS duration_in, "
    f"coalesce({_SPAN.format(a='out_first', b='out_last')}, 0) AS duration_out, "
    "shortest_flow_pkt, longest_flow_pkt, shortest_flow_pkt AS min_ip_pkt_len, "
    f"longest_flow_pkt AS max_ip_pkt_len, {_BUCKET_NAMES} FROM ("
    "SELECT protocol, slice, pair, first_src, first_dst, first_sp, first_dp, "
    + _direction_sql("in", "src_ip = first_src AND src_port = first_sp") + ", "
    + _direction_sql("out", "src_ip <> first_src OR src_port <> first_sp")
    + ", min(ts) AS first_ts, max(ts) AS last_ts, min(pkt_len) AS shortest_flow_pkt, "
    f"max(pkt_len) AS longest_flow_pkt, {_BUCKET_SQL} FROM ("
    "SELECT *, first_value(src_ip) OVER w AS first_src, first_value(dst_ip) OVER w AS first_dst, "
    "first_value(src_port) OVER w AS first_sp, first_value(dst_port) OVER w AS first_dp FROM ("
    "SELECT *, time_bucket(interval '1 hour', ts) AS slice, "
    "least(src_ip || ':' || src_port, dst_ip || ':' || dst_port) || '-' || "
    "greatest(src_ip || ':' || src_port, dst_ip || ':' || dst_port) AS pair FROM packets) "
    "WINDOW w AS (PARTITION BY pair, protocol, slice ORDER BY ts)) "
    "GROUP BY protocol, slice, pair, first_src, first_dst, first_sp, first_dp))"
)


@query(oracle(ASSEMBLED_SQL, "packets"))
def assemble_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packet_ops.assemble_flows(fx.packets(spark, sf_dir), "1 hour")


# The same over gaps and islands: a new record after two silent hours, or with a new day.
SESSIONS_SQL = ASSEMBLED_SQL.replace(
    "SELECT *, time_bucket(interval '1 hour', ts) AS slice, ",
    "SELECT * EXCLUDE (opens), sum(opens) OVER (PARTITION BY pair, protocol, day ORDER BY ts) "
    "|| '/' || day AS slice FROM (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER ("
    "PARTITION BY pair, protocol, day ORDER BY ts)) <= 7200000000 THEN 0 ELSE 1 END AS opens FROM ("
    "SELECT *, date_trunc('day', ts) AS day, ",
).replace("AS pair FROM packets)", "AS pair FROM packets)))")


@query(oracle(SESSIONS_SQL, "packets"))
def assemble_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packet_ops.assemble_sessions(fx.packets(spark, sf_dir), "2 hours", "1 day")


@query(oracle(
    "SELECT src_ip, dst_ip, src_port, dst_port, protocol, min(ts) AS flow_start_time, "
    "cast(sum(pkt_len) AS bigint) AS in_bytes, count(*) AS in_pkts, "
    "bit_or(tcp_flags) AS tcp_flags, "
    f"{_SPAN.format(a='min(ts)', b='max(ts)')} AS duration_ms, {_BUCKET_SQL} FROM packets "
    "GROUP BY src_ip, dst_ip, src_port, dst_port, protocol, time_bucket(interval '1 hour', ts)",
    "packets",
))
def assemble_flows_one_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packet_ops.assemble_flows(fx.packets(spark, sf_dir), "1 hour", bidirectional=False)
    return rows.select(
        "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "flow_start_time",
        "in_bytes", "in_pkts", "tcp_flags", "duration_ms",
        *[name for name, _, _ in packet_ops.SIZE_BUCKETS],
    )


# Extractor records: one per packet of the TCP conversations, so flows have several
# candidates or none.
_FEATURE_ROWS = (
    "SELECT src_ip, dst_ip, src_port, dst_port, protocol, ts AS flow_start_time, "
    "pkt_len * 2 AS idle_mean, tcp_flags & 2 AS syn_seen FROM packets WHERE protocol = 6"
)


@query(oracle(
    "SELECT p.ts AS flow_start_time, p.src_ip, p.dst_ip, p.src_port, p.dst_port, p.protocol, "
    "p.pkt_len, f.idle_mean, f.syn_seen FROM packets p LEFT JOIN ("
    "SELECT *, time_bucket(interval '6 hours', flow_start_time) AS slice, row_number() OVER ("
    "PARTITION BY src_ip, dst_ip, src_port, dst_port, protocol, "
    "time_bucket(interval '6 hours', flow_start_time) ORDER BY flow_start_time DESC) AS rank "
    f"FROM ({_FEATURE_ROWS})) f ON p.src_ip = f.src_ip AND p.dst_ip = f.dst_ip "
    "AND p.src_port = f.src_port AND p.dst_port = f.dst_port AND p.protocol = f.protocol "
    "AND f.slice = time_bucket(interval '6 hours', p.ts) AND f.rank = 1",
    "packets",
))
def enrich_flows_with_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = fx.packets(spark, sf_dir)
    flows = packets.withColumnRenamed("ts", "flow_start_time").drop("tcp_flags")
    features = packets.filter("protocol = 6").selectExpr(
        "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "ts AS flow_start_time",
        "pkt_len * 2 AS idle_mean", "tcp_flags & 2 AS syn_seen",
    )
    return enrichment.enrich_flows_with_features(flows, features, slice="6 hours")


# Extractor records that were written some time after their packet, as those of a slow extractor.
_LATE_ROWS = (
    "SELECT src_ip, dst_ip, src_port, dst_port, protocol, "
    "ts + to_seconds(pkt_len * 60) AS flow_start_time, pkt_len * 2 AS idle_mean, "
    "tcp_flags & 2 AS syn_seen FROM packets WHERE tcp_flags % 3 = 0"
)
IN_RANGE_SQL = (
    "SELECT flow_start_time, src_ip, dst_ip, src_port, dst_port, protocol, pkt_len, idle_mean, "
    "syn_seen FROM (SELECT p.ts AS flow_start_time, p.src_ip, p.dst_ip, p.src_port, p.dst_port, "
    "p.protocol, p.pkt_len, f.idle_mean, f.syn_seen, row_number() OVER (PARTITION BY p.n ORDER BY "
    "abs(epoch_us(p.ts) - epoch_us(f.flow_start_time)), f.flow_start_time) AS rank "
    "FROM (SELECT *, row_number() OVER () AS n FROM packets) p "
    f"LEFT JOIN ({_LATE_ROWS}) f ON p.src_ip = f.src_ip AND p.dst_ip = f.dst_ip "
    "AND p.src_port = f.src_port AND p.dst_port = f.dst_port AND p.protocol = f.protocol "
    "AND abs(epoch_us(p.ts) - epoch_us(f.flow_start_time)) <= 21600000000) WHERE rank = 1"
)


def packet_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.packets(spark, sf_dir).withColumnRenamed("ts", "flow_start_time").drop("tcp_flags")


def late_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.packets(spark, sf_dir).filter("tcp_flags % 3 = 0").selectExpr(
        "src_ip", "dst_ip", "src_port", "dst_port", "protocol",
        "timestampadd(SECOND, pkt_len * 60, ts) AS flow_start_time",
        "pkt_len * 2 AS idle_mean", "tcp_flags & 2 AS syn_seen",
    )


@query(oracle(IN_RANGE_SQL, "packets"))
def enrich_flows_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest record of the 5-tuple, six hours away at most, before or after."""
    return enrichment.enrich_flows_in_range(
        packet_flows(spark, sf_dir), late_features(spark, sf_dir), within=21_600
    )


# --- upsert, samples, metrics -------------------------------------------------


@query(oracle(
    f"SELECT {fx.FLOW_LIST} FROM (SELECT *, row_number() OVER (PARTITION BY src_ip_int "
    "ORDER BY flow_start_time DESC, flow_id DESC) AS rank FROM flows) WHERE rank = 1",
    "flows",
))
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = flows_table(spark, sf_dir).select(*FLOW_COLUMNS)
    return upsert.keyed_upsert(flows, ["src_ip_int"], ["flow_start_time", "flow_id"])


_RANK = "cast('0x' || substr(md5(cast(flow_id AS string) || '-42'), 1, 15) AS bigint)"


@query(oracle(f"{_FLOWS} ORDER BY {_RANK}, flow_id LIMIT 4000", "flows"))
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.hash_sample(flows_table(spark, sf_dir).select(*FLOW_COLUMNS), 4000)


@query(oracle(
    "SELECT (SELECT least(500, count(*)) FROM flows) AS rows, "
    "(SELECT count(DISTINCT flow_id % 8) FROM flows) AS keys_met",
    "flows",
))
def hash_sample_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight keys only, so each holds far more rows than any share of the sample."""
    flows = flows_table(spark, sf_dir).select(*FLOW_COLUMNS)
    few = flows.withColumn("key", F.col("flow_id") % 8)
    sample = sampling.hash_sample(few, 500, ["key"])
    every = sampling.hash_sample(few, few.count() + 1, ["key"])
    return sample.agg(F.count(F.lit(1)).alias("rows")).crossJoin(
        every.agg(F.count_distinct("key").alias("keys_met"))
    )


@query(oracle(
    f"SELECT {fx.FLOW_LIST} FROM (SELECT *, row_number() OVER (PARTITION BY attack_type "
    f"ORDER BY {_RANK}, flow_id) AS place FROM flows) WHERE place <= CASE attack_type "
    "WHEN 'Benign' THEN 300 WHEN 'SSH-Bruteforce' THEN 100000 ELSE 50 END",
    "flows",
))
def class_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact numbers of four classes, one of which has fewer rows than asked for."""
    flows = flows_table(spark, sf_dir).select(*FLOW_COLUMNS)
    return sampling.class_sample(flows, "attack_type", {
        "Benign": 300, "SSH-Bruteforce": 100_000, "DDoS attacks-LOIC-HTTP": 50,
        "DoS attacks-Hulk": 50, "Infiltration": 50,
    })


@query(oracle("SELECT json FROM messages ORDER BY json LIMIT 1000", "messages"))
def limit_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.limit_batch(received_texts(spark, sf_dir), 1000, ["json"])


@query(oracle(
    f"SELECT flow_id, CASE WHEN {_TRAIN_BUCKET.format(id='flow_id')} < 80 THEN 'train' "
    "ELSE 'test' END AS side FROM flows",
    "flows",
))
def split_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flows_table(spark, sf_dir).select("flow_id")
    train, test = training_data.split_train_test(rows)
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )


@query(oracle(
    "SELECT avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END) AS accuracy FROM scored",
    "scored",
))
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.accuracy(scored_table(spark, sf_dir), "label")


@query(oracle(
    "SELECT round((sum(CASE WHEN label = 1 THEN rank ELSE 0 END) "
    "- sum(label) * (sum(label) + 1) / 2) / (sum(label) * (count(*) - sum(label))), 9) AS auc "
    "FROM (SELECT cast(label AS double) AS label, rank() OVER (ORDER BY anomaly_score) "
    "+ (count(*) OVER (PARTITION BY anomaly_score) - 1) / 2 AS rank FROM scored)",
    "scored",
))
def auc_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = metrics.auc_roc(scored_table(spark, sf_dir), "label")
    return area.select(F.round("auc", 9).alias("auc"))
