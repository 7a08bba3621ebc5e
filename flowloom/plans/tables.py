"""Queries over sources and sinks: written to the shared folder, read back, returned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from flowloom.functions import messages as fn
from flowloom.operators import cleaning, normalize, training_data
from flowloom.plans import fixtures as fx
from flowloom.plans.cleaning import EXPORT_SQL, TRAINING_SQL
from flowloom.plans.fixtures import oracle
from flowloom.plans.messages import PARSED_SQL
from flowloom.plans.registry import query
from flowloom.plans.stored import flows_table, message_topic, scored_table
from flowloom.schemas import (
    FIVE_TUPLE,
    FLOW,
    FLOW_COLUMNS,
    LEGACY_FLOW,
    MESSAGE,
    RAW_COLUMNS,
)
from flowloom.session import run_dir
from flowloom.sources import csvs, documents, layout, tables, topics
from flowloom.streaming.realtime import predictions_from_scored

_FLOWS = f"SELECT {fx.FLOW_LIST} FROM flows"


# --- sources ------------------------------------------------------------------


def write_raw_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    rows = fx.raw_flows(spark, sf_dir).select(*RAW_COLUMNS)
    # The planted padding must survive the file.
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)


@query(oracle(f"SELECT {fx.RAW_LIST} FROM raw_flows", "raw_flows"))
def read_raw_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "raw-csv")
    write_raw_csv(spark, sf_dir, path)
    return csvs.read_raw_csv(spark, path)


@query(oracle(f"SELECT {fx.RAW_LIST} FROM raw_flows", "raw_flows"))
def read_raw_csv_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one folder with their columns in two orders."""
    path = run_dir(spark, "raw-csv-orders")
    rows = fx.raw_flows(spark, sf_dir)
    for rest, names in ((0, RAW_COLUMNS), (1, RAW_COLUMNS[::-1])):
        rows.filter(F.col("event_id") % 2 == rest).select(*names).write.option(
            "header", True
        ).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        ).mode("append").csv(path)
    return csvs.read_raw_csv(spark, path)


@query(oracle(EXPORT_SQL, "flow_export"))
def read_flow_export_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one folder with two headers, both known."""
    path = run_dir(spark, "export-csv-mixed")
    rows = fx.flow_export(spark, sf_dir)
    first = F.crc32(F.coalesce(F.col("DstPort"), F.lit("")).cast("binary")) % 2 == 0
    other = rows.filter(~first).select(*rows.columns[::-1]).withColumnsRenamed(
        {"Src Addr": "sa", "DstAddr": "da", "Prot": "pr", "Bytes": "ibyt", "Flags": "flg"}
    )
    for part in (rows.filter(first), other):
        part.write.option("header", True).mode("append").csv(path)
    return csvs.read_flow_export(spark, path)


@query(oracle(EXPORT_SQL, "flow_export"))
def export_to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collector export to messages in a topic, read back as any consumer does."""
    base = run_dir(spark, "export-topic")
    fx.flow_export(spark, sf_dir).write.option("header", True).csv(f"{base}/in")
    topic = topics.Topic("exports", base, "parquet")
    csvs.publish_flow_export(spark, f"{base}/in", topic)
    received = topics.batch_messages(spark, topic)
    return received.transform(fn.decode_value).transform(fn.parse_flow_json)


_TUPLE = ", ".join(FIVE_TUPLE)


@query(oracle(
    f"SELECT {', '.join('e.' + c for c in FIVE_TUPLE)}, e.in_pkts, e.in_bytes, f.idle_mean "
    f"FROM ({EXPORT_SQL}) e LEFT JOIN (SELECT {_TUPLE}, cast(max(in_bytes) AS bigint) AS idle_mean "
    f"FROM ({EXPORT_SQL}) WHERE in_pkts % 2 = 0 GROUP BY {_TUPLE}) f ON "
    + " AND ".join(f"e.{c} IS NOT DISTINCT FROM f.{c}" for c in FIVE_TUPLE),
    "flow_export",
))
def export_to_topic_with_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same chain joined with the extractor's features, which have no time here."""
    base = run_dir(spark, "export-features")
    export = fx.flow_export(spark, sf_dir)
    export.write.option("header", True).csv(f"{base}/in")
    features = normalize.normalize_flow_export(export).filter("in_pkts % 2 = 0").groupBy(
        *FIVE_TUPLE
    ).agg(F.max("in_bytes").alias("idle_mean"))
    topic = topics.Topic("exports", base, "parquet")
    csvs.publish_flow_export(spark, f"{base}/in", topic, features)
    kind = StructType([*MESSAGE.fields, StructField("idle_mean", LongType())])
    texts = topics.batch_messages(spark, topic).transform(fn.decode_value)
    return texts.select(F.from_json("json", kind).alias("row")).select("row.*").select(
        *FIVE_TUPLE, "in_pkts", "in_bytes", "idle_mean"
    )


@query(oracle(_FLOWS, "flows"))
def read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "orc-flows")
    fx.flows(spark, sf_dir).write.orc(path)
    return tables.read_table(spark, path, "orc", FLOW)


@query(oracle(PARSED_SQL, "flows"))
def batch_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    received = topics.batch_messages(spark, message_topic(spark, sf_dir))
    return received.transform(fn.decode_value).transform(fn.parse_flow_json)


@query(oracle(EXPORT_SQL, "flow_export"))
def read_flow_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "export-csv")
    fx.flow_export(spark, sf_dir).write.option("header", True).csv(path)
    return csvs.read_flow_export(spark, path)


@query(oracle(
    "SELECT ts, src_ip, dst_ip, src_port, dst_port, protocol, pkt_len, "
    "CASE WHEN protocol = 6 THEN tcp_flags ELSE 0 END AS tcp_flags FROM packets",
    "packets",
))
def read_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "packet-csv")
    tcp = F.col("protocol") == 6
    fx.packets(spark, sf_dir).select(
        (F.unix_micros("ts") / 1000000).alias("frame.time_epoch"),
        F.col("src_ip").alias("ip.src"), F.col("dst_ip").alias("ip.dst"),
        F.when(tcp, F.col("src_port")).alias("tcp.srcport"),
        F.when(tcp, F.col("dst_port")).alias("tcp.dstport"),
        F.when(~tcp, F.col("src_port")).alias("udp.srcport"),
        F.when(~tcp, F.col("dst_port")).alias("udp.dstport"),
        F.col("protocol").alias("ip.proto"), F.col("pkt_len").alias("frame.len"),
        F.when(tcp, F.col("tcp_flags")).alias("tcp.flags"),
    ).write.option("header", True).csv(path)
    return csvs.read_packets(spark, path)


# --- sinks --------------------------------------------------------------------


@query(oracle(_FLOWS, "flows"))
def write_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "flows")
    tables.write_flows(fx.flows(spark, sf_dir), path)
    return tables.read_table(spark, path).select(*FLOW_COLUMNS)


@query(oracle(
    f"SELECT {fx.FLOW_LIST}, cast(flow_start_time AS date) AS flow_date FROM flows", "flows"
))
def table_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "clustered")
    tables.write_clustered(fx.flows(spark, sf_dir), path)
    return spark.read.parquet(path)


@query(oracle(
    f"SELECT {fx.FLOW_LIST}, cast(flow_start_time AS date) AS flow_date FROM flows", "flows"
))
def write_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow table in the common order of source, destination and time."""
    path = run_dir(spark, "ordered")
    layout.write_ordered(flows_table(spark, sf_dir).select(*FLOW_COLUMNS), path)
    return spark.read.parquet(path)


@query(oracle(
    f"SELECT {fx.FLOW_LIST} FROM flows WHERE attack_type = 'SSH-Bruteforce' "
    f"UNION ALL SELECT {fx.FLOW_LIST} FROM flows WHERE label = 1", "flows",
))
def rows_with_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookups by attack type and label through postings, of which the second lacks some files."""
    path = run_dir(spark, "posted")
    flows = flows_table(spark, sf_dir).select(*FLOW_COLUMNS)
    early = F.col("flow_id") % 3 == 0
    tables.write_flows(flows.filter(early), path)
    layout.post_values(spark, path)
    tables.write_flows(flows.filter(~early), path)
    by_label = layout.rows_with_value(spark, path, "label", 1)
    layout.post_values(spark, path)
    by_type = layout.rows_with_value(spark, path, "attack_type", "SSH-Bruteforce")
    return by_type.select(*FLOW_COLUMNS).unionByName(by_label.select(*FLOW_COLUMNS))


@query(oracle(
    f"SELECT {fx.FLOW_LIST}, cast(flow_start_time AS date) AS flow_date FROM flows", "flows"
))
def one_flow_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow table filled by a load, by an append and by rewriting one day, then read
    through the catalog table over the same files."""
    location = run_dir(spark, "one-table")
    database = "one_" + location.rsplit("-", 1)[1]
    tables.create_tables(spark, database, location)
    flows, path = flows_table(spark, sf_dir).select(*FLOW_COLUMNS), f"{location}/flows"
    early = F.col("flow_id") % 3 == 0
    tables.write_clustered(flows.filter(early), path)
    tables.write_flows(flows.filter(~early), path)
    last = flows.agg(F.max(F.to_date("flow_start_time"))).first()[0]
    tables.write_clustered(flows.filter(F.to_date("flow_start_time") == F.lit(last)), path)
    spark.sql(f"MSCK REPAIR TABLE {database}.flows")
    return spark.table(f"{database}.flows")


@query(oracle(
    "SELECT 'flows' AS table_name, (SELECT count(*) FROM flows) AS rows, 28 AS columns, "
    "(SELECT cast(sum(in_bytes) AS bigint) FROM flows) AS in_bytes "
    "UNION ALL SELECT 'predictions', (SELECT count(*) FROM scored), 13, "
    "(SELECT cast(sum(in_bytes) AS bigint) FROM scored) "
    "UNION ALL SELECT 'legacy_flows', (SELECT count(*) FROM flows), 10, "
    "(SELECT cast(sum(in_bytes) AS bigint) FROM flows)",
    "flows", "scored",
))
def create_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables made twice, as the statement allows, then filled from the cleaned flows."""
    location = run_dir(spark, "store")
    database = "store_" + location.rsplit("-", 1)[1]
    tables.create_tables(spark, database, location)
    names = tables.create_tables(spark, database, location)
    flows = fx.flows(spark, sf_dir)
    rows = {
        "flows": flows.withColumn("flow_date", F.to_date("flow_start_time")),
        "predictions": predictions_from_scored(fx.scored_flows(spark, sf_dir)).withColumn(
            "ingestion_date", F.to_date("ingestion_time")
        ),
        "legacy_flows": normalize.legacy_from_canonical(flows)
        .transform(cleaning.assign_uuid).select(*LEGACY_FLOW.names),
    }
    counts = None
    for full_name in names:
        name = full_name.split(".")[1]
        rows[name].write.insertInto(full_name)
        table = spark.table(full_name)
        octets = "bytes_in" if name == "legacy_flows" else "in_bytes"
        one = table.agg(F.count(F.lit(1)).alias("rows"), F.sum(octets).alias("in_bytes")).select(
            F.lit(name).alias("table_name"), "rows",
            F.lit(len(table.columns)).alias("columns"), "in_bytes",
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query(oracle(
    # Attacks written over benign flows: per day and source the newest attack wins,
    # else the newest benign flow.
    "SELECT flow_date, src_ip_int, flow_id, label FROM (SELECT *, "
    "cast(flow_start_time AS date) AS flow_date, row_number() OVER (PARTITION BY src_ip_int, "
    "cast(flow_start_time AS date) ORDER BY label DESC, flow_start_time DESC, flow_id DESC) "
    "AS rank FROM flows) WHERE rank = 1",
    "flows",
))
def keyed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "upserted")
    flows = fx.flows(spark, sf_dir).withColumn("flow_date", F.to_date("flow_start_time"))
    keys, newest = ["flow_date", "src_ip_int"], ["flow_start_time", "flow_id"]
    for label in (0, 1):
        wave = flows.filter(F.col("label") == label)
        tables.upsert_table(wave, path, keys, newest, day="flow_date")
    stored = spark.read.parquet(path)
    return stored.select("flow_date", "src_ip_int", "flow_id", "label")


@query(oracle(f"SELECT {fx.MESSAGE_LIST} FROM flows", "flows"))
def publish_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = topics.Topic("published", run_dir(spark, "topics"), "parquet")
    rows = flows_table(spark, sf_dir).select(*MESSAGE.names)
    topics.publish_messages(fn.encode_row(rows), topic)
    received = topics.batch_messages(spark, topic)
    return received.transform(fn.decode_value).transform(fn.parse_flow_json)


_DOCUMENT = [c for c in FLOW_COLUMNS if c != "flow_start_time"]


@query(oracle(f"SELECT {', '.join(_DOCUMENT)} FROM flows", "flows"))
def index_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "documents")
    rows = flows_table(spark, sf_dir).select(*_DOCUMENT)
    documents.index_documents(rows, path)
    return spark.read.schema(rows.schema).json(path)


LEGACY_ROWS_SQL = (
    "SELECT src_ip, dst_ip AS dest_ip, src_port, dst_port AS dest_port, "
    "{protocol} AS protocol, in_bytes AS bytes_in, out_bytes AS bytes_out, "
    "in_pkts AS num_pkts_in, out_pkts AS num_pkts_out FROM {source}"
)


@query(oracle(LEGACY_ROWS_SQL.format(protocol="protocol", source="flows"), "flows"))
def legacy_flow_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "legacy-flows")
    tables.legacy_flow_insert(normalize.legacy_from_canonical(flows_table(spark, sf_dir)), path)
    return spark.read.schema(LEGACY_FLOW).parquet(path).drop("id")


@query(oracle(
    "SELECT label AS \"Label_Binaire\", prediction, "
    "CASE WHEN label = 0 THEN 'Benign' ELSE 'Attaque' END AS \"Label\", "
    "CASE WHEN prediction = 0 THEN 'Benign' ELSE 'Attaque' END AS \"Prédiction\" FROM scored",
    "scored",
))
def export_predictions_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "report-csv")
    csvs.export_predictions_csv(scored_table(spark, sf_dir), path, "label")
    schema = "Label_Binaire int, prediction double, Label string, `Prédiction` string"
    return spark.read.schema(schema).option("header", True).csv(path)


@query(oracle(TRAINING_SQL, "flows"))
def export_clean_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "clean-csv")
    rows = training_data.training_set(flows_table(spark, sf_dir).select(*FLOW_COLUMNS))
    csvs.export_clean_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)

