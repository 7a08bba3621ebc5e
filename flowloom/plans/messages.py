"""Queries over the JSON message functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions import messages as fn
from flowloom.plans import fixtures as fx
from flowloom.plans.fixtures import oracle
from flowloom.plans.registry import query
from flowloom.plans.stored import flows_table, message_topic, scored_table
from flowloom.schemas import ALERT, ALERT_COLUMNS, FLOW
from flowloom.sources.topics import batch_messages

# Messages that are not JSON parse to a row of nulls.
PARSED_SQL = "SELECT " + ", ".join(
    f"CASE WHEN flow_id % 61 <> 0 THEN {name} END AS {name}" for name in fx.MESSAGE.names
) + " FROM flows"
SENT_SQL = f"SELECT {fx.MESSAGE_LIST} FROM sent"


def received_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_messages(spark, message_topic(spark, sf_dir)).transform(fn.decode_value)


@query(oracle("SELECT json FROM messages", "messages"))
def decode_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return received_texts(spark, sf_dir)


@query(oracle(PARSED_SQL, "flows"))
def parse_flow_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return received_texts(spark, sf_dir).transform(fn.parse_flow_json)


_LEGACY = {
    "src_ip": "src_ip", "dest_ip": "dst_ip", "protocol": "cast(protocol AS string)",
    "bytes_in": "in_bytes", "bytes_out": "out_bytes",
}
LEGACY_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _LEGACY.items()) + " FROM flows"


def legacy_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flows_table(spark, sf_dir).selectExpr(*[f"{e} AS {n}" for n, e in _LEGACY.items()])
    return rows.select(F.to_json(F.struct("*")).alias("json"))


@query(oracle(LEGACY_SQL, "flows"))
def parse_legacy_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn.parse_legacy_json(legacy_texts(spark, sf_dir))


@query(oracle(
    "SELECT json, json <> 'not json' AS readable FROM messages", "messages"
))
def split_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = received_texts(spark, sf_dir)
    readable, rejected = fn.split_malformed(texts)
    return readable.withColumn("readable", F.lit(True)).unionByName(
        rejected.withColumn("readable", F.lit(False))
    )


_ALERT_FIELDS = [c for c in ALERT_COLUMNS if c != "ingestion_time"]


@query(oracle(
    f"SELECT {', '.join(_ALERT_FIELDS)}, "
    "date_trunc('milliseconds', flow_start_time) AS ingestion_time FROM scored",
    "scored",
))
def encode_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded, then read back field by field: JSON keeps times to the millisecond."""
    scored = scored_table(spark, sf_dir).withColumnRenamed("flow_start_time", "ingestion_time")
    values = fn.encode_alert(scored)
    return values.select(F.from_json("value", ALERT).alias("alert")).select("alert.*")


_ROW_FIELDS = [c for c in FLOW.names if c != "flow_start_time"]


@query(oracle(
    f"SELECT {', '.join(_ROW_FIELDS)}, 'flows.csv' AS source_file FROM flows", "flows"
))
def encode_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flows_table(spark, sf_dir).select(*_ROW_FIELDS)
    values = fn.encode_row(rows, F.lit("flows.csv"))
    schema = rows.schema.add("source_file", "string")
    return values.select(F.from_json("value", schema).alias("row")).select("row.*")
