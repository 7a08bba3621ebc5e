"""The two earlier ingestion jobs: a stream and a batch of legacy messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from flowloom.functions.messages import decode_value, parse_legacy_json, split_malformed
from flowloom.operators.cleaning import assign_uuid
from flowloom.operators.normalize import legacy_from_documents
from flowloom.session import run_dir
from flowloom.sources.documents import index_documents
from flowloom.sources.tables import legacy_flow_insert
from flowloom.sources.topics import Topic, batch_messages


def legacy_stream_ingest(
    messages: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", once: bool = False
) -> StreamingQuery:
    """Five-field messages, each under a new UUID, appended to a table. The file sink
    commits each batch once, so a retried batch leaves one set of ids."""
    rows = messages.transform(decode_value).transform(parse_legacy_json).transform(assign_uuid)
    writer = (
        rows.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def legacy_batch_load(
    spark: SparkSession, topic: Topic, documents: str, table: str,
    failures: str | None = None,
) -> DataFrame:
    """All messages of a topic to the search index, best effort (``failures`` names what it
    lacks, beside ``table`` unless given), and to the ten-column table. Returns the undecodable ones, which are skipped.

    The topic is read once, into the shared folder, so that the three outputs agree
    however much arrives meanwhile.
    """
    staged = run_dir(spark, "legacy-batch-read")
    batch_messages(spark, topic).transform(decode_value).write.parquet(staged)
    readable, rejected = split_malformed(spark.read.parquet(staged))
    index_documents(
        readable, documents, "text", best_effort=True,
        failures=failures or f"{table}_index_failures",
    )
    legacy_flow_insert(legacy_from_documents(readable), table)
    return rejected
