"""Messages to history, predictions and alerts: one query, one scoring, one clock.

A micro-batch may run again after a failure. Its clock is fixed by the query's log,
every output replaces what an earlier try of the same batch wrote, and flow ids are
frozen by the history write before anything else reads them.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowloom.functions.addresses import ipv4_to_long
from flowloom.functions.labels import binary_label
from flowloom.functions.messages import (
    decode_value,
    encode_alert,
    flag_readable,
    parse_flow_json,
    split_malformed,
)
from flowloom.operators.cleaning import assign_flow_id, canonical_projection, stamp_ingestion
from flowloom.operators.lookups import filter_alerts
from flowloom.schemas import FLOW, PREDICTION_COLUMNS
from flowloom.sources.documents import index_documents
from flowloom.sources.topics import Topic, publish_messages

log = logging.getLogger(__name__)

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Outputs:
    """Where a scoring query writes. Table folders get one ``batch_id`` partition per
    micro-batch; ``documents`` is a search index or folder, written best effort: what
    could not be written is named in the table ``index_failures`` (beside ``rejects`` unless
    given), for a retry to read."""

    history: str
    predictions: str
    alerts: Topic
    rejects: str
    fmt: str = "parquet"
    documents: str | None = None
    documents_fmt: str = "json"
    index_failures: str | None = None

    def __post_init__(self) -> None:
        if self.index_failures is None:
            object.__setattr__(self, "index_failures", f"{self.rejects}_index_failures")


def batch_path(folder: str, batch_id: int) -> str:
    return f"{folder}/batch_id={batch_id}"


def flows_from_messages(
    parsed: DataFrame, batch_id: int, time: str = "ingestion_time"
) -> DataFrame:
    """Parsed messages as canonical flows, cleaned as a load is: without rows that lack an
    address, trimmed addresses, integers recomputed where the sender left them out, the
    ingestion time as flow time, a label if the sender named the attack type."""
    given = parsed.filter(F.col("src_ip").isNotNull() & F.col("dst_ip").isNotNull())
    trimmed = given.withColumns({"src_ip": F.trim("src_ip"), "dst_ip": F.trim("dst_ip")})
    return (
        trimmed.withColumns({
            "src_ip_int": F.coalesce("src_ip_int", ipv4_to_long(F.col("src_ip"))),
            "dst_ip_int": F.coalesce("dst_ip_int", ipv4_to_long(F.col("dst_ip"))),
            "flow_start_time": F.col(time),
            "label": F.when(
                F.col("attack_type").isNotNull(), binary_label(F.col("attack_type"))
            ),
        })
        .transform(assign_flow_id, None, batch_id, True)
        .transform(canonical_projection)
    )


def _replace_batch(df: DataFrame, folder: str, batch_id: int, fmt: str) -> None:
    df.write.format(fmt).mode("overwrite").save(batch_path(folder, batch_id))


def stream_flows_sink(
    flows: DataFrame, batch_id: int, folder: str, fmt: str = "parquet"
) -> DataFrame:
    """Store the batch's canonical flows and return them as stored."""
    _replace_batch(flows, folder, batch_id, fmt)
    stored = flows.sparkSession.read.format(fmt).schema(FLOW)
    return stored.load(batch_path(folder, batch_id))


def predictions_from_scored(scored: DataFrame) -> DataFrame:
    """The eleven prediction columns and the flow id that completes their key."""
    return scored.withColumnRenamed("flow_start_time", "ingestion_time").select(
        *PREDICTION_COLUMNS, "flow_id"
    )


def stream_predictions_sink(
    scored: DataFrame, batch_id: int, folder: str, fmt: str = "parquet"
) -> None:
    """Store the batch's predictions. The key holds the flow id, which no two flows share,
    so there is one per key as it is."""
    _replace_batch(predictions_from_scored(scored), folder, batch_id, fmt)


def stream_alerts_sink(scored: DataFrame, batch_id: int, topic: Topic) -> None:
    """Send the batch's alerts, keyed by flow where the topic has keys."""
    alerts = scored.transform(filter_alerts).withColumnRenamed("flow_start_time", "ingestion_time")
    publish_messages(encode_alert(alerts, "flow_id"), topic, batch_id, key="flow_id")


def fan_out(
    flows: DataFrame, batch_id: int, scorer: Transform, outputs: Outputs,
    enrich: Transform | None = None,
) -> None:
    """Write one batch of canonical flows to every output, scoring it once."""
    stored = stream_flows_sink(flows, batch_id, outputs.history, outputs.fmt)
    prepared = stored if enrich is None else enrich(stored)
    counts = Observation(f"scored-{batch_id}")
    scored = (
        scorer(prepared)
        .observe(counts, F.count(F.lit(1)).alias("rows"))
        .select(*FLOW.names, "prediction", "is_anomaly", "anomaly_score")
        .persist()
    )
    try:
        stream_predictions_sink(scored, batch_id, outputs.predictions, outputs.fmt)
        log.info("batch %s: %s flows scored", batch_id, counts.get["rows"])
        stream_alerts_sink(scored, batch_id, outputs.alerts)
        if outputs.documents is not None:
            index_documents(
                stored, batch_path(outputs.documents, batch_id), outputs.documents_fmt,
                best_effort=True, mode="overwrite", failures=outputs.index_failures,
            )
    finally:
        scored.unpersist()


def score_messages(
    texts: DataFrame, batch_id: int, scorer: Transform, outputs: Outputs,
    enrich: Transform | None = None,
) -> None:
    """One batch of (json, ingestion_time): rejects aside, the rest to every output."""
    texts = flag_readable(texts).persist()
    try:
        readable, rejected = split_malformed(texts)
        _replace_batch(rejected, outputs.rejects, batch_id, outputs.fmt)
        flows = readable.transform(parse_flow_json).transform(flows_from_messages, batch_id)
        fan_out(flows, batch_id, scorer, outputs, enrich)
    finally:
        texts.unpersist()


def realtime_scoring(
    messages: DataFrame, scorer: Transform, outputs: Outputs, checkpoint: str,
    enrich: Transform | None = None, once: bool = False, interval: str = "10 seconds",
) -> StreamingQuery:
    """Start the scoring query over a message stream.

    ``scorer`` adds prediction, is_anomaly and anomaly_score, usually
    ``score_batch`` with a loaded model; ``enrich`` runs before it. ``once`` works off
    what is there and stops; else a batch starts every ``interval``.
    """
    stamped = messages.transform(decode_value).transform(stamp_ingestion)

    def run(texts: DataFrame, batch_id: int) -> None:
        score_messages(texts, batch_id, scorer, outputs, enrich)

    writer = stamped.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    trigger = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return trigger.start()
