"""Alert counts per time bucket, kept up to date by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from flowloom.operators.reports import alert_trend


def stream_alert_trend(
    scored: DataFrame, path: str, checkpoint: str, bucket: str = "1 hour",
    watermark: str = "10 minutes", time: str = "flow_start_time", once: bool = False,
) -> StreamingQuery:
    """Append each bucket when the watermark has passed it; the state holds one
    counter per open bucket."""
    trend = alert_trend(scored, bucket, time, watermark)
    writer = (
        trend.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
