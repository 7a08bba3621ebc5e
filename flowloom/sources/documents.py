"""Search documents: one JSON document per record."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def index_documents(
    documents: DataFrame, target: str, fmt: str = "json", best_effort: bool = False,
    mode: str = "append", failures: str | None = None, **options: str,
) -> bool:
    """Write each row as a document; a search-engine connector takes its index as
    ``target``. With ``best_effort`` a failed write is logged, not raised, and recorded in
    the Parquet table ``failures`` (target, error, failed_at), from which a retry can tell
    what the index lacks."""
    try:
        documents.write.format(fmt).options(**options).mode(mode).save(target)
    except Exception as error:
        if not best_effort:
            raise
        log.exception("documents not indexed to %s", target)
        if failures is not None:
            spark = documents.sparkSession
            record = spark.createDataFrame([(target, str(error)[:1000])], "target string, error string")
            record.withColumn("failed_at", F.current_timestamp()).write.mode("append").parquet(
                failures
            )
        return False
    return True
