"""The stream's history: batch folders compacted into the day partitions of the flow table.

A compaction writes a run of its own and then, as one small file, the range of batches in it.
Readers take the runs that are listed and the batch folders that no range holds, by a filter on
the partition column, so a compaction that dies half way changes nothing, and no flow is read
twice or lost. The next compaction deletes the folders: readers that began before the list was
written have had that long to end.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from flowloom.schemas import FLOW, FLOW_COLUMNS
from flowloom.session import child_names, drop_dir
from flowloom.sources.tables import STORED_PREDICTION, place_flows

Place = Callable[[DataFrame], tuple[DataFrame, str]]

MANIFEST = (
    StructType().add("run", StringType()).add("first", LongType()).add("last", LongType())
)


def _manifest(spark: SparkSession, compacted: str) -> list[tuple[str, int, int]]:
    """Runs and the batches in them: one row a compaction for each unbroken range."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{compacted}/manifest").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [(r["run"], r["first"], r["last"]) for r in rows]


def _joined(parts: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges that touch as one: as few as the gaps between them leave, whatever their number."""
    found: list[tuple[int, int]] = []
    for first, last in sorted(parts):
        if found and first <= found[-1][1] + 1:
            found[-1] = (found[-1][0], max(last, found[-1][1]))
        else:
            found.append((first, last))
    return found


def _within(parts: Iterable[tuple[int, int]]) -> Column:
    return reduce(or_, [F.col("batch_id").between(a, b) for a, b in parts], F.lit(False))


def _batch_ids(spark: SparkSession, folder: str) -> list[int]:
    """Batches that have a folder; the store is listed, no file is opened."""
    names = [re.fullmatch(r"batch_id=(\d+)", name) for name in child_names(spark, folder)]
    return sorted(int(name[1]) for name in names if name)


def compact_batches(
    spark: SparkSession, folder: str, compacted: str, schema: StructType, place: Place,
) -> int:
    """Compact all batch folders that no run holds yet, as ``place`` lays out their rows and
    names the column of the day; returns how many. Folders of earlier runs are deleted.

    Call it where no batch is being written, or between two of the stream: a batch that runs
    again after its compaction would be skipped by readers in favour of the compacted copy.
    """
    done = _joined((first, last) for _, first, last in _manifest(spark, compacted))
    present = _batch_ids(spark, folder)
    held = [b for b in present if any(first <= b <= last for first, last in done)]
    pending = sorted(set(present) - set(held))
    if pending:
        run = uuid.uuid4().hex
        fresh = spark.read.schema(schema).option("basePath", folder).parquet(
            *[f"{folder}/batch_id={b}" for b in pending]
        )
        rows, day = place(fresh.drop("batch_id"))
        rows.write.partitionBy(day).parquet(f"{compacted}/runs/run={run}")
        spark.createDataFrame(
            [(run, first, last) for first, last in _joined((b, b) for b in pending)], MANIFEST
        ).coalesce(1).write.mode("append").parquet(f"{compacted}/manifest")
    for batch in held:
        drop_dir(spark, f"{folder}/batch_id={batch}")
    return len(pending)


def read_batches(
    spark: SparkSession, folder: str, compacted: str, schema: StructType, place: Place,
) -> DataFrame:
    """All rows of the batches, with their day: compacted runs, and the folders not in one."""
    listed = _manifest(spark, compacted)
    with_id = StructType([*schema.fields]).add("batch_id", LongType())
    fresh = spark.read.schema(with_id).parquet(folder).filter(
        ~_within(_joined((first, last) for _, first, last in listed))
    )
    rows, day = place(fresh.drop("batch_id"))
    rows = rows.select(*schema.names, day)
    if not listed:
        return rows
    stored = spark.read.option("basePath", f"{compacted}/runs").parquet(
        *sorted({f"{compacted}/runs/run={run}" for run, _, _ in listed})
    )
    return stored.select(*rows.columns).unionByName(rows)


def _dated_flows(rows: DataFrame) -> tuple[DataFrame, str]:
    return rows.withColumn("flow_date", F.to_date("flow_start_time")), "flow_date"


def _placed_flows(rows: DataFrame) -> tuple[DataFrame, str]:
    return place_flows(rows.select(*FLOW_COLUMNS)), "flow_date"


def _dated_predictions(rows: DataFrame) -> tuple[DataFrame, str]:
    return rows.withColumn("ingestion_date", F.to_date("ingestion_time")), "ingestion_date"


def _placed_predictions(rows: DataFrame) -> tuple[DataFrame, str]:
    dated, day = _dated_predictions(rows.select(*STORED_PREDICTION.names))
    keys = ("src_ip_int", "ingestion_time", "flow_id")
    return dated.repartitionByRange(day, *keys).sortWithinPartitions(
        day, "src_ip_int", F.desc("ingestion_time"), "flow_id"
    ), day


def compact_history(spark: SparkSession, history: str, compacted: str) -> int:
    """compact_batches() of the stream's flows, in the layout of the flow table."""
    return compact_batches(spark, history, compacted, FLOW, _placed_flows)


def read_history(spark: SparkSession, history: str, compacted: str) -> DataFrame:
    """All flows of the history, with their day."""
    return read_batches(spark, history, compacted, FLOW, _dated_flows)


def compact_predictions(spark: SparkSession, predictions: str, compacted: str) -> int:
    """compact_batches() of the stream's predictions, by day, source and newest first."""
    return compact_batches(
        spark, predictions, compacted, STORED_PREDICTION, _placed_predictions
    )


def read_predictions(spark: SparkSession, predictions: str, compacted: str) -> DataFrame:
    """All predictions of the stream, with their day."""
    return read_batches(spark, predictions, compacted, STORED_PREDICTION, _dated_predictions)
