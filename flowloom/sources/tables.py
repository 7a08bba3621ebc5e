"""Flow, prediction and legacy tables: create, read, write, physical layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from flowloom.operators.cleaning import assign_uuid
from flowloom.operators.upsert import keyed_upsert, merge_latest
from flowloom.schemas import FLOW, LEGACY_FLOW, PREDICTION
from flowloom.session import run_dir

STORED_PREDICTION = StructType([*PREDICTION.fields]).add("flow_id", LongType(), True)

# Table -> (columns, day column it is partitioned by).
TABLES: dict[str, tuple[StructType, str | None]] = {
    "flows": (FLOW, "flow_date"),
    "predictions": (STORED_PREDICTION, "ingestion_date"),
    "legacy_flows": (LEGACY_FLOW, None),
}



def create_tables(spark: SparkSession, database: str, location: str | None = None) -> list[str]:
    """Create the tables that are missing and return all their names.

    ``flows`` and ``predictions`` are partitioned by day, the compaction window of
    their time-ordered rows.
    """
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    names = []
    for name, (schema, day) in TABLES.items():
        columns = [f"{f.name} {f.dataType.simpleString()}" for f in schema.fields]
        if day:
            columns.append(f"{day} date")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({', '.join(columns)}) USING parquet"
            + (f" PARTITIONED BY ({day})" if day else "")
            + (f" LOCATION '{location}/{name}'" if location else "")
        )
        names.append(f"{database}.{name}")
    return names


def read_table(
    spark: SparkSession, name: str, fmt: str = "parquet", schema: StructType | None = None,
    **options: str,
) -> DataFrame:
    """Scan of a stored table. File formats take its path as ``name``; a store
    connector takes its own options and must be on the class path."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(name) if name else reader.load()


# Formats whose folders carry the partition column.
FILE_FORMATS = ("parquet", "orc", "json", "csv")


def clustered_order(flows: DataFrame) -> DataFrame:
    """Within each partition: by source, then newest first, then id."""
    return flows.sortWithinPartitions("src_ip_int", F.desc("flow_start_time"), "flow_id")


def place_flows(flows: DataFrame) -> DataFrame:
    """Canonical flows with their day, dealt out in the order of the flow table.

    By range of (day, source, time, id): a task holds few days and a contiguous run of
    sources, so file statistics prune on both, and a source that fills more than a task is
    split by time. The range needs a sample, so ``flows`` is read twice.
    """
    dated = flows.withColumn("flow_date", F.to_date("flow_start_time"))
    return dated.repartitionByRange(
        "flow_date", "src_ip_int", "flow_start_time", "flow_id"
    ).sortWithinPartitions("flow_date", "src_ip_int", F.desc("flow_start_time"), "flow_id")


def write_flows(
    flows: DataFrame, path: str, fmt: str = "parquet", metrics: Observation | None = None,
    **options: str,
) -> None:
    """Append canonical flows to the flow table; ``metrics`` receives the row count of the
    same job. A store connector gets them in their order, without the day column."""
    is_file = fmt in FILE_FORMATS
    rows = place_flows(flows) if is_file else flows.transform(clustered_order)
    if metrics is not None:
        rows = rows.observe(metrics, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.format(fmt).options(**options).mode("append")
    (writer.partitionBy("flow_date") if is_file else writer).save(path)


def write_clustered(flows: DataFrame, path: str) -> None:
    """Write whole days of the flow table: the days that ``flows`` holds are replaced, all
    others stay. Same layout as write_flows()."""
    (
        place_flows(flows).write.partitionBy("flow_date")
        .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    )


def upsert_table(
    incoming: DataFrame, path: str, keys: Sequence[str], newest_by: Sequence[str], day: str
) -> None:
    """Write ``incoming`` over a day-partitioned Parquet table, last write per key wins.
    The driver sees one value per day touched.

    ``day`` must be a function of the keys, so only the days that ``incoming`` touches
    are read and rewritten. Running it again changes nothing. ``incoming`` is stored first,
    as it is read more than once. Days change one after the other: a reader that must see
    all of them at once has to wait for the end of the call.
    """
    staged = run_dir(incoming.sparkSession, "upsert")
    incoming.write.parquet(staged)
    incoming = incoming.sparkSession.read.schema(incoming.schema).parquet(staged)
    days = [r[0] for r in incoming.select(day).distinct().collect()]
    if not days:
        return
    existing = _stored(incoming, path)
    if existing is not None:
        existing = existing.filter(F.col(day).isin(days))
    merged = (
        keyed_upsert(incoming, keys, newest_by)
        if existing is None
        else merge_latest(existing, incoming, keys, newest_by)
    )
    (
        merged.write.option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .mode("overwrite")
        .parquet(path)
    )


def _stored(like: DataFrame, path: str) -> DataFrame | None:
    try:
        return like.sparkSession.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def legacy_flow_insert(rows: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Append rows of the ten-column table, each under a new UUID."""
    stored = rows.transform(assign_uuid).select(*LEGACY_FLOW.names)
    stored.write.format(fmt).options(**options).mode("append").save(path)
