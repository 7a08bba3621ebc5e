"""Raw flow text to the canonical typed flow table. Narrow work only: one scan,
one projection, no shuffle. Each step serves batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.addresses import ipv4_to_long
from flowloom.functions.fields import number_from_text
from flowloom.functions.labels import derive_label
from flowloom.schemas import FLOW_COLUMNS, MEASURES


def drop_missing_ips(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("IPV4_SRC_ADDR").isNotNull() & F.col("IPV4_DST_ADDR").isNotNull())


def trim_ips(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "src_ip": F.trim("IPV4_SRC_ADDR"),
        "dst_ip": F.trim("IPV4_DST_ADDR"),
    })


def add_ip_integers(flows: DataFrame) -> DataFrame:
    return flows.withColumns({
        "src_ip_int": ipv4_to_long(F.col("src_ip")),
        "dst_ip_int": ipv4_to_long(F.col("dst_ip")),
    })


def cast_flow_types(raw: DataFrame) -> DataFrame:
    """The 19 measures under their canonical names and types. A raw column of the
    same name, whatever its case, is replaced."""
    return raw.withColumns({
        name: number_from_text(F.col(source), dtype) for name, (source, dtype) in MEASURES.items()
    })


def label_flows(raw: DataFrame) -> DataFrame:
    return raw.withColumn("label", derive_label(F.col("Label")))


def rename_attack(raw: DataFrame) -> DataFrame:
    return raw.withColumnRenamed("Attack", "attack_type")


def stamp_ingestion(
    df: DataFrame, name: str = "ingestion_time", clock: Column | None = None
) -> DataFrame:
    """Add the load time, or the time ``clock`` gives."""
    return df.withColumn(name, F.current_timestamp() if clock is None else clock)


# Bits of a generated id for (load or batch number, partition, row), below the bit that
# tells streams from loads.
LOAD_BITS = (12, 23, 27)
STREAM_BITS = (28, 13, 21)


def assign_flow_id(
    df: DataFrame, source: Column | None = None, load: int = 0, stream: bool = False
) -> DataFrame:
    """Add a 64-bit id: ``source`` if the data has one, else unique but not dense.

    Generated ids hold the number of the load (of the micro-batch, with ``stream``), which
    the caller counts, then partition and row, so no two loads or batches share one. They
    depend on the partitioning; write the result before using it twice.
    """
    if source is not None:
        return df.withColumn("flow_id", source.cast("bigint"))
    bits, part_bits, row_bits = STREAM_BITS if stream else LOAD_BITS
    if not 0 <= load < 1 << bits:
        raise ValueError(f"load number {load} does not fit {bits} bits")
    base = (int(stream) << (bits + part_bits + row_bits)) + (load << (part_bits + row_bits))
    part = F.shiftright("flow_id", 33)
    row = F.col("flow_id").bitwiseAND(F.lit((1 << 33) - 1))
    fits = (part < F.lit(1 << part_bits)) & (row < F.lit(1 << row_bits))
    placed = F.lit(base) + part * F.lit(1 << row_bits) + row
    return df.withColumn("flow_id", F.monotonically_increasing_id()).withColumn(
        "flow_id",
        F.when(fits, placed).otherwise(F.raise_error(F.lit("too many rows for one load's ids"))),
    )


def assign_uuid(df: DataFrame, name: str = "id") -> DataFrame:
    """Add a random text UUID; write the result before using it twice."""
    return df.withColumn(name, F.uuid())


def canonical_projection(flows: DataFrame) -> DataFrame:
    return flows.select(*FLOW_COLUMNS)


def clean_flows(
    raw: DataFrame, flow_id: Column | None = None, flow_time: Column | None = None, load: int = 0
) -> DataFrame:
    """Raw 45-column text to the 27 canonical columns. ``load`` numbers the load that
    generated ids belong to."""
    return (
        raw.transform(drop_missing_ips)
        .transform(trim_ips)
        .transform(add_ip_integers)
        .transform(cast_flow_types)
        .transform(label_flows)
        .transform(rename_attack)
        .transform(stamp_ingestion, "flow_start_time", flow_time)
        .transform(assign_flow_id, flow_id, load)
        .transform(canonical_projection)
    )
