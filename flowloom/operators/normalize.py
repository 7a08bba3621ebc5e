"""Collector exports and earlier message formats to the canonical message."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.addresses import ipv4_to_long
from flowloom.functions.fields import (
    coerce_number,
    decode_tcp_flags,
    duration_to_ms,
    protocol_number,
)
from flowloom.functions.labels import BENIGN
from flowloom.schemas import LEGACY_FLOW, MESSAGE

# Header names a field may have, best first.
ALIASES: dict[str, list[str]] = {
    "src_ip": ["Src Addr", "SrcAddr", "sa", "src_ip"],
    "dst_ip": ["Dst Addr", "DstAddr", "da", "dst_ip", "dest_ip"],
    "src_port": ["Src Port", "SrcPort", "sp", "src_port"],
    "dst_port": ["Dst Port", "DstPort", "dp", "dst_port", "dest_port"],
    "protocol": ["Prot", "pr", "protocol"],
    "in_bytes": ["Bytes", "ibyt", "bytes_in", "in_bytes"],
    "out_bytes": ["obyt", "bytes_out", "out_bytes"],
    "in_pkts": ["Packets", "ipkt", "num_pkts_in", "pkt_in", "in_pkts"],
    "out_pkts": ["opkt", "num_pkts_out", "pkt_out", "out_pkts"],
    "duration": ["Dur", "Duration", "td"],
    "flags": ["Flags", "flg"],
}

# Fixed value: the application protocol of exports that do not name one.
DEFAULT_L7_PROTO = 7.0


def first_present(columns: Sequence[str], field: str) -> Column:
    """First non-blank value among the field's aliases that the input has."""
    found = [
        F.nullif(F.trim(F.col(f"`{alias}`").cast("string")), F.lit(""))
        for alias in ALIASES[field]
        if alias in columns
    ]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def normalize_flow_export(export: DataFrame) -> DataFrame:
    """Any known export header to the 24 message fields; what the export lacks
    gets the message default."""
    # Resolved in a projection of their own, as the conversions use them repeatedly.
    resolved = export.select(*[
        first_present(export.columns, field).alias(f"_{field}") for field in ALIASES
    ])
    given = {field: F.col(f"_{field}") for field in ALIASES}
    text_ip = {side: F.coalesce(given[side], F.lit("")) for side in ("src_ip", "dst_ip")}
    known = {
        **text_ip,
        "src_ip_int": ipv4_to_long(text_ip["src_ip"]),
        "dst_ip_int": ipv4_to_long(text_ip["dst_ip"]),
        "src_port": coerce_number(given["src_port"]),
        "dst_port": coerce_number(given["dst_port"]),
        "protocol": protocol_number(given["protocol"]),
        "l7_proto": F.lit(DEFAULT_L7_PROTO),
        "in_bytes": coerce_number(given["in_bytes"]),
        "out_bytes": coerce_number(given["out_bytes"]),
        "in_pkts": coerce_number(given["in_pkts"]),
        "out_pkts": coerce_number(given["out_pkts"]),
        "duration_ms": F.coalesce(duration_to_ms(given["duration"]), F.lit(0)),
        "tcp_flags": decode_tcp_flags(given["flags"]),
        "attack_type": F.lit(BENIGN),
    }
    return resolved.select(*[
        known.get(f.name, F.lit(0)).try_cast(f.dataType).alias(f.name) for f in MESSAGE.fields
    ])


def legacy_from_canonical(flows: DataFrame) -> DataFrame:
    """Canonical flows as rows of the ten-column table, id aside."""
    return flows.select(
        "src_ip",
        F.col("dst_ip").alias("dest_ip"),
        "src_port",
        F.col("dst_port").alias("dest_port"),
        "protocol",
        F.col("in_bytes").alias("bytes_in"),
        F.col("out_bytes").alias("bytes_out"),
        F.col("in_pkts").alias("num_pkts_in"),
        F.col("out_pkts").alias("num_pkts_out"),
    )


def legacy_from_documents(texts: DataFrame, column: str = "json") -> DataFrame:
    """JSON documents with any of the alias names as rows of the ten-column table,
    id aside. A zero or blank number gives way to the next alias."""
    fields = F.from_json(column, "map<string,string>")
    docs = texts.select(fields.alias("_doc"))

    def text(field: str) -> Column:
        return F.coalesce(*[
            F.nullif(F.col("_doc")[alias], F.lit("")) for alias in ALIASES[field]
        ])

    def number(field: str) -> Column:
        values = [coerce_number(F.col("_doc")[alias]) for alias in ALIASES[field]]
        return F.coalesce(*[F.nullif(v, F.lit(0)) for v in values], F.lit(0))

    sources = {
        "src_ip": text("src_ip"), "dest_ip": text("dst_ip"),
        "src_port": number("src_port"), "dest_port": number("dst_port"),
        "protocol": number("protocol"),
        "bytes_in": number("in_bytes"), "bytes_out": number("out_bytes"),
        "num_pkts_in": number("in_pkts"), "num_pkts_out": number("out_pkts"),
    }
    return docs.select(*[
        sources[f.name].try_cast(f.dataType).alias(f.name)
        for f in LEGACY_FLOW.fields
        if f.name in sources
    ])
