"""CSV in and out: labelled flows, collector exports, packets, reports."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowloom.functions.labels import decode_prediction
from flowloom.functions.messages import encode_row
from flowloom.operators.enrichment import enrich_flows_with_features
from flowloom.operators.normalize import normalize_flow_export
from flowloom.operators.packets import normalize_packets
from flowloom.operators.training_data import TARGET
from flowloom.schemas import PACKET_CSV, RAW
from flowloom.sources.topics import Topic, publish_messages

HEADER_READERS = 16


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a text file on any store, unpacked by its suffix; no more is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        text = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8")).readLine()
    finally:
        stream.close()


def files_by_header(spark: SparkSession, files: Iterable[str]) -> dict[str, list[str]]:
    """CSV files by their header line; empty files have none. The driver reads one line of
    each file, several files at a time."""
    files = list(files)
    found: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEADER_READERS) as readers:
        headers = readers.map(lambda file: first_line(spark, file), files)
        for file, header in zip(files, headers, strict=True):
            if header is not None:
                found.setdefault(header, []).append(file)
    return found


def _files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    return files_by_header(spark, map(unquote, spark.read.text(path).inputFiles()))


def read_csv_by_name(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The named columns of CSV files as text, wherever each file's own header has them.

    Files of one header are read together; a column that a file lacks is null. Names match
    exactly. Where there is no file with a header, there are no rows.
    """
    rows = None
    for _, files in sorted(_files_by_header(spark, path).items()):
        part = spark.read.option("header", True).csv(files)
        part = part.select(*[
            (F.col(f"`{c}`") if c in part.columns else F.lit(None)).cast("string").alias(c)
            for c in columns
        ])
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        rows = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
    return rows


def read_raw_csv(spark: SparkSession, path: str, schema: StructType = RAW) -> DataFrame:
    """Labelled flow CSV, every column text and found by its name: nothing is inferred."""
    return read_csv_by_name(spark, path, schema.names)


def read_flow_export(spark: SparkSession, path: str) -> DataFrame:
    """Collector CSV as canonical messages; each file may have any known header. Where there is
    no file with a header, there are no rows."""
    rows = normalize_flow_export(spark.createDataFrame([], "src_ip string"))
    for _, files in sorted(_files_by_header(spark, path).items()):
        part = normalize_flow_export(spark.read.option("header", True).csv(files))
        rows = rows.unionByName(part)
    return rows


def read_packets(spark: SparkSession, path: str) -> DataFrame:
    """Per-packet CSV by column name, with plain names and one source and destination port."""
    named = read_csv_by_name(spark, path, PACKET_CSV.names)
    return normalize_packets(named.select(*[
        F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in PACKET_CSV.fields
    ]))


def publish_flow_export(
    spark: SparkSession, path: str, topic: Topic, features: DataFrame | None = None
) -> None:
    """Collector CSV to a message topic, joined with the extractor's features if given."""
    messages = read_flow_export(spark, path)
    if features is not None:
        messages = enrich_flows_with_features(messages, features)
    publish_messages(encode_row(messages), topic)


def predictions_report(scored: DataFrame, label: str = TARGET) -> DataFrame:
    return scored.select(
        F.col(label).cast("int").alias(TARGET),
        F.col("prediction").cast("double").alias("prediction"),
        decode_prediction(F.col(label)).alias("Label"),
        decode_prediction(F.col("prediction")).alias("Prédiction"),
    )


def export_predictions_csv(scored: DataFrame, path: str, label: str = TARGET) -> None:
    """Label and prediction with their names, for dashboards."""
    predictions_report(scored, label).write.option("header", True).mode("overwrite").csv(path)


def export_clean_csv(labelled: DataFrame, path: str) -> None:
    """Cleaned, labelled features; one file per task."""
    labelled.write.option("header", True).mode("overwrite").csv(path)
