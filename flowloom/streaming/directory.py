"""A folder of arriving CSV files as a stream: each file once, bad rows set aside."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from flowloom.functions.messages import encode_row
from flowloom.sources.csvs import files_by_header
from flowloom.sources.topics import Topic, publish_messages

_CORRUPT = "_corrupt_record"


def stream_csv_directory(
    spark: SparkSession, folder: str, schema: StructType, archive: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """New files' rows with ``source_file`` and, for a row that does not fit the
    schema, its text in ``_corrupt_record``. With ``archive`` finished files move there."""
    reader = (
        spark.readStream.schema(StructType([*schema.fields]).add(_CORRUPT, StringType(), True))
        .option("header", True)
        # A file whose header has other names or another order fails, not shifts columns.
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(folder).withColumn("source_file", F.col("_metadata.file_name"))


# Files that one batch takes unless another number is given: their headers go through the driver.
MOST_FILES = 1_000


def new_files(
    spark: SparkSession, folder: str, archive: str | None = None, max_files: int | None = None
) -> DataFrame:
    """New files of a folder as a stream of ``path``; their contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length bigint, content binary"
    ).option("maxFilesPerTrigger", max_files or MOST_FILES)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(folder).select("path", "length")


def sort_files(
    spark: SparkSession, files: Sequence[str], names: Sequence[str]
) -> tuple[dict[str, list[str]], list[tuple[str, str]]]:
    """Files that have all the named columns, by their header, and the others with a reason."""
    fit: dict[str, list[str]] = {}
    unfit: list[tuple[str, str]] = []
    by_header = files_by_header(spark, files)
    for header, of in sorted(by_header.items()):
        given = next(csv.reader([header]), [])
        missing = [n for n in names if n not in given]
        if missing or len(set(given)) < len(given):
            reason = f"lacks {', '.join(missing)}" if missing else "names a column twice"
            unfit += [(file, reason) for file in of]
        else:
            fit[header] = of
    headed = {file for of in by_header.values() for file in of}
    return fit, unfit + [(file, "is empty") for file in files if file not in headed]


def _typed_rows(spark: SparkSession, header: str, files: list[str], schema: StructType) -> DataFrame:
    """Rows of files of one header, in the schema's order, with their file and corrupt text."""
    given = next(csv.reader([header]))
    fields = {f.name: f for f in schema.fields}
    typed = StructType([fields.get(n, StructField(n, StringType())) for n in given])
    rows = (
        spark.read.schema(typed.add(_CORRUPT, StringType(), True)).option("header", True)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
        # Rows are checked against all columns of their file, also those nobody asked for.
        .option("columnPruning", False).csv(files)
    )
    return rows.select(
        *[F.col(f"`{n}`") for n in schema.names], _CORRUPT,
        F.col("_metadata.file_name").alias("source_file"),
    )


def ingest_csv_directory(
    spark: SparkSession, folder: str, schema: StructType, out: str, quarantine: str,
    checkpoint: str, archive: str | None = None, max_files: int | None = None, once: bool = False,
) -> StreamingQuery:
    """Good rows of every new file to ``out``, unreadable ones to ``quarantine``; both
    in one partition per batch, replaced if the batch runs again.

    Columns are found by each file's own header, in any order. A file that lacks one, or is
    empty, is set aside: its name and the reason (as ``_corrupt_record``) go to ``quarantine``,
    and the batch goes on with the others.
    """
    empty = spark.createDataFrame(
        [], StructType([*schema.fields]).add(_CORRUPT, StringType()).add("source_file", StringType())
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        files = [row["path"] for row in batch.select("path").collect()]
        fit, unfit = sort_files(session, files, schema.names)
        rows = empty
        for header, of in sorted(fit.items()):
            rows = rows.unionByName(_typed_rows(session, header, of, schema))
        aside = session.createDataFrame(
            [(file.rsplit("/", 1)[-1], f"file {reason}") for file, reason in unfit],
            f"source_file string, {_CORRUPT} string",
        )
        rows = rows.persist()
        try:
            for path, part in (
                (out, rows.filter(F.col(_CORRUPT).isNull()).drop(_CORRUPT)),
                (quarantine, rows.filter(F.col(_CORRUPT).isNotNull()).select(
                    "source_file", _CORRUPT).unionByName(aside)),
            ):
                part.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    found = new_files(spark, folder, archive, max_files)
    writer = found.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def publish_csv_directory(
    spark: SparkSession, folder: str, schema: StructType, topic: Topic, checkpoint: str,
    archive: str | None = None, max_files: int | None = None, once: bool = False,
) -> StreamingQuery:
    """Rows of every new file to a topic, as JSON with their ``source_file``; rows that do
    not fit the schema stay out. A batch that runs again replaces what it sent to a folder
    topic; other topics get it at least once."""
    rows = stream_csv_directory(spark, folder, schema, archive, max_files)

    def send(batch: DataFrame, batch_id: int) -> None:
        good = batch.persist()
        try:
            fit = good.filter(F.col(_CORRUPT).isNull()).drop(_CORRUPT)
            publish_messages(encode_row(fit), topic, batch_id)
        finally:
            good.unpersist()

    writer = rows.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
