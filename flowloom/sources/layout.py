"""Layouts of the flow table for lookups: postings of values to files, and order by several keys."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

#: Columns of few values that postings are kept for.
POSTED = ("label", "attack_type")
POSTING = StructType().add("column", StringType()).add("value", StringType()).add(
    "file", StringType()
)
#: Bits that each key has in the common order, and the relative error of its bounds.
KEY_BITS, BOUND_ERROR = 8, 0.001


def _postings_path(table: str) -> str:
    return f"{table.rstrip('/')}_postings"


def _postings(spark: SparkSession, table: str) -> DataFrame:
    try:
        return spark.read.schema(POSTING).parquet(_postings_path(table))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], POSTING)


def _files(spark: SparkSession, table: str) -> list[str]:
    return sorted(unquote(file) for file in spark.read.parquet(table).inputFiles())


def _named(postings: DataFrame) -> set[str]:
    """The files that postings name."""
    return {unquote(r["file"]) for r in postings.select("file").distinct().collect()}


def _rows_of(spark: SparkSession, table: str, files: Sequence[str]) -> DataFrame:
    schema = spark.read.parquet(table).schema
    return spark.read.schema(schema).option("basePath", table).parquet(*files)


def post_values(spark: SparkSession, table: str, columns: Sequence[str] = POSTED) -> int:
    """Post the values of files that are not posted yet; returns how many files.

    Call it after each write. One scan of the new files, of these columns only; a task sends a
    row per file and value. Files that a rewrite has removed keep harmless postings.
    """
    posted = _named(_postings(spark, table))
    fresh = [file for file in _files(spark, table) if file not in posted]
    if not fresh:
        return 0
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]))
    _rows_of(spark, table, fresh).select(
        pairs.alias("posted"), F.input_file_name().alias("file")
    ).select("posted.*", "file").distinct().coalesce(1).write.mode("append").parquet(_postings_path(table))
    return len(fresh)


def rows_with_value(spark: SparkSession, table: str, column: str, value: object) -> DataFrame:
    """Rows of a table whose column has the value, from the files that hold it.

    Files that are not posted yet are read too, so the answer is whole at any time. The driver
    sees the files of that value. A null value, as in SQL, equals nothing.
    """
    postings = _postings(spark, table)
    present = _files(spark, table)
    known = _named(postings)
    text = spark.range(1).select(F.lit(value).cast("string")).first()[0]
    held = _named(postings.filter((F.col("column") == column) & (F.col("value") == F.lit(text))))
    wanted = [file for file in present if file in held or file not in known]
    if not wanted or value is None:
        return spark.read.parquet(table).limit(0)
    return _rows_of(spark, table, wanted).filter(F.col(column) == F.lit(value))


def _bucket(value: Column, bounds: Sequence[float]) -> Column:
    """How many of the rising bounds a value reaches: a binary search as nested conditions."""
    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(bounds[middle]), between(low, middle)).otherwise(
            between(middle + 1, high)
        )

    return between(0, len(bounds))


def order_key(df: DataFrame, keys: Sequence[str], bits: int = KEY_BITS) -> Column:
    """A Z-order key: the bits of all keys' quantile buckets in turn, the highest first.

    Rows that are near in this order are near in every key, so files of a range of it have
    narrow bounds of all keys. The quantiles (2**bits - 1 a key) come from one pass over df;
    a null is in the first bucket. Numbers and timestamps can be keys.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = [
        (F.unix_micros(k) if dict(df.dtypes)[k] == "timestamp" else F.col(k)).cast("double")
        for k in keys
    ]
    found = df.agg(*[
        F.percentile_approx(n, shares, int(1 / BOUND_ERROR)).alias(f"b{i}")
        for i, n in enumerate(numbers)
    ]).first()
    buckets = F.array(*[
        _bucket(F.coalesce(n, F.lit(float("-inf"))), sorted(set(found[i] or []))).cast("bigint")
        for i, n in enumerate(numbers)
    ])

    def gathered(of: Column) -> Column:
        key = F.lit(0).cast("bigint")
        for bit in reversed(range(bits)):
            for i in range(len(keys)):
                one = F.shiftright(F.get(of, F.lit(i)), bit).bitwiseAND(F.lit(1))
                key = F.shiftleft(key, 1).bitwiseOR(one)
        return key

    # One computation of the buckets, whose bits are read many times.
    return F.get(F.transform(F.array(buckets), gathered), F.lit(0))


def write_ordered(
    flows: DataFrame, path: str,
    keys: Sequence[str] = ("src_ip_int", "dst_ip_int", "flow_start_time"),
) -> None:
    """Write whole days of the flow table so that lookups by any of the keys open few files.

    The days that ``flows`` holds are replaced, all others stay. ``flows`` is read three times:
    for the keys' quantiles, for the bounds of the range shuffle, and to write.
    """
    dated = flows.withColumn("flow_date", F.to_date("flow_start_time"))
    keyed = dated.withColumn("_key", order_key(dated, keys))
    (
        keyed.repartitionByRange("flow_date", "_key", "flow_id")
        .sortWithinPartitions("flow_date", "_key", "flow_id").drop("_key")
        .write.partitionBy("flow_date")
        .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    )
