"""Dashboard rollups of scored flows: small aggregates of each micro-batch, merged when read.

A batch writes its aggregates by hour into a folder of its own, replacing what an earlier try
wrote, so a repeated batch counts once. Reports read the rollups of a period instead of all
flows. Counts and sums are exact; distinct sources and quantiles come from sketches that merge:
HyperLogLog with 2**12 registers (relative standard error 1.6 %) and KLL with k = 200 (rank error
1.65 % at most with 99 % confidence).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from flowloom.operators.lookups import filter_alerts
from flowloom.streaming.history import compact_batches, read_batches

HLL_BITS, KLL_K = 12, 200

HOURLY_KEYS = ("hour", "protocol", "attack_type")
HOURLY = StructType([StructField(name, kind) for name, kind in (
    ("hour", TimestampType()), ("protocol", IntegerType()), ("attack_type", StringType()),
    ("flows", LongType()), ("alerts", LongType()), ("in_bytes", LongType()),
    ("out_bytes", LongType()), ("sources", BinaryType()), ("flow_bytes", BinaryType()),
)])
SOURCE_KEYS = ("hour", "src_ip")
SOURCES = StructType([StructField(name, kind) for name, kind in (
    ("hour", TimestampType()), ("src_ip", StringType()), ("alerts", LongType()),
    ("score_sum", DoubleType()),
)])


def hourly_rollup(scored: DataFrame, time: str = "flow_start_time") -> DataFrame:
    """One row per hour, protocol and attack type: counts, bytes and sketches."""
    dated = scored.withColumn("hour", F.date_trunc("hour", time))
    total = F.coalesce("in_bytes", F.lit(0)) + F.coalesce("out_bytes", F.lit(0))
    return dated.groupBy(*HOURLY_KEYS).agg(
        F.count(F.lit(1)).alias("flows"),
        F.count_if(F.col("prediction") == 1).alias("alerts"),
        F.sum("in_bytes").alias("in_bytes"),
        F.sum("out_bytes").alias("out_bytes"),
        F.hll_sketch_agg("src_ip_int", HLL_BITS).alias("sources"),
        F.kll_sketch_agg_bigint(total, F.lit(KLL_K)).alias("flow_bytes"),
    )


def source_rollup(scored: DataFrame, time: str = "flow_start_time") -> DataFrame:
    """One row per hour and source that raised alerts."""
    alerts = scored.transform(filter_alerts).withColumn("hour", F.date_trunc("hour", time))
    return alerts.groupBy(*SOURCE_KEYS).agg(
        F.count(F.lit(1)).alias("alerts"), F.sum("anomaly_score").alias("score_sum")
    )


def merge_hourly(rows: DataFrame, *keys: str) -> DataFrame:
    """Hourly rows merged by some of their keys (none: one row)."""
    return rows.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("flows", "alerts", "in_bytes", "out_bytes")],
        F.hll_union_agg("sources").alias("sources"),
        F.kll_merge_agg_bigint("flow_bytes").alias("flow_bytes"),
    )


def merge_sources(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("alerts").alias("alerts"), F.sum("score_sum").alias("score_sum")
    )


def write_rollups(scored: DataFrame, batch_id: int, folder: str) -> None:
    """The rollups of one batch of scored flows; writing them again changes nothing."""
    for name, rows in (("hourly", hourly_rollup(scored)), ("sources", source_rollup(scored))):
        rows.write.mode("overwrite").parquet(f"{folder}/{name}/batch_id={batch_id}")


def _days(rows: DataFrame) -> tuple[DataFrame, str]:
    return rows.withColumn("day", F.to_date("hour")), "day"


def _merged_hours(rows: DataFrame) -> tuple[DataFrame, str]:
    return _days(merge_hourly(rows, *HOURLY_KEYS).select(*HOURLY.names))


def _merged_sources(rows: DataFrame) -> tuple[DataFrame, str]:
    return _days(merge_sources(rows, *SOURCE_KEYS).select(*SOURCES.names))


def compact_rollups(spark: SparkSession, folder: str, compacted: str) -> int:
    """Merge the rollups of all batches that are not merged yet into one row per key and day
    folder; returns how many batches. The same rules hold as for compact_batches()."""
    count = compact_batches(
        spark, f"{folder}/hourly", f"{compacted}/hourly", HOURLY, _merged_hours
    )
    compact_batches(spark, f"{folder}/sources", f"{compacted}/sources", SOURCES, _merged_sources)
    return count


def _period(rows: DataFrame, start: Column | None, end: Column | None) -> DataFrame:
    """Rows from start up to end, by hour and, for the files' sake, by day."""
    if start is not None:
        rows = rows.filter((F.col("day") >= F.to_date(start)) & (F.col("hour") >= start))
    if end is not None:
        rows = rows.filter((F.col("day") <= F.to_date(end)) & (F.col("hour") < end))
    return rows


def read_hourly(
    spark: SparkSession, folder: str, compacted: str, start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """Hourly rollups of a period (whole hours), several rows per key: merge them to read."""
    rows = read_batches(spark, f"{folder}/hourly", f"{compacted}/hourly", HOURLY, _days)
    return _period(rows, start, end)


def read_sources(
    spark: SparkSession, folder: str, compacted: str, start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    rows = read_batches(spark, f"{folder}/sources", f"{compacted}/sources", SOURCES, _days)
    return _period(rows, start, end)


def volume_by_protocol(hourly: DataFrame) -> DataFrame:
    """The report of that name from rollups."""
    return hourly.groupBy("protocol").agg(
        F.sum("in_bytes").alias("in_bytes"),
        F.sum("out_bytes").alias("out_bytes"),
        F.sum(F.col("in_bytes") + F.col("out_bytes")).alias("total_bytes"),
        F.sum("flows").alias("flows"),
    )


def top_attack_types(hourly: DataFrame, n: int = 10) -> DataFrame:
    counts = hourly.groupBy("attack_type").agg(F.sum("flows").alias("rows"))
    return counts.orderBy(F.desc("rows"), "attack_type").limit(n)


def alert_trend(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy(F.col("hour").alias("bucket_start")).agg(
        F.sum("alerts").alias("alerts")
    ).filter("alerts > 0")


def top_suspicious_ips(sources: DataFrame, n: int = 10) -> DataFrame:
    return merge_sources(sources, "src_ip").select(
        "src_ip", "alerts", F.round(F.col("score_sum") / F.col("alerts"), 6).alias("mean_score")
    ).orderBy(F.desc("alerts"), F.desc("mean_score"), "src_ip").limit(n)


def distinct_sources(hourly: DataFrame, *keys: str) -> DataFrame:
    """Estimated number of sources, of the period or by some keys."""
    return hourly.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sources")).alias("sources")
    )


def flow_bytes_quantiles(hourly: DataFrame, shares: list[float], *keys: str) -> DataFrame:
    """Estimated quantiles of the bytes of a flow, both directions together."""
    asked = F.array(*[F.lit(float(share)) for share in shares])
    merged = hourly.groupBy(*keys).agg(F.kll_merge_agg_bigint("flow_bytes").alias("flow_bytes"))
    return merged.select(
        *keys, F.kll_sketch_get_quantile_bigint("flow_bytes", asked).alias("quantiles")
    )
