"""Counts, rankings and trends. Every aggregate combines on the map side, so a
hot key costs no more than a cold one, and every ranking is a distributed top-k."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.fields import number_from_text
from flowloom.functions.hashing import percent_bucket
from flowloom.functions.labels import BENIGN
from flowloom.operators.lookups import filter_alerts
from flowloom.operators.training_data import TARGET
from flowloom.schemas import MEASURES

# An authentication flow is one to a login service; it failed if the file
# service answered 530 or the attack type names a brute force.
AUTH_PORTS = [21, 22, 23, 3389]
FTP_LOGIN_FAILED = 530


def _percent(part: Column, whole: Column) -> Column:
    return F.round(part.cast("double") * F.lit(100.0) / whole, 6)


def row_counts(
    raw: DataFrame, flow_id: Column, train_percent: int = 80, seed: int = 42
) -> DataFrame:
    """Rows per stage (raw, ready, cleaned, train, test) from one scan."""
    ready = F.col("IPV4_SRC_ADDR").isNotNull() & F.col("IPV4_DST_ADDR").isNotNull()
    numbers = [number_from_text(F.col(c), dtype) for c, dtype in MEASURES.values()]
    # NaN is as incomplete as null, as it is for the training set.
    typed = [n.isNotNull() & ~F.isnan(n.cast("double")) for n in numbers]
    cleaned = reduce(and_, [ready, F.col("Attack").isNotNull(), *typed])
    marked = raw.select(
        ready.alias("ready"),
        cleaned.alias("cleaned"),
        (percent_bucket([flow_id], seed) < train_percent).alias("train"),
    )
    counts = marked.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if("ready").alias("ready"),
        F.count_if("cleaned").alias("cleaned"),
        F.count_if(F.col("cleaned") & F.col("train")).alias("train"),
        F.count_if(F.col("cleaned") & ~F.col("train")).alias("test"),
    )
    return counts.unpivot([], ["raw", "ready", "cleaned", "train", "test"], "stage", "rows")


def class_distribution(labelled: DataFrame) -> DataFrame:
    """Rows and percent per binary class. The window sees one row per class."""
    counts = labelled.groupBy(TARGET).agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())
    return counts.withColumn("percent", _percent(F.col("rows"), total))


def attack_counts(flows: DataFrame) -> DataFrame:
    return flows.groupBy("attack_type").agg(F.count(F.lit(1)).alias("rows"))


def top_attack_types(flows: DataFrame, n: int = 10, exclude_benign: bool = False) -> DataFrame:
    if exclude_benign:
        flows = flows.filter(F.col("attack_type") != BENIGN)
    return attack_counts(flows).orderBy(F.desc("rows"), "attack_type").limit(n)


def attack_breakdown_with_others(flows: DataFrame, n: int = 9) -> DataFrame:
    """The ``n`` most frequent attacks, the remaining attacks as one ``others`` row,
    and each one's percent of all rows. Totals come from scalar subqueries over the
    same counts, so no window gathers the attack types in one task."""
    # The flag is an aggregate, so filtering on it does not move below the counting
    # and every branch shares the one scan.
    counts = flows.groupBy("attack_type").agg(
        F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("attack_type") != BENIGN).alias("attack")
    )
    attacks = counts.filter("attack").drop("attack")
    top = attacks.orderBy(F.desc("rows"), "attack_type").limit(n)
    all_rows = counts.agg(F.sum("rows")).scalar()
    top_rows = top.agg(F.coalesce(F.sum("rows"), F.lit(0))).scalar()
    others = (
        attacks.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
        .select(F.lit("others").alias("attack_type"), (F.col("rows") - top_rows).alias("rows"))
        .filter(F.col("rows") > 0)
    )
    return top.unionByName(others).withColumn("percent", _percent(F.col("rows"), all_rows))


def volume_by_protocol(flows: DataFrame) -> DataFrame:
    return flows.groupBy("protocol").agg(
        F.sum("in_bytes").alias("in_bytes"),
        F.sum("out_bytes").alias("out_bytes"),
        F.sum(F.col("in_bytes") + F.col("out_bytes")).alias("total_bytes"),
        F.count(F.lit(1)).alias("flows"),
    )


def top_suspicious_ips(scored: DataFrame, n: int = 10) -> DataFrame:
    """Sources with most alerts; equal counts go by mean score, then by address."""
    return (
        scored.transform(filter_alerts)
        .groupBy("src_ip")
        .agg(
            F.count(F.lit(1)).alias("alerts"),
            F.round(F.avg("anomaly_score"), 6).alias("mean_score"),
        )
        .orderBy(F.desc("alerts"), F.desc("mean_score"), "src_ip")
        .limit(n)
    )


def auth_failure_rate(
    flows: DataFrame, period: str = "1 day", time: str = "flow_start_time",
    ftp_code: str = "ftp_command_ret_code",
) -> DataFrame:
    """Failed share of authentication flows per period, and overall in the row
    without a period. The service's return code counts when the input has it."""
    failed = F.lower("attack_type").rlike("brute *force")
    if ftp_code in flows.columns:
        failed = failed | (F.col(ftp_code) == FTP_LOGIN_FAILED)
    auth = flows.filter(F.col("dst_port").isin(AUTH_PORTS)).select(
        F.window(time, period).start.alias("period_start"),
        F.coalesce(failed, F.lit(False)).alias("failed"),
    )
    return (
        auth.rollup("period_start")
        .agg(F.count(F.lit(1)).alias("auth_flows"), F.count_if("failed").alias("failed_flows"))
        .withColumn("failure_rate", F.round(F.col("failed_flows") / F.col("auth_flows"), 6))
    )


def alert_trend(
    scored: DataFrame, bucket: str = "1 hour", time: str = "flow_start_time",
    watermark: str | None = None,
) -> DataFrame:
    """Alerts per time bucket. On a stream, ``watermark`` closes buckets."""
    alerts = scored.transform(filter_alerts)
    if watermark is not None:
        alerts = alerts.withWatermark(time, watermark)
    return (
        alerts.groupBy(F.window(time, bucket).alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("alerts"))
        .select(F.col("_bucket.start").alias("bucket_start"), "alerts")
    )


def dataset_profile(df: DataFrame) -> DataFrame:
    """Position, name, type, rows and nulls of every column, from one scan."""
    names = df.columns
    facts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(names)],
    )
    described = F.array(*[
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col("_rows").alias("rows"),
            F.col(f"n{i}").alias("nulls"),
        )
        for i, field in enumerate(df.schema.fields)
    ])
    return facts.select(F.inline(described))


def preview(df: DataFrame, order: list[Column | str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)
