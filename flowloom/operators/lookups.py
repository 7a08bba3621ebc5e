"""Point lookups and dashboard filters. All predicates reach the Parquet scan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.functions.labels import severity


# Day partition that goes with each time column.
DAY_COLUMNS = {"flow_start_time": "flow_date", "ingestion_time": "ingestion_date"}


def filter_alerts(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("prediction") == 1)


def flows_by_label(flows: DataFrame, label: int) -> DataFrame:
    return flows.filter(F.col("label") == label)


def flows_by_attack_type(flows: DataFrame, attack_type: str) -> DataFrame:
    return flows.filter(F.col("attack_type") == attack_type)


def _in_period(
    df: DataFrame, time: str, since: datetime | None, until: datetime | None
) -> DataFrame:
    """Rows in [since, until). Where the table is partitioned by day, days out of reach
    are not read; a day's margin allows for writers in another time zone."""
    day = DAY_COLUMNS.get(time)
    by_day = day in df.columns
    if since is not None:
        df = df.filter(F.col(time) >= F.lit(since))
        if by_day:
            df = df.filter(F.col(day) >= F.lit(since.date() - timedelta(days=1)))
    if until is not None:
        df = df.filter(F.col(time) < F.lit(until))
        if by_day:
            df = df.filter(F.col(day) <= F.lit(until.date() + timedelta(days=1)))
    return df


def _latest(
    df: DataFrame, src: int, time: str, tie: str | None,
    since: datetime | None, until: datetime | None, n: int | None,
) -> DataFrame:
    order = [F.col(time).desc(), *([F.col(tie)] if tie else [])]
    rows = df.filter(F.col("src_ip_int") == src)
    rows = _in_period(rows, time, since, until).orderBy(*order)
    return rows if n is None else rows.limit(n)


def latest_flows_for_source(
    flows: DataFrame, src: int, since: datetime | None = None,
    until: datetime | None = None, n: int | None = None,
) -> DataFrame:
    """One source's flows, newest first, within [since, until), at most ``n``."""
    return _latest(flows, src, "flow_start_time", "flow_id", since, until, n)


def latest_predictions_for_source(
    predictions: DataFrame, src: int, since: datetime | None = None,
    until: datetime | None = None, n: int | None = None,
) -> DataFrame:
    """One source's predictions, newest first, within [since, until), at most ``n``."""
    tie = "flow_id" if "flow_id" in predictions.columns else None
    return _latest(predictions, src, "ingestion_time", tie, since, until, n)


def dashboard_filter(
    scored: DataFrame,
    sources: Sequence[str] | None = None,
    since: datetime | None = None,
    until: datetime | None = None,
    severities: Sequence[str] | None = None,
    time: str = "flow_start_time",
) -> DataFrame:
    """Rows of the chosen sources, period and severities, with a ``severity`` column.

    Severity is the band of ``anomaly_score``: low < 0.5 <= medium < 0.8 <= high.
    """
    rows = _in_period(scored, time, since, until)
    if sources is not None:
        rows = rows.filter(F.col("src_ip").isin(*sources))
    rows = rows.withColumn("severity", severity(F.col("anomaly_score")))
    return rows if severities is None else rows.filter(F.col("severity").isin(*severities))
