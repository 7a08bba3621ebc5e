"""Named queries, each with the SQL that must give the same rows where one exists."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from flowloom.session import tune

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name."""

    def register(run: Run) -> Run:
        def comparable(spark: SparkSession, sf_dir: str) -> DataFrame:
            return without_zone(run(tune(spark), sf_dir))

        QUERIES[run.__name__] = Query(comparable, sql)
        return run

    return register


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as the zone-free type of the given tables."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df
