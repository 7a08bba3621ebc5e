"""Hash values that depend on row content only, so samples and splits repeat
whatever the partitioning, the cluster size or a retried task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 16**15


def _text(keys: list[Column]) -> Column:
    return F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])


def hash_rank(keys: list[Column], seed: int) -> Column:
    """Uniform value in ``[0, HASH_SPACE)`` from the keys' text and a seed."""
    digest = F.md5(F.concat(_text(keys), F.lit(f"-{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def percent_bucket(keys: list[Column], seed: int) -> Column:
    """Uniform bucket 0..99."""
    digest = F.md5(F.concat(_text(keys), F.lit(f"-{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
