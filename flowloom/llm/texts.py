"""What the text operators share: reading tables, split remainders, Arrow columns."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these six ASCII white space characters.
WHITE_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of a number as text, modulo folds; a null number belongs to no fold."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


_kept_caches: dict[str, tuple] = {}


def only_caches_of(owner: str, *caches) -> None:
    """Empty what other operators left in this Python worker, which Spark uses for all stages."""
    for other, kept in _kept_caches.items():
        if other != owner:
            for cache in kept:
                cache.clear()
    _kept_caches[owner] = caches


def text_list(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column of an Arrow batch; null reads as empty."""
    return [text or "" for text in batch.column(name).to_pylist()]


def set_aside(docs: DataFrame) -> DataFrame:
    """doc_id, text and the other columns as the struct rest, out of reach of added names."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others, F.lit(0).alias("flowloom_pad"))
    return docs.select("doc_id", "text", rest.alias("rest"))


def put_back(df: DataFrame, names: list[str], *more: str) -> DataFrame:
    """The columns that set_aside() had, in their order, and more."""
    own = ("doc_id", "text")
    return df.select(*(F.col(n) if n in own else F.col("rest")[n].alias(n) for n in names), *more)
