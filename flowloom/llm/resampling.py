"""Quality by importance resampling.

Two generative models over hashed n-grams, one of target texts (labelled good) and one of all raw
texts, give each document an importance weight: how much likelier the target is to write it.
Documents are sampled without replacement in proportion to those weights by Gumbel top-k: add
Gumbel noise to the log weight and keep the k largest keys.

The n-grams are one and two words, one and two word shapes (letters and digits as classes, so
that layout and symbols count in any vocabulary), and one and two lags: how far back, up to
eight words, the same word stood last.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.texts import (
    fold,
    only_caches_of,
    put_back,
    set_aside,
    table,
    text_list,
)
from flowloom.llm.toxicity import training_sample
from flowloom.session import run_dir

BUCKETS = 1 << 14
LAGS = 8
#: Labelled rows that the target model and the cut are fitted on, at most about so many.
TRAINING_ROWS = 20_000
#: N-grams of weight zero added to a text, so that a few odd words do not decide.
PRIOR_NGRAMS = 20
#: Log weights are taken per n-gram and scaled as if a text had so many.
EFFECTIVE_NGRAMS = 60
LOST_WEIGHT = 4
#: Rows among which the k-th key is found on the driver.
LAST_CELL = 4_096
CACHE_ENTRIES = 300_000

_RUN = re.compile(r"(.)\1+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _shape(word: str) -> str:
    classes = "".join(
        "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        for c in word
    )
    return _RUN.sub(r"\1", classes)


class _Words(dict):
    """Word to hash of the word (high half) and of its shape (low half)."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        shape = zlib.crc32(_shape(word).encode())
        self[word] = value = zlib.crc32(word.lower().encode()) << 32 | shape
        return value


_WORDS = _Words()


def _mix(values: np.ndarray, salt: int) -> np.ndarray:
    mixed = (values + np.uint64(salt)) * _ODD
    return (mixed ^ (mixed >> np.uint64(29))) * _ODD >> np.uint64(50)


def ngrams(text: str) -> np.ndarray:
    """The bucket of every n-gram of a text."""
    words = text.split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    both = np.array([_WORDS[w] for w in words], dtype=np.uint64)
    word, shape = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    pair = word[:-1] * np.uint64(0x1000193) + word[1:]
    shape_pair = shape[:-1] * np.uint64(0x1000193) + shape[1:]
    lag = np.zeros(len(word), dtype=np.uint64)
    for back in range(min(LAGS, len(word) - 1), 0, -1):
        lag[back:][word[back:] == word[:-back]] = back
    lag_pair = lag[:-1] * np.uint64(LAGS + 1) + lag[1:]
    found = (
        _mix(word, 1), _mix(pair, 2), _mix(shape, 3), _mix(shape_pair, 4), _mix(lag, 5),
        _mix(lag_pair, 6),
    )
    return np.concatenate(found).astype(np.int64)


def bucket_counts(docs: DataFrame) -> DataFrame:
    """bucket, n: n-grams of all texts by bucket.

    Each task adds up its own texts, so at most BUCKETS rows of a task are shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        only_caches_of("resampling", _WORDS)
        for batch in batches:
            for text in text_list(batch, "text"):
                total += np.bincount(ngrams(text), minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"]
        )

    return docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")
    )


def _model(counts: DataFrame) -> np.ndarray | None:
    """Log probability of every bucket, with one n-gram added to each; None without n-grams."""
    totals = np.ones(BUCKETS)
    rows = counts.collect()  # at most BUCKETS rows
    for row in rows:
        totals[row["bucket"]] += row["n"]
    return np.log(totals / totals.sum()) if rows else None


@dataclass(frozen=True)
class Resampler:
    """log_ratio: target over raw by bucket; cut: mean log ratio that parts good from bad."""

    log_ratio: np.ndarray
    cut: float

    def mean(self, text: str) -> float:
        """Mean log ratio of a text's n-grams; -inf for a text without words."""
        found = ngrams(text)
        if not len(found):
            return -math.inf
        return float(self.log_ratio[found].sum()) / (len(found) + PRIOR_NGRAMS)


def _cut(scored: list[tuple[float, int]]) -> float:
    """The mean log ratio that parts good from bad best, in the middle of its gap.

    Losing a good text counts LOST_WEIGHT times as much as passing a bad one.
    """
    good = np.sort([s for s, q in scored if q and s > -math.inf])
    bad = np.sort([s for s, q in scored if not q and s > -math.inf])
    if not len(good) or not len(bad):
        return -math.inf
    steps = np.unique(np.concatenate([good, bad]))
    lost = np.searchsorted(good, steps, side="left") / len(good)
    passed = 1 - np.searchsorted(bad, steps, side="left") / len(bad)
    best = int(np.argmin(LOST_WEIGHT * lost + passed))
    return float((steps[best] + steps[max(0, best - 1)]) / 2)


def fit(docs: DataFrame, sample: DataFrame) -> Resampler:
    """Models from all docs (raw) and from the sample's good rows (target).

    Without good rows in the sample every text with words has the same weight.
    """
    target = _model(bucket_counts(sample.where(F.col("quality") == 1)))
    if target is None:
        return Resampler(np.zeros(BUCKETS), -math.inf)
    log_ratio = target - _model(bucket_counts(docs))
    unfinished = Resampler(log_ratio, -math.inf)

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [unfinished.mean(t) for t in text_list(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, pa.float64()), batch.column("quality")], ["mean", "quality"]
            )

    scored = sample.select("text", F.col("quality").cast("int").alias("quality")).mapInArrow(
        means, "mean double, quality int"
    ).collect()  # the bounded sample, two numbers a row
    return Resampler(log_ratio, _cut([(r["mean"], r["quality"]) for r in scored]))


def weigh(docs: DataFrame, model: Resampler) -> DataFrame:
    """docs with log_weight: the mean log ratio above the cut, scaled; -inf without words."""
    names = [n for n in docs.columns if n != "log_weight"]
    docs = docs.select(*(F.col(f"`{n}`") for n in names))
    cut = model.cut if model.cut > -math.inf else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_caches_of("resampling", _WORDS)
        for batch in batches:
            values = [
                EFFECTIVE_NGRAMS * (model.mean(t) - cut) for t in text_list(batch, "text")
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(values, pa.float64())],
                [*names, "log_weight"],
            )

    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(run, f"{schema}, log_weight double")


def gumbel(key: str, seed: int = 6) -> Column:
    """Standard Gumbel noise from the hash of a column, so that a retry draws the same."""
    uniform = (F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 52)) + 0.5) / (1 << 52)
    return -F.log(-F.log(uniform))


def kth_largest(keys: DataFrame, column: str, k: int) -> float:
    """The k-th largest finite value of a column, found by counting cells, never by sorting all.

    Each step counts rows in LAST_CELL cells of equal width between two bounds and goes on
    in the cell that holds the k-th, until that cell is small or holds one value only.
    """
    value = F.col(column)
    low, high = keys.agg(F.min(value), F.max(value)).first()
    while True:
        inside = keys.where((value >= low) & (value <= high))
        width = (high - low) / LAST_CELL
        if low + width == low or high - width == high:
            # No more doubles between the bounds than cells, so they are counted by value.
            break
        cell = F.least(F.floor((value - low) / width), F.lit(LAST_CELL - 1))
        counted = inside.groupBy(cell.alias("cell")).agg(
            F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high")
        ).collect()  # at most LAST_CELL rows
        for row in sorted(counted, key=lambda r: -r["cell"]):
            if row["n"] >= k:
                break
            k -= row["n"]
        low, high = row["low"], row["high"]
        if row["n"] <= LAST_CELL:
            rows = keys.where((value >= low) & (value <= high)).select(value.alias("v")).collect()
            return sorted((r["v"] for r in rows), reverse=True)[k - 1]
    counted = inside.groupBy(value.alias("v")).agg(F.count("*").alias("n")).collect()
    for row in sorted(counted, key=lambda r: -r["v"]):
        k -= row["n"]
        if k <= 0:
            return row["v"]
    raise ValueError("fewer rows than k")


def resample(weighed: DataFrame, path: str, k: int | None = None) -> DataFrame:
    """weighed (stored at path by the caller) with key and kept: the Gumbel top-k.

    k is the number of rows with a positive log weight unless given. Rows without words are
    never kept. Rows whose keys tie with the k-th are kept together, so equal rows share a fate.
    """
    spark = weighed.sparkSession
    weighed.withColumn("key", F.col("log_weight") + gumbel("doc_id")).write.option(
        "compression", "zstd"
    ).parquet(path)
    stored = spark.read.parquet(path)
    finite = stored.where(F.col("log_weight") > -math.inf)
    total, positive = finite.agg(
        F.count("*"), F.count(F.when(F.col("log_weight") >= 0, 1))
    ).first()
    k = positive if k is None else min(k, total)
    bound = kth_largest(finite.select("key"), "key", k) if k else math.inf
    return stored.withColumn(
        "kept", (F.col("log_weight") > -math.inf) & (F.col("key") >= F.lit(bound))
    )


def fitted(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Resampler:
    """The models of docs and of labelled good rows outside the held-out fold."""
    sample = training_sample(docs, labels, fold("doc_id", 3) != 1, "quality", TRAINING_ROWS)
    path = run_dir(spark, "quality-sample")
    sample.write.parquet(path)
    return fit(docs, spark.read.parquet(path))


def quality(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """doc_id, log_weight, key and kept of every document.

    Labels (doc_id, quality 0/1) are read outside the held-out fold (crc32 of the id modulo 3 is
    1); null marks and ids are left out. Null and empty texts have log weight -inf and are not
    kept. Repeated rows share weight, noise and verdict; rows with a null id share their noise.
    An empty table gives no rows; without labels every text with words is kept. Other columns
    are ignored. Whole texts count, whatever their length.
    """
    model = fitted(docs.sparkSession, docs, labels)
    weighed = weigh(docs.select("doc_id", "text"), model).drop("text")
    return resample(weighed, run_dir(docs.sparkSession, "quality-weights"), k)


def keep(docs: DataFrame, model: Resampler) -> DataFrame:
    """The rows of docs that are sampled, with all their columns and no others.

    Null and empty texts go. Repeated rows share weight, noise and verdict; rows with a null id
    share their noise, and rows that tie with the last one are kept together. An empty table
    stays empty.
    """
    weighed = weigh(set_aside(docs), model)
    stored = resample(weighed, run_dir(docs.sparkSession, "quality-weights"))
    return put_back(stored.where("kept"), docs.columns)


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", "log_weight", "key", "kept"
    )
