"""From raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next stage's docs. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowloom.llm import near_dedup, packing, resampling, toxicity
from flowloom.llm.texts import table
from flowloom.session import drop_dir, run_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps.

    Every row is judged by its own text; rows without words go. Repeated rows share a verdict,
    and rows with a null id are sampled with one common noise. An empty table stays empty, and
    without labels every text with words stays.
    """
    model = resampling.fitted(spark, docs, table(spark, sf_dir, "labels"))
    return resampling.keep(docs, model)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not predict as toxic.

    Null and empty texts stay. Every row is judged by its own text, so repeated rows share a
    verdict. An empty table stays empty, and without labels only the built-in patterns judge.
    """
    grammar = toxicity.fitted(spark, docs, table(spark, sf_dir, "labels"))
    return toxicity.keep(docs, grammar)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that of the smallest id (null ids last).

    Of equal ids the one with the smallest digest stays, and of rows that are equal in all
    columns one. Texts without words (null, empty) are copies of each other. An empty table
    stays empty.
    """
    return near_dedup.drop_near_duplicates(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens, with their ids.

    Null and empty texts are the end id alone; repeated rows and equal or null ids are packed as
    documents of their own. An empty table gives no rows.
    """
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup_stage),
    ("packing", packing_stage),
]

#: Fitted models, hashing and packing have no SQL form; tests/llm holds run() against the
#: stages applied one by one in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each on what the one before it wrote, which is then deleted."""
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = run_dir(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if before is not None:
                drop_dir(spark, before)
            before = path
    return docs
