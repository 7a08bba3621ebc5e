"""Intermediate results that several queries share, written once per session."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from flowloom.operators.forest import train_random_forest
from flowloom.operators.training_data import split_train_test, training_set_with_id
from flowloom.plans import fixtures as fx
from flowloom.session import input_state, run_dir
from flowloom.sources.models import save_model
from flowloom.sources.tables import write_clustered
from flowloom.sources.topics import Topic, publish_messages

_made: dict[tuple, str] = {}
_models: dict[tuple, PipelineModel] = {}


def _source(spark: SparkSession, sf_dir: str) -> tuple:
    """The session and the input as it is now: all that is stored here comes from the events."""
    state = input_state(spark, f"{sf_dir}/events.parquet")
    return spark.sparkContext.applicationId, sf_dir, state


def _once(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    key = (*_source(spark, sf_dir), label)
    if key not in _made:
        path = run_dir(spark, label)
        write(path)
        _made[key] = path
    return _made[key]


def flows_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clustered flow table."""
    path = _once(
        spark, sf_dir, "flows", lambda p: write_clustered(fx.flows(spark, sf_dir), p)
    )
    return spark.read.parquet(path)


def scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clustered flow table with the fixed score."""
    path = _once(
        spark, sf_dir, "scored", lambda p: write_clustered(fx.scored_flows(spark, sf_dir), p)
    )
    return spark.read.parquet(path)


def message_topic(spark: SparkSession, sf_dir: str) -> Topic:
    """All flows as messages in a folder topic."""

    def write(path: str) -> None:
        values = fx.message_values(flows_table(spark, sf_dir))
        publish_messages(values, Topic("flow-messages", path, "parquet"))

    return Topic("flow-messages", _once(spark, sf_dir, "topic", write), "parquet")


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split_train_test(training_set_with_id(flows_table(spark, sf_dir)))


def detector(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """The default forest, fitted on the training side of the flow table."""
    key = _source(spark, sf_dir)
    if key not in _models:
        _models[key] = train_random_forest(train_test(spark, sf_dir)[0])
    return _models[key]


def detector_path(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "model", lambda p: save_model(detector(spark, sf_dir), p))
