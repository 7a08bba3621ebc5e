"""Queries over training, scoring and evaluation."""

from __future__ import annotations

from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions.fields import drop_incomplete
from flowloom.functions.labels import derive_label
from flowloom.operators import forest, isolation, training_data
from flowloom.plans import fixtures as fx
from flowloom.plans.fixtures import oracle
from flowloom.plans.registry import query
from flowloom.plans.stored import detector, detector_path, flows_table, train_test
from flowloom.schemas import CANONICAL_19, MEASURES, RAW_41
from flowloom.session import run_dir
from flowloom.sources import models

_COMPLETE = " AND ".join(f"{m} IS NOT NULL" for m in MEASURES)
_RAW_COMPLETE = " AND ".join(f'try_cast("{c}" AS double) IS NOT NULL' for c in RAW_41)
_FEATURE_SUM = " + ".join(f"cast({c} AS double)" for c in CANONICAL_19)


@query(oracle(
    f"SELECT flow_id, {len(CANONICAL_19)} AS features, {_FEATURE_SUM} AS total "
    f"FROM flows WHERE {_COMPLETE}",
    "flows",
))
def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = forest.assemble_features(fx.flows(spark, sf_dir))
    values = rows.select("flow_id", vector_to_array("features").alias("v"))
    zero = F.lit(0).cast("double")
    return values.select(
        "flow_id", F.size("v").alias("features"),
        F.aggregate("v", zero, lambda total, x: total + x).alias("total"),
    )


@query(oracle("SELECT flow_id, is_anomaly, anomaly_score FROM scored", "scored"))
def anomaly_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fx.scored_flows(spark, sf_dir)
    attack = F.col("anomaly_score")
    vectors = scored.withColumn("probability", array_to_vector(F.array(1 - attack, attack)))
    rows = forest.anomaly_columns(vectors.drop("is_anomaly", "anomaly_score"))
    return rows.select("flow_id", "is_anomaly", "anomaly_score")


def _properties(scored: DataFrame, verdict) -> DataFrame:
    """What must hold of scores whatever the model: one per row, in [0, 1], verdict by rule."""
    score = F.col("anomaly_score")
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(score.between(0, 1)).alias("in_range"),
        F.count_if(F.col("is_anomaly") == F.when(verdict, 1).otherwise(0)).alias("by_rule"),
    )


_PROPERTIES = "SELECT count(*) AS rows, count(*) AS in_range, count(*) AS by_rule FROM "


@query(oracle(
    f"SELECT count(*) AS rows, true AS beats_guessing FROM flows WHERE {_COMPLETE} "
    "AND cast('0x' || substr(md5(cast(flow_id AS string) || '-42'), 1, 8) AS bigint) % 100 >= 80",
    "flows",
))
def train_random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted forest on the unseen side: rows, and whether it does better than always
    naming the larger class."""
    scored = forest.score_batch(train_test(spark, sf_dir)[1], detector(spark, sf_dir))
    label = F.col(training_data.TARGET)
    hits = F.count_if(label == F.col("prediction"))
    larger = F.greatest(F.count_if(label == 0), F.count_if(label == 1))
    return scored.agg(F.count(F.lit(1)).alias("rows"), (hits >= larger).alias("beats_guessing"))


@query(oracle(f"{_PROPERTIES} flows WHERE {_COMPLETE}", "flows"))
def train_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = flows_table(spark, sf_dir)
    grown = isolation.train_isolation_forest(flows)
    scored = isolation.score_isolation_forest(flows, grown)
    return _properties(scored, F.col("anomaly_score") >= 0.6)


@query(oracle(f"{_PROPERTIES} flows WHERE {_COMPLETE}", "flows"))
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = forest.score_batch(flows_table(spark, sf_dir), detector(spark, sf_dir))
    return _properties(scored, F.col("anomaly_score") > 0.5)


@query(oracle(f"{_PROPERTIES} raw_flows WHERE {_RAW_COMPLETE}", "raw_flows"))
def score_batch_raw41(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide model over the whole table: the 41 raw measures, labelled by the raw label."""
    label = derive_label(F.col("Label")).alias(training_data.TARGET)
    rows = training_data.raw_features(fx.raw_flows(spark, sf_dir), "event_id", label)
    complete = drop_incomplete(rows)
    train, _ = training_data.split_train_test(complete, ["event_id"])
    model = forest.train_random_forest(train, RAW_41, trees=100, depth=12)
    return _properties(forest.score_batch(complete, model), F.col("anomaly_score") > 0.5)


_ALIKE_SQL = oracle(
    f"SELECT true AS alike, count(*) AS rows FROM flows WHERE {_COMPLETE}", "flows"
)


@query(_ALIKE_SQL)
def save_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows by whether the saved copy of the model scores them alike."""
    model, path = detector(spark, sf_dir), run_dir(spark, "model")
    models.save_model(model, path)
    return _agreement(flows_table(spark, sf_dir), model, models.load_model(path))


@query(_ALIKE_SQL)
def load_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = models.load_model(detector_path(spark, sf_dir))
    return _agreement(flows_table(spark, sf_dir), detector(spark, sf_dir), loaded)


def _agreement(flows: DataFrame, one, other) -> DataFrame:
    first = forest.score_batch(flows, one).withColumnRenamed("anomaly_score", "first")
    both = forest.score_batch(first.drop("prediction", "is_anomaly"), other)
    alike = F.abs(F.col("first") - F.col("anomaly_score")) < 1e-12
    return both.groupBy(alike.alias("alike")).agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT 10 AS rows, true AS sorted, true AS whole, true AS named")
def top_feature_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten rows in order; all importances add up to one and belong to the features."""
    flows, model = flows_table(spark, sf_dir), detector(spark, sf_dir)
    top = forest.top_feature_importances(flows, model)
    values = [(r.feature, r.importance) for r in top.collect()]
    every = forest.feature_importances(model)
    facts = (
        len(values), [v for _, v in values] == sorted((v for _, v in every), reverse=True)[:10],
        abs(sum(v for _, v in every) - 1) < 1e-9, {n for n, _ in values} <= set(CANONICAL_19),
    )
    return spark.createDataFrame(
        [facts], "rows int, sorted boolean, whole boolean, named boolean"
    )


@query(
    "SELECT * FROM (VALUES ('accuracy', true), ('auc_roc', true), ('importances', true)) "
    "AS t(name, agrees)"
)
def evaluation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy and area equal the library's evaluators on the same scores."""
    test, model = train_test(spark, sf_dir)[1], detector(spark, sf_dir)
    report = {(r.kind, r.name): r.value for r in forest.evaluation_report(test, model).collect()}
    scored = forest.score_batch(test, model).withColumn(
        training_data.TARGET, F.col(training_data.TARGET).cast("double")
    )
    accuracy = MulticlassClassificationEvaluator(
        labelCol=training_data.TARGET, metricName="accuracy"
    ).evaluate(scored)
    # One threshold per distinct score, as the report counts.
    area = BinaryClassificationEvaluator(
        labelCol=training_data.TARGET, rawPredictionCol="anomaly_score", numBins=0
    ).evaluate(scored)
    top = dict(forest.feature_importances(model))
    facts = [
        ("accuracy", abs(report["metric", "accuracy"] - accuracy) < 1e-9),
        ("auc_roc", abs(report["metric", "auc_roc"] - area) < 1e-9),
        ("importances", all(v == top[n] for (k, n), v in report.items() if k == "importance")),
    ]
    return spark.createDataFrame(facts, "name string, agrees boolean")
