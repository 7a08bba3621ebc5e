"""Random-forest attack detector: assemble, train, score, explain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.functions.fields import drop_incomplete
from flowloom.operators.metrics import accuracy, auc_roc
from flowloom.operators.training_data import TARGET
from flowloom.schemas import CANONICAL_19, FEATURE_GROUPS, MEASURES
from flowloom.session import run_dir

# The detector's hyperparameters.
TREES, DEPTH, SUBSAMPLING, SEED = 80, 12, 0.8, 42


def assembler(features: Sequence[str] = CANONICAL_19) -> VectorAssembler:
    """Features to one vector; a row with a null or NaN feature is left out."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")


def _apply(stage: Transformer, df: DataFrame) -> DataFrame:
    """A pipeline stage, with an assembler's skipping done by ``drop_incomplete``:
    its own filter is one condition over all features, which does not plan well
    over computed columns."""
    if isinstance(stage, VectorAssembler) and stage.getHandleInvalid() == "skip":
        df = drop_incomplete(df, stage.getInputCols())
        stage = stage.copy({stage.handleInvalid: "keep"})
    return stage.transform(df)


def assemble_features(df: DataFrame, features: Sequence[str] = CANONICAL_19) -> DataFrame:
    return _apply(assembler(features), df)


def train_random_forest(
    train: DataFrame, features: Sequence[str] = CANONICAL_19, trees: int = TREES,
    depth: int = DEPTH, subsampling: float = SUBSAMPLING, seed: int = SEED,
    memory_mb: int = 1024,
) -> PipelineModel:
    """Assembler and forest fitted as one pipeline.

    ``memory_mb`` lets one pass over the data split many nodes at once, so a deep
    forest needs few passes.
    """
    forest = RandomForestClassifier(
        labelCol=TARGET, featuresCol="features", numTrees=trees, maxDepth=depth,
        subsamplingRate=subsampling, seed=seed, maxMemoryInMB=memory_mb,
    )
    rows = assemble_features(train.select(*features, TARGET), features)
    fitted = forest.fit(rows.select("features", TARGET))
    # A fresh model drags its training summary, session and data included, into every
    # scoring task; its stored copy is the trees alone.
    path = run_dir(train.sparkSession, "fitted-forest")
    fitted.write().save(path)
    return PipelineModel([assembler(features), RandomForestClassificationModel.load(path)])


def anomaly_columns(scored: DataFrame) -> DataFrame:
    """``is_anomaly`` from the prediction, ``anomaly_score`` = probability of attack."""
    return scored.withColumns({
        "is_anomaly": F.col("prediction").cast("int"),
        "anomaly_score": vector_to_array("probability")[1],
    })


def score_batch(df: DataFrame, model: Transformer) -> DataFrame:
    """Input columns plus prediction, is_anomaly and anomaly_score. Works alike on a
    table, a single record and a stream."""
    for stage in model.stages if isinstance(model, PipelineModel) else [model]:
        df = _apply(stage, df)
    return df.transform(anomaly_columns).drop("features", "rawPrediction", "probability")


score_stream = score_batch


def feature_importances(model: PipelineModel) -> list[tuple[str, float]]:
    names = model.stages[0].getInputCols()
    values = _forest(model).featureImportances.toArray()
    return [(name, float(value)) for name, value in zip(names, values, strict=True)]


def group_importances(model: PipelineModel) -> list[tuple[str, float]]:
    """Importance per feature group; features outside every group are left out."""
    raw = {name: source for name, (source, _) in MEASURES.items()}
    weights: dict[str, float] = {}
    for name, value in feature_importances(model):
        for group, members in FEATURE_GROUPS.items():
            if raw.get(name, name) in members:
                weights[group] = weights.get(group, 0.0) + value
    return sorted(weights.items(), key=lambda item: (-item[1], item[0]))


def _forest(model: PipelineModel) -> Model:
    return model.stages[-1]


def top_feature_importances(df: DataFrame, model: PipelineModel, n: int = 10) -> DataFrame:
    """The ``n`` features that weigh most, by the session of ``df``."""
    rows = df.sparkSession.createDataFrame(
        feature_importances(model), "feature string, importance double"
    )
    return rows.orderBy(F.desc("importance"), "feature").limit(n)


def evaluation_report(test: DataFrame, model: PipelineModel, n: int = 10) -> DataFrame:
    """Accuracy, area under ROC, the top importances and those of feature groups, as
    (kind, name, value) rows."""
    scored = score_batch(test, model).select(TARGET, "prediction", "anomaly_score").persist()
    try:
        metrics = accuracy(scored).select(
            F.lit("metric").alias("kind"), F.lit("accuracy").alias("name"),
            F.col("accuracy").alias("value"),
        ).unionByName(auc_roc(scored).select(
            F.lit("metric").alias("kind"), F.lit("auc_roc").alias("name"),
            F.col("auc").alias("value"),
        ))
        values = [tuple(r) for r in metrics.collect()]
    finally:
        scored.unpersist()
    values += [("importance", f, v) for f, v in sorted(
        feature_importances(model), key=lambda item: (-item[1], item[0])
    )[:n]]
    values += [("group", group, value) for group, value in group_importances(model)]
    return test.sparkSession.createDataFrame(values, "kind string, name string, value double")
