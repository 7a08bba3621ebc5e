import time

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from flowloom.operators import forest, isolation, metrics, training_data
from flowloom.operators.lookups import filter_alerts
from flowloom.plans import fixtures as fx
from flowloom.plans.stored import train_test
from flowloom.schemas import CANONICAL_19, FEATURE_GROUPS, FLOW_COLUMNS, MESSAGE, RAW_41, RAW_COLUMNS
from flowloom.session import run_dir
from flowloom.sources.models import load_model, save_model


@pytest.fixture(scope="module")
def small(spark, sf_dir):
    train, test = train_test(spark, sf_dir)
    return forest.train_random_forest(train, trees=10, depth=5), train, test


def test_schemas():
    assert (len(RAW_COLUMNS), len(RAW_41), len(CANONICAL_19)) == (45, 41, 19)
    assert (len(FLOW_COLUMNS), len(MESSAGE.names)) == (27, 24)
    assert all(set(names) <= set(RAW_41) for names in FEATURE_GROUPS.values())


def test_forest_repeats_and_separates(small):
    model, train, test = small
    again = forest.train_random_forest(train, trees=10, depth=5)
    assert forest.feature_importances(model) == forest.feature_importances(again)
    report = {r["name"]: r["value"] for r in forest.evaluation_report(test, model).collect()}
    assert report["auc_roc"] > 0.95 and report["accuracy"] > 0.9


def test_own_metrics_agree_with_the_library(small):
    model, _, test = small
    scored = model.transform(test).withColumn("y", F.col(training_data.TARGET).cast("double"))
    scored = forest.anomaly_columns(scored)
    auc = BinaryClassificationEvaluator(labelCol="y").evaluate(scored)
    hits = MulticlassClassificationEvaluator(labelCol="y", metricName="accuracy").evaluate(scored)
    assert metrics.auc_roc(scored, "y").first().auc == pytest.approx(auc, abs=1e-9)
    assert metrics.accuracy(scored, "y").first().accuracy == pytest.approx(hits, abs=1e-12)


def test_metrics_without_one_class(spark):
    scored = spark.createDataFrame([(1, 0.2, 0.0), (1, 0.9, 1.0)], "y int, s double, p double")
    assert metrics.auc_roc(scored, "y", "s").first().auc is None
    assert metrics.accuracy(scored, "y", "p").first().accuracy == 0.5
    assert metrics.auc_roc(scored.limit(0), "y", "s").first().auc is None


def test_saved_pipeline_scores_like_its_plain_transform(spark, small):
    model, _, test = small
    path = run_dir(spark, "t-model")
    save_model(model, path)
    plain = forest.anomaly_columns(load_model(path).transform(test)).select(
        "flow_id", "anomaly_score"
    )
    ours = forest.score_batch(test, load_model(path)).select("flow_id", "anomaly_score")
    assert sorted(plain.collect()) == sorted(ours.collect())


def test_one_record_scores(spark, small):
    record = {c: 1 for c in CANONICAL_19} | {"src_ip_int": 3232235521}
    rows = spark.createDataFrame([record])
    assert forest.score_batch(rows, small[0]).count() == 1


def test_incomplete_rows_are_skipped(spark, small):
    rows = spark.createDataFrame(
        [tuple([1.0] * 19), tuple([None] + [1.0] * 18), tuple([float("nan")] + [1.0] * 18)],
        ", ".join(f"{c} double" for c in CANONICAL_19),
    )
    assert forest.score_batch(rows, small[0]).count() == 1


def test_alerts_over_freshly_cleaned_flows_plan_quickly(spark, sf_dir, small):
    start = time.time()
    scored = forest.score_batch(fx.flows(spark, sf_dir), small[0])
    alerts = filter_alerts(scored).filter("protocol = 17").select("flow_id")
    alerts._jdf.queryExecution().executedPlan()
    assert time.time() - start < 20


def test_split_does_not_depend_on_partitions(spark):
    ids = spark.range(10_000).withColumnRenamed("id", "flow_id")
    train, test = training_data.split_train_test(ids)
    again, _ = training_data.split_train_test(ids.repartition(7))
    assert sorted(train.collect()) == sorted(again.collect())
    assert train.count() + test.count() == 10_000 and 7800 < train.count() < 8200
    assert train.intersect(test).isEmpty()


def test_isolation_forest_finds_planted_outliers(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(0, 1, (2000, 3))
    points[:10] += 12
    rows = spark.createDataFrame(
        [(i, *map(float, p)) for i, p in enumerate(points)],
        "flow_id long, a double, b double, c double",
    )
    grown = isolation.train_isolation_forest(rows, ["a", "b", "c"])
    assert (grown.trees, grown.sample) == (100, 256)
    scored = isolation.score_isolation_forest(rows, grown).toPandas().set_index("flow_id")
    scores = scored["anomaly_score"]
    assert ((scores > 0) & (scores <= 1)).all()
    assert scores.loc[:9].min() > scores.loc[10:].quantile(0.95)
    again = isolation.train_isolation_forest(rows.repartition(5), ["a", "b", "c"])
    assert np.array_equal(grown.threshold, again.threshold)


def test_isolation_forest_on_constant_data(spark):
    rows = spark.range(50).selectExpr("id AS flow_id", "1.0D AS a")
    grown = isolation.train_isolation_forest(rows, ["a"], trees=5, sample=16)
    scores = {r.anomaly_score for r in isolation.score_isolation_forest(rows, grown).collect()}
    assert len(scores) == 1
