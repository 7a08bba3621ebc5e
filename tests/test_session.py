from pyspark.sql import functions as F

from flowloom.plans import catalog
from flowloom.session import tune
from flowloom.sources.topics import Topic, batch_messages, publish_messages


def test_queries_plan_for_wide_projections_in_any_session(spark, sf_dir):
    """A session that does not come from local_session() gets the settings, too."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        catalog()["class_distribution"].run(spark, sf_dir)
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    finally:
        tune(spark)


def test_queries_cut_scans_small_in_any_session(spark, sf_dir):
    """What a task caches of messages is a multiple of what it scans."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
    try:
        catalog()["class_distribution"].run(spark, sf_dir)
        assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) == 8 << 20
    finally:
        tune(spark)


def test_a_task_reads_a_bounded_run_of_messages(spark, tmp_path):
    """Messages that look alike fill one row group, which no scan can cut."""
    tune(spark)
    topic = Topic("alike", str(tmp_path), "parquet")
    alike = spark.range(0, 250_000, 1, 1).select(F.lit("message " * 90).alias("value"))
    publish_messages(alike, topic)
    read = batch_messages(spark, topic).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in read) == 250_000
    assert max(r["count"] for r in read) <= 200_000
    files = spark.read.parquet(topic.path).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in files) <= 100_000
