import re
import uuid

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from flowloom import session
from flowloom.operators.cleaning import clean_flows
from flowloom.plans import fixtures as fx
from flowloom.plans.stored import flows_table
from flowloom.schemas import FLOW, LEGACY_FLOW, MESSAGE, RAW
from flowloom.sources import csvs, documents, layout, tables
from flowloom.sources.csvs import read_raw_csv
from flowloom.sources.topics import Topic

SAMPLE = """IPV4_SRC_ADDR,{middle},Label,Attack
13.58.98.64,{values},1,SSH-Bruteforce
,{values},0,Benign
 10.0.0.1 ,{values},0,Benign
"""


def test_shared_dir_is_the_clusters(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert session.run_dir(spark, "x") != session.run_dir(spark, "x")


def test_raw_csv_to_canonical(spark, tmp_path):
    names = RAW.names[1:-2]
    values = ["1.5" if n == "L7_PROTO" else "10.0.0.2" if n == "IPV4_DST_ADDR" else "7"
              for n in names]
    path = tmp_path / "flows.csv"
    path.write_text(SAMPLE.format(middle=",".join(names), values=",".join(values)))
    rows = clean_flows(read_raw_csv(spark, str(path))).orderBy("src_ip").collect()
    assert [(r.src_ip, r.src_ip_int, r.label) for r in rows] == [
        ("10.0.0.1", 167772161, 0), ("13.58.98.64", 221930048, 1),
    ]
    assert rows[0].l7_proto == 1.5 and rows[0].in_bytes == 7
    assert rows[0].flow_id != rows[1].flow_id


def test_clean_is_one_narrow_stage(spark, sf_dir):
    plan = fx.flows(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    pruned = fx.flows(spark, sf_dir).groupBy("attack_type").count()
    schema = re.search(r"ReadSchema: (\S+)", pruned._jdf.queryExecution().executedPlan().toString())
    assert "value" not in schema.group(1) and "ts" not in schema.group(1).replace("struct", "")


def test_write_flows_counts_in_the_same_job(spark, sf_dir):
    seen = Observation("written")
    path = session.run_dir(spark, "t-flows")
    tables.write_flows(fx.flows(spark, sf_dir), path, metrics=seen)
    assert seen.get["rows"] == spark.read.parquet(path).count() > 0


def test_create_tables_twice_and_keep_rows(spark, sf_dir):
    database = "t_" + uuid.uuid4().hex
    location = session.run_dir(spark, "t-store")
    names = tables.create_tables(spark, database, location)
    flows = fx.flows(spark, sf_dir).withColumn("flow_date", F.to_date("flow_start_time"))
    flows.write.insertInto(names[0])
    assert tables.create_tables(spark, database, location) == names
    assert spark.table(names[0]).count() == flows.count()
    assert spark.table(names[0]).schema.names == [*FLOW.names, "flow_date"]
    assert spark.table(names[2]).schema.names == LEGACY_FLOW.names


def test_topic_options():
    topic = Topic("flows", "broker:9092", options={"startingOffsets": "earliest"})
    assert topic.is_kafka
    assert topic.kafka_options(subscribe="flows", startingOffsets="latest") == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "flows",
        "startingOffsets": "earliest",
    }


def test_index_failure_is_raised_unless_best_effort(spark):
    rows = spark.range(3)
    assert documents.index_documents(rows, "x", "no.such.format", best_effort=True) is False
    with pytest.raises(Exception, match="no.such.format"):
        documents.index_documents(rows, "x", "no.such.format")


def test_export_of_an_empty_folder_has_no_rows(spark):
    base = session.run_dir(spark, "t-no-export")
    spark.createDataFrame([], "value string").write.text(base)
    export = csvs.read_flow_export(spark, base)
    assert export.columns == MESSAGE.names and export.collect() == []


def test_headers_are_read_from_packed_and_oddly_named_files(spark):
    base = session.run_dir(spark, "t-headers")
    lines = spark.createDataFrame([("b,a",), ("1,2",)], "value string").coalesce(1)
    lines.write.option("compression", "gzip").text(f"{base}/a folder/k=x y%")
    assert [tuple(r) for r in csvs.read_csv_by_name(spark, f"{base}/a folder/k=x y%", ["a", "b"])
            .collect()] == [("2", "1")]


def test_stored_inputs_follow_their_table(spark, sf_dir):
    """A table that is written anew gives new answers in the same session."""
    base = session.run_dir(spark, "t-changing")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    sizes = []
    for rows in (events.filter("event_id % 2 = 0"), events):
        rows.write.mode("overwrite").parquet(f"{base}/events.parquet")
        sizes.append(flows_table(spark, base).count())
    assert 0 < sizes[0] < sizes[1]
    assert flows_table(spark, base).inputFiles() == flows_table(spark, base).inputFiles()


def test_lookups_by_value_open_only_files_that_hold_it(spark):
    base = session.run_dir(spark, "t-posted +%")
    for part, kinds in enumerate((["Benign", "rare"], ["Benign", None], ["Benign", "Bot"])):
        spark.createDataFrame(
            [(i, kind, i % 2) for i, kind in enumerate(kinds * 3)],
            "flow_id bigint, attack_type string, label int",
        ).coalesce(1).write.parquet(f"{base}/flow_date=2024-01-0{part + 1}")

    def opened(column, value):
        rows = layout.rows_with_value(spark, base, column, value)
        assert "flow_date" in rows.columns
        files = {r.f for r in rows.select(F.input_file_name().alias("f")).collect()}
        return rows.count(), len(files), len(rows.inputFiles())

    assert opened("attack_type", "rare") == (3, 1, 3)  # nothing is posted yet
    assert layout.post_values(spark, base) == 3
    assert layout.post_values(spark, base) == 0
    assert opened("attack_type", "rare") == (3, 1, 1)
    assert opened("attack_type", "Benign") == (9, 3, 3)
    assert opened("label", 1)[0] == 9
    assert opened("attack_type", "none") == (0, 0, 0) or opened("attack_type", "none")[0] == 0
    assert layout.rows_with_value(spark, base, "attack_type", None).count() == 0
    # A file that came later is read although it is not posted.
    spark.createDataFrame(
        [(9, "rare", 1)], "flow_id bigint, attack_type string, label int"
    ).coalesce(1).write.parquet(f"{base}/flow_date=2024-01-09")
    assert opened("attack_type", "rare")[0] == 4
    assert layout.post_values(spark, base) > 0
    assert opened("attack_type", "rare") == (4, 2, 2)


def test_ordered_files_prune_by_source_and_by_destination(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.col("id").alias("flow_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id") % 5_000).cast("bigint").alias(
            "src_ip_int"),
        (F.xxhash64("id", F.lit(1)) % 5_000).alias("dst_ip_int"),
        F.timestamp_seconds(1704067200 + F.abs(F.xxhash64("id", F.lit(2))) % 86_400).alias(
            "flow_start_time"),
    )
    stored = f"{tmp_path}/rows"
    rows.write.parquet(stored)
    rows = spark.read.parquet(stored)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout.write_ordered(rows, f"{tmp_path}/t")
    finally:
        spark.conf.unset("spark.sql.shuffle.partitions")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    table = spark.read.parquet(f"{tmp_path}/t")
    assert table.drop("flow_date").exceptAll(rows).isEmpty() and table.count() == 40_000
    bounds = table.groupBy(F.input_file_name().alias("f")).agg(*[
        f(c).alias(f"{n}_{c}") for c in ("src_ip_int", "dst_ip_int")
        for n, f in (("low", F.min), ("high", F.max))
    ]).collect()
    assert len(bounds) > 40
    for column in ("src_ip_int", "dst_ip_int"):
        for value in (-4_000, -1_234, 1_300, 2_222, 4_321):
            met = sum(r[f"low_{column}"] <= value <= r[f"high_{column}"] for r in bounds)
            assert met < 0.5 * len(bounds), (column, value, met, len(bounds))


def test_order_key_takes_nulls_and_equal_values(spark):
    rows = spark.createDataFrame([(None, 1), (2, 1), (2, None), (9, 1)], "a int, b bigint")
    keys = [r.k for r in rows.select(layout.order_key(rows, ["a", "b"]).alias("k"), "a").orderBy(
        F.col("a").asc_nulls_first()).collect()]
    assert keys[0] <= keys[1] and keys[-1] == max(keys)
    empty = rows.limit(0)
    assert empty.select(layout.order_key(empty, ["a"])).collect() == []
