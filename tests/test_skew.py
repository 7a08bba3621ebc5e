"""A third of all rows under one key, source, score or conversation."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowloom.operators import enrichment, isolation, metrics, packets, sampling, upsert
from flowloom.operators.lookups import (
    flows_by_attack_type,
    flows_by_label,
    latest_flows_for_source,
)
from flowloom.operators.reports import (
    attack_breakdown_with_others,
    top_attack_types,
    volume_by_protocol,
)
from flowloom.plans.stored import flows_table
from flowloom.session import run_dir
from flowloom.sources.tables import upsert_table, write_clustered

ROWS = 30_000


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def flows(spark):
    """One source sends a third of the flows."""
    rows = spark.range(ROWS).select(
        F.col("id").alias("flow_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).cast("bigint").alias(
            "src_ip_int"
        ),
        F.timestamp_seconds(1704067200 + F.col("id") * 7).alias("flow_start_time"),
        (F.col("id") % 5).cast("int").alias("label"),
    )
    path = run_dir(spark, "skewed")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_upsert_sends_one_row_per_key_and_task(flows):
    out = upsert.keyed_upsert(flows, ["src_ip_int"], ["flow_start_time", "flow_id"])
    plan = final_plan(out)
    partial = plan.index("1, Partial")
    assert plan.index("Exchange hashpartitioning(src_ip_int") < partial
    newest = flows.groupBy("src_ip_int").agg(F.max("flow_id").alias("flow_id"))
    assert sorted(out.select("src_ip_int", "flow_id").collect()) == sorted(newest.collect())


def test_salted_join_is_whole_and_spreads_the_hot_key(spark, flows):
    names = spark.range(500).select(
        F.col("id").alias("src_ip_int"), F.concat(F.lit("n"), "id").alias("name")
    ).filter("src_ip_int <> 7")
    out = enrichment.salted_left_join(flows, names, ["src_ip_int"], salts=8)
    plain = flows.join(names, "src_ip_int", "left").select(*flows.columns, "name")
    assert out.count() == ROWS
    assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()


def test_identical_rows_of_a_hot_key_get_different_salts(spark):
    """One key, one content: the rows still lie in several tasks, none with most of them."""
    copies = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    one = spark.createDataFrame([(1, "x")], "k int, w string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = enrichment.salted_left_join(copies, one, ["k"], salts=16)
        tasks = out.select(F.spark_partition_id().alias("p"), "w").groupBy("p").count().collect()
        assert out.filter("w = 'x'").count() == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(t["count"] for t in tasks) == 4000
    assert len(tasks) > 2 and max(t["count"] for t in tasks) <= 2500


def test_hot_keys_are_few_and_right(flows):
    hot = enrichment.hot_keys(flows, ["src_ip_int"], share=100)
    assert [r.src_ip_int for r in hot.collect()] == [1]


def test_null_keys_join_as_equal(spark):
    left = spark.createDataFrame([(None, 1), (2, 2)], "k int, v int")
    right = spark.createDataFrame([(None, "n"), (3, "m")], "k int, w string")
    out = enrichment.salted_left_join(left, right, ["k"])
    assert sorted(out.collect(), key=lambda r: r.v) == [(None, 1, "n"), (2, 2, None)]


def test_features_match_within_the_slice(spark):
    tuple_ = "'a' AS src_ip, 'b' AS dst_ip, 1 AS src_port, 2 AS dst_port, 6 AS protocol"
    flows = spark.sql(
        f"SELECT {tuple_}, TIMESTAMP '2024-01-01 00:00:10' AS flow_start_time, 1 AS f UNION ALL "
        f"SELECT {tuple_}, TIMESTAMP '2024-01-01 00:01:10', 2"
    )
    features = spark.sql(
        f"SELECT {tuple_}, TIMESTAMP '2024-01-01 00:00:50' AS flow_start_time, 5 AS x UNION ALL "
        f"SELECT {tuple_}, TIMESTAMP '2024-01-01 00:00:05', 4"
    )
    timed = enrichment.enrich_flows_with_features(flows, features)
    assert sorted((r.f, r.x) for r in timed.collect()) == [(1, 5), (2, None)]
    untimed = enrichment.enrich_flows_with_features(flows, features.drop("flow_start_time"))
    assert sorted((r.f, r.x) for r in untimed.collect()) == [(1, 5), (2, 5)]


def test_features_match_within_the_range(spark):
    """Across a slice border, before and after, ties to the earlier, hot tuples in several chunks."""
    rows = [(t, t * 10) for t in (0, 50, 120, 240, 3_590, 3_700, 7_260, 7_260, 90_000)]
    flows = [-61, -60, 0, 25, 26, 85, 179, 180, 181, 301, 3_645, 3_646, 7_200, 7_199, 89_940, 89_939]
    key = "'a' AS src_ip, 'b' AS dst_ip, 1 AS src_port, 2 AS dst_port, cast(NULL AS int) AS protocol"
    when = "timestamp_micros(1704067200000000L + cast(t AS bigint) * 1000000)"
    features = spark.createDataFrame(rows, "t int, x int").selectExpr(
        "*", *key.split(", "), f"{when} AS flow_start_time"
    ).drop("t")
    asked = spark.createDataFrame([(t,) for t in flows], "t int").selectExpr(
        "*", *key.split(", "), f"{when} AS flow_start_time"
    )
    missing = asked.limit(1).withColumn("flow_start_time", F.lit(None).cast("timestamp"))
    found = enrichment.enrich_flows_in_range(asked, features)
    assert found.columns == [*asked.columns, "x"]

    def nearest(t):
        near = sorted((abs(t - at), at, x) for at, x in rows if abs(t - at) <= 60)
        return near[0][2] if near else None

    assert {r.t: r.x for r in found.collect()} == {t: nearest(t) for t in flows}
    assert [r.x for r in enrichment.enrich_flows_in_range(missing, features).collect()] == [None]
    assert "NestedLoop" not in final_plan(found) and "Cartesian" not in final_plan(found)


def test_range_join_spreads_a_hot_tuple(spark):
    """A third of the rows under one tuple and time is whole, and lies in several tasks."""
    flows = spark.range(0, 30_000, 1, 8).selectExpr(
        "id", "if(id % 3 = 0, 'hot', cast(id % 900 AS string)) AS src_ip", "'b' AS dst_ip",
        "1 AS src_port", "2 AS dst_port", "6 AS protocol",
        "timestamp_seconds(1704067200 + if(id % 3 = 0, 30, id)) AS flow_start_time",
    )
    features = flows.dropDuplicates(["src_ip"]).drop("id").withColumn("x", F.length("src_ip"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = enrichment.enrich_flows_in_range(flows, features)
        tasks = found.filter("src_ip = 'hot'").groupBy(
            F.spark_partition_id().alias("p")
        ).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(t["count"] for t in tasks) == 10_000
    assert len(tasks) > 2 and max(t["count"] for t in tasks) < 5_000


def test_clustered_table_splits_a_hot_source(spark, flows):
    path = run_dir(spark, "clustered")
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        write_clustered(flows.repartition(16), path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    stored = spark.read.parquet(path)
    assert stored.count() == ROWS
    hot = stored.filter("src_ip_int = 1 AND flow_date = '2024-01-01'")
    sizes = [r["count"] for r in hot.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.7 * sum(sizes)
    rows = latest_flows_for_source(
        stored, 1, datetime(2024, 1, 1, 6), datetime(2024, 1, 2, 6), 5
    )
    plan = final_plan(rows)
    for part in ("EqualTo(src_ip_int,1)", "TakeOrderedAndProject"):
        assert part in plan
    assert "flow_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    want = flows.filter("src_ip_int = 1 AND flow_start_time < TIMESTAMP '2024-01-02 06:00:00'")
    assert [r.flow_id for r in rows.collect()] == [
        r.flow_id for r in want.orderBy(F.desc("flow_id")).limit(5).collect()
    ]


def test_files_are_sorted_within(spark, flows):
    path = run_dir(spark, "sorted")
    write_clustered(flows, path)
    for part in spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect():
        rows = spark.read.parquet(part.f).select("src_ip_int", "flow_start_time").collect()
        assert rows == sorted(
            rows, key=lambda r: (r.src_ip_int, -r.flow_start_time.timestamp())
        )


def test_upsert_table_rewrites_only_touched_days(spark, flows):
    path = run_dir(spark, "upsert")
    daily = flows.withColumn("flow_date", F.to_date("flow_start_time"))
    keys, newest = ["flow_date", "src_ip_int"], ["flow_start_time", "flow_id"]
    upsert_table(daily, path, keys, newest, "flow_date")
    before = {r.f for r in spark.read.parquet(path).select(
        F.input_file_name().alias("f")).distinct().collect()}
    change = daily.filter("flow_date = '2024-01-02' AND src_ip_int = 1").withColumn(
        "label", F.lit(99)
    )
    for _ in range(2):
        upsert_table(change, path, keys, newest, "flow_date")
    stored = spark.read.parquet(path)
    after = {r.f for r in stored.select(F.input_file_name().alias("f")).distinct().collect()}
    assert {f for f in before if "2024-01-02" not in f} <= after
    assert stored.count() == daily.select(*keys).distinct().count()
    assert [tuple(r) for r in stored.filter("label = 99").select(*keys).collect()] == [
        (datetime(2024, 1, 2).date(), 1)
    ]


def test_hot_conversation_is_combined_before_the_shuffle(spark):
    rows = spark.range(ROWS).select(
        F.timestamp_seconds(1704067200 + F.col("id") % 60).alias("ts"),
        F.lit("a").alias("src_ip"), F.lit("b").alias("dst_ip"),
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 50).cast("int")).alias("src_port"),
        F.lit(80).alias("dst_port"), F.lit(6).alias("protocol"),
        F.lit(100).alias("pkt_len"), F.lit(16).alias("tcp_flags"),
    )
    out = packets.assemble_flows(rows)
    plan = final_plan(out)
    assert "partial_sum" in plan and plan.count("Exchange hashpartitioning") >= 1
    assert out.agg(F.sum(F.col("in_pkts") + F.col("out_pkts"))).first()[0] == ROWS


def test_auc_with_a_hot_score(spark):
    scored = spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise((F.col("id") * 7919 % 1000) / 1000).alias("s"),
        ((F.col("id") * 31 % 100) < (F.col("id") * 7919 % 1000) / 20 + 10).cast("int").alias("y"),
    )
    local = scored.toPandas().sort_values("s")
    ranks = local["s"].rank()
    pos = int(local["y"].sum())
    want = (ranks[local["y"] == 1].sum() - pos * (pos + 1) / 2) / (pos * (ROWS - pos))
    for ranges in (1, 2, 64):
        got = metrics.auc_roc(scored, "y", "s", ranges).first().auc
        assert got == pytest.approx(want, abs=1e-12)


def test_hash_sample_is_exact_and_repeats(flows):
    one = sampling.hash_sample(flows, 1000)
    two = sampling.hash_sample(flows.repartition(7), 1000)
    ids = sorted(r.flow_id for r in one.collect())
    assert len(ids) == 1000 and ids == sorted(r.flow_id for r in two.collect())
    assert sampling.hash_sample(flows, ROWS).count() == ROWS


def test_hash_sample_with_repeated_ids(spark, flows):
    rows = flows.select((F.col("flow_id") % 5).alias("flow_id"), "src_ip_int").repartition(9)
    equal = spark.range(3000).select(F.lit(1).alias("flow_id"))
    for n in (1, 700, 2999):
        assert sampling.hash_sample(rows, n).count() == n
        assert sampling.hash_sample(equal, n).count() == n
    plan = final_plan(sampling.hash_sample(flows, 2000))
    assert "TakeOrderedAndProject" not in plan


def test_class_sample_is_exact_in_every_class(spark, flows):
    """Classes of any size, a null one, one that ends among equal keys, one of equal rows."""
    rows = flows.select("flow_id", F.when(F.col("flow_id") % 3 == 0, "hot").when(
        F.col("flow_id") % 7 == 0, F.lit(None).cast("string")
    ).otherwise(F.concat(F.lit("c"), (F.col("flow_id") % 5).cast("string"))).alias("kind"))
    equal = spark.range(500).select(F.lit(1).cast("bigint").alias("flow_id"), F.lit("e").alias("kind"))
    tied = spark.range(500).select((F.col("id") % 2).alias("flow_id"), F.lit("t").alias("kind"))
    rows = rows.unionByName(equal).unionByName(tied).repartition(7)
    sizes = {r.kind: r["count"] for r in rows.groupBy("kind").count().collect()}
    wanted = {"hot": 5_000, None: 40, "c1": 1, "c2": 10**6, "e": 77, "t": 300, "none": 5, "c3": 0}
    sample = sampling.class_sample(rows, "kind", wanted)
    assert sample.columns == rows.columns
    got = {r.kind: r["count"] for r in sample.groupBy("kind").count().collect()}
    assert got == {k: min(n, sizes[k]) for k, n in wanted.items() if n and k in sizes}
    again = sampling.class_sample(rows.repartition(3), "kind", wanted)
    assert sample.exceptAll(again).isEmpty() and again.exceptAll(sample).isEmpty()
    alone = sampling.hash_sample(rows.filter("kind = 'hot'"), 5_000)
    assert alone.exceptAll(sample.filter("kind = 'hot'")).isEmpty()
    assert sampling.class_sample(rows, "kind", {}).isEmpty()


def test_tree_samples_are_bounded(flows):
    rows = flows.withColumn("x", F.col("src_ip_int").cast("double"))
    per_tree = isolation.tree_samples(rows, ["x"], 7, 64, ["flow_id"], 1).groupBy("tree").count()
    assert [r["count"] for r in per_tree.collect()] == [64] * 7
    few = rows.limit(100)
    per_tree = isolation.tree_samples(few, ["x"], 7, 64, ["flow_id"], 1).groupBy("tree").count()
    assert [r["count"] for r in per_tree.collect()] == [64] * 7


def test_lookups_and_reports_prune_the_scan(spark, sf_dir):
    stored = flows_table(spark, sf_dir)
    for rows, pushed in (
        (flows_by_label(stored, 1), "EqualTo(label,1)"),
        (flows_by_attack_type(stored, "SSH-Bruteforce"), "EqualTo(attack_type,SSH-Bruteforce)"),
    ):
        assert pushed in final_plan(rows)
    plan = final_plan(volume_by_protocol(stored))
    assert "ReadSchema: struct<protocol:int,in_bytes:bigint,out_bytes:bigint>" in plan
    plan = final_plan(top_attack_types(stored))
    assert "ReadSchema: struct<attack_type:string>" in plan and "TakeOrderedAndProject" in plan


def test_breakdown_scans_once(spark, sf_dir):
    out = attack_breakdown_with_others(flows_table(spark, sf_dir), 2)
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1
