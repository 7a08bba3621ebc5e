import pytest
from pyspark.sql import functions as F

from flowloom.functions import messages as fn
from flowloom.operators.cleaning import assign_flow_id
from flowloom.operators import reports
from flowloom.operators.reports import alert_trend
from flowloom.plans import fixtures as fx
from flowloom.plans.stored import message_topic
from flowloom.plans import streams
from flowloom.plans.streams import in_turns, outputs_in
from flowloom.schemas import FIVE_TUPLE, FLOW, FLOW_COLUMNS, MESSAGE
from flowloom.session import child_names, run_dir
from flowloom.sources.topics import Topic, batch_messages, publish_messages, stream_messages
from flowloom.streaming import directory, enrichment, history, legacy, realtime, rollups

RAW_3 = "a string, b string, c string"


def run_stream(spark, topic, outputs, base, **kwargs):
    realtime.realtime_scoring(
        stream_messages(spark, topic, kwargs.pop("max_files", None)),
        kwargs.pop("scorer", fx.fixed_scorer), outputs, f"{base}/checkpoint", once=True, **kwargs,
    ).awaitTermination()


def test_stream_equals_batch(spark, sf_dir):
    base = run_dir(spark, "t-stream")
    topic = Topic("in", base, "parquet")
    publish_messages(fx.messages(spark, sf_dir).repartition(6), topic)
    outputs = outputs_in(base)
    run_stream(spark, topic, outputs, base, max_files=2)

    texts = batch_messages(spark, topic).transform(fn.decode_value)
    readable, rejected = fn.split_malformed(texts)
    batch = readable.transform(fn.parse_flow_json)
    history = spark.read.schema(FLOW).parquet(outputs.history)
    got = history.select(*MESSAGE.names)
    assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()
    assert spark.read.parquet(outputs.rejects).count() == rejected.count() > 0
    predictions = spark.read.parquet(outputs.predictions)
    assert predictions.count() == history.count()
    # Each prediction belongs to a stored flow, and several batches ran.
    key = [history.flow_id == predictions.flow_id, history.src_ip_int == predictions.src_ip_int,
           history.flow_start_time == predictions.ingestion_time]
    assert predictions.join(history, key, "left_anti").isEmpty()
    assert predictions.select("batch_id").distinct().count() == 3


def test_a_batch_that_runs_again_replaces_its_outputs(spark, sf_dir):
    base = run_dir(spark, "t-again")
    outputs = outputs_in(base)
    texts = (
        fx.messages(spark, sf_dir).transform(fn.decode_value)
        .withColumn("ingestion_time", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    )
    counts = []
    for _ in range(2):
        realtime.score_messages(texts, 0, fx.fixed_scorer, outputs)
        counts.append([
            spark.read.parquet(path).count()
            for path in (outputs.history, outputs.predictions, outputs.alerts.path, outputs.rejects)
        ])
    assert counts[0] == counts[1]


def test_flows_without_features_are_stored_but_not_scored(spark):
    base = run_dir(spark, "t-partial")
    outputs = outputs_in(base)
    texts = spark.createDataFrame(
        [('{"src_ip": "10.0.0.1", "dst_ip": " 10.0.0.2 ", "src_port": 1, "attack_type": "Bot"}',),
         ('{"src_ip": "10.0.0.3", "dst_ip": "10.0.0.4"}',),
         # As in a load, a row without an address is no flow.
         ('{"src_ip": "10.0.0.5"}',), ("{}",)],
        "json string",
    ).withColumn("ingestion_time", F.current_timestamp())

    def scorer(flows):
        return fx.fixed_scorer(flows.filter("src_port IS NOT NULL"))

    realtime.score_messages(texts, 5, scorer, outputs)
    history = {r.src_ip: r for r in spark.read.schema(FLOW).parquet(outputs.history).collect()}
    assert set(history) == {"10.0.0.1", "10.0.0.3"}
    assert history["10.0.0.1"].dst_ip == "10.0.0.2"
    assert history["10.0.0.1"].dst_ip_int == 167772162
    assert (history["10.0.0.1"].label, history["10.0.0.3"].label) == (1, None)
    assert list(history["10.0.0.1"].asDict()) == [*FLOW_COLUMNS, "batch_id"]
    assert spark.read.parquet(outputs.predictions).count() == 1


def test_enrichment_runs_before_the_scorer(spark):
    base = run_dir(spark, "t-enrich")
    outputs = outputs_in(base)
    texts = spark.createDataFrame(
        [('{"src_ip": "10.0.0.1", "dst_ip": "10.0.0.2", "src_port": 1}',)], "json string"
    ).withColumn("ingestion_time", F.current_timestamp())

    def scorer(flows):
        score = F.when(F.col("hot"), 0.9).otherwise(0.1)
        return flows.withColumns({
            "anomaly_score": score, "prediction": (score > 0.5).cast("double"),
            "is_anomaly": (score > 0.5).cast("int"),
        })

    realtime.score_messages(
        texts, 0, scorer, outputs, enrich=lambda flows: flows.withColumn("hot", F.lit(True))
    )
    assert spark.read.parquet(outputs.predictions).first().is_anomaly == 1
    assert batch_messages(spark, outputs.alerts).count() == 1


def test_failed_search_index_does_not_stop_a_batch(spark, sf_dir):
    base = run_dir(spark, "t-index")
    outputs = outputs_in(base)
    broken = realtime.Outputs(**{
        **outputs.__dict__, "documents_fmt": "no.such.connector",
        "index_failures": f"{base}/failures",
    })
    texts = fx.messages(spark, sf_dir).transform(fn.decode_value).withColumn(
        "ingestion_time", F.current_timestamp()
    )
    realtime.score_messages(texts, 0, fx.fixed_scorer, broken)
    assert spark.read.parquet(broken.predictions).count() > 0
    missing = spark.read.parquet(broken.index_failures).collect()
    assert [r.target for r in missing] == [realtime.batch_path(broken.documents, 0)]


def test_failures_are_named_by_default(spark, sf_dir):
    base = run_dir(spark, "t-index-default")
    given = outputs_in(base)
    assert given.index_failures == f"{base}/index_failures"
    broken = realtime.Outputs(**{
        **given.__dict__, "documents_fmt": "no.such.connector", "index_failures": None,
    })
    texts = fx.messages(spark, sf_dir).transform(fn.decode_value).withColumn(
        "ingestion_time", F.current_timestamp()
    )
    realtime.score_messages(texts, 0, fx.fixed_scorer, broken)
    missing = spark.read.parquet(f"{broken.rejects}_index_failures").collect()
    assert [r.target for r in missing] == [realtime.batch_path(broken.documents, 0)]

    topic = message_topic(spark, sf_dir)
    legacy.legacy_batch_load(spark, topic, "no-such-store://index/flows", f"{base}/rows")
    missing = spark.read.parquet(f"{base}/rows_index_failures").collect()
    assert [r.target for r in missing] == ["no-such-store://index/flows"]


def test_directory_takes_each_file_once_and_sets_bad_rows_aside(spark):
    base = run_dir(spark, "t-dir")
    lines = spark.createDataFrame(
        [("a,b,c",), ("1,2,3",), ("4,5",), ("6,7,8,9",), ('10,"x,y",12',)], "value string"
    ).coalesce(1)

    def ingest():
        schema = spark.createDataFrame([], RAW_3).schema
        directory.ingest_csv_directory(
            spark, f"{base}/in", schema, f"{base}/out", f"{base}/bad", f"{base}/checkpoint",
            once=True,
        ).awaitTermination()
        return (
            sorted((r.a, r.b, r.c) for r in spark.read.parquet(f"{base}/out").collect()),
            sorted(r._corrupt_record for r in spark.read.parquet(f"{base}/bad").collect()),
        )

    lines.write.text(f"{base}/in")
    good, bad = ingest()
    assert good == [("1", "2", "3"), ("10", "x,y", "12")] and bad == ["4,5", "6,7,8,9"]
    assert ingest() == (good, bad)
    lines.write.mode("append").text(f"{base}/in")
    again = ingest()
    assert again == (sorted(good * 2), sorted(bad * 2))
    assert spark.read.parquet(f"{base}/out").select("source_file").distinct().count() == 2


def test_streamed_trend_holds_only_closed_buckets(spark):
    rows = spark.createDataFrame(
        [("2024-01-01 00:10:00", 1.0), ("2024-01-01 00:20:00", 0.0), ("2024-01-01 01:30:00", 1.0)],
        "t string, prediction double",
    ).withColumn("flow_start_time", F.col("t").cast("timestamp"))
    assert [r.alerts for r in alert_trend(rows).orderBy("bucket_start").collect()] == [1, 1]


def test_files_are_read_by_name_or_set_aside(spark):
    """Swapped columns are found by name; a file that lacks one does not stop the next."""
    base = run_dir(spark, "t-dir-order")
    schema = spark.createDataFrame([], RAW_3).schema

    def put(*lines):
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode(
            "append"
        ).text(f"{base}/in")

    def ingest():
        directory.ingest_csv_directory(
            spark, f"{base}/in", schema, f"{base}/out", f"{base}/bad", f"{base}/checkpoint",
            max_files=1, once=True,
        ).awaitTermination()
        return (
            sorted((r.a, r.b, r.c) for r in spark.read.parquet(f"{base}/out").collect()),
            sorted(r._corrupt_record for r in spark.read.parquet(f"{base}/bad").collect()),
        )

    put("a,b,c", "1,2,3")
    put("c,b,a", "6,5,4")
    put("a,b", "7,8")
    put("a,b,c,b", "7,8,9,9")
    put('"c",x,"b",a', "12,0,11,10", "1,2")
    good, bad = ingest()
    assert good == [("1", "2", "3"), ("10", "11", "12"), ("4", "5", "6")]
    assert bad == ["1,2", "file lacks c", "file names a column twice"]
    put("a,b,c", "13,14,15")
    assert ingest() == (sorted([*good, ("13", "14", "15")]), bad)


def test_load_numbers_that_do_not_fit_are_refused(spark):
    with pytest.raises(ValueError):
        assign_flow_id(spark.range(1), load=1 << 12)
    ids = [
        r.flow_id for stream in (False, True) for load in (0, 1)
        for r in assign_flow_id(spark.range(0, 50, 1, 5), None, load, stream).collect()
    ]
    assert len(set(ids)) == 200 and min(ids) >= 0


def test_readers_of_the_history_open_no_retired_batch(spark):
    base = run_dir(spark, "t-history")
    one = spark.createDataFrame(
        [("10.0.0.1", "2024-01-01 10:00:00"), ("10.0.0.2", "2024-01-02 10:00:00")],
        "src_ip string, t string",
    ).withColumn("flow_start_time", F.col("t").cast("timestamp")).drop("t")

    def put(batch):
        flows = one.select(*[
            (F.col(f.name) if f.name in one.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in FLOW.fields
        ]).withColumn("flow_id", F.lit(batch).cast("bigint"))
        flows.write.mode("overwrite").parquet(f"{base}/h/batch_id={batch}")

    def files():
        rows = history.read_history(spark, f"{base}/h", f"{base}/c")
        opened = rows.select(F.input_file_name().alias("f")).distinct().collect()
        assert rows.count() == rows.distinct().count()
        return rows.count(), sum("batch_id=" in r.f for r in opened)

    def folders():
        return sorted(child_names(spark, f"{base}/h"))

    for batch in (0, 1, 3):
        put(batch)
    assert history.compact_history(spark, f"{base}/h", f"{base}/c") == 3
    assert files() == (6, 0)
    # Kept until the next compaction, for readers that began before.
    assert folders() == ["batch_id=0", "batch_id=1", "batch_id=3"]
    for batch in (2, 4):
        put(batch)
    rows, opened = files()
    assert rows == 10 and 0 < opened <= 4
    assert history.compact_history(spark, f"{base}/h", f"{base}/c") == 2
    assert folders() == ["batch_id=2", "batch_id=4"]
    assert history.compact_history(spark, f"{base}/h", f"{base}/c") == 0
    assert folders() == [] and files() == (10, 0)
    # A run that no list names, as of a compaction that died, is not read.
    put(9)
    spark.read.schema(FLOW).parquet(f"{base}/h/batch_id=9").withColumn(
        "flow_date", F.to_date("flow_start_time")
    ).write.partitionBy("flow_date").parquet(f"{base}/c/runs/run=dead")
    assert files()[0] == 12


def test_streamed_features_may_be_late_and_survive_a_restart(spark):
    """A feature that comes batches after its flow is found, one beyond the delay is not, and a
    flow that is sent twice is one."""
    base = run_dir(spark, "t-enrich-stream")
    key = "'a' AS src_ip, 'b' AS dst_ip, 1 AS src_port, 2 AS dst_port, 6 AS protocol"

    def at(seconds):
        return f"timestamp_seconds(1704067200 + {seconds}) AS flow_start_time"

    def put(name, *rows):
        column = "flow_id" if name == "flows" else "x"
        for second, value in rows:
            spark.sql(f"SELECT {key}, {at(second)}, {value}L AS {column}").coalesce(
                1).write.mode("append").parquet(f"{base}/{name}")

    def run():
        def stream(name, more):
            schema = (
                "src_ip string, dst_ip string, src_port int, dst_port int, protocol int, "
                f"flow_start_time timestamp, {more} bigint"
            )
            return spark.readStream.schema(schema).parquet(f"{base}/{name}")

        joined = enrichment.enrich_stream(
            stream("flows", "flow_id"), stream("features", "x"), within=60, delay="100 seconds"
        )
        joined.writeStream.format("parquet").option("path", f"{base}/out").option(
            "checkpointLocation", f"{base}/checkpoint"
        ).trigger(availableNow=True).start().awaitTermination()
        rows = spark.read.schema(joined.schema).parquet(f"{base}/out").collect()
        return sorted((r.flow_id, r.x) for r in rows)

    put("flows", (0, 1), (0, 1), (30, 2))
    put("features", (200, 9))
    assert run() == []
    # Late by more than a batch, but within the delay of the watermark (flows are at 30).
    put("features", (50, 7), (10, 8))
    put("flows", (400, 3))
    run()
    put("features", (400, 5), (2000, 6))
    put("flows", (2000, 4))
    run()
    # Beyond the delay: the watermark has passed it.
    put("features", (35, 99))
    put("flows", (9000, 10))
    put("features", (9000, 11))
    got = run()
    assert got == [(1, 8), (2, 8), (3, 5), (4, 6)]


def test_rollups_keep_their_error_bounds_and_forget_repeats(spark, tmp_path):
    """Distinct sources and quantiles of any period, after repeats and compactions."""
    scored = spark.range(60_000).select(
        (F.col("id") % 7_000).alias("src_ip_int"),
        F.concat(F.lit("s"), F.col("id") % 7_000).alias("src_ip"),
        F.timestamp_seconds(1704067200 + F.col("id") % (72 * 3600)).alias("flow_start_time"),
        (F.col("id") % 3).cast("int").alias("protocol"), F.lit("Benign").alias("attack_type"),
        (F.col("id") * 17 % 10_007).alias("in_bytes"), F.lit(5).cast("bigint").alias("out_bytes"),
        (F.col("id") % 10 == 0).cast("double").alias("prediction"),
        (F.col("id") % 10 == 0).cast("int").alias("is_anomaly"),
        (F.col("id") % 10 / 10).alias("anomaly_score"),
    )
    folder, compacted = f"{tmp_path}/b", f"{tmp_path}/c"
    for batch in (0, 1, 2, 1, 0):
        rollups.write_rollups(scored.filter(F.col("src_ip_int") % 3 == batch), batch, folder)
    start, end = (F.lit(f"2024-01-0{d} 06:00:00").cast("timestamp") for d in (1, 3))
    within = scored.filter((F.col("flow_start_time") >= start) & (F.col("flow_start_time") < end))
    for _ in range(3):
        for rows, limits in ((scored, ()), (within, (start, end))):
            hourly = rollups.read_hourly(spark, folder, compacted, *limits)
            exact = rows.agg(F.count_distinct("src_ip_int").alias("n")).first().n
            assert abs(rollups.distinct_sources(hourly).first().sources - exact) < 0.05 * exact
            values = sorted(r[0] for r in rows.select(F.expr("in_bytes + out_bytes")).collect())
            found = rollups.flow_bytes_quantiles(hourly, [0.1, 0.5, 0.99]).first().quantiles
            for share, value in zip((0.1, 0.5, 0.99), found, strict=True):
                rank = sum(v <= value for v in values) / len(values)
                assert abs(rank - share) < 0.02
            assert hourly.agg(F.sum("flows")).first()[0] == rows.count()
            by_protocol = rollups.volume_by_protocol(hourly).orderBy("protocol").collect()
            plain = reports.volume_by_protocol(rows).orderBy("protocol").collect()
            assert by_protocol == plain
        rollups.compact_rollups(spark, folder, compacted)
    assert child_names(spark, f"{folder}/hourly") == []
    plan = rollups.read_hourly(spark, folder, compacted, start, end)._jdf.queryExecution()
    assert "PartitionFilters: [isnotnull(day" in plan.executedPlan().toString()


def test_streamed_enrichment_grows_with_rows_not_with_pairs(spark, tmp_path):
    """Two thousand flows and as many records in each other's range, all of one 5-tuple."""
    base, n = str(tmp_path), 2000
    ends = ["'a' AS src_ip", "'b' AS dst_ip", "1 AS src_port", "2 AS dst_port", "6 AS protocol"]
    # Records lie on even seconds, two at a time; odd flows are as near to the one after.
    flows = spark.range(n).union(spark.range(10)).selectExpr(
        *ends, "id AS flow_id", "timestamp_seconds(1704067200 + id) AS flow_start_time"
    )
    features = spark.range(n).selectExpr(
        *ends, "timestamp_seconds(1704067200 + 2 * (id div 2)) AS flow_start_time", "id AS x"
    )
    for key in (("flow_id",), (*FIVE_TUPLE, "flow_id")):
        out = f"{base}/{len(key)}"
        joined = enrichment.enrich_stream(
            in_turns(flows, f"{out}/flows", 2), in_turns(features, f"{out}/features", 2),
            row_key=key, within=21_600, delay="1 day",
        )
        query = joined.writeStream.format("parquet").option("path", f"{out}/rows").option(
            "checkpointLocation", f"{out}/checkpoint"
        ).trigger(availableNow=True).start()
        query.awaitTermination()
        rows = spark.read.schema(joined.schema).parquet(f"{out}/rows").filter("src_ip = 'a'")
        assert sorted((r.flow_id, r.x) for r in rows.collect()) == [
            (i, 2 * (i // 2) + 1) for i in range(n)
        ]
        # In the operator that holds what meets.
        held = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress)
        assert held <= 20
    table = enrichment.enrich_stream(flows, features, ("flow_id",), within=0)
    assert table.filter("x = flow_id + 1").count() == table.filter("x IS NOT NULL").count() == n // 2


def test_turns_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "_FILE_ROWS", 50, raising=False)
    rows = spark.range(300).selectExpr(
        "timestamp_seconds(1704067200 + id) AS flow_start_time", "'a' AS src_ip", "id"
    ).union(spark.sql("SELECT CAST(NULL AS timestamp), 'null', -1L"))
    arriving = in_turns(rows, f"{tmp_path}/in", 3)
    stored = spark.read.parquet(f"{tmp_path}/in").withColumn("file", F.input_file_name())
    sizes = [r["count"] for r in stored.groupBy("file").count().collect()]
    assert sum(sizes) == 302 and max(sizes) <= 60
    query = arriving.writeStream.format("noop").option(
        "checkpointLocation", f"{tmp_path}/checkpoint"
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    taken = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert taken[-1] == 1 and len(taken) == 4 and all(95 <= n <= 106 for n in taken[:3])
