import json

from pyspark.sql import functions as F

from flowloom.functions import messages as fn
from flowloom.operators.normalize import legacy_from_documents, normalize_flow_export
from flowloom.schemas import MESSAGE


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "json string")


def parse_one(spark, value):
    return fn.parse_flow_json(texts(spark, value)).first().asDict()


def test_large_addresses_and_float_longs_survive(spark):
    row = parse_one(spark, json.dumps({
        "src_ip": "192.168.0.1", "src_ip_int": 3232235521, "duration_ms": 1234.0, "in_bytes": 7,
        "src_port": 80,
    }))
    assert row["src_ip_int"] == 3232235521
    assert (row["duration_ms"], row["in_bytes"], row["src_port"]) == (1234, 7, 80)
    assert row["out_bytes"] is None


def test_bad_field_is_null_and_the_rest_stays(spark):
    row = parse_one(spark, '{"src_port": "http", "dst_port": 443, "protocol": 6}')
    assert (row["src_port"], row["dst_port"], row["protocol"]) == (None, 443, 6)


def test_unreadable_documents_are_rows_of_nulls(spark):
    for text in ("not json", "null", "", None, '{"src_port": 1'):
        assert set(parse_one(spark, text).values()) == {None}, text


def test_split_malformed(spark):
    good = ['{}', '{"a": 1}', '{"src_port": "http"}', '{"in_bytes": 1e999}']
    bad = ["not json", "null", "[1]", "5", "", None, '{"a": 1', '"text"']
    readable, rejected = fn.split_malformed(texts(spark, *good, *bad))
    assert sorted(r.json for r in readable.collect()) == sorted(good)
    assert {r.json for r in rejected.collect()} == set(bad)


def test_parse_reads_each_message_once(spark):
    plan = fn.parse_flow_json(texts(spark, "{}"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_encode_alert_fields(spark):
    scored = spark.sql(
        "SELECT 'a' AS src_ip, 'b' AS dst_ip, 1 AS src_port, 2 AS dst_port, 6 AS protocol, "
        "10L AS in_bytes, 20L AS out_bytes, 30L AS duration_ms, 0.75D AS anomaly_score, "
        "TIMESTAMP '2024-01-02 03:04:05' AS ingestion_time, 'x' AS other"
    )
    assert json.loads(fn.encode_alert(scored).first().value) == {
        "src_ip": "a", "dst_ip": "b", "src_port": 1, "dst_port": 2, "protocol": 6,
        "in_bytes": 10, "out_bytes": 20, "duration_ms": 30, "anomaly_score": 0.75,
        "ingestion_time": "2024-01-02T03:04:05.000Z",
    }


def test_encode_row_keeps_odd_names(spark):
    rows = spark.createDataFrame([(1, "x")], "`Src Addr` int, `a.b` string")
    value = fn.encode_row(rows, F.lit("f.csv")).first().value
    assert json.loads(value) == {"Src Addr": 1, "a.b": "x", "source_file": "f.csv"}


def test_export_with_short_names(spark):
    rows = spark.createDataFrame(
        [("10.0.0.1", "10.0.0.2", "80", "90", "17", "100", "7", "3", "2")],
        "sa string, da string, sp string, dp string, pr string, ibyt string, obyt string, "
        "ipkt string, opkt string",
    )
    out = normalize_flow_export(rows)
    assert out.schema.names == MESSAGE.names
    row = out.first()
    assert (row.src_ip_int, row.dst_port, row.protocol) == (167772161, 90, 17)
    assert (row.in_bytes, row.out_bytes, row.in_pkts, row.out_pkts) == (100, 7, 3, 2)
    assert (row.l7_proto, row.duration_ms, row.tcp_flags, row.attack_type) == (7.0, 0, 0, "Benign")


def test_export_falls_back_past_blank_headers(spark):
    rows = spark.createDataFrame(
        [("", "10.0.0.9"), ("10.0.0.8", "10.0.0.9"), (None, None)],
        "`Src Addr` string, SrcAddr string",
    )
    assert [r.src_ip for r in normalize_flow_export(rows).collect()] == [
        "10.0.0.9", "10.0.0.8", "",
    ]


def test_legacy_documents(spark):
    out = legacy_from_documents(texts(
        spark,
        '{"sa": "1.1.1.1", "dest_ip": "2.2.2.2", "sp": "80.0", "pr": 6, "ibyt": 0, "bytes_in": 5}',
        '{"src_ip": "3.3.3.3", "opkt": "oops", "num_pkts_out": 4}',
    )).collect()
    assert (out[0].src_ip, out[0].dest_ip, out[0].src_port, out[0].protocol) == (
        "1.1.1.1", "2.2.2.2", 80, 6,
    )
    assert (out[0].bytes_in, out[0].bytes_out) == (5, 0)
    assert (out[1].src_ip, out[1].dest_ip, out[1].num_pkts_out) == ("3.3.3.3", None, 4)
