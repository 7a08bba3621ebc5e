import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType

from flowloom.functions import fields, labels
from flowloom.functions.addresses import ipv4_to_long


def apply(spark, function, values, dtype="string"):
    """Results of a column function, in input order. Values come from a table, so
    nothing is folded away before it runs."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {dtype}")
    return [r[0] for r in rows.repartition(2).select(function(F.col("v")).alias("o"), "i")
            .orderBy("i").collect()]


@pytest.mark.parametrize("ip, value", [
    ("0.0.0.0", 0), ("192.168.0.1", 3232235521), ("255.255.255.255", 4294967295),
    ("10.0.0.1", 167772161), ("1.2.3", 0), ("1.2.3.4.5", 0), ("256.1.1.1", 0), ("bad-ip", 0),
    ("", 0), (None, 0), (" 1.2.3.4", 0), ("1.2.3.-4", 0), ("1234.1.1.1", 0), ("1..2.3", 0),
])
def test_ipv4_to_long(spark, ip, value):
    assert apply(spark, ipv4_to_long, [ip]) == [value]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=40))
def test_ipv4_round_trip(spark, numbers):
    texts = [".".join(str(n >> s & 255) for s in (24, 16, 8, 0)) for n in numbers]
    assert apply(spark, ipv4_to_long, texts) == numbers


def test_number_from_text(spark):
    texts = ["6", "6.9", "-3.2", " 7 ", "x", "", None, "99999999999", "1.2.3", "5."]
    as_long = [6, 6, -3, 7, None, None, None, 99999999999, None, 5]
    as_int = [v if v is None or abs(v) < 2**31 else None for v in as_long]
    assert apply(spark, lambda c: fields.number_from_text(c, LongType()), texts) == as_long
    assert apply(spark, lambda c: fields.number_from_text(c, IntegerType()), texts) == as_int
    assert apply(spark, lambda c: fields.number_from_text(c, DoubleType()), ["7.5", "x"]) == [
        7.5, None,
    ]


def test_floor_long_keeps_what_fits(spark):
    values = [1234.0, 1234.9, float("inf"), float("nan"), 1e300, None]
    assert apply(spark, fields.floor_long, values, "double") == [1234, 1234, None, None, None, None]


def test_coerce_number(spark):
    texts = ["12", "12.9", "-1.5", "1e3", "", None, "x", "nan"]
    assert apply(spark, fields.coerce_number, texts) == [12, 12, -1, 1000, 0, 0, 0, 0]


def test_duration_to_ms(spark):
    texts = ["1.001", "0.057", "12", "", None, "x"]
    assert apply(spark, fields.duration_to_ms, texts) == [1001, 57, 12000, None, None, None]


def test_protocol_number(spark):
    texts = ["TCP", "udp", "UDP/17", "1", "6.0", "", None, "ICMP"]
    assert apply(spark, fields.protocol_number, texts) == [6, 17, 17, 1, 6, 0, 0, 0]


def test_decode_tcp_flags(spark):
    texts = [".AP.SF", "......", "C", "0x1b", "27", "", None, "UAPRSF", "EC", "S"]
    assert apply(spark, fields.decode_tcp_flags, texts) == [27, 0, 128, 27, 27, 0, 0, 63, 192, 2]


def test_labels(spark):
    assert apply(spark, labels.derive_label, ["0", "1", "Benign", "Attack", None, " 0"]) == [
        0, 1, 0, 1, 1, 0,
    ]
    assert apply(spark, labels.binary_label, ["Benign", "benign", "Bot", None]) == [0, 1, 1, 1]


def test_severity_bands(spark):
    scores = [0.0, 0.49, 0.5, 0.79, 0.8, 1.0, None]
    assert apply(spark, labels.severity, scores, "double") == [
        "low", "low", "medium", "medium", "high", "high", None,
    ]


def test_drop_incomplete(spark):
    rows = spark.createDataFrame(
        [(1, 1.0, "a"), (2, None, "b"), (3, float("nan"), "c"), (None, 1.0, "d"), (5, 1.0, None)],
        "k int, x double, t string",
    )
    assert [r.k for r in fields.drop_incomplete(rows).collect()] == [1]
    assert {r.t for r in fields.drop_incomplete(rows, ["x"]).collect()} == {"a", "d", None}
