"""Number and text reading against Python's own."""

import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from invoicelake.functions.text import basename, read_float, read_int, remove_first, strip, utc_seconds


def evaluate(spark, expression, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, c string")
    return [r.v for r in df.select("i", F.expr(expression("c")).alias("v")).orderBy("i").collect()]


def python_float(text):
    try:
        return float(text)
    except ValueError:
        return None


def python_int(text):
    try:
        n = int(text)
    except ValueError:
        return None
    return n if -2**31 <= n < 2**31 else None


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


NUMBERS = st.one_of(
    st.text("0123456789+-._eE", max_size=8), st.floats().map(repr), st.integers().map(str),
    st.sampled_from(["nan", "NaN", "+nan", "-nan", "INF", "-inf", "Infinity", "infin", "1d", "1f", "0x1p3", "1L", ""]),
)


@settings(max_examples=20, deadline=None)
@given(st.lists(NUMBERS, min_size=30, max_size=60))
def test_numbers(spark, texts):
    for text, got in zip(texts, evaluate(spark, read_float, texts)):
        assert same(got, python_float(text)), text
    for text, got in zip(texts, evaluate(spark, read_int, texts)):
        assert got == python_int(text), text


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.sampled_from("a é\t\n\r  　\u0085\u001c"), max_size=8), min_size=20, max_size=40))
def test_strip(spark, texts):
    assert evaluate(spark, strip, texts) == [t.strip() for t in texts]


def test_basename(spark):
    assert evaluate(spark, basename, ["a/b/x 1.xml", "x.xml", "file:/a%20b.xml"]) == ["x 1.xml", "x.xml", "a%20b.xml"]


def test_remove_first(spark):
    got = evaluate(spark, lambda c: remove_first(c, "NFe"), ["NFe1NFe2", "7NFe8", "x", "", None])
    assert got == ["1NFe2", "78", "x", "", None]


def test_utc_seconds_in_any_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/Sao_Paulo", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            df = spark.range(1).select(F.expr(utc_seconds("timestamp_micros(1700000000999999)")).alias("t"))
            assert df.first().t == "2023-11-14T22:13:20Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
