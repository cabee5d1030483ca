import pytest
from pyspark.sql import functions as F

from teletide.functions import text, times
from teletide.functions.attrs import attr, canonical_json, json_text, series_key
from teletide.functions.histogram import histogram_quantile
from teletide.functions.register import register_functions


def one(df):
    return df.first()[0]


@pytest.mark.parametrize("q, bounds, counts, want", [
    (0.95, [1.0, 2.0, 5.0, 10.0], [0, 0, 10, 0, 0], 4.85),
    (0.0, [1.0, 2.0, 5.0, 10.0], [0, 0, 10, 0, 0], 2.0),
    (1.0, [1.0, 2.0, 5.0, 10.0], [0, 0, 10, 0, 0], 5.0),
    (0.5, [1.0, 2.0], [4, 0, 0], 0.5),
    (0.5, [-1.0, 2.0], [4, 0, 0], -1.0),
    (0.99, [1.0, 2.0], [1, 1, 8], 2.0),
    (0.5, [1.0, 2.0], [0, 0, 0], None),
    (0.5, [1.0], [2, 2], 1.0),
    (0.75, [1.0, 2.0, 4.0], [2, 0, 2, 0], 3.0),
])
def test_histogram_quantile(spark, q, bounds, counts, want):
    register_functions(spark)
    df = spark.createDataFrame([(bounds, counts)], "b array<double>, c array<bigint>")
    got = one(df.select(histogram_quantile(q, F.col("b"), F.col("c"))))
    assert got == (pytest.approx(want) if want is not None else None)
    assert one(df.selectExpr(f"histogram_quantile({q}D, b, c)")) == got


def test_matches_needs_every_term_as_a_whole_word(spark):
    register_functions(spark)
    df = spark.createDataFrame([("Payment ERROR: time-out (42)",), ("errors only",), ("héllo wörld",)], "t string")
    hits = lambda q: [r[0] for r in df.select(text.matches(F.col("t"), q)).collect()]
    assert hits("error") == [True, False, False]
    assert hits("Error, OUT") == [True, False, False]
    assert hits("WÖRLD") == [False, False, True]
    assert hits("error missing") == [False, False, False]
    assert hits("") == [True, True, True]
    for q in ("error", "Error, OUT", "WÖRLD", "error missing"):
        assert [r[0] for r in df.selectExpr(f"matches(t, '{q}')").collect()] == hits(q)


@pytest.mark.parametrize("pattern", ["(?=a)", "(?<!a)b", r"(a)\1", "(?>a)", "a*+"])
def test_patterns_outside_re2_are_refused(pattern):
    with pytest.raises(ValueError):
        text.regex(None, pattern)


def test_regex_is_unanchored(spark):
    df = spark.createDataFrame([("abc",), ("xyz",)], "t string")
    assert df.where(text.regex(F.col("t"), "(?P<m>b)")).count() == 1
    assert df.where(text.regex(F.col("t"), r"a\+|^x")).count() == 1


def test_json_text(spark):
    df = spark.createDataFrame([('{"http.method":"GET","n":1,"z":null,"o\'k":"q"}',)], "j string")
    get = lambda k: one(df.select(json_text(F.col("j"), k)))
    assert (get("http.method"), get("n"), get("z"), get("gone"), get("o'k")) == ("GET", "1", None, None, "q")


def test_canonical_json_sorts_keys_and_keeps_types(spark):
    df = spark.createDataFrame([('{ "b": 1, "a": "x", "c": {"z": true, "y": null} }',), ("nonsense",)], "j string")
    got = [r[0] for r in df.select(canonical_json(F.col("j"))).collect()]
    assert got == ['{"a":"x","b":1,"c":{"y":null,"z":true}}', None]


def test_series_key_takes_string_attributes_only(spark):
    df = spark.createDataFrame(
        [("web", "cpu.util", '{"zone":"a","n":3,"ok":true,"b":"x"}'), (None, "m", "{}")],
        "s string, m string, a string")
    keys = [r[0] for r in df.select(series_key(F.col("s"), F.col("m"), F.col("a"))).collect()]
    assert keys == ['{"__name__":"cpu_util","b":"x","service":"web","zone":"a"}', '{"__name__":"m"}']


def test_attr_prefers_service_and_promoted_columns(logs):
    df = logs([{"service": "a", "attributes": '{"k":"json","service.name":"no"}'}])
    get = lambda d, k: one(d.select(attr(d, k)))
    assert get(df, "service") == get(df, "service.name") == "a"
    assert get(df, "k") == "json"
    promoted = df.withColumn("k", F.lit(None).cast("string"))
    assert get(promoted, "k") is None
    assert get(df, "body") is None  # a model column is not an attribute


def test_buckets_and_divisions_round_down_below_zero(spark):
    df = spark.createDataFrame([(-1,), (0,), (9,), (10,), (-10,)], "t bigint")
    rows = df.select(times.bucket(F.col("t"), 10), times.floor_div(F.col("t"), 10),
                     times.ceil_div(F.col("t"), 10)).collect()
    assert [tuple(r) for r in rows] == [(-10, -1, 0), (0, 0, 0), (0, 0, 1), (10, 1, 1), (-10, -1, -1)]
    with pytest.raises(ValueError):
        times.bucket(F.col("t"), 0)


def test_days_are_utc_even_in_another_session_zone(spark):
    df = spark.createDataFrame([(1_700_000_000_000_000_000,), (-1,)], "t bigint")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = [str(r[0]) for r in df.select(times.to_day(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2023-11-14", "1969-12-31"]
