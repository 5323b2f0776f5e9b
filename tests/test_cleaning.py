import datetime as dt

import pytest
from pyspark.sql import functions as F

from churnspark.functions import columns as C
from churnspark.operators import cleaning as K
from churnspark.operators.features import FeatureSpec


def test_blank_to_null(spark):
    texts = [" ", "  ", "", "\t", " ", " \n", "a", None, "\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = [r.s for r in K.blank_to_null(df).orderBy("i").collect()]
    assert got == [None, "  ", "", None, None, None, "a", None, None]


def test_drop_incomplete_counts_id_and_label(spark):
    df = spark.createDataFrame([("a", 1.0, "Yes"), (None, 1.0, "No"), ("b", None, "No"), ("c", 2.0, None)], "id string, x double, y string")
    assert [r.id for r in K.drop_incomplete(df).collect()] == ["a"]


def test_recode_and_known_labels(spark):
    df = spark.createDataFrame([("1",), ("0",), ("Yes",), (None,)], "s string")
    assert sorted(r.s for r in K.known_labels(K.recode(df, "s", {"1": "Yes", "0": "No"}), "s").collect()) == ["No", "Yes", "Yes"]


def test_cast_request(spark):
    schema = spark.createDataFrame([], "seg string, tenure double, n bigint").schema
    got = K.cast_request(spark.createDataFrame([("k", "29", "7")], "id string, tenure string, n string"), schema, keep=["id"])
    assert tuple(got.first()) == ("k", 29.0, 7)
    with pytest.raises(ValueError, match="unknown request fields"):
        K.cast_request(spark.createDataFrame([("x",)], "other string"), schema)


def test_fill_defaults_adds_absent_fields(spark):
    defaults = spark.createDataFrame([("DSL", 5.0)], "net string, tenure double")
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "id string, tenure double")
    got = {r.id: (r.net, r.tenure) for r in K.fill_defaults(df, defaults).collect()}
    assert got == {"a": ("DSL", 5.0), "b": ("DSL", 1.0)}


def test_fill_defaults_moves_no_rows(spark):
    plan = K.fill_defaults(spark.range(10).withColumn("x", F.lit(None).cast("double")), spark.createDataFrame([(1.0,)], "x double"))
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_by_id(spark):
    assert K.by_id(spark.range(5), "id", 3).first().id == 3
    with pytest.raises(KeyError):
        K.by_id(spark.range(5), "id", 9)


def test_overlay_null_wins(spark):
    df = spark.sql("select map('a', 'x', 'b', 'y') d, map('a', cast(null as string), 'c', 'z') s")
    assert df.select(C.overlay("d", "s").alias("m")).first().m == {"a": None, "b": "y", "c": "z"}


def test_quantize(spark):
    xs = [-1.0, -0.3, -0.299, 0.0, 0.299, 0.3, 1.0, None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    assert [r.q for r in df.orderBy("i").select(C.quantize("x", -0.3, 0.3).alias("q")).collect()] == [0, 0, 0, 3, 6, 6, 6, None]
    assert [r.q for r in df.orderBy("i").select(C.quantize("x", 0, 0).alias("q")).collect()] == [0, 0, 0, 6, 6, 6, 6, None]


def test_url_params(spark):
    urls = ["http://h/p?page=2&ref=x", "http://h/p", "http://h/p?a=1&a=2#f?b=3", "http://h/p?q=a%20b+c&flag&bad=%zz", "http://h/p?e=1=2"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string")
    got = [r.m for r in df.orderBy("i").select(C.url_params("u").alias("m")).collect()]
    assert got == [{"page": "2", "ref": "x"}, {}, {"a": "2"}, {"q": "a b c", "flag": "", "bad": "%zz"}, {"e": "1=2"}]


def test_valid_override(spark):
    df = spark.createDataFrame([("1.5",), ("12abc",), ("",), (None,), ("NaN",), ("-3",), ("Infinity",)], "s string")
    assert [r.v for r in df.select(C.valid_override("s").alias("v")).collect()] == [True, False, False, False, False, True, False]


def test_times(spark):
    df = spark.createDataFrame([(1_000, 2_500), (0, 3_250)], "s long, e long").select(C.ms_to_ts("s").alias("s"), C.ms_to_ts("e").alias("e"))
    got = df.select(C.processing_time_compat("s", "e").alias("c"), C.processing_ms("s", "e").alias("m")).collect()
    assert [tuple(r) for r in got] == [(500_000_000, 1500), (250_000_000, 3250)]
    one = spark.createDataFrame([(dt.datetime(2024, 3, 5, 14, 7, 9),)], "t timestamp").select(C.run_suffix("t").alias("s")).first()
    assert one.s == "05032024140709"
    assert spark.range(1).select(C.now_ms().alias("n")).first().n > 1_700_000_000_000


def test_threshold_tie(spark):
    r = spark.createDataFrame([(0.5,)], "p double").select(C.threshold_label("p").alias("a"), C.threshold_label("p", tie=False).alias("b")).first()
    assert (r.a, r.b) == (True, False)


def test_text_helpers(spark):
    df = spark.createDataFrame([(10, 3, 7, 0.123456)], "t long, c long, r long, p double")
    r = df.select(C.format_summary("t", "c", "r").alias("s"), C.short_text("p").alias("p")).first()
    assert r.s == "3 of 10 customers churned and 7 stayed" and r.p == "0.123"


def test_feature_spec(spark):
    df = spark.createDataFrame([], "id string, a string, x double, n bigint, y string")
    spec = FeatureSpec.infer(df, label="y", drop=("id",))
    assert spec == FeatureSpec(("a", "x", "n"), ("a",)) and spec.numeric == ("x", "n")
    assert FeatureSpec.declare([("a", True), ("x", False)]) == FeatureSpec(("a", "x"), ("a",))
    assert K.select_features(df, spec).columns == ["a", "x", "n"]
