import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnspark.functions.columns import version_key
from churnspark.operators.monitoring import max_version
from churnspark.operators.ordering import exact_quantiles, with_row_number, with_running_total


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_row_number_any_layout(spark, parts):
    values = list(range(500))
    random.Random(parts).shuffle(values)
    df = spark.createDataFrame([(v % 7, v) for v in values], "tie int, v int").repartition(parts)
    got = with_row_number(df, ["tie", "v"]).collect()
    assert [(r.tie, r.v) for r in sorted(got, key=lambda r: r.row_number)] == sorted((v % 7, v) for v in values)
    assert sorted(r.row_number for r in got) == list(range(1, 501))


def test_row_number_hot_group_spans_partitions(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 700, "hot").when(F.col("id") < 990, "warm").alias("g"), "id")
    got = with_row_number(df, [F.desc("id")], by=["g"], name="n", start=0)
    per = {r.g: (r.n, r.lo, r.hi, r.c) for r in got.groupBy("g").agg(F.countDistinct("n").alias("n"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.count("*").alias("c")).collect()}
    assert per == {"hot": (700, 0, 699, 700), "warm": (290, 0, 289, 290), None: (10, 0, 9, 10)}
    assert got.filter("g = 'hot' and id = 699").first().n == 0


def test_empty_and_one_row(spark):
    assert with_row_number(spark.range(0), ["id"]).count() == 0
    assert with_row_number(spark.range(1), ["id"]).first().row_number == 1
    assert exact_quantiles(spark.range(0).select(F.col("id").cast("double").alias("x")), ["x"], [0.5]).count() == 0


def test_running_total(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("g"), "id", (F.col("id") * 2).alias("w"))
    got = {(r.g, r.id): r for r in with_running_total(df, ["id"], ["w"], by=["g"], following=["w"]).collect()}
    for g in range(3):
        ids = [i for i in range(200) if i % 3 == g]
        total = 0
        for j, i in enumerate(ids):
            total += 2 * i
            r = got[(g, i)]
            assert r.w_upto == total and r.w_total == sum(2 * k for k in ids)
            assert r.w_next == (2 * ids[j + 1] if j + 1 < len(ids) else None)


@pytest.mark.parametrize("n", [1, 2, 5, 101, 1000])
def test_quantiles_equal_numpy(spark, n):
    rng = np.random.default_rng(n)
    xs = np.round(rng.exponential(size=n), 2)  # rounding gives equal values
    xs[: n // 3] = xs[0]  # one value holds a third of the rows
    df = spark.createDataFrame([(float(x), float(-x)) for x in xs], "x double, y double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.feature, r.prob): r.value for r in exact_quantiles(df, ["x", "y"], probs).collect()}
    for p in probs:
        assert got[("x", p)] == pytest.approx(np.quantile(xs, p), abs=1e-12)
        assert got[("y", p)] == pytest.approx(np.quantile(-xs, p), abs=1e-12)


@pytest.mark.parametrize("shape", ["heavy", "hot", "two"])
def test_quantiles_of_many_rows_through_brackets(spark, shape):
    """Above the small limit only values near the rank are ordered; the result stays exact."""
    rng = np.random.default_rng(3)
    n = 60_000
    xs = {"heavy": rng.pareto(0.5, n), "hot": np.where(rng.random(n) < 0.34, 7.0, rng.normal(7, 3, n)), "two": rng.integers(0, 2, n) * 1.0}[shape]
    df = spark.createDataFrame(pd.DataFrame({"g": np.where(np.arange(n) % 3 == 0, "a", "b"), "x": xs})).repartition(7)
    probs = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r.prob: r.value for r in exact_quantiles(df, ["x"], probs).collect()}
    assert got == {p: pytest.approx(np.quantile(xs, p), rel=1e-12) for p in probs}
    per = {(r.g, r.prob): r.value for r in exact_quantiles(df, ["x"], [0.5], by=["g"]).collect()}
    assert per["a", 0.5] == pytest.approx(np.median(xs[::3]), rel=1e-12)


def test_a_missed_bracket_falls_back(spark, monkeypatch):
    """With a bracket that cannot hold the rank the whole column is ranked."""
    from churnspark.operators import ordering as O

    monkeypatch.setattr(O, "_bracket_probs", lambda probs: [0.0] * 2 * len(probs))
    df = spark.range(30_000).select(F.col("id").cast("double").alias("x"))
    assert exact_quantiles(df, ["x"], [0.5]).first().value == 14999.5


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0), (None, 5.0)], "g string, x double")
    got = {r.g: r.value for r in exact_quantiles(df, ["x"], [0.5], by=["g"]).collect()}
    assert got == {"a": 2.0, None: 5.0}


def test_no_single_task_window(spark):
    """The rows themselves never pass through an unpartitioned window."""
    df = spark.range(1000).withColumn("v", F.col("id") * 2)
    plan = with_row_number(df, ["v"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    assert len(windows) == 1 and "_before" in plan and "Join" in plan.splitlines()[1]


VERSIONS = [
    "none", "0.9", "1.dev1", "1.0.dev2", "1.0a1.dev3", "1.0a1", "1.0a2", "1.0-beta", "1.0b2", "1.0b10", "1.0rc1", "V1.0.0-RC2", "1.0", "1.0+abc", "1.0+2",
    "1.0+10", "1.0.post1.dev2", "1.0.post1", "1.0-2", "1.0.post10", "1.0.1", "1.9", "1.10", "2022.04.1-b6", "2022.04.1-b10", "2022.04.1",
    "99999999999999999999.1", "1!0.1",
]


def test_versions_in_order(spark):
    given = spark.createDataFrame(list(enumerate(VERSIONS)), "i int, v string")
    got = given.orderBy(version_key("v")).collect()
    assert [r.v for r in got] == VERSIONS
    equal = spark.createDataFrame([("1.0", "1"), ("1.0.0", "v1"), ("1.0c1", "1rc1"), ("1.0-2", "1.post2"), ("1.0_alpha.3", "1a3")], "a string, b string")
    assert equal.where(version_key("a") == version_key("b")).count() == 5


def test_max_version_per_group(spark):
    rows = [("m", 1, "2022.04.1-b6"), ("m", 2, "2022.04.1-b10"), ("n", 3, "1.0rc1"), ("n", 4, "1.0rc2"), ("n", 5, None), ("o", 6, None)]
    got = max_version(spark.createDataFrame(rows, "m string, i int, v string"), "v", by=["m"]).collect()
    assert {(r.m, r.i) for r in got} == {("m", 2), ("n", 4), ("o", 6)}
