import json

import pytest
from pyspark.sql import functions as F

from churnspark.session import staged, work_table
from churnspark.sources import metrics as M
from churnspark.sources import tables as T


def _line(**set_):
    values = {c: "No" for c in T.CUSTOMER_COLUMNS} | {"tenure": "1", "MonthlyCharges": "2.5", "TotalCharges": "3"} | set_
    return ",".join(values[c] for c in T.CUSTOMER_COLUMNS)


@pytest.fixture
def raw(tmp_path):
    lines = [
        _line(customerID="a"),
        _line(customerID="b", tenure=" ", gender=" "),
        _line(customerID="c", tenure="x1", gender="NA"),
        _line(customerID="d", tenure="NA", gender=""),
        _line(customerID="e", gender='""', Churn="NA"),
    ]
    path = tmp_path / "raw.csv"
    path.write_text("\n".join([",".join(T.CUSTOMER_COLUMNS), *lines]) + "\n")
    return str(path)


def test_schema_has_21_nullable_columns():
    assert len(T.CUSTOMER_SCHEMA) == 21 and all(f.nullable for f in T.CUSTOMER_SCHEMA)
    assert [f.name for f in T.CUSTOMER_SCHEMA if f.dataType.simpleString() == "double"] == ["tenure", "MonthlyCharges", "TotalCharges"]


def test_read_customers(spark, raw):
    got = {r.customerID: r for r in T.read_customers(spark, raw).collect()}
    assert set(got) == set("abcde")
    assert got["a"].tenure == 1.0
    assert [got[k].tenure for k in "bcd"] == [None, None, None]
    assert [got[k].gender for k in "bcde"] == [" ", None, None, ""]
    assert got["e"].Churn is None


def test_fallback(spark, raw):
    name = work_table(spark, "fallback")
    assert T.read_with_fallback(spark, name, raw).count() == 5
    T.replace_table(T.read_customers(spark, raw).limit(0), name)
    assert T.read_with_fallback(spark, name, raw).count() == 5
    T.replace_table(T.read_customers(spark, raw).limit(2), name)
    assert T.read_with_fallback(spark, name, raw).count() == 2


def test_write_csv_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", "", 1.5), ("b", " ", None), ("c", None, 2.0), ("d", "  ", 0.1), ("e", 'q"x,y', 3.0)], "k string, s string, x double")
    path = str(tmp_path / "out")
    T.write_csv(df, path)
    T.write_csv(df, path, files=1)
    assert rows(T.read_customers(spark, path, df.schema)) == rows(df)
    assert len(list((tmp_path / "out").glob("part-*.csv"))) == 1


def test_create_once_keeps_the_first(spark):
    name = work_table(spark, "once")
    assert T.create_table_once(spark.range(3), name)
    assert not T.create_table_once(spark.range(9), name)
    assert spark.table(name).count() == 3
    T.replace_table(spark.range(9), name)
    assert spark.table(name).count() == 9


def test_catalog(spark):
    name = work_table(spark, "cat")
    T.replace_table(spark.range(3), name)
    db, table = name.split(".")
    assert db in [r[0] for r in T.databases(spark).collect()]
    assert table in [r.tableName for r in T.tables(spark, db).collect()]
    described = T.describe(spark, name).collect()
    assert described[0].col_name == "id" and any(r.col_name == "Provider" and r.data_type == "parquet" for r in described)


def test_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert T.to_json_records(df).first().record == '{"a":1,"b":null}'


def test_flatten(spark):
    df = spark.createDataFrame([('{"metrics":{"x":{"y":1.5},"l":[1,2]},"uuid":"u"}',)], "j string")
    flat = M.flatten(M.parse_metrics(df, "j", "metrics struct<x: struct<y: double>, l: array<int>>, uuid string"))
    assert flat.columns == ["metrics.x.y", "metrics.l", "uuid"]
    assert tuple(flat.first()) == (1.5, [1, 2], "u")


def test_read_metrics_bounds_and_pruning(spark):
    name = work_table(spark, "log")
    day = M.DAY_MS
    df = spark.createDataFrame(
        [("m", f"d{i % 2}", i * day, i * day + 5) for i in range(10)], "model string, deployment string, start_ms long, end_ms long"
    )
    M.append_inference_log(df, name)
    assert M.read_metrics(spark, name).count() == 10
    assert M.read_metrics(spark, name, model="other").count() == 0
    got = M.read_metrics(spark, name, "m", "d1", 3 * day, 7 * day)
    assert sorted(r.start_ms // day for r in got.collect()) == [3, 5, 7]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(deployment" in plan and "day" in plan.split("PartitionFilters")[1].split("]")[0]
    future = spark.createDataFrame([("m", "d0", 9_000_000_000_000, 9_000_000_000_001)], df.schema)
    M.append_inference_log(future, name)
    assert M.read_metrics(spark, name).count() == 10  # the open end is now


def test_run_metrics_and_lineage(spark):
    runs, lineage = work_table(spark, "runs"), work_table(spark, "lineage")
    M.append_run_metrics(spark, runs, "r1", {"train_score": 0.80567, "test_score": 0.7})
    M.append_run_metrics(spark, runs, "r2", {"train_score": 0.5})
    assert {(r.run_id, r.metric): r.value for r in spark.table(runs).collect()} == {
        ("r1", "train_score"): 0.81, ("r1", "test_score"): 0.7, ("r2", "train_score"): 0.5,
    }
    M.record_lineage(spark, lineage, "m", "t", "select 1", "job")
    M.record_lineage(spark, lineage, "m", "t2", "select 2", "job")
    assert [r.source_table for r in spark.table(lineage).orderBy("source_query").collect()] == ["t", "t2"]


def test_staged_is_stable(spark):
    df = staged(spark.range(100).withColumn("x", F.rand()))
    assert df.agg(F.sum("x")).first()[0] == df.agg(F.sum("x")).first()[0]


def test_json_of_unknown_keys(spark):
    texts = ['{"a": 1, "b": {"c": 0.25, "d e": "x"}}', '{"a": 2.5, "z": [1, {"q": 1}], "b": {"c": 10}}', '{"b": "t", "y.k": true, "n": null, "e": {}}', "oops", "[1]", "3", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, j string")
    out = M.flatten_json(rows, "j")
    assert sorted(out.columns) == sorted(["i", "a", "b", "e", "n", "y.k", "z", "unreadable"])
    got = {r.i: r.asDict() for r in out.collect()}
    assert [got[k]["a"] for k in range(7)] == [1.0, 2.5, None, None, None, None, None]
    assert json.loads(got[0]["b"]) == {"c": 0.25, "d e": "x"} and got[2]["b"] == '"t"' and got[2]["y.k"] is True and got[2]["e"] == "{}"
    assert [got[k]["unreadable"] for k in range(7)] == [None, None, None, "oops", "[1]", "3", None]
    union = M.flatten_json(rows.where("i < 2"), "j")
    assert union.columns == ["i", "a", "b.c", "b.d e", "z", "unreadable"]
    assert [tuple(r)[:4] for r in union.orderBy("i").collect()] == [(0, 1.0, 0.25, "x"), (1, 2.5, 10.0, None)]
    assert M.flatten_json(rows.where("i in (3, 6)"), "j").columns == ["i", "unreadable"] and M.flatten_json(rows.limit(0), "j").count() == 0
