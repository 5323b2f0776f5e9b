"""Every registered query against its SQL on the same tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
# Fitting these takes long; test_models.py and test_explain.py cover them on small frames.
FITTED = {"logreg_cv", "param_search", "random_forest", "compare_models", "explain_batch", "serve_batch", "what_if_fitted", "score_label", "score_probability", "fit_model"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "~nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return str(v)


def canon(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    got = df.collect()
    result = duck.execute(ORACLE[name])
    columns, types = [d[0] for d in result.description], {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert canon(got, df.columns) == canon(want, columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - FITTED))
def test_without_sql_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    out = entry.entry(spark).collect()
    assert sum(r.total for r in out) == sum(r.churned + r.remained for r in out) == 150


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_frame_of_the_survey(spark, duck):
    from churnspark.plans.frames import churn_frame

    got = {r.churn: r.n for r in churn_frame(spark, "/root/testdata/sf0.01").groupBy("churn").agg({"*": "count"}).toDF("churn", "n").collect()}
    assert got == {None: 4, "No": 1174, "Yes": 322}
