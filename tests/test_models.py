import re

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnspark.operators import features as X
from churnspark.operators import models as M
from churnspark.operators.features import FeatureSpec

SPEC = FeatureSpec(("colour", "size", "x", "z"), ("colour", "size"))


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        colour, size = ["red", "blue", "green"][rng.integers(3)], ["L", "S"][rng.integers(2)]
        x, z = float(rng.normal()), float(rng.normal() * 10)
        s = -0.5 + 1.5 * (colour == "red") - 1.0 * (size == "L") + 1.2 * x
        rows.append((f"r{i}", colour, size, x, z, "Yes" if rng.random() < 1 / (1 + np.exp(-s)) else "No"))
    return spark.createDataFrame(rows, "id string, colour string, size string, x double, z double, y string").repartition(3).cache()


@pytest.fixture(scope="module")
def fitted(train):
    return M.fit_logistic(train, SPEC, "y", c=0.5)


def _matrix(model, train):
    df = M.with_target(model.transform(train), "y", "Yes").select(vector_to_array("features").alias("f"), "target").toPandas()
    return np.stack(df.f), df.target.to_numpy()


def test_codes_are_alphabetic_and_levels_all_kept(fitted, train):
    assert [list(a) for a in fitted.stages[0].labelsArray] == [["blue", "green", "red"], ["L", "S"]]
    x, _ = _matrix(fitted, train)
    assert x.shape[1] == 3 + 2 + 2


def test_zero_gradient_of_the_population_scaled_objective(fitted, train):
    """C * sum(log loss) + |w|^2 / 2 on columns scaled by the population deviation is stationary at the fit."""
    x, y = _matrix(fitted, train)
    n = len(y)
    shrink = np.sqrt((n - 1) / n)  # sample-scaled = population-scaled * shrink
    xs = x / shrink
    w = fitted.stages[-1].coefficients.toArray() * shrink
    p = 1 / (1 + np.exp(-(xs @ w + fitted.stages[-1].intercept)))
    assert np.allclose(xs.std(axis=0), 1.0)
    gradient = 0.5 * xs.T @ (p - y) + w
    assert np.abs(gradient).max() / n < 1e-4
    assert abs((p - y).sum()) / n < 1e-4


def test_recovers_signs(fitted):
    w = dict(zip(["blue", "green", "red", "L", "S", "x", "z"], fitted.stages[-1].coefficients))
    assert w["red"] > 0 > w["L"] and w["x"] > 0 and abs(w["z"]) < 0.3


def test_cv_prefers_weakest_on_ties_and_refits(train):
    found = M.fit_logistic_cv(train, SPEC, "y", "id", cv=3, strengths=(1e-4, 1.0, 1e4))
    best = max(found.scores.values())
    assert found.strength == min(c for c, a in found.scores.items() if a == best)
    direct = M.fit_logistic(train, SPEC, "y", c=found.strength)
    assert np.allclose(found.model.stages[-1].coefficients, direct.stages[-1].coefficients, atol=1e-3)


def test_ten_strengths():
    assert len(M.STRENGTHS) == 10 and M.STRENGTHS[0] == pytest.approx(1e-4) and M.STRENGTHS[-1] == pytest.approx(1e4)


def test_unknown_solver(train):
    with pytest.raises(ValueError, match="saga"):
        M.fit_logistic_cv(train, SPEC, "y", "id", solver="saga")


def test_param_search_and_compare(train):
    out = M.param_search(train, train, SPEC, "y", "id", [(2, "lbfgs", 5)]).first()
    assert out.train_score == out.test_score > 0.6
    forest = M.fit_forest(train, SPEC, "y", trees=10)
    logistic = M.fit_logistic(train, SPEC, "y")
    got = {(r.model, r.side): r.accuracy for r in M.compare_models({"lr": logistic, "rf": forest}, train, train, "y").collect()}
    assert set(got) == {("lr", "train"), ("lr", "test"), ("rf", "train"), ("rf", "test")}
    assert got["rf", "train"] > 0.9  # deep trees learn the training rows


def test_forest_treats_codes_as_numbers(train):
    forest = M.fit_forest(train, SPEC, "y", trees=3, max_depth=4).stages[-1]
    assert "in {" not in forest.toDebugString


def test_forest_does_not_depend_on_the_layout(train):
    rows = train.unionByName(train.limit(1).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(100)))).drop("k"))
    told = [M.fit_forest(rows.repartition(n), SPEC, "y", trees=5, max_depth=6, partitions=4).stages[-1].toDebugString for n in (1, 4, 13)]
    # thresholds are scaled by means and deviations, whose last digits follow the order of additions
    assert len({re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda m: f"{float(m[0]):.6f}", t.split("\n", 1)[1]) for t in told}) == 1


def test_unseen_category_fails(fitted, train):
    bad = train.limit(1).withColumn("colour", F.lit("pink"))
    with pytest.raises(Exception, match="pink"):
        M.predict(fitted, bad).collect()


def test_predict_label(fitted, train):
    out = M.predict_label(fitted, train)
    assert out.filter((F.col("probability") > 0.5) != (F.col("predicted") == "Yes")).count() == 0


def test_explained_model(spark, train, fitted, tmp_path):
    em = M.ExplainedModel.build(train, SPEC, "y", fitted)
    assert em.label_name == "y probability" and em.label_name in em.predict_df(train).columns
    assert [tuple(r) for r in em.categories.orderBy("feature", "index").collect()] == [
        ("colour", 0, "blue"), ("colour", 1, "green"), ("colour", 2, "red"), ("size", 0, "L"), ("size", 1, "S"),
    ]
    em.save(str(tmp_path / "m"))
    em.save(str(tmp_path / "m"))  # a second save replaces the first
    again = M.ExplainedModel.load(spark, str(tmp_path / "m"))
    some = train.orderBy("id").limit(20)
    a = {r.id: r for r in em.explain(some, 300).collect()}
    b = {r.id: r for r in again.explain(some, 300).collect()}
    assert {k: (r.probability, r.explanation) for k, r in a.items()} == {k: (r.probability, r.explanation) for k, r in b.items()}
    requests = spark.createDataFrame([("q1", "red", None), ("q2", None, "3")], "id string, colour string, x string")
    got = {r.id: r for r in again.serve(requests, "id", 300).collect()}
    medians = train.agg(F.median("x"), F.median("z")).first()
    assert got["q1"].data.asDict() == {"colour": "red", "size": "L", "x": pytest.approx(medians[0]), "z": pytest.approx(medians[1])}
    assert got["q2"].data.colour == "blue" and got["q2"].data.x == 3.0
    assert 0 < got["q1"].probability < 1 and set(got["q1"].explanation) == set(SPEC.features)
    one = spark.createDataFrame([got["q1"].data], em.types)
    assert em.predict(one).first().probability == got["q1"].probability
    with pytest.raises(ValueError):
        em.serve(requests.withColumn("other", F.lit(1)), "id", 300)
    wi = em.what_if(some, "id", "colour").collect()
    assert len(wi) == 60 and {r.alternative for r in wi} == {"blue", "green", "red"}
    same = {r.id: r.colour for r in some.collect()}
    assert all(abs(r.delta) < 1e-12 for r in wi if same[r.id] == r.alternative)
    assert len(em.what_if(some, "id", "x", numbers=[0, 1]).collect()) == 40
    card = em.feature_card(em.explain(some, 300, k=2), "id").collect()
    assert len(card) == 80 and sum(r.weight != 0 for r in card) == 40


def test_missing_model_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        M.ExplainedModel.load(spark, str(tmp_path / "nowhere"))


def test_dictionary_and_codes(spark, train):
    d = X.fit_dictionary(train, SPEC.categorical)
    coded = X.encode_ordinal(train, d, SPEC)
    assert dict(coded.dtypes)["colour"] == "double"
    pairs = train.alias("a").join(coded.alias("b"), "id").select("a.colour", "b.colour").distinct().collect()
    assert sorted(tuple(p) for p in pairs) == [("blue", 0.0), ("green", 1.0), ("red", 2.0)]
    with pytest.raises(Exception, match="outside the dictionary of colour: pink"):
        X.encode_ordinal(train.withColumn("colour", F.lit("pink")), d, SPEC).collect()


def test_onehot_rows_sum(train):
    d = X.fit_dictionary(train, SPEC.categorical)
    per = X.onehot_rows(train, d, SPEC, "id").filter("position < 5").groupBy("id").agg(F.sum("x").alias("s"))
    assert per.filter("s <> 2").count() == 0 and per.count() == 400


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "c double, d double")
    out = X.standardize(df, ["c", "d"], X.fit_scaler(df, ["c", "d"])).orderBy("d").collect()
    assert [tuple(r) for r in out] == [(0.0, -1.0), (0.0, 1.0)]


def test_stats(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,), (None,)], "x double")
    r = X.numeric_stats(df, ["x"]).first()
    assert (r.median, r["mean"], r["min"], r["max"]) == (3.0, 4.0, 1.0, 9.0) and r["std"] == pytest.approx(np.std([1, 2, 4, 9], ddof=1))


def test_unseen_report(spark, train):
    d = X.fit_dictionary(train.filter("colour <> 'red'"), ["colour"])
    got = X.unseen(train, d, ["colour"]).collect()
    assert [(r.feature, r.value) for r in got] == [("colour", "red")] and got[0].n == train.filter("colour = 'red'").count()
