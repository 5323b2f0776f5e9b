import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.functions.columns import normal_cdf, normal_quantile
from churnspark.operators import explain as L
from churnspark.operators.features import FeatureSpec

SPEC = FeatureSpec(("a", "b", "x"), ("a", "b"))


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    rows = [(i, ["u", "v", "w"][rng.integers(3)], ["p", "q"][rng.integers(2)], float(np.round(rng.gamma(2.0), 2))) for i in range(300)]
    return spark.createDataFrame(rows, "id int, a string, b string, x double").repartition(5).cache()


def model(df):
    s = -1.0 + 2.0 * (F.col("a") == "u").cast("double") - 0.7 * F.col("x")
    return df.withColumn("probability", 1.0 / (1.0 + F.exp(-s)))


@pytest.fixture(scope="module")
def perturbation(data):
    return L.Perturbation.fit(data, SPEC)


def test_normal_functions(spark):
    ref = statistics.NormalDist()
    xs = [-6.0, -2.5, -1.0, -0.1, 0.0, 0.3, 1.7, 5.0]
    got = [r.c for r in spark.createDataFrame([(x,) for x in xs], "x double").select(normal_cdf("x").alias("c")).collect()]
    assert got == [pytest.approx(ref.cdf(x), abs=1e-7) for x in xs]
    ps = [1e-9, 0.001, 0.024, 0.3, 0.5, 0.9, 0.98, 0.999999]
    got = [r.q for r in normal_quantile(spark.createDataFrame([(p,) for p in ps], "p double"), "p", "q").select("q").collect()]
    assert got == [pytest.approx(ref.inv_cdf(p), rel=1e-7, abs=1e-8) for p in ps]


def test_quartile_cells(data):
    xs = np.array([r.x for r in data.collect()])
    cuts = np.quantile(xs, [0.25, 0.5, 0.75])
    where = np.searchsorted(cuts, xs)
    for r in L.quartile_cells(data, ["x"]).collect():
        part = xs[where == r.bin]
        assert r.n == len(part) and r["mean"] == pytest.approx(part.mean()) and r["std"] == pytest.approx(part.std())
        assert r["min"] == pytest.approx([xs.min(), *cuts][r.bin]) and r["max"] == pytest.approx([*cuts, xs.max()][r.bin])


def test_constant_numeric_has_one_cell(spark):
    df = spark.createDataFrame([("k", 5.0)] * 4, "a string, x double")
    p = L.Perturbation.fit(df, FeatureSpec(("a", "x"), ("a",)))
    assert {(r.feature, r.cell) for r in p.cells.collect()} == {("a", "k"), ("x", "0")}
    assert {r.x for r in p.draw(50, 1).collect()} == {5.0}
    assert p.cell_columns(df).select("cell_x").distinct().collect()[0].cell_x == "0"


def test_draws_follow_the_training_rows(data, perturbation):
    draws = perturbation.draw(5000, 1).cache()
    assert draws.count() == 4999
    n = data.count()
    share = {r.a: r["count"] / n for r in data.groupBy("a").count().collect()}
    drawn = {r.a: r["count"] / 4999 for r in draws.groupBy("a").count().collect()}
    assert all(abs(share[k] - drawn[k]) < 0.03 for k in share)
    ends = {r.cell: (r["min"], r["max"]) for r in perturbation.cells.filter("feature = 'x'").collect()}
    assert all(ends[r.cell_x][0] <= r.x <= ends[r.cell_x][1] for r in draws.collect())


def test_sums_and_weights_equal_brute_force(data, perturbation):
    """One row after the other with numpy: draws, kernel, two ridge fits with a free intercept."""
    n = 400
    draws = model(perturbation.draw(n, 9)).toPandas()
    rows = model(perturbation.cell_columns(data)).toPandas()
    for k in (3, 2):
        got = {r.id: r for r in L.explain(data, perturbation, model, n, k=k, seed=9).collect()}
        assert len(got) == 300
        for _, row in rows.iloc[::23].iterrows():
            z = np.vstack([np.ones(3), np.column_stack([draws[f"cell_{f}"] == row[f"cell_{f}"] for f in SPEC.features]).astype(float)])
            y = np.concatenate([[row.probability], draws.probability])
            w = np.sqrt(np.exp(-(3 - z.sum(1)) / (0.75**2 * 3)))

            def ridge(cols, alpha):
                a = np.column_stack([np.ones(len(y)), z[:, cols]])
                pen = np.diag([0.0] + [alpha] * len(cols))
                return np.linalg.solve(a.T @ (w[:, None] * a) + pen, a.T @ (w * y))[1:]

            rough = ridge([0, 1, 2], 0.01)
            keep = sorted(np.argsort(-np.abs(rough), kind="stable")[:k])
            want = dict(zip([SPEC.features[i] for i in keep], ridge(keep, 1.0)))
            assert got[row.id].explanation == {f: pytest.approx(v, abs=1e-9) for f, v in want.items()}
            assert got[row.id].probability == pytest.approx(row.probability)


def test_explanations_find_the_driver(data, perturbation):
    rows = L.explain(data, perturbation, model, 2000).collect()
    assert all(r.explanation["a"] > 0.1 for r in rows if r.a == "u")
    assert all(r.explanation["a"] < 0 for r in rows if r.a != "u")
    assert max(abs(r.explanation["b"]) for r in rows) < 0.05


def test_layout_does_not_matter(data, perturbation):
    a = {r.id: r.explanation for r in L.explain(data.repartition(1), perturbation, model, 200).collect()}
    b = {r.id: r.explanation for r in L.explain(data.repartition(13), perturbation, model, 200).collect()}
    assert all(a[i] == {f: pytest.approx(v, abs=1e-12) for f, v in b[i].items()} for i in a)


def test_top_features_and_extent(spark):
    df = spark.sql("select map('a', 0.1D, 'b', -0.9D, 'c', 0.5D) e, 0.3D p union all select map('a', -1.0D), 0.7D")
    top = df.select(L.top_features("e", 2).alias("t")).collect()
    assert [(t.feature, t.weight) for t in top[0].t] == [("b", -0.9), ("c", 0.5)] and len(top[1].t) == 1
    assert tuple(L.map_extent(df, "e", "p").first()) == (-1.0, 0.5, 0.3, 0.7)


def test_levels_do_not_meet_all_draws(spark):
    """A feature of 100,000 levels of equal share beside one level that has nearly all rows."""
    wide = spark.range(100_000).select(F.format_string("l%06d", "id").alias("a"), F.lit("q").alias("b"), (F.col("id") % 7).cast("double").alias("x"))
    p = L.Perturbation.fit(wide, SPEC)
    draws = p.draw(500, 3)
    got = draws.collect()
    assert len(got) == 499 and all(r.a == r.cell_a and r.b == "q" for r in got) and len({r.a for r in got}) > 480
    plan = draws._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "block" in plan
    rare = p.cells.withColumn("lo", F.when(F.col("feature") == "a", F.col("lo") / 1000).otherwise(F.col("lo"))).withColumn(
        "hi", F.when(F.col("feature") == "a", F.when(F.col("cell") == "l099999", 1.0).otherwise(F.col("hi") / 1000)).otherwise(F.col("hi"))
    )
    assert L.Perturbation(SPEC, rare).draw(500, 3).where("a = 'l099999'").count() > 490
    out = L.explain(wide.limit(300), p, lambda d: d.withColumn("probability", (F.col("x") > 3).cast("double")), 300)
    assert out.where("size(explanation) = 3").count() == 300


def test_choices_change_only_where_strengths_cross():
    rng = np.random.default_rng(0)
    rough = rng.normal(size=(40, 9, 2))
    rough[3, 4] = rough[3, 5]  # equal features: the first is taken
    for k in (1, 4, 8):
        for row, pieces in zip(rough, L.choices(rough, k)):
            assert [u for u, _ in pieces] == sorted({u for u, _ in pieces}) and pieces[-1][0] == 1.0
            for p in rng.random(50):
                chosen = next(c for u, c in pieces if p <= u)
                assert chosen.tolist() == sorted(np.argsort(-np.abs(row[:, 0] + p * row[:, 1]), kind="stable")[:k].tolist())


def test_sums_of_cells_that_no_draw_has_and_no_draws():
    draws, y = np.array([[5, 7], [5, 8], [6, 8]]), np.array([0.25, 0.5, 1.0])
    kernel = np.array([1.0, 0.5, 0.25])  # by the number of features that differ
    got = L.weighted_sums(np.array([[5, 8], [9, 0], [6, 99]]), draws, y, kernel)
    assert got.tolist() == [
        [2.0, 0.5 * 0.25 + 0.5 + 0.5, 1.5, 1.5, 0.5 * 0.25 + 0.5, 0.5 + 0.5, 1.0],
        [0.75, 0.25 * 1.75, 0.0, 0.0, 0.0, 0.0, 0.0],
        [1.0, 0.25 * 0.75 + 0.5, 0.5, 0.0, 0.5, 0.0, 0.0],
    ]
    assert not L.weighted_sums(np.array([[5, 8]]), draws[:0], y[:0], kernel).any()


def test_explanations_and_sums_from_one_pass(spark, data, perturbation, monkeypatch):
    """Both come from one table of combinations, and are what the two functions give apart."""
    passes, solved = [], L.Patterns.solved
    monkeypatch.setattr(L.Patterns, "solved", lambda self, df, **wanted: passes.append(sorted(wanted)) or solved(self, df, **wanted))
    both = {r.id: r for r in L.explain_with_gram(data, perturbation, model, 400, k=2).collect()}
    assert passes == [["_ranges", "_sums"]]
    assert {i: r.explanation for i, r in both.items()} == {r.id: r.explanation for r in L.explain(data, perturbation, model, 400, k=2).collect()}
    for r in L.with_gram(data, perturbation, model, 400).collect():
        assert all(r[c] == both[r.id][c] for c in r.asDict())
    assert len(both) == 300


def test_residuals_of_rows_that_share_an_id(data, perturbation):
    """Each row's sums meet the explanations of all rows of its id: m rows give m * m."""
    from churnspark.plans.explaining import _residuals

    some = data.where("id < 6").select(F.col("id").alias("customer_id"), *SPEC.features)
    rows = some.unionByName(some.where("customer_id = 2")).unionByName(some.where("customer_id = 2"))
    got = [(r.customer_id, r.n_features, r.residual) for r in _residuals(rows, perturbation, model, SPEC, 2).collect()]
    assert sorted(got) == [(i, 2, 0.0) for i in (0, 1, *[2] * 9, 3, 4, 5)]


def test_combinations_are_spread_over_tasks(spark, data, perturbation):
    """However few bytes the combinations have, their sums are not left to one task."""
    sums = L.Patterns(perturbation, model, 50, 1).solved(data, **L.SUMS)
    assert sums.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = perturbation.cell_columns(data).select("cell_a", "cell_b", "cell_x").distinct()
    assert sums.count() == cells.count()
