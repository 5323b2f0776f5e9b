"""The forest whose trees are rows of a table, against trees grown node by node."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from churnspark.operators import forest as R


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(600, 4)), 1)
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=600) > 0).astype(float)
    rows = [(i, r.tolist(), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "id int, x array<double>, target double")
    return df.select("id", array_to_vector("x").alias("raw"), "target").cache()


def plain(x, w0, w1, node, tree, seed, max_depth):
    """A tree by recursion, all splits of a node tried one by one."""
    n0, n1 = w0.sum(), w1.sum()
    best = (0.0, None, None)
    if n0 and n1 and node.bit_length() - 1 < max_depth:
        for f in R.tried(np.array([node]), tree, seed, x.shape[1])[0]:
            for b in np.unique(x[:, f]):
                on = x[:, f] <= b
                found = float(R.quality(w0[on].sum(), w1[on].sum(), n0, n1))
                best = (found, f, b) if found > best[0] else best
    if best[1] is None:
        return (n0, n1)
    on = x[:, best[1]] <= best[2]
    below = [plain(x[s], w0[s], w1[s], 2 * node + i, tree, seed, max_depth) for i, s in enumerate((on, ~on))]
    if all(len(b) == 2 for b in below) and len({b[1] > b[0] for b in below}) == 1:
        return (n0, n1)
    return (best[1], best[2], *below)


def nested(nodes, i=0):
    left = nodes["left"][i]
    if left < 0:
        return (nodes["n0"][i], nodes["n1"][i])
    return (nodes["feature"][i], nodes["bin"][i], nested(nodes, left), nested(nodes, left + 1))


@pytest.mark.parametrize("max_depth", [0, 3, 30])
def test_grown_by_level_is_grown_by_recursion(max_depth):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 12, (300, 5)).astype(np.uint8)
    w0, w1 = rng.poisson(1.0, (2, 300)).astype(float)
    w1[x[:, 0] < 5] = 0
    assert nested(R.grown(x, w0, w1, 1, 3, 7, max_depth)) == plain(x, w0, w1, 1, 3, 7, max_depth)


def test_copies_are_drawn_as_a_bootstrap_does():
    n = np.repeat([0, 1, 5, 2000], 20000)
    k = R.drawn_copies(np.arange(len(n)), n, 2, 42, 0)
    for mean in (1, 5, 2000):
        of = k[n == mean]
        assert of.mean() == pytest.approx(mean, rel=0.03) and of.var() == pytest.approx(mean, rel=0.05)
    assert not k[n == 0].any()


def test_no_group_holds_a_whole_tree(data, monkeypatch):
    """Grown in pieces of at most 60 cells and in one piece a forest is the same; scored in small chunks and slices, too."""
    whole = R.fit(data, 4, 6, 30, 1)
    parts = R.fit(data, 4, 6, 30, 1, bound=60)
    assert all(parts.tops) and not any(whole.tops)
    cells = parts.nodes.select(F.expr("aggregate(n0, 0D, (a, x) -> a + x)"), F.size("left").alias("n"), "tree", "node").toPandas()
    assert len(cells) > 6 * 4 and cells["n"].max() <= 2 * 60
    assert parts.toDebugString.split("\n", 1)[1] == whole.toDebugString.split("\n", 1)[1]
    probability = lambda m: {r.id: tuple(r.probability) for r in m.transform(data).collect()}
    want = probability(whole)
    monkeypatch.setattr(R, "CHUNK_CELLS", 50)
    monkeypatch.setattr(R, "SLICE_CELLS", 100)
    assert probability(parts) == want and len(want) == 600


def test_scores_are_mean_shares_of_leaves(data):
    model = R.fit(data, 4, 5, 4, 9)
    trees = {r.tree: {c: np.array(getattr(r, c)) for c in ("feature", "bin", "left", "n0", "n1")} for r in model.nodes.toPandas().itertuples()}
    for r in model.transform(data.limit(50)).collect():
        x = [np.searchsorted(e, v) for e, v in zip(model.ends, r.raw, strict=True)]
        shares = []
        for t in range(5):
            n, i = trees[t], 0
            while n["left"][i] >= 0:
                i = n["left"][i] + (x[n["feature"][i]] > n["bin"][i])
            shares.append(n["n1"][i] / (n["n0"][i] + n["n1"][i]))
        assert r.probability[1] == pytest.approx(np.mean(shares), abs=1e-12) and r.prediction == (np.mean(shares) > 0.5)


def test_saved_and_loaded(data, tmp_path):
    model = PipelineModel(stages=[R.fit(data, 4, 3, 30, 1, bound=100)])
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    score = lambda m: {r.id: r.probability[1] for r in m.transform(data).collect()}
    assert score(again) == score(model)


def test_one_row_and_one_class(spark):
    one = spark.createDataFrame([([1.0, 2.0], 1.0)], "x array<double>, target double").select(array_to_vector("x").alias("raw"), "target")
    r = R.fit(one, 2, 20, 30, 1).transform(one).first()
    assert r.probability[1] == 1.0 and r.prediction == 1.0
