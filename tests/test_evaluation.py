import itertools
import random

import pytest
from pyspark.sql import functions as F

from churnspark.operators import evaluation as E
from churnspark.operators import explore as P


def frame(spark, pairs):
    return spark.createDataFrame([(int(y), float(s)) for y, s in pairs], "y int, s double")


@pytest.mark.parametrize("digits", [0, 1, 3])
def test_auc_equals_pair_count(spark, digits):
    rng = random.Random(digits)
    data = [(rng.random() < 0.3, round(rng.random(), digits)) for _ in range(300)]
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p, n in itertools.product(pos, neg))
    assert E.auc(frame(spark, data), "y", "s").first().auc == pytest.approx(wins / len(pos) / len(neg))


def test_auc_all_tied(spark):
    assert E.auc(frame(spark, [(1, 0.5), (0, 0.5), (0, 0.5)]), "y", "s").first().auc == 0.5


def test_roc_points(spark):
    data = [(1, 0.9), (1, 0.8), (0, 0.7), (1, 0.6), (0, 0.5), (0, 0.4)]
    full = sorted((r.fpr, r.tpr) for r in E.roc_curve(frame(spark, data), "y", "s", drop_intermediate=False).collect())
    third = 1 / 3
    want = [(0, 0), (0, third), (0, 2 * third), (third, 2 * third), (third, 1), (2 * third, 1), (1, 1)]
    assert full == [pytest.approx(p) for p in want]
    kept = sorted((r.fpr, r.tpr) for r in E.roc_curve(frame(spark, data), "y", "s").collect())
    # second differences of the cumulative counts vanish at 0.5 only, the first and last points always stay
    assert kept == [pytest.approx(p) for p in [(0, 0), (0, third), (0, 2 * third), (third, 2 * third), (third, 1), (1, 1)]]


def test_roc_many_partitions(spark):
    rng = random.Random(4)
    data = [(rng.random() < 0.5, round(rng.random(), 2)) for _ in range(400)]
    by = {}
    for y, s in data:
        by.setdefault(s, [0, 0])[0 if y else 1] += 1
    order = sorted(by, reverse=True)
    d = [by[s] for s in order]
    keep = [i for i in range(len(d)) if i in (0, len(d) - 1) or d[i + 1] != d[i]]
    got = sorted((r.threshold for r in E.roc_curve(frame(spark, data), "y", "s").collect() if r.threshold is not None), reverse=True)
    assert got == [order[i] for i in keep]


def test_report(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] * 2 + [(0, 0)] * 4 + [(0, 1)]
    df = spark.createDataFrame(pairs, "y int, p int")
    r = {x["class"]: x for x in E.classification_report(df, "y", "p").collect()}
    assert (r["1"].precision, r["1"].recall, r["1"].support) == (0.75, 0.6, 5)
    assert r["accuracy"].f1 == 0.7 and r["accuracy"].support == 10
    assert r["macro avg"].recall == pytest.approx(0.7)
    assert r["weighted avg"].f1 == pytest.approx((r["1"].f1 * 5 + r["0"].f1 * 5) / 10)


def test_report_undefined_is_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 0)], "y int, p int")
    r = {x["class"]: x for x in E.classification_report(df, "y", "p").collect()}
    assert (r["1"].precision, r["1"].recall, r["1"].f1, r["0"].precision, r["0"].support) == (0, 0, 0, 0, 0)


@pytest.mark.parametrize("n,blocks", [(0, 0), (99, 0), (100, 1), (101, 1), (250, 2)])
def test_blocks_of_100(spark, n, blocks):
    df = spark.range(n).select("id", (F.col("id") * 10).alias("ms"), (F.col("id") % 4 == 0).alias("y"), F.lit(True).alias("p")).repartition(7)
    got = sorted(E.accuracy_per_n(df, ["ms", "id"], "y", "p", "ms").collect())
    assert [(r.block, r.accuracy, r.start_ms, r.end_ms) for r in got] == [(b, 0.25, b * 1000, b * 1000 + 990) for b in range(blocks)]


def test_histogram(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    got = sorted(P.histogram(df, "x", bins=5).collect())
    assert [(r.bin, r.n) for r in got] == [(0, 2), (1, 2), (2, 2), (3, 2), (4, 3)] and got[4].hi == 10.0
    flat = P.histogram(spark.createDataFrame([(2.0,)] * 9, "x double"), "x").collect()
    assert len(flat) == 3 and sum(r.n for r in flat) == 9  # no spread: sqrt(n) bins around the value
    assert P.histogram(df.limit(0), "x").count() == 0


def test_box_outlier(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]] + [(None, 5.0)], "g string, x double")
    r = P.box_stats(df, "g", "x").collect()
    assert len(r) == 1 and (r[0].q1, r[0].median, r[0].q3, r[0].whisker_lo, r[0].whisker_hi, r[0].outliers) == (2, 3, 4, 1, 4, 1)


def test_density_holds_one(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([("ab"[i % 2], rng.gauss(i % 2, 1)) for i in range(400)], "g string, x double")
    got = {}
    for r in P.density_by_class(df, "x", "g").collect():
        got.setdefault(r.g, []).append((r.x, r.density))
    area = 0.0
    for pts in got.values():
        pts.sort()
        area += sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(pts, pts[1:]))
    assert area == pytest.approx(1.0, abs=0.01)


def test_binned_density_is_near_the_exact_one(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("k"), (F.sqrt(F.col("id")) + F.col("id") % 7).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([("c", 1.0), (None, 2.0), ("a", None)], "k string, v double"))
    exact = {(r.k, r.point): (r.x, r.density) for r in P.density_by_class(rows, "v", "k").collect()}
    binned = {(r.k, r.point): (r.x, r.density) for r in P.binned_density(rows, "v", "k").collect()}
    top = max(d for _, d in exact.values())
    assert set(exact) == set(binned) and len(exact) == 400
    assert all(abs(exact[p][0] - binned[p][0]) < 1e-9 and abs(exact[p][1] - binned[p][1]) < 1e-5 * top for p in exact)
