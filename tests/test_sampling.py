import math

import pytest
from pyspark.sql import functions as F

from churnspark.operators import sampling as S


@pytest.fixture(scope="module")
def base(spark):
    return spark.range(1000).select(F.concat(F.lit("c"), "id").alias("k"), F.when(F.col("id") % 5 == 0, "Yes").otherwise("No").alias("y"))


def keys(df):
    return sorted(r.k for r in df.collect())


def test_same_sample_for_any_layout(base):
    for f in (
        lambda d: S.hash_sample(d, "k", 0.5, 83),
        lambda d: S.sample_n(d, 100, "k", 83),
        lambda d: S.train_test_split(d, "k").filter("is_test"),
        lambda d: S.folds(d, "y", "k").filter("fold = 2"),
    ):
        assert keys(f(base.repartition(1))) == keys(f(base.repartition(13)))


@pytest.mark.parametrize("n", [0, 1, 10, 999, 1000, 5000])
def test_sample_n_is_exact(base, n):
    got = keys(S.sample_n(base, n, "k", 7))
    assert len(got) == len(set(got)) == min(n, 1000)


def test_sample_n_is_the_hash_order(base):
    want = sorted(r.k for r in base.orderBy(F.md5(F.concat(F.lit("7:"), "k"))).limit(50).collect())
    assert keys(S.sample_n(base, 50, "k", 7)) == want


def test_repeated_keys_are_cut_exactly(spark):
    df = spark.range(900).select(F.when(F.col("id") < 300, "hot").when(F.col("id") < 400, None).otherwise(F.concat(F.lit("c"), "id")).alias("k"), (F.col("id") % 450).alias("v"))
    for n in (1, 200, 450, 899, 900):
        got = [(r.k, r.v) for r in S.sample_n(df, n, "k", 7).collect()]
        assert len(got) == n and sorted(got, key=str) == sorted(((r.k, r.v) for r in S.sample_n(df.repartition(11), n, "k", 7).collect()), key=str)
    same = spark.range(1000).select(F.lit("one").alias("k"), F.lit(1).alias("v"))
    assert S.sample_n(same, 333, "k", 7).count() == 333
    assert S.train_test_split(same, "k", 0.25).where("is_test").count() == 250


def test_seeds_differ(base):
    assert keys(S.sample_n(base, 50, "k", 7)) != keys(S.sample_n(base, 50, "k", 8))


@pytest.mark.parametrize("n", [1, 3, 4, 101])
def test_split_is_ceil(base, n):
    part = base.limit(n)
    counts = {r.is_test: r["count"] for r in S.train_test_split(part, "k", 0.25, 42).groupBy("is_test").count().collect()}
    assert counts.get(True, 0) == math.ceil(n * 0.25) and sum(counts.values()) == n


def test_folds_are_balanced_per_class(base):
    counts = {(r.y, r.fold): r["count"] for r in S.folds(base, "y", "k", 5).groupBy("y", "fold").count().collect()}
    assert counts == {("Yes", i): 40 for i in range(5)} | {("No", i): 160 for i in range(5)}


def test_empty(base):
    assert S.sample_n(base.limit(0), 5, "k", 1).count() == 0
    assert S.train_test_split(base.limit(0), "k").count() == 0


def test_ramp(base):
    out = S.ramp_noise(base, ["k"], "y", 3, "k").collect()
    assert len(out) == 1000
    assert all(r.final_label for r in out if r.y == "Yes")
    flipped = [i for i, r in enumerate(sorted(out, key=lambda r: r.k)) if r.y == "No" and r.final_label]
    early, late = sum(i < 300 for i in flipped), sum(i >= 700 for i in flipped)
    assert late > 3 * early > 0
