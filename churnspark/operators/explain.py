"""Local surrogate explanations, what-if variants and the data behind the feature cards.

Perturbed samples are drawn from the training rows alone, so all explained rows share one set of draws: the
model scores ``n_samples`` rows once, whatever the number of rows to explain. What differs between rows is
only which draws agree with the row's own category or quartile, and rows that agree in all of them share
those sums too. Each row adds itself as one more sample before its small regression is solved.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.functions.columns import hash_uniform, normal_cdf, normal_quantile
from churnspark.operators.features import QUARTILES, FeatureSpec, category_frequencies
from churnspark.operators.ordering import exact_quantiles, value_rows
from churnspark.session import broadcast_if_small, shuffle_partitions, staged

# The one Python function that runs in tasks travels by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Predict = Callable[[DataFrame], DataFrame]  # adds a double column ``probability``

SELECT_ALPHA, FIT_ALPHA = 0.01, 1.0  # ridge strength while choosing features and for the final weights
STD_FLOOR = 1e-11  # keeps the spread of a constant bin above zero
BLOCKS = 4096  # of the unit interval, under which cells are looked up


def _bin(value: Column, cuts: Column) -> Column:
    """Number of cut points below the value: 0 for the lowest quarter, 3 for the highest."""
    return sum((value > cuts[i]).cast("int") for i in range(3))


def quartile_cells(df: DataFrame, cols, quantiles: DataFrame | None = None) -> DataFrame:
    """(feature, bin, mean, std, n, share, min, max) of the four quarters of each numeric column.

    min and max are the ends of the quarter: cut points, and the extremes of the data at the outside.
    """
    quantiles = exact_quantiles(df, list(cols), QUARTILES) if quantiles is None else quantiles
    per = quantiles.groupBy("feature").agg(F.array_sort(F.collect_list("value")).alias("cuts"))  # three values each
    cuts = per.agg(F.map_from_entries(F.collect_list(F.struct("feature", "cuts")))).scalar()
    rows = value_rows(df, list(cols)).filter(F.col("value").isNotNull()).withColumn("cuts", F.element_at(cuts, F.col("feature")))
    per = rows.groupBy("feature", "cuts", _bin(F.col("value"), F.col("cuts")).alias("bin")).agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("*").alias("n"),
        F.min("value").alias("lo"), F.max("value").alias("hi"),
    )
    feature = Window.partitionBy("feature")  # four rows each
    c = F.col("cuts")
    return per.select(
        "feature", "bin", "mean", "std", "n",
        (F.col("n") / F.sum("n").over(feature)).alias("share"),
        F.when(F.col("bin") == 0, F.min("lo").over(feature)).otherwise(F.get(c, F.col("bin") - 1)).alias("min"),
        F.when(F.col("bin") == 3, F.max("hi").over(feature)).otherwise(F.get(c, F.col("bin"))).alias("max"),
    )


@dataclass
class Perturbation:
    """What the explainer keeps of the training rows: cells per feature with their share and spread."""

    spec: FeatureSpec
    cells: DataFrame  # feature, cell, lo, hi (share of draws), mean, std, min, max, p_lo, p_hi (normal share below the ends)

    @staticmethod
    def fit(df: DataFrame, spec: FeatureSpec, quantiles: DataFrame | None = None) -> Perturbation:
        cats = category_frequencies(df, spec.categorical).select(
            "feature", F.col("value").alias("cell"), "n", *[F.lit(None).cast("double").alias(c) for c in ("mean", "std", "min", "max")]
        )
        nums = quartile_cells(df, spec.numeric, quantiles).select(
            "feature", F.col("bin").cast("string").alias("cell"), "n", "mean", (F.col("std") + STD_FLOOR).alias("std"), "min", "max"
        )
        # As many rows per feature as the fitted model has levels for it.
        upto = Window.partitionBy("feature").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        total = F.sum("n").over(Window.partitionBy("feature"))
        cells = cats.unionByName(nums).select(
            "feature", "cell",
            ((F.sum("n").over(upto) - F.col("n")) / total).alias("lo"), (F.sum("n").over(upto) / total).alias("hi"),
            "mean", "std", "min", "max",
            normal_cdf((F.col("min") - F.col("mean")) / F.col("std")).alias("p_lo"),
            normal_cdf((F.col("max") - F.col("mean")) / F.col("std")).alias("p_hi"),
        )
        return Perturbation(spec, staged(cells, "cells"))

    def cell_columns(self, df: DataFrame) -> DataFrame:
        """Add ``cell_<f>``: the row's own category or quarter of each feature."""
        cuts = (
            self.cells.filter(F.col("mean").isNotNull() & (F.col("cell") != "3"))
            .groupBy("feature")
            .agg(F.map_from_entries(F.collect_list(F.struct("cell", "max"))).alias("ends"))
            .agg(F.map_from_entries(F.collect_list(F.struct("feature", "ends"))))
            .scalar()
        )
        missing = lambda c: F.raise_error(F.lit(f"{c} is null: fill defaults before explaining"))
        out = {f"cell_{c}": F.coalesce(F.col(c).cast("string"), missing(c).cast("string")) for c in self.spec.categorical}
        for c in self.spec.numeric:
            ends = F.element_at(cuts, F.lit(c))
            above = lambda i: F.coalesce((F.col(c) > F.element_at(ends, F.lit(str(i)))).cast("int"), F.lit(0))  # noqa: B023, E731
            bin_ = (above(0) + above(1) + above(2)).cast("string")
            out[f"cell_{c}"] = F.when(F.col(c).isNotNull(), bin_).otherwise(missing(c).cast("string"))
        return df.withColumns(out)

    def draw(self, n_samples: int, seed: int) -> DataFrame:
        """``n_samples - 1`` drawn rows (sample 0 is the explained row): key k, each feature, each ``cell_<f>``."""
        spark = self.cells.sparkSession
        spec = self.spec
        draws = spark.range(1, n_samples).select(
            F.col("id").alias("k"), F.explode(F.array(*[F.lit(f) for f in spec.features])).alias("feature")
        )
        draws = draws.withColumn("u", hash_uniform(seed, "k", "feature"))
        # Which cell's share a draw falls into: cells are listed under the blocks of [0, 1) that they reach into, so a
        # draw meets the few cells of its block, not all levels of its feature.
        first = F.floor(F.col("lo") * BLOCKS)
        blocks = F.sequence(first, F.greatest(first, F.ceil(F.col("hi") * BLOCKS) - 1))
        listed = self.cells.select("*", F.explode(blocks).alias("block"))
        picked = draws.withColumn("block", F.floor(F.col("u") * BLOCKS)).join(listed, ["feature", "block"])
        picked = picked.filter((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi")))
        # Within a quarter: a normal distribution cut to the ends of the quarter, by its quantiles.
        inside = (F.col("u") - F.col("lo")) / (F.col("hi") - F.col("lo"))
        picked = picked.withColumn("p", F.col("p_lo") + inside * (F.col("p_hi") - F.col("p_lo")))
        x = F.greatest("min", F.least(F.col("max"), F.col("mean") + F.col("std") * F.col("quantile")))
        picked = normal_quantile(picked, "p", "quantile").withColumn("x", x)
        only = lambda f, c: F.max(F.when(F.col("feature") == f, F.col(c)))
        return picked.groupBy("k").agg(
            *[only(f, "cell" if f in spec.categorical else "x").alias(f) for f in spec.features],
            *[only(f, "cell").alias(f"cell_{f}") for f in spec.features],
        )

    def kernel(self) -> np.ndarray:
        """Weight of a draw by the number of features in which it differs from the row."""
        f = len(self.spec.features)
        return np.sqrt(np.exp(-np.arange(f + 1) / (0.75**2 * f)))


def gram_columns(features) -> list[str]:
    """Names of the weighted sums, in the order of the ``sums`` array."""
    f = list(features)
    return [
        "w", "wy", *[f"w_{a}" for a in f], *[f"wy_{a}" for a in f],
        *[f"w_{a}__{b}" for i, a in enumerate(f) for b in f[i + 1 :]],
    ]


def weighted_sums(cells: np.ndarray, draws: np.ndarray, y: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Sums over the draws for each row of ``cells`` (its own cells), in :func:`gram_columns` order.

    Cells are numbered by feature, and one row at a time is worked out in buffers that stay in the processor's cache:
    which draws agree in which feature, their weights, and one product of these matrices.
    """
    n, f = draws.shape
    codes, own = np.empty((f, n), np.int16 if n < 1 << 15 else np.int32), np.empty(cells.shape, np.int64)
    for a in range(f):
        levels, codes[a] = np.unique(draws[:, a], return_inverse=True)
        at = np.searchsorted(levels, cells[:, a])
        own[:, a] = np.where(np.append(levels, 0)[at] == cells[:, a], at, -1)
        own[at == len(levels), a] = -1  # in no draw
    own = own.astype(codes.dtype)
    agreed = kernel[::-1].astype(float)  # weight by the number of features that agree
    i, j = np.triu_indices(f, 1)
    out = np.empty((len(cells), 2 + 2 * f + len(i)))
    same, z, wz = np.empty((f, n), bool), np.empty((f + 2, n)), np.empty((f, n))
    z[f], z[f + 1] = 1.0, y
    for row, mine in zip(out, own, strict=True):
        np.equal(codes, mine[:, None], out=same)
        w = agreed[same.sum(axis=0, dtype=np.uint8 if f < 256 else np.int32)]
        z[:f] = same
        np.multiply(z[:f], w, out=wz)
        sums = wz @ z.T
        row[0], row[1] = w.sum(), w @ y
        row[2 : 2 + f], row[2 + f : 2 + 2 * f] = sums[:, f], sums[:, f + 1]
        row[2 + 2 * f :] = sums[i, j]
    return out


class Patterns:
    """The distinct combinations of cells of some rows, and the draws that all of them are compared with.

    Cells are compared by their 64-bit hashes; a combination's key is two hashes of all its cells. The draws travel
    to the tasks as one matrix, ``n_samples`` by features whatever the size of the data.
    """

    KEY = ("pattern_one", "pattern_two")

    def __init__(self, perturbation: Perturbation, predict: Predict, n_samples: int, seed: int):
        self.perturbation, self.features = perturbation, perturbation.spec.features
        hashes = [F.xxhash64(f"cell_{f}").alias(f"cell_{f}") for f in self.features]
        drawn = predict(perturbation.draw(n_samples, seed)).select("k", "probability", *hashes).orderBy("k").toPandas()
        matrix = drawn[[f"cell_{f}" for f in self.features]].to_numpy(np.int64)
        self.shared = perturbation.cells.sparkSession.sparkContext.broadcast((matrix, drawn["probability"].to_numpy(float)))

    def keyed(self, df: DataFrame) -> DataFrame:
        """``df`` with the key of each row's combination and the hashes of its cells."""
        cells = [F.col(f"cell_{f}") for f in self.features]
        rows = self.perturbation.cell_columns(df).withColumn("pattern", F.array(*[F.xxhash64(c) for c in cells]))
        keys = {k: F.xxhash64(F.lit(i), *cells) for i, k in enumerate(self.KEY)}
        return rows.withColumns(keys).drop(*[f"cell_{f}" for f in self.features])

    def solved(self, df: DataFrame, **wanted: tuple[str, Callable[[np.ndarray], list]]) -> DataFrame:
        """(key, names of ``wanted``): what each function makes of the weighted sums of each distinct combination, given
        with its SQL type; the sums are worked out once, spread over the tasks."""
        shared, kernel = self.shared, self.perturbation.kernel()
        makers = {name: make for name, (_, make) in wanted.items()}

        @F.pandas_udf(f"struct<{', '.join(f'{name}: {kind}' for name, (kind, _) in wanted.items())}>")
        def run(own: pd.Series) -> pd.DataFrame:
            if own.empty:
                return pd.DataFrame({name: pd.Series([], dtype=object) for name in makers})
            draws, y = shared.value
            sums = weighted_sums(np.stack(own.to_numpy()), draws, y, kernel)
            return pd.DataFrame({name: pd.Series(make(sums), dtype=object) for name, make in makers.items()})

        # The key follows from the cells, so equal rows are one combination; without an aggregate they are hashed, not
        # sorted. Dealt by other columns than they are grouped by, they are neither left in place nor put together.
        patterns = self.keyed(df).select(*self.KEY, "pattern").distinct()
        spread = patterns.repartition(shuffle_partitions(df.sparkSession), "pattern")
        return spread.select(*self.KEY, run("pattern").alias("_out")).select(*self.KEY, "_out.*")


def _looked_up(df: DataFrame, perturbation: Perturbation, predict: Predict, n_samples: int, seed: int, **wanted) -> DataFrame:
    """``df`` with its probability and what :meth:`Patterns.solved` makes of each row's combination."""
    patterns = Patterns(perturbation, predict, n_samples, seed)
    return patterns.keyed(predict(df)).join(patterns.solved(df, **wanted), [*Patterns.KEY])


SUMS = {"_sums": ("array<double>", list)}


def _fit(f: int, k: int) -> dict:
    kind = "array<struct<upto: double, chosen: array<int>, base: array<double>, slope: array<double>>>"
    return {"_ranges": (kind, lambda sums: weights_by_probability(sums, f, k))}


def _own_sums(features) -> list[str]:
    """The sums by name; the row itself agrees with itself in every feature and has weight 1."""
    return [f"_sums[{i}] + {'probability' if n.startswith('wy') else 'double(1)'} as {n}" for i, n in enumerate(gram_columns(features))]


def _with_explanation(rows: DataFrame, features) -> DataFrame:
    fit = rows.withColumn("_fit", F.expr("get(filter(_ranges, x -> probability <= x.upto), 0)"))
    names = F.array(*[F.lit(x) for x in features])
    entries = F.expr("zip_with(_fit.base, _fit.slope, (a, b) -> a + probability * b)")
    chosen = F.transform("_fit.chosen", lambda i: F.get(names, i))
    return fit.withColumn("explanation", F.map_from_arrays(chosen, entries))


def with_gram(df: DataFrame, perturbation: Perturbation, predict: Predict, n_samples: int = 5000, seed: int = 1) -> DataFrame:
    """``df`` with its probability and the weighted sums of its samples by name, the row itself included."""
    rows = _looked_up(df, perturbation, predict, n_samples, seed, **SUMS)
    return rows.selectExpr(*df.columns, "probability", *_own_sums(perturbation.spec.features))


def solve_sums(sums: np.ndarray, f: int, alpha: float, keep: np.ndarray | None = None) -> np.ndarray:
    """Ridge weights (rows x features x 2) with a free intercept, from :func:`gram_columns` sums of the draws.

    The explained row joins as a sample that agrees in every feature; its probability p is left open: the
    weights are ``[..., 0] + p * [..., 1]``. Features not in ``keep`` get weight 0.
    """
    w, wy, wz, wzy = sums[:, :1] + 1.0, sums[:, 1:2], sums[:, 2 : 2 + f] + 1.0, sums[:, 2 + f : 2 + 2 * f]
    zz = np.empty((len(sums), f, f))
    i, j = np.triu_indices(f, 1)
    zz[:, i, j] = zz[:, j, i] = sums[:, 2 + 2 * f :] + 1.0
    zz[:, np.arange(f), np.arange(f)] = wz
    zz -= wz[:, :, None] * wz[:, None, :] / w[:, :, None]
    zy = np.stack([wzy - wz * wy / w, 1.0 - wz / w], axis=2)
    keep = np.ones((len(sums), f), bool) if keep is None else keep
    a = np.where(keep[:, :, None] & keep[:, None, :], zz, 0.0) + np.eye(f) * np.where(keep, alpha, 1.0)[:, None, :]
    return np.linalg.solve(a, np.where(keep[:, :, None], zy, 0.0))


def choices(rough: np.ndarray, k: int) -> list[list[tuple[float, np.ndarray]]]:
    """For each row of ``rough`` (features x 2) the ``k`` strongest features by probability p from 0 to 1.

    Strength is ``|base + p * slope|``, so the choice changes only where two strengths cross: a list of (the p up to
    which it holds, features), of ties the first features.
    """
    f = rough.shape[1]
    i, j = np.triu_indices(f, 1)
    out = []
    for base, slope in rough.transpose(0, 2, 1):
        with np.errstate(divide="ignore", invalid="ignore"):
            cross = np.concatenate([(base[j] - base[i]) / (slope[i] - slope[j]), -(base[i] + base[j]) / (slope[i] + slope[j])])
        ends = np.append(np.unique(cross[(cross > 0) & (cross < 1)]), 1.0)
        middle = (ends + np.concatenate([[0.0], ends[:-1]])) / 2
        strength = np.abs(base + middle[:, None] * slope)
        chosen = np.sort(np.argsort(-strength, axis=1, kind="stable")[:, :k], axis=1)
        last = np.append((chosen[1:] != chosen[:-1]).any(axis=1), True)
        out.append(list(zip(ends[last], chosen[last], strict=True)))
    return out


def weights_by_probability(sums: np.ndarray, f: int, k: int) -> list[list[dict]]:
    """For each row of sums the chosen features and their weights (base + p * slope), by ranges of p."""
    if k >= f:
        ranges = [[(1.0, np.arange(f))]] * len(sums)
    else:
        ranges = choices(solve_sums(sums, f, SELECT_ALPHA), k)
    own = np.repeat(np.arange(len(sums)), [len(r) for r in ranges])
    flat = [piece for r in ranges for piece in r]
    keep = np.zeros((len(flat), f), bool)
    for row, (_, chosen) in zip(keep, flat, strict=True):
        row[chosen] = True
    fit = solve_sums(sums[own], f, FIT_ALPHA, keep)
    pieces = [
        {"upto": float(upto), "chosen": chosen.tolist(), "base": w[chosen, 0].tolist(), "slope": w[chosen, 1].tolist()}
        for (upto, chosen), w in zip(flat, fit, strict=True)
    ]
    bounds = np.cumsum([0, *(len(r) for r in ranges)])
    return [pieces[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def explain(
    df: DataFrame, perturbation: Perturbation, predict: Predict, n_samples: int = 5000, k: int = 10, seed: int = 1
) -> DataFrame:
    """``df`` with ``probability`` and ``explanation``: feature -> weight of the ``k`` strongest features per row.

    One pass over the distinct combinations of cells makes the weighted sums, chooses features and solves both
    regressions; never per row: a row's own probability enters its weights linearly, and so do the ranges of it
    in which one choice of features holds. Rows look their combination up by its key.
    """
    feats = perturbation.spec.features
    rows = _looked_up(df, perturbation, predict, n_samples, seed, **_fit(len(feats), k))
    return _with_explanation(rows, feats).select(*df.columns, "probability", "explanation")


def explain_with_gram(
    df: DataFrame, perturbation: Perturbation, predict: Predict, n_samples: int = 5000, k: int = 10, seed: int = 1
) -> DataFrame:
    """What :func:`explain` and :func:`with_gram` add, from one pass over the combinations."""
    feats = perturbation.spec.features
    rows = _looked_up(df, perturbation, predict, n_samples, seed, **SUMS, **_fit(len(feats), k))
    return _with_explanation(rows, feats).selectExpr(*df.columns, "probability", "explanation", *_own_sums(feats))


def normal_residual(df: DataFrame, features, alpha: float = FIT_ALPHA, explanation: str = "explanation") -> DataFrame:
    """``df`` (the sums of :func:`with_gram` and an explanation) with ``residual``: the largest absolute value of the
    ridge regression's normal equations at the explained weights, over the features that have one.

    Zero means that no other weights of these features fit the row's samples better.
    """
    weight = {a: F.coalesce(F.col(explanation)[a], F.lit(0.0)) for a in features}
    both = lambda a, b: f"w_{a}" if a == b else next(c for c in (f"w_{a}__{b}", f"w_{b}__{a}") if c in df.columns)
    parts = []
    for a in features:
        fitted = sum(((F.col(both(a, b)) - F.col(f"w_{a}") * F.col(f"w_{b}") / F.col("w")) * weight[b] for b in features), F.lit(alpha) * weight[a])
        target = F.col(f"wy_{a}") - F.col(f"w_{a}") * F.col("wy") / F.col("w")
        parts.append(F.when(F.map_contains_key(explanation, a), F.abs(fitted - target)).otherwise(0.0))
    return df.withColumn("residual", F.array_max(F.array(*parts)))


def top_features(explanation, k: int = 10) -> Column:
    """The ``k`` strongest entries of a weight map as an array of (feature, weight), strongest first."""
    entries = F.transform(F.map_entries(explanation), lambda e: F.struct(
        (-F.abs(e["value"])).alias("rank"), e["key"].alias("feature"), e["value"].alias("weight")
    ))
    return F.transform(F.slice(F.array_sort(entries), 1, k), lambda e: F.struct(e["feature"].alias("feature"), e["weight"].alias("weight")))


def map_extent(df: DataFrame, weights: str, probability: str) -> DataFrame:
    """Smallest and largest weight over all maps, and the extent of the probability."""
    values = F.map_values(weights)
    return df.agg(
        F.min(F.array_min(values)).alias("weight_min"), F.max(F.array_max(values)).alias("weight_max"),
        F.min(probability).alias("probability_min"), F.max(probability).alias("probability_max"),
    )


def feature_meta(stats: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(feature, name, code, category, stat): mean, min and max of numerics, categories of the others."""
    numeric = stats.select("feature", F.explode(F.array(*[
        F.struct(F.lit(s).alias("name"), F.col(s).alias("stat")) for s in ("mean", "min", "max")
    ])).alias("s")).select("feature", "s.name", "s.stat")
    levels = dictionary.select("feature", F.lit("category").alias("name"), "code", F.col("value").alias("category"))
    return levels.unionByName(numeric, allowMissingColumns=True)


def feature_card(df: DataFrame, key: str, spec: FeatureSpec, stats: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Per row and feature: its value (and, of a numeric feature, the number), its weight (0 when not chosen), and
    mean/min/max or the category list.

    ``df`` holds the key, the features and ``explanation``. The metadata has one row per feature; it is broadcast only
    if it is measured to be small.
    """
    meta = feature_meta(stats, dictionary)
    stat = lambda s: F.max(F.when(F.col("name") == s, F.col("stat"))).alias(s)
    levels = F.transform(F.array_sort(F.collect_list(F.when(F.col("code").isNotNull(), F.struct("code", "category")))), lambda e: e["category"])
    meta = meta.groupBy("feature").agg(stat("mean"), stat("min"), stat("max"), levels.alias("categories"))
    fields = df.select(key, "explanation", F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value"), (F.lit(None) if f in spec.categorical else F.col(f)).cast("double").alias("number"))
        for f in spec.features
    ])).alias("d")).select(key, "d.*", F.coalesce(F.col("explanation")[F.col("d.feature")], F.lit(0.0)).alias("weight"))
    return fields.join(broadcast_if_small(staged(meta, "meta")), "feature", "left")


def what_if(df: DataFrame, key: str, feature: str, values: Column, predict: Predict) -> DataFrame:
    """(key, feature, alternative, base_probability, probability, delta) for each alternative value of a feature.

    ``values`` is an array column: the feature's categories, or supplied numbers.
    """
    base = predict(df).withColumnRenamed("probability", "base_probability")
    variants = base.withColumn(feature, F.explode(values))
    return predict(variants).select(
        key, F.lit(feature).alias("feature"), F.col(feature).cast("string").alias("alternative"),
        "base_probability", "probability", (F.col("probability") - F.col("base_probability")).alias("delta"),
    )


def category_values(dictionary: DataFrame, feature: str) -> Column:
    """The sorted categories of a feature as an array, from a scalar subquery."""
    return dictionary.filter(F.col("feature") == feature).agg(F.array_sort(F.collect_list("value"))).scalar()


