"""Feature specification, category dictionary, ordinal codes, one-hot codes and scaling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.operators.ordering import exact_quantiles, value_rows, with_row_number
from churnspark.session import broadcast_if_small, staged


@dataclass(frozen=True)
class FeatureSpec:
    """Ordered features and which of them are categorical."""

    features: tuple[str, ...]
    categorical: tuple[str, ...]

    @staticmethod
    def infer(df: DataFrame, label: str | None = None, drop=()) -> FeatureSpec:
        """Text columns are categorical, the others numeric; label and dropped columns are left out."""
        fields = [f for f in df.schema.fields if f.name != label and f.name not in drop]
        return FeatureSpec(
            tuple(f.name for f in fields),
            tuple(f.name for f in fields if isinstance(f.dataType, T.StringType)),
        )

    @staticmethod
    def declare(pairs) -> FeatureSpec:
        """From (column, is_categorical) pairs."""
        return FeatureSpec(tuple(c for c, _ in pairs), tuple(c for c, cat in pairs if cat))

    @property
    def numeric(self) -> tuple[str, ...]:
        return tuple(f for f in self.features if f not in self.categorical)


def category_rows(df: DataFrame, cols, keep=()) -> DataFrame:
    """Categorical columns as (keep..., feature, value) rows."""
    return df.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("_v")).select(*keep, "_v.feature", "_v.value")


def category_counts(df: DataFrame, cols) -> DataFrame:
    """Rows per (feature, value), nulls left out; counted before the shuffle."""
    return (
        category_rows(df, cols).filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count("*").alias("n"))
    )


def fit_dictionary(df: DataFrame, cols) -> DataFrame:
    """(feature, value, code): code is the position of the value among the sorted values of its feature."""
    values = category_counts(df, cols).select("feature", "value")
    return with_row_number(values, ["value"], by=["feature"], name="code", start=0).select(
        "feature", "value", F.col("code").cast("int").alias("code")
    )


def category_frequencies(df: DataFrame, cols) -> DataFrame:
    """(feature, value, n, share) over the known values of each feature."""
    counts = category_counts(df, cols)
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    return counts.join(totals, "feature").select("feature", "value", "n", (F.col("n") / F.col("total")).alias("share"))


def unseen(df: DataFrame, dictionary: DataFrame, cols) -> DataFrame:
    """(feature, value, n) of category values that the dictionary does not hold."""
    return category_counts(df, cols).join(dictionary, ["feature", "value"], "left_anti")


def encode_ordinal(df: DataFrame, dictionary: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Categories replaced by their codes as doubles, numerics untouched; a value outside the dictionary fails.

    A dictionary of checked size is broadcast to each column's lookup; a larger one joins by shuffle.
    """
    codes = broadcast_check(dictionary)
    out = df
    for c in spec.categorical:
        lookup = codes(dictionary.filter(F.col("feature") == c).select(F.col("value").alias(f"_{c}_value"), F.col("code").alias(f"_{c}_code")))
        out = out.join(lookup, F.col(c) == F.col(f"_{c}_value"), "left")
    error = lambda c: F.raise_error(F.concat(F.lit(f"value outside the dictionary of {c}: "), F.coalesce(F.col(c), F.lit("null"))))
    others = [c for c in df.columns if c not in spec.categorical]
    return out.select(
        *[
            F.col(c) if c in others else F.coalesce(F.col(f"_{c}_code").cast("double"), error(c)).alias(c)
            for c in df.columns
        ]
    )


def broadcast_check(dictionary: DataFrame):
    """A hint for the slices of ``dictionary``: broadcast when the whole of it is small, else nothing."""
    small = broadcast_if_small(dictionary) is not dictionary
    return F.broadcast if small else (lambda df: df)


def decode(codes: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(..., feature, code) rows with the category ``value`` the code stands for; ``dictionary`` is a written table."""
    names = dictionary.select(F.col("feature").alias("_f"), F.col("code").alias("_c"), "value")
    return codes.join(broadcast_if_small(names), (F.col("feature") == F.col("_f")) & (F.col("code") == F.col("_c"))).drop("_f", "_c")


def onehot_rows(df: DataFrame, dictionary: DataFrame, spec: FeatureSpec, key: str) -> DataFrame:
    """Long form of the model matrix: (key, position, name, x); all category levels first, then the numerics.

    Zero entries of the indicator columns are left out, as in a sparse vector.
    """
    offsets = staged(_level_offsets(dictionary, spec), "levels")
    cats = category_rows(df, spec.categorical, [key]).join(broadcast_if_small(offsets), ["feature", "value"]).select(
        key, "position", F.concat("feature", F.lit("="), "value").alias("name"), F.lit(1.0).alias("x")
    )
    n_levels = offsets.agg(F.count("*")).scalar()
    place = F.element_at(F.create_map(*[x for i, c in enumerate(spec.numeric) for x in (F.lit(c), F.lit(i))]), F.col("feature"))
    nums = value_rows(df, list(spec.numeric), [key]).select(
        key, (place + n_levels).cast("int").alias("position"), F.col("feature").alias("name"), F.col("value").alias("x")
    )
    return cats.unionByName(nums)


def _level_offsets(dictionary: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(feature, value, position): levels numbered through, features in the order of the spec."""
    order = F.element_at(
        F.create_map(*[x for i, c in enumerate(spec.categorical) for x in (F.lit(c), F.lit(i))]), F.col("feature")
    )
    # One row per feature of the spec, so the unpartitioned window is a handful of rows.
    earlier = Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dictionary.groupBy("feature")
        .agg(F.count("*").alias("levels"))
        .withColumn("ord", order)
        .select("feature", F.coalesce(F.sum("levels").over(earlier), F.lit(0)).alias("before"))
    )
    return dictionary.join(before, "feature").select(
        "feature", "value", (F.col("code") + F.col("before")).cast("int").alias("position")
    )


def fit_scaler(df: DataFrame, cols) -> DataFrame:
    """(feature, mean, std): mean and population standard deviation of each column."""
    return _describe(df, cols, {"mean": F.avg, "std": F.stddev_pop})


def _describe(df: DataFrame, cols, stats) -> DataFrame:
    """One pass over ``df``; one row per column with the named aggregates."""
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{c}\x01{s}") for c in cols for s, f in stats.items()])
    return row.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}\x01{s}").alias(s) for s in stats]) for c in cols])).alias("_s")
    ).select("_s.*")


def standardize(df: DataFrame, cols, scaler: DataFrame) -> DataFrame:
    """(x - mean) / std for each column; a constant column becomes 0."""
    row = scaler.agg(
        F.map_from_entries(F.collect_list(F.struct("feature", F.struct("mean", "std")))).alias("m")
    ).scalar()
    out = {}
    for c in cols:
        p = F.element_at(row, F.lit(c))
        out[c] = (F.col(c) - p["mean"]) / F.when(p["std"] == 0, F.lit(1.0)).otherwise(p["std"])
    return df.withColumns(out)


QUARTILES = (0.25, 0.5, 0.75)


def numeric_stats(df: DataFrame, cols, quantiles: DataFrame | None = None) -> DataFrame:
    """(feature, median, mean, min, max, std): exact median, sample standard deviation.

    ``quantiles`` may hold ready results of :func:`exact_quantiles` that include the median.
    """
    base = _describe(df, cols, {"mean": F.avg, "min": F.min, "max": F.max, "std": F.stddev_samp})
    quantiles = exact_quantiles(df, list(cols), [0.5]) if quantiles is None else quantiles
    median = quantiles.filter("prob = 0.5").select("feature", F.col("value").alias("median"))
    return base.join(median, "feature", "left").select("feature", "median", "mean", "min", "max", "std")


def default_values(df: DataFrame, spec: FeatureSpec, quantiles: DataFrame | None = None) -> DataFrame:
    """One row: first sorted category of each categorical feature, median of each numeric feature."""
    quantiles = exact_quantiles(df, list(spec.numeric), [0.5]) if quantiles is None else quantiles
    first = df.agg(*[F.min(c).alias(c) for c in spec.categorical])
    medians = (
        quantiles.filter("prob = 0.5")
        .agg(F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("m"))
        .scalar()
    )
    return first.select(
        *[F.col(c) if c in spec.categorical else F.element_at(medians, F.lit(c)).alias(c) for c in spec.features]
    )


def categories(dictionary: DataFrame) -> DataFrame:
    """(feature, index, value): the values of each feature with their positions."""
    return dictionary.select("feature", F.col("code").alias("index"), "value")


def fit_tables(df: DataFrame, spec: FeatureSpec, quantiles: DataFrame | None = None):
    """(dictionary, defaults, stats) of the training rows, each written once because serving reads them often."""
    quantiles = exact_quantiles(df, list(spec.numeric), QUARTILES) if quantiles is None else quantiles
    return (
        staged(fit_dictionary(df, spec.categorical), "dictionary"),
        staged(default_values(df, spec, quantiles), "defaults"),
        staged(numeric_stats(df, list(spec.numeric), quantiles), "stats"),
    )
