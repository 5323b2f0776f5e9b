"""Exploratory counts and distributions: the numbers behind the plots."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.operators.ordering import exact_quantiles
from churnspark.session import broadcast_if_small, staged


def group_count(df: DataFrame, col: str, dropna: bool = False) -> DataFrame:
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    return src.groupBy(col).agg(F.count("*").alias("count"))


def churn_totals(df: DataFrame, label: str) -> DataFrame:
    """(total, churned, remained) in one pass over the rows with a known label."""
    return df.filter(F.col(label).isNotNull()).agg(
        F.count("*").alias("total"),
        F.count_if(F.col(label) == "Yes").alias("churned"),
        F.count_if(F.col(label) == "No").alias("remained"),
    )


def histogram(df: DataFrame, col: str, bins: int | None = None) -> DataFrame:
    """(bin, lo, hi, n) with equal bins, empty ones included.

    The default number of bins follows Freedman and Diaconis, at most 50, or the square root of the row
    count when the quartiles coincide. The last bin is closed on both sides.
    """
    src = df.select(F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull())
    ends = src.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("n"))
    if bins is None:
        q = exact_quantiles(src, ["x"], [0.25, 0.75])
        iqr = q.agg(F.max("value") - F.min("value")).scalar()
        width = F.lit(2.0) * F.col("iqr") / F.pow(F.col("n").cast("double"), F.lit(1.0 / 3.0))
        count = F.when(width == 0, F.floor(F.sqrt("n"))).otherwise(F.ceil((F.col("hi") - F.col("lo")) / width))
        shape = ends.withColumn("iqr", iqr).withColumn("bins", F.greatest(F.lit(1), F.least(F.lit(50), count)).cast("int"))
    else:
        shape = ends.withColumn("bins", F.lit(bins))
    flat = F.col("hi") == F.col("lo")
    shape = shape.filter(F.col("n") > 0).select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        "bins",
    )
    shape = staged(shape, "histogram")  # one row, used by both sides below
    s = shape.select(F.struct("*")).scalar()
    bin_of = F.least(s["bins"] - 1, F.floor((F.col("x") - s["lo"]) / (s["hi"] - s["lo"]) * s["bins"])).cast("int")
    counts = src.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"))
    step = (F.col("hi") - F.col("lo")) / F.col("bins")
    edges = shape.select("lo", step.alias("step"), F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"))
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("step")).alias("lo"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("step")).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, by: str, col: str) -> DataFrame:
    """(by, q1, median, q3, whisker_lo, whisker_hi, outliers) per group; whiskers end at the last value within 1.5 IQR."""
    src = df.select(by, F.col(col).cast("double").alias("x")).filter(F.col(by).isNotNull() & F.col("x").isNotNull())
    q = exact_quantiles(src, ["x"], [0.25, 0.5, 0.75], by=[by])
    pick = lambda p: F.max(F.when(F.col("prob") == p, F.col("value")))
    q = staged(q.groupBy(by).agg(pick(0.25).alias("q1"), pick(0.5).alias("median"), pick(0.75).alias("q3")), "box")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (F.col("x") >= F.col("q1") - reach) & (F.col("x") <= F.col("q3") + reach)
    return (
        src.join(broadcast_if_small(q), by)
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("x"))).alias("whisker_lo"),
            F.max(F.when(inside, F.col("x"))).alias("whisker_hi"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def pairwise_bins(df: DataFrame, cols: list[str], by: str, bins: int = 10) -> DataFrame:
    """(by, x, y, x_bin, y_bin, n): joint counts of each pair of columns on an equal grid over the data extent."""
    src = df.select(by, *[F.col(c).cast("double").alias(c) for c in cols])
    ext = src.agg(*[f(c).alias(f"{c}_{n}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))])
    e = ext.select(F.struct("*")).scalar()

    def bin_of(c):
        width = e[f"{c}_hi"] - e[f"{c}_lo"]
        raw = F.floor((F.col(c) - e[f"{c}_lo"]) / F.when(width == 0, F.lit(1.0)).otherwise(width) * bins)
        return F.least(F.lit(bins - 1), raw).cast("int")

    binned = src.select(by, *[bin_of(c).alias(c) for c in cols])
    pairs = F.array(*[
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(a).alias("x_bin"), F.col(b).alias("y_bin"))
        for a, b in combinations(cols, 2)
    ])
    return (
        binned.select(by, F.explode(pairs).alias("p"))
        .select(by, "p.*")
        .filter(F.col("x_bin").isNotNull() & F.col("y_bin").isNotNull())
        .groupBy(by, "x", "y", "x_bin", "y_bin")
        .agg(F.count("*").alias("n"))
    )


def pairwise_corr(df: DataFrame, cols: list[str], by: str) -> DataFrame:
    """(by, x, y, corr) for each pair of columns, one pass."""
    pairs = list(combinations(cols, 2))
    wide = df.groupBy(by).agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return wide.select(
        by,
        F.explode(F.array(*[
            F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)
        ])).alias("p"),
    ).select(by, "p.*")


def density_by_class(df: DataFrame, col: str, by: str, grid: int = 200, cut: float = 3.0) -> DataFrame:
    """(by, point, x, density): Gaussian kernel density of each class, scaled so all classes together hold 1.

    Bandwidth after Scott; the grid reaches ``cut`` bandwidths beyond the data. Equal values are counted
    first, and each grid point is summed before the shuffle.
    """
    src = df.select(by, F.col(col).cast("double").alias("v")).filter(F.col(by).isNotNull() & F.col("v").isNotNull())
    counts = staged(src.groupBy(by, "v").agg(F.count("*").alias("c")), "density")
    mean = F.sum(F.col("c") * F.col("v")) / F.sum("c")
    moments = counts.groupBy(by).agg(
        F.sum("c").alias("n"), mean.alias("m"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    spread = (
        counts.join(broadcast_if_small(moments), by)
        .groupBy(by, "n", "lo", "hi")
        .agg(F.sum(F.col("c") * (F.col("v") - F.col("m")) ** 2).alias("ss"))
        .filter((F.col("n") > 1) & (F.col("ss") > 0))
        .withColumn("h", F.sqrt(F.col("ss") / (F.col("n") - 1)) * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    )
    shape = staged(
        spread.select(by, "n", "h", (F.col("lo") - cut * F.col("h")).alias("lo"), (F.col("hi") + cut * F.col("h")).alias("hi")),
        "density_shape",
    )
    total = counts.agg(F.sum("c")).scalar()
    x = F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / (grid - 1)
    bump = F.col("c") * F.exp(-0.5 * ((F.col("x") - F.col("v")) / F.col("h")) ** 2)
    return (
        counts.join(broadcast_if_small(shape), by)
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
        .withColumn("x", x)
        .groupBy(by, "point", "x", "h")
        .agg(F.sum(bump).alias("s"))
        .select(by, "point", "x", (F.col("s") / (F.col("h") * math.sqrt(2 * math.pi)) / total).alias("density"))
    )


def binned_density(df: DataFrame, col: str, by: str, grid: int = 200, cut: float = 3.0, cells: int = 4096) -> DataFrame:
    """What :func:`density_by_class` returns, from a fixed number of cells instead of all distinct values.

    A value's weight goes to the two cell points next to it, the nearer the more, and the densities are sums over
    the cell points: ``grid`` x ``cells`` terms a class whatever the table. With d the distance of cell points in
    bandwidths, a density is off by at most d^2 / 8 of the curve's greatest bend: less than 1e-5 of the greatest
    possible density for ranges up to 30 bandwidths.
    """
    src = df.select(by, F.col(col).cast("double").alias("v")).filter(F.col(by).isNotNull() & F.col("v").isNotNull())
    shape = src.groupBy(by).agg(F.count("*").alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("least"), F.max("v").alias("most"))
    total = shape.agg(F.sum("n")).first()[0]
    shape = shape.filter((F.col("n") > 1) & (F.col("sd") > 0)).withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    ends = shape.select(by, "h", (F.col("least") - cut * F.col("h")).alias("lo"), (F.col("most") + cut * F.col("h")).alias("hi"))
    shape = staged(ends.withColumn("step", (F.col("hi") - F.col("lo")) / (cells - 1)), "density_shape")
    place = (F.col("v") - F.col("lo")) / F.col("step")
    near = src.join(broadcast_if_small(shape), by).select(by, "lo", "hi", "h", "step", F.floor(place).alias("i"), (place - F.floor(place)).alias("far"))
    shares = F.array(F.struct("i", (1 - F.col("far")).alias("w")), F.struct((F.col("i") + 1).alias("i"), F.col("far").alias("w")))
    held = near.select(by, "lo", "hi", "h", "step", F.explode(shares).alias("s")).groupBy(by, "lo", "hi", "h", "step", "s.i").agg(F.sum("s.w").alias("w"))
    x = F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / (grid - 1)
    bump = F.col("w") * F.exp(-0.5 * ((F.col("x") - F.col("lo") - F.col("i") * F.col("step")) / F.col("h")) ** 2)
    return (
        held.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
        .withColumn("x", x)
        .groupBy(by, "point", "x", "h")
        .agg(F.sum(bump).alias("s"))
        .select(by, "point", "x", (F.col("s") / (F.col("h") * math.sqrt(2 * math.pi)) / (total or 1)).alias("density"))
    )
