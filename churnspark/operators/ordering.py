"""Numbering, running totals and exact quantiles over a global order, without a single-task window.

Rows are range-partitioned by the order and the placed rows are written once. One small row per
(partition, group) then gives every partition its starting offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.session import as_columns, broadcast_if_small, shuffle_partitions, staged

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row within the partition below


def _running_before(runs: DataFrame, value: str, by: list[str]) -> Column:
    """Sum of ``value`` over the earlier partitions of the same group (one row per partition and group)."""
    w = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0))


def with_row_number(df: DataFrame, order, by=(), name: str = "row_number", start: int = 1) -> DataFrame:
    """Number rows from ``start`` in ``order`` (a total order), restarting in each ``by`` group.

    A group may span any number of partitions, so one group holding most rows is no bottleneck.
    """
    by = list(by)
    order = as_columns(order)
    place = [F.col(b) for b in by] + order
    placed = staged(
        df.repartitionByRange(shuffle_partitions(df.sparkSession), *place)
        .sortWithinPartitions(*place)
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("_part", F.shiftright("_place", _ROW_BITS))
    runs = placed.groupBy("_part", *by).agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    runs = runs.withColumn("_before", _running_before(runs, "_n", by)).drop("_n")
    # Without groups there is one run per range partition, a number fixed by the session setting.
    runs = runs if by else F.broadcast(runs)
    left, right = placed.alias("l"), runs.alias("r")
    cond = F.col("l._part") == F.col("r._part")
    for b in by:
        cond = cond & F.col(f"l.`{b}`").eqNullSafe(F.col(f"r.`{b}`"))
    number = F.col("l._place") - F.col("r._first") + F.col("r._before") + F.lit(start)
    return left.join(right, cond).select(*[F.col(f"l.`{c}`") for c in df.columns], number.cast("long").alias(name))


def with_running_total(df: DataFrame, order: list[str], weights: list[str], by=(), following=()) -> DataFrame:
    """Add ``<w>_upto`` (running sum including the row) and ``<w>_total`` (group sum) for each weight.

    Rows run in ascending ``order``; ``df`` should already be aggregated to one row per (by, order) value.
    For each column in ``following`` also add ``<c>_next``, its value in the next row of the same group.
    """
    by = list(by)
    place = [*by, *order]
    placed = staged(
        df.repartitionByRange(shuffle_partitions(df.sparkSession), *place).withColumn("_part", F.spark_partition_id()),
        "running",
    )
    here = Window.partitionBy("_part", *by).orderBy(*order)
    local = placed.select(
        "*",
        *[F.sum(w).over(here.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_{w}_local") for w in weights],
        *[F.lead(c).over(here).alias(f"_{c}_lead") for c in following],
        F.lead(F.lit(1)).over(here).isNull().alias("_last"),
    )
    runs = placed.groupBy("_part", *by).agg(
        *[F.sum(w).alias(f"_{w}_run") for w in weights],
        *[F.min_by(c, F.struct(*order)).alias(f"_{c}_first") for c in following],
    )
    group = Window.partitionBy(*by)
    after = group.orderBy("_part")
    runs = runs.select(
        F.col("_part").alias("_r_part"),
        *[F.col(b).alias(f"_r_{b}") for b in by],
        *[_running_before(runs, f"_{w}_run", by).alias(f"_{w}_before") for w in weights],
        *[F.sum(f"_{w}_run").over(group).alias(f"{w}_total") for w in weights],
        *[F.lead(f"_{c}_first").over(after).alias(f"_{c}_head") for c in following],
    )
    cond = F.col("_part") == F.col("_r_part")
    for b in by:
        cond = cond & F.col(b).eqNullSafe(F.col(f"_r_{b}"))
    runs = runs if by else F.broadcast(runs)
    return local.join(runs, cond).select(
        *df.columns,
        *[(F.col(f"_{w}_local") + F.col(f"_{w}_before")).alias(f"{w}_upto") for w in weights],
        *[f"{w}_total" for w in weights],
        *[F.when(F.col("_last"), F.col(f"_{c}_head")).otherwise(F.col(f"_{c}_lead")).alias(f"{c}_next") for c in following],
    )


# Brackets around each wanted rank come from a sketch whose rank error is at most rows / SKETCH. The bracket
# must also hold the neighbouring rank, so it reaches 2 * rows / SKETCH ranks to either side; where that is not
# two whole ranks (EDGES rows or fewer) its ends are the least and the greatest value.
SKETCH = 10_000
EDGES = 2 * SKETCH


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], by=()) -> DataFrame:
    """Exact quantiles (linear between the two closest ranks) as rows (by..., feature, prob, value).

    One pass sketches a narrow bracket around each rank; a second pass counts the rows below the bracket and
    ranks only the distinct values inside it, across partitions. Neither pass moves the column through a
    shuffle or holds it in one task. Should a bracket ever miss its rank, the whole column is ranked instead.
    The plan is the same at every size. The small result is written. Nulls and NaN are left out.
    """
    by, cols, probs = list(by), list(cols), [float(p) for p in probs]
    x = {c: F.col(c).cast("double") for c in cols}
    src = df.select(*by, *[F.when(~F.isnan(x[c]), x[c]).alias(f"x{i}") for i, c in enumerate(cols)])
    names = [f"x{i}" for i in range(len(cols))]
    marks = src.groupBy(*by).agg(
        *[f(n).alias(f"{k}_{n}") for n in names for k, f in (("n", F.count), ("min", F.min), ("max", F.max))],
        *[F.percentile_approx(n, _bracket_probs(probs), SKETCH).alias(f"q_{n}") for n in names],
    )
    marks = staged(marks, "marks")
    cells = marks.agg(sum(F.count_if(F.col(f"n_{n}") > 0) for n in names).alias("cells")).first()["cells"]
    expected = (cells or 0) * len(probs)
    for whole in (False, True):
        ends = staged(_ranked_values(src, marks, names, cols, probs, by, whole), "quantiles")
        found = ends.agg(F.count("*").alias("rows"), F.count("value").alias("values")).first()
        if found["rows"] == found["values"] == expected:
            return ends
    raise AssertionError("ranks outside the whole column")


def _bracket_probs(probs: list[float]) -> list[float]:
    reach = 2.0 / SKETCH
    return [q for p in probs for q in (max(0.0, p - reach), min(1.0, p + reach))]


def _ranked_values(src, marks, names, cols, probs, by, whole: bool) -> DataFrame:
    """The quantiles from the values inside the brackets and the number of rows below them."""
    reach = 2.0 / SKETCH
    bounds = []
    for n in names:
        edges = F.lit(whole) | (F.col(f"n_{n}") <= EDGES)
        for j, p in enumerate(probs):
            lo, hi = F.col(f"q_{n}")[2 * j], F.col(f"q_{n}")[2 * j + 1]
            bounds.append(F.when(edges | F.lit(p - reach <= 0), F.col(f"min_{n}")).otherwise(lo).alias(f"lo_{n}_{j}"))
            bounds.append(F.when(edges | F.lit(p + reach >= 1), F.col(f"max_{n}")).otherwise(hi).alias(f"hi_{n}_{j}"))
    wide = marks.select(*[F.col(b).alias(f"_m_{b}") for b in by], *[f"n_{n}" for n in names], *bounds)
    m = [c for c in wide.columns if not c.startswith("_m_")]
    if by:
        same = F.lit(True)
        for b in by:
            same = same & F.col(b).eqNullSafe(F.col(f"_m_{b}"))
        placed = src.join(broadcast_if_small(wide), same).select(*by, *names, F.struct(*m).alias("m"))
    else:
        placed = src.withColumn("m", wide.select(F.struct(*m)).scalar())
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit(p).alias("prob"),
            F.col(f"m.n_{n}").alias("total"),
            F.when(F.col(n) >= F.col(f"m.lo_{n}_{j}"), F.col(n)).alias("value"),
            (F.col(n) <= F.col(f"m.hi_{n}_{j}")).alias("kept"),
        )
        for n, c in zip(names, cols)
        for j, p in enumerate(probs)
    ]
    # Rows below a bracket share the null value, so they are counted into one row before the shuffle.
    keys = [*by, "feature", "prob", "total"]
    counts = (
        placed.select(*by, F.explode(F.array(*cells)).alias("c"))
        .select(*by, "c.*")
        .filter("kept")
        .groupBy(*keys, "value")
        .agg(F.count("*").alias("n"))
    )
    ranked = with_running_total(counts, ["value"], ["n"], by=keys)
    rank = F.col("prob") * (F.col("total") - 1)
    first = F.col("n_upto") - F.col("n")
    holds = lambda r: (r >= first) & (r < F.col("n_upto"))
    ends = ranked.filter(holds(F.floor(rank)) | holds(F.ceil(rank))).groupBy(*keys).agg(
        F.max(F.when(holds(F.floor(rank)), F.col("value"))).alias("a"),
        F.max(F.when(holds(F.ceil(rank)), F.col("value"))).alias("b"),
    )
    value = F.col("a") + (F.col("b") - F.col("a")) * (rank - F.floor(rank))
    return ends.select(*by, "feature", "prob", value.alias("value"))


def value_rows(df: DataFrame, cols: list[str], keep=()) -> DataFrame:
    """Numeric columns as (keep..., feature, value) rows."""
    return df.select(
        *keep, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])).alias("_v")
    ).select(*keep, "_v.feature", "_v.value")
