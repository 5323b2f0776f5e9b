"""Samples, splits and folds that depend on row keys only, never on how rows are laid out."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.functions.columns import hash_text, hash_uniform
from churnspark.operators.ordering import with_row_number

_PREFIX = 4  # hexadecimal digits: at most 65,536 counts, whatever the size of the table


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Each row kept with probability ``fraction``, decided by the hash of its key."""
    return df.filter(hash_uniform(seed, key) < fraction)


def _marked(df: DataFrame, key: str, seed, wanted: Callable[[int], int], name: str) -> DataFrame:
    """``df`` with a column that is true for exactly ``wanted(rows)`` rows: the first by hash of the key, then by hash
    of the whole row; of rows equal in every column any may be marked.

    One scan counts rows by hash prefix; a fixed number of counts comes to the driver and tells the prefix in which
    the cut falls. Only the rows of that prefix are put in order (range-partitioned, so rows that share a key may be
    many), all others are marked by their prefix where they lie.
    """
    prefix = F.substring(F.coalesce(hash_text(seed, key), F.lit("")), 1, _PREFIX)
    counts = sorted((r["p"], r["n"]) for r in df.groupBy(prefix.alias("p")).agg(F.count("*").alias("n")).collect())  # 16^_PREFIX rows at most
    total = sum(n for _, n in counts)
    need = min(max(wanted(total), 0), total)
    if need in (0, total):
        return df.withColumn(name, F.lit(need > 0))
    for border, n in counts:  # ends at the border, as need is less than the total
        if need <= n:
            break
        need -= n
    row = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{f.name}`"))) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in df.schema.fields])
    rest = df.filter(prefix != border).withColumn(name, prefix < border)
    order = {"_h": F.coalesce(hash_text(seed, key), F.lit("")), "_r": row, "_t": F.monotonically_increasing_id()}
    near = with_row_number(df.filter(prefix == border).withColumns(order), list(order), name="_n")
    return rest.unionByName(near.withColumn(name, F.col("_n") <= need).select(*df.columns, name))


def sample_n(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """Exactly ``n`` rows (all of them when there are fewer), whether or not keys repeat."""
    return _marked(df, key, seed, lambda total: n, "_in").filter("_in").drop("_in")


def train_test_split(df: DataFrame, key: str, test: float = 0.25, seed: int = 42, name: str = "is_test") -> DataFrame:
    """Mark exactly ceil(test * rows) rows as test, without regard to classes."""
    return _marked(df, key, seed, lambda total: math.ceil(total * test), name)


def folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold 0..k-1 per row; within each class the folds differ by at most one row."""
    hashed = df.withColumn("_h", hash_text(seed, key))
    numbered = with_row_number(hashed, ["_h", key], by=[label], name="_rn", start=0)
    return numbered.withColumn(name, (F.col("_rn") % k).cast("int")).drop("_h", "_rn")


def ramp_noise(df: DataFrame, order, label: str, seed: int, key: str, name: str = "final_label") -> DataFrame:
    """Row i of n becomes positive with chance i/n, else keeps ``label == 'Yes'``; never turned negative."""
    numbered = with_row_number(df, order, name="_i")
    n = df.agg(F.count("*")).scalar()
    forced = hash_uniform(seed, key) < F.col("_i") / n
    return numbered.withColumn(name, forced | (F.col(label) == "Yes")).drop("_i")
