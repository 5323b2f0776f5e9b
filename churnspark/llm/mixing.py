"""Mixing sources to target weights, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.operators.ordering import with_row_number, with_running_total
from churnspark.session import staged

GAPS = r"[\x20\x09-\x0D]+"
EPOCHS = 3  # a source is used up to so many times its size
WEIGHTS = (1, 2, 3)  # by source in order, repeating


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), GAPS), "")).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Rows (source, source_size, target) for rows (source, size).

    All sizes together are shared by weight. A target stops at ``epochs`` times its source's size and the excess
    is shared again by weight until none is above. That is one level: with the sources in ascending order of
    limit / weight, those before it get their limit, those after it a share by weight of what is left.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_row_number(sources.select(F.col("source").isNull().alias("last"), "source", "source_size"), ["last", "source"])
    turn = (F.col("row_number") - 1) % len(weights) + 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), turn.cast("int"))
    ranked = ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * epochs).alias("most"))
    ranked = ranked.withColumn("level", F.col("most") / F.col("weight"))
    steps = staged(ranked.groupBy("level").agg(F.sum("most").alias("most"), F.sum("weight").alias("weight"), F.sum("source_size").alias("own")))
    steps = with_running_total(steps, ["level"], ["most", "weight", "own"])
    left = F.col("own_total") - (F.col("most_upto") - F.col("most"))
    weights_left = F.col("weight_total") - (F.col("weight_upto") - F.col("weight"))
    fits = left <= F.col("level") * weights_left
    open_steps = steps.where(fits)
    rest = open_steps.agg(F.min_by(left, "level")).scalar()
    weights = open_steps.agg(F.min_by(weights_left, "level")).scalar()
    shared = F.col("weight") * rest / weights
    return ranked.select("source", "source_size", F.least(F.col("most").cast("double"), shared).alias("target"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: str = "mix",
    also: tuple[str, ...] = (),
) -> DataFrame:
    """Return per row of ``docs`` (<id>, <source>, size, source_size, target, times, taken, also...).

    ``size`` counts the words of the text, ``times`` how often the mix takes the document, ``taken`` the words.
    Documents get a random key from a hash of seed and id, are range-sorted by it within their source, and the
    running total of sizes cuts each source at its target: whole rounds over the source first, then the
    documents in key order as long as at least half of the document lies before the cut. A source misses its
    target by at most half of one document.

    Null and empty texts have size 0 and are never taken. A null source is a source, the last one. Equal ids
    are ordered by text hash and size, then by the columns ``also``; rows equal in all of these are numbered and
    cut one by one. Other columns are ignored, an empty table gives no rows.
    """
    ties = [f"also{i}" for i in range(len(also))]
    sizes = docs.select(
        docs[id_col].alias("id"),
        docs[source_col].alias("source"),
        word_count(docs[text_col]).alias("size"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(docs[id_col].cast("string"), F.lit("")))).alias("key"),
        F.coalesce(F.xxhash64(docs[text_col]), F.lit(0)).alias("tie"),
        *[docs[c].alias(t) for c, t in zip(also, ties, strict=True)],
        F.monotonically_increasing_id().alias("number"),  # fixed by the write
    )
    sizes = staged(sizes, "sizes")
    targets = staged(source_targets(sizes, weights, epochs), "targets")

    # Nulls do not compare; sources travel as (missing, text) pairs.
    rows = sizes.withColumns({"none": F.col("source").isNull(), "src": F.coalesce("source", F.lit(""))})
    total = with_running_total(rows, ["key", "tie", "size", *ties, "number"], ["size"], by=["none", "src"])
    targets = targets.select(
        F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("src"), "source_size", "target"
    )
    rounds = F.floor(F.try_divide(F.col("target"), F.col("source_size")))  # no words in the source: null, not used
    rest = F.col("target") - rounds * F.col("source_size")
    extra = F.when(2 * F.col("size_upto") - F.col("size") <= 2 * rest, 1).otherwise(0)
    out = total.join(targets, ["none", "src"]).withColumn("times", F.when(F.col("size") == 0, 0).otherwise(rounds + extra).cast("long"))
    return out.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "times",
        (F.col("times") * F.col("size")).alias("taken"), *[F.col(t).alias(c) for c, t in zip(also, ties, strict=True)],
    )
