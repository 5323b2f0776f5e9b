"""Near-duplicate embeddings by Euclidean p-stable hashing in several tables, with exact cosine checks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.chunks import shown_id, signed
from churnspark.llm.components import components
from churnspark.llm.words import mixed
from churnspark.session import staged

WIDTH = 2.0  # width of a hash cell; vectors have unit length
RECALL = 0.96  # chance that a pair exactly at the threshold shares a bucket; closer pairs do better
BLOCK = 1024  # vectors of a bucket compared at once; larger buckets are split into pairs of blocks
NULL_LAST = (1 << 63) - 1


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that one quantised Gaussian projection agrees for vectors this far apart."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_plan(n: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """Projections per table and number of tables for n vectors.

    Unrelated vectors (at right angles) meet about once in eight vectors and tables, at any n.
    """
    far = collision(math.sqrt(2))
    k = max(1, math.ceil(math.log(8 * max(n, 2)) / -math.log(far)))
    near = collision(math.sqrt(2 - 2 * threshold)) ** k
    return k, max(1, math.ceil(math.log(1 - recall) / math.log(1 - near)))


class Tables:
    """The hash functions of all tables for one dimension, from a fixed seed."""

    def __init__(self, dim: int, k: int, tables: int, seed: int = 11):
        draw = np.random.default_rng([seed, dim, k, tables])
        self.k, self.tables = k, tables
        self.lines = np.rint(draw.standard_normal((dim, k * tables)) * 2**12)
        self.shift = np.rint(draw.uniform(0, WIDTH, k * tables) * 2**36)
        self.factors = draw.integers(1, 1 << 62, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.salt = mixed(np.arange(tables, dtype=np.uint64) + np.uint64(dim << 20))

    def slots(self, unit: np.ndarray) -> np.ndarray:
        """A 64-bit bucket name for each vector and table.

        Vectors and lines are rounded to whole multiples of 2^-24 and 2^-12, so that the sums are exact and a
        vector gets the same names in every task, whatever the order of addition.
        """
        cells = np.floor((np.rint(unit * 2**24) @ self.lines + self.shift) / (WIDTH * 2**36)).astype(np.int64).view(np.uint64)
        return mixed((cells.reshape(len(unit), self.tables, self.k) * self.factors).sum(axis=2, dtype=np.uint64) + self.salt)


def unit_rows(values: np.ndarray) -> np.ndarray:
    rows = values.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)  # keeps the squares of very large and small values finite
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def bucket_links(unit: np.ndarray, count: np.ndarray, side: np.ndarray | None, slot: int, tables: Tables, threshold: float):
    """Links within a bucket (or between the two sides of a pair of blocks).

    Returns the number of linked vectors that this bucket adds to each member, and a label per member that
    joins members connected here. A pair that also shares an earlier table's bucket was counted there.
    """
    if side is None:
        one, two = np.nonzero(np.triu(unit @ unit.T >= threshold, 1))
    else:
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        one, two = np.nonzero(unit[left] @ unit[right].T >= threshold)
        one, two = left[one], right[two]
    label = np.arange(len(unit))
    if not len(one):
        return None, label
    while True:
        low = np.minimum(label[one], label[two])
        new = label.copy()
        np.minimum.at(new, one, low)
        np.minimum.at(new, two, low)
        if (new == label).all():
            break
        label = new
    touched = np.unique(np.concatenate([one, two]))
    slots = np.zeros((len(unit), tables.tables), np.uint64)
    slots[touched] = tables.slots(unit[touched])
    here = int(np.flatnonzero(slots[one[0]] == np.uint64(slot))[0])
    for t in range(here):
        fresh = slots[one, t] != slots[two, t]
        one, two = one[fresh], two[fresh]
    n = len(unit)
    return np.bincount(one, count[two], n) + np.bincount(two, count[one], n), label


def embedding_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """Return per row of ``vectors`` (<id>, n_links, component_id, kept).

    Rows link when the cosine of their vectors, in double precision, is at least ``threshold``. Equal vectors
    are one class with a count. Normalised vectors are hashed by quantised Gaussian projections into several
    tables; the number of projections grows with the logarithm of the number of vectors and the number of
    tables is set so that a pair exactly at the threshold is found with probability 0.96. Whatever shares a
    bucket is compared exactly, so no link below the threshold is reported; a bucket of more than 1024 vectors
    is split into pairs of blocks that different tasks compare. Links are counted and closed to components where
    they are found; pairs themselves are never written out.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing. Vectors of
    different length never link. Rows that share an id but not the vector count as different vectors of one
    component label; a null id is the smallest of a component only if it is alone. Extra columns are ignored; an
    empty table gives no rows. ``kept`` marks rows that are their component's smallest id.
    """
    vec = vectors[vector_col].cast("array<double>")
    finite = lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)
    usable = F.coalesce((F.size(vec) > 0) & F.forall(vec, finite) & F.exists(vec, lambda x: x != 0), F.lit(False))
    rows = vectors.select(
        F.coalesce(vectors[id_col].cast("long"), F.lit(NULL_LAST)).alias("id"),
        F.when(usable, F.xxhash64(vec)).alias("one"),
        F.when(usable, F.xxhash64(F.lit("second"), vec)).alias("two"),
        F.when(usable, vectors[vector_col]).alias("vec"),
    )
    classes = rows.where("one is not null").groupBy("one", "two")
    classes = staged(classes.agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("vec").alias("vec")), "classes")
    k, n_tables = table_plan(classes.count(), threshold)

    def made(cache: dict[int, Tables], dim: int) -> Tables:
        if dim not in cache:
            cache[dim] = Tables(dim, k, n_tables)
        return cache[dim]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[int, Tables] = {}
        for batch in batches:
            one, two = batch.column("one").to_numpy(), batch.column("two").to_numpy()
            values, at = batch.column("vec").flatten().to_numpy(), batch.column("vec").value_lengths().to_numpy()
            ends = np.cumsum(at)
            for dim in np.unique(at):
                mine = np.flatnonzero(at == dim)
                for part in np.array_split(mine, -(-len(mine) // BLOCK)):
                    unit = unit_rows(np.stack([values[ends[i] - dim : ends[i]] for i in part]))
                    slots = made(cache, int(dim)).slots(unit)
                    yield pa.RecordBatch.from_pydict({
                        "slot": signed(slots.ravel()),
                        "one": pa.array(np.repeat(one[part], n_tables)),
                        "two": pa.array(np.repeat(two[part], n_tables)),
                    })

    slots = classes.select("one", "two", "vec").mapInArrow(place, "slot long, one long, two long")
    size = F.count("*").over(Window.partitionBy("slot"))
    slots = slots.withColumn("size", size).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK)
    slots = slots.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.col("one"), F.col("blocks")))
    slots = slots.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    slots = slots.select(
        "slot", "one", "two",
        F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
        F.when(F.col("mine") != F.col("other"), F.col("mine") > F.col("other")).alias("right"),
    )
    # A block pair needs both blocks: the members of `low` against those of `high`.
    members = slots.join(classes.select("one", "two", "rep", "n", "vec"), ["one", "two"])
    members = members.repartition("slot", "low", "high").sortWithinPartitions("slot", "low", "high", "rep", "one")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[int, Tables] = {}
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        key, held = None, []

        def close() -> None:
            if key is None:
                return
            rep, count, one, two, right = (np.concatenate([h[i] for h in held]) for i in range(5))
            unit = np.concatenate([h[5] for h in held])
            if len(rep) < 2:
                return
            side = None if key[1] == key[2] else right
            added, label = bucket_links(unit, count, side, np.int64(key[0]).view(np.uint64), made(cache, unit.shape[1]), threshold)
            if added is not None:
                linked = np.flatnonzero((added > 0) | (label != np.arange(len(label))))
                found.append((one[linked], two[linked], added[linked].astype(np.int64), rep[linked], rep[label[linked]]))

        def ready() -> pa.RecordBatch:
            cols = [np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(5)]
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["one", "two", "links", "a", "b"])

        for batch in batches:
            slot, low, high, rep, count, one, two = (
                batch.column(c).to_numpy() for c in ("slot", "low", "high", "rep", "n", "one", "two")
            )
            right = batch.column("right").fill_null(False).to_numpy(zero_copy_only=False)
            values, at = batch.column("vec").flatten().to_numpy(), batch.column("vec").value_lengths().to_numpy()
            ends = np.cumsum(at)
            edges = np.flatnonzero((slot[1:] != slot[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, len(slot)], strict=True):
                if a == b:
                    continue
                mine = (slot[a], low[a], high[a])
                if mine != key:
                    close()
                    key, held = mine, []
                unit = unit_rows(values[ends[a] - at[a] : ends[b - 1]].reshape(b - a, -1))
                held.append((rep[a:b], count[a:b], one[a:b], two[a:b], right[a:b], unit))
            yield ready()
        close()
        yield ready()

    found = staged(members.mapInArrow(compare, "one long, two long, links long, a long, b long"), "links")
    links = found.groupBy("one", "two").agg(F.sum("links").alias("links"))
    # Classes whose smallest ids agree (repeated ids) are one node of the graph.
    joined = components(found.select("a", "b").unionByName(
        rows.where("one is not null").join(classes.select("one", "two", "rep"), ["one", "two"]).where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    ))
    per_class = staged(
        classes.select("one", "two", "n").join(links, ["one", "two"], "left").select("one", "two", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
        "counts",
    )
    result = rows.drop("vec").join(per_class, ["one", "two"], "left").join(joined, "id", "left")
    component = F.coalesce("component", "id")
    return result.select(
        shown_id("id", NULL_LAST).alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(component != NULL_LAST, component).alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
