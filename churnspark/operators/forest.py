"""Random forest whose trees are rows of a table: neither the driver nor a task ever holds a whole forest.

Features are cut into bins; equal rows are one cell with a count per class. A tree's first nodes are split by
histograms that all tasks add up, until no node has more than ``SUBTREE_CELLS`` cells; each of these nodes then
grows to its leaves in a group of its own. Bootstrap weights and the features tried at a node follow from
hashes of the cell, the tree and the node, so a forest depends neither on the layout of its rows nor on that bound.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.session import shuffle_partitions, staged

# The functions that run in tasks travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BINS = 128  # of a feature
SAMPLE_ROWS = MAX_BINS**2  # from which the bins' ends are taken, drawn by hash
SUBTREE_CELLS = 1 << 17  # drawn cells of a node that is grown in one group
CHUNK_CELLS = 1 << 14  # to score at a time
SLICE_CELLS = 1 << 22  # scored with one copy of the trees, at most

NODE_KIND = "tree int, node long, feature array<smallint>, bin array<smallint>, left array<int>, n0 array<double>, n1 array<double>"

Tops = list[dict[int, tuple[int, int]]]  # of each tree: node -> (feature, bin); the children of node i are 2i and 2i + 1


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit words, thoroughly mixed (splitmix64)."""
    with np.errstate(over="ignore"):
        x = np.asarray(x).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def drawn_copies(hashes: np.ndarray, n: np.ndarray, tree: int, seed: int, kind: int) -> np.ndarray:
    """How often a bootstrap sample holds each cell of ``n`` rows: Poisson with mean ``n``, by the cell's hash."""
    word = mixed(hashes.astype(np.uint64) ^ mixed(np.array([(seed * 1_000_003 + tree) * 2 + kind]))[0])
    u = (word >> np.uint64(11)).astype(float) * 2.0**-53
    out = np.zeros(len(n), np.int64)
    for mean in np.unique(n[n > 0]):
        k = np.arange(int(mean + 12 * np.sqrt(mean)) + 24)
        log_p = k * np.log(mean) - mean - np.concatenate([[0.0], np.cumsum(np.log(k[1:]))])
        of = n == mean
        out[of] = np.searchsorted(np.cumsum(np.exp(log_p)), u[of], side="right")
    return out


def tried(nodes: np.ndarray, tree: int, seed: int, f: int) -> np.ndarray:
    """The features tried at each node (nodes x sqrt(f)), in a random order by hash."""
    base = mixed(nodes.astype(np.uint64) ^ mixed(np.array([seed * 1_000_003 + tree]) + (1 << 40)))
    keys = mixed(base[:, None] ^ mixed(np.arange(f)))
    return np.argsort(keys, axis=1, kind="stable")[:, : int(np.ceil(np.sqrt(f)))]


def matrix(cells: pa.Array | Iterable[bytes], f: int) -> np.ndarray:
    """Cells as rows of bins."""
    return np.frombuffer(b"".join(cells if isinstance(cells, list) else cells.to_pylist()), np.uint8).reshape(-1, f)


def routed(x: np.ndarray, top: dict[int, tuple[int, int]]) -> np.ndarray:
    """The node below the split ones to which each cell comes."""
    at = np.ones(len(x), np.int64)
    level = [1]
    while level := [n for n in level if n in top]:
        inner = np.array(sorted(level))
        feature, bin_ = np.array([top[n] for n in inner]).T
        here = np.flatnonzero(np.isin(at, inner))
        of = np.searchsorted(inner, at[here])
        at[here] = 2 * at[here] + (x[here, feature[of]] > bin_[of])
        level = [c for n in level for c in (2 * n, 2 * n + 1)]
    return at


def quality(l0: np.ndarray, l1: np.ndarray, t0: np.ndarray, t1: np.ndarray) -> np.ndarray:
    """Fall of the Gini impurity up to a factor of the node, without rounding in whether there is one."""
    r0, r1 = t0 - l0, t1 - l1
    cross = l0 * r1 - l1 * r0
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.nan_to_num(cross * cross / ((l0 + l1) * (r0 + r1)), nan=0.0, posinf=0.0)


def grown(x: np.ndarray, w0: np.ndarray, w1: np.ndarray, root: int, tree: int, seed: int, max_depth: int) -> dict[str, np.ndarray]:
    """The nodes below ``root`` by level: feature, bin, left child (-1: a leaf; the right one follows it), drawn rows
    per class. As in Spark's forest, two leaves of one prediction become one."""
    f = x.shape[1]
    paths, at = np.array([root], np.int64), np.zeros(len(x), np.int64)
    levels, size, depth = [], 0, root.bit_length() - 1
    while True:
        t0, t1 = (np.bincount(at, w, len(paths)) for w in (w0, w1))
        best, feature, bin_ = np.zeros(len(paths)), np.full(len(paths), -1), np.zeros(len(paths), np.int64)
        live = (t0 > 0) & (t1 > 0) & (depth < max_depth)
        on = live[at]
        x, w0, w1, at = x[on], w0[on], w1[on], at[on]
        features = tried(paths, tree, seed, f) if len(at) else np.empty((len(paths), 0), np.int64)
        for s in range(features.shape[1]):
            key = at * 256 + x[np.arange(len(at)), features[at, s]]
            order = np.argsort(key, kind="stable")
            key = key[order]
            last = np.flatnonzero(np.append(key[1:] != key[:-1], True))  # of each bin of each node
            node = key[last] >> 8
            l0, l1 = (np.cumsum(w[order])[last] for w in (w0, w1))
            first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            before = np.repeat(first, np.diff(np.append(first, len(node))))
            l0, l1 = (a - np.where(before > 0, a[before - 1], 0.0) for a in (l0, l1))
            good = quality(l0, l1, t0[node], t1[node])
            top = np.maximum.reduceat(good, first)
            place = np.minimum.reduceat(np.where(good == np.repeat(top, np.diff(np.append(first, len(node)))), np.arange(len(node)), len(node)), first)
            held = node[first]
            better = top > best[held]
            held, place = held[better], place[better]
            best[held], feature[held], bin_[held] = top[better], features[held, s], key[last[place]] & 255
        inner = feature >= 0
        left = np.where(inner, size + len(paths) + 2 * (np.cumsum(inner) - 1), -1)
        levels.append({"feature": feature, "bin": bin_, "left": left, "n0": t0, "n1": t1})
        size, depth = size + len(paths), depth + 1
        if not inner.any():
            break
        on = inner[at]
        x, w0, w1, at = x[on], w0[on], w1[on], at[on]
        at = 2 * (np.cumsum(inner) - 1)[at] + (x[np.arange(len(at)), feature[at]] > bin_[at])
        paths = np.stack([2 * paths[inner], 2 * paths[inner] + 1], axis=1).ravel()
    nodes = {k: np.concatenate([v[k] for v in levels]) for k in levels[0]}
    ends = np.cumsum([len(v["left"]) for v in levels])
    left, says = nodes["left"], nodes["n1"] > nodes["n0"]
    for a, b in reversed(list(zip([0, *ends[:-1]], ends, strict=True))):
        i = a + np.flatnonzero(left[a:b] >= 0)
        c = left[i]
        left[i[(left[c] < 0) & (left[c + 1] < 0) & (says[c] == says[c + 1])]] = -1
    kept = np.zeros(size, bool)
    kept[0] = True
    for a, b in zip([0, *ends[:-1]], ends, strict=True):
        c = left[a:b][kept[a:b] & (left[a:b] >= 0)]
        kept[c] = kept[c + 1] = True
    number = np.cumsum(kept) - 1
    nodes["left"] = np.where(left >= 0, number[left], -1)
    return {k: v[kept] for k, v in nodes.items()}


def binned(raw: Column, ends: list[list[float]]) -> Column:
    """The cell of a vector: for each feature how many ends of bins lie below its value, a byte each."""

    @F.pandas_udf("binary")
    def cell(values: pd.Series) -> pd.Series:
        x = np.stack(values.to_numpy()) if len(values) else np.empty((0, len(ends)))
        bins = np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(ends)], axis=1).astype(np.uint8)
        return pd.Series([r.tobytes() for r in bins], dtype=object)

    return cell(vector_to_array(raw))


def bin_ends(data: DataFrame, f: int, seed: int) -> list[list[float]]:
    """Up to 127 ends per feature: between all neighbouring values of the sample, or at even shares of its rows."""
    x = vector_to_array("raw")
    drawn = data.select(x.alias("x")).orderBy(F.xxhash64(F.lit(seed), "x"), "x").limit(SAMPLE_ROWS).toPandas()
    sample = np.stack(drawn["x"].to_numpy()) if len(drawn) else np.empty((0, f))
    out = []
    for column in np.sort(sample, axis=0).T:
        values = np.unique(column)
        middles = (values[1:] + values[:-1]) / 2
        if len(middles) >= MAX_BINS:
            at = np.searchsorted(values, column[np.arange(1, MAX_BINS) * len(column) // MAX_BINS])
            middles = middles[np.unique(at[at > 0]) - 1]
        out.append(middles.tolist())
    return out


def each_tree(batches: Iterator[pa.RecordBatch], f: int, trees: int, seed: int, tops: Tops) -> Iterator[tuple]:
    """(tree, bins, drawn rows per class, node) of the cells that each tree's sample holds."""
    for b in batches:
        x, hashes, n0, n1 = matrix(b["cell"], f), *(b[c].to_numpy() for c in ("hash", "n0", "n1"))
        for t in range(trees):
            w0, w1 = (drawn_copies(hashes, n, t, seed, kind) for kind, n in enumerate((n0, n1)))
            on = w0 + w1 > 0
            yield t, x[on], w0[on].astype(float), w1[on].astype(float), routed(x[on], tops[t])


def split_tops(cells: DataFrame, f: int, trees: int, seed: int, max_depth: int, bound: int) -> Tops:
    """The splits above the nodes of at most ``bound`` drawn cells: one pass a level over histograms per node."""
    tops: Tops = [{} for _ in range(trees)]
    k = int(np.ceil(np.sqrt(f)))
    open_: list[list[int]] = [[1] for _ in range(trees)]
    while any(open_):
        now, told = [sorted(o) for o in open_], [dict(t) for t in tops]

        def histograms(batches: Iterator[pa.RecordBatch], now=now, told=told) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros((len(nodes), k, 256, 3)) for nodes in now]
            features = [tried(np.array(nodes, np.int64), t, seed, f) for t, nodes in enumerate(now)]
            for t, x, w0, w1, at in each_tree(batches, f, trees, seed, told):
                for i, node in enumerate(now[t]):
                    here = at == node
                    for s in range(k):
                        column = x[here, features[t][i, s]]
                        for c, w in enumerate((w0[here], w1[here], None)):
                            sums[t][i, s, :, c] += np.bincount(column, w, 256)
            for t, nodes in enumerate(now):
                if nodes:
                    yield pa.record_batch({"tree": pa.array([t] * len(nodes), pa.int32()), "node": pa.array(nodes, pa.int64()), "sums": [h.tobytes() for h in sums[t]]})

        def best(group: pa.Table) -> pa.Table:
            t, node = group["tree"][0].as_py(), group["node"][0].as_py()
            h = sum(np.frombuffer(b, float).reshape(k, 256, 3) for b in group["sums"].to_pylist())
            upto = np.cumsum(h, axis=1)
            n0, n1, held = upto[0, -1]
            good = quality(upto[:, :, 0], upto[:, :, 1], n0, n1)
            s, b = np.unravel_index(np.argmax(good), good.shape)
            feature = int(tried(np.array([node]), t, seed, f)[0, s]) if held > bound and good[s, b] > 0 and node.bit_length() - 1 < max_depth else -1
            few = upto[s, b, 2]
            return pa.table({"tree": pa.array([t], pa.int32()), "node": [node], "feature": [feature], "bin": [int(b)], "below": [float(few)], "above": [float(held - few)]})

        sums = cells.mapInArrow(histograms, "tree int, node long, sums binary")
        kind = "tree int, node long, feature long, bin long, below double, above double"
        found = sums.groupBy("tree", "node").applyInArrow(best, kind).where("feature >= 0").toPandas()  # at most a row per open node
        open_ = [[] for _ in range(trees)]
        for r in found.itertuples():
            tops[r.tree][r.node] = (r.feature, r.bin)
            open_[r.tree] += [c for c, n in ((2 * r.node, r.below), (2 * r.node + 1, r.above)) if n > bound]
    return tops


def grow_subtrees(cells: DataFrame, f: int, trees: int, seed: int, max_depth: int, tops: Tops) -> DataFrame:
    """The nodes below the tops' lowest splits, a row per (tree, node) with all nodes under it."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, x, w0, w1, at in each_tree(batches, f, trees, seed, tops):
            nodes = np.unique(at)
            parts = [at == n for n in nodes]
            blobs = lambda a, kind: [a[p].astype(kind).tobytes() for p in parts]  # noqa: B023, E731
            if len(nodes):
                yield pa.record_batch({"tree": pa.array([t] * len(nodes), pa.int32()), "node": pa.array(nodes), "cells": blobs(x, np.uint8), "w0": blobs(w0, np.int32), "w1": blobs(w1, np.int32)})

    def grow(group: pa.Table) -> pa.Table:
        t, node = group["tree"][0].as_py(), group["node"][0].as_py()
        w0, w1 = (np.frombuffer(b"".join(group[c].to_pylist()), np.int32).astype(float) for c in ("w0", "w1"))
        nodes = grown(matrix(group["cells"], f), w0, w1, node, t, seed, max_depth)
        kinds = {"feature": pa.int16(), "bin": pa.int16(), "left": pa.int32(), "n0": pa.float64(), "n1": pa.float64()}
        lists = {c: pa.ListArray.from_arrays(pa.array([0, len(nodes[c])], pa.int32()), pa.array(nodes[c]).cast(kind)) for c, kind in kinds.items()}
        return pa.table({"tree": pa.array([t], pa.int32()), "node": pa.array([node], pa.int64()), **lists})

    parts = cells.mapInArrow(dealt, "tree int, node long, cells binary, w0 binary, w1 binary")
    return parts.repartition(shuffle_partitions(cells.sparkSession), "tree", "node").groupBy("tree", "node").applyInArrow(grow, NODE_KIND)


def join_leaves(nodes: DataFrame, tops: Tops) -> tuple[DataFrame, Tops]:
    """Tops without splits between two leaves of one prediction; the rows of the nodes that became leaves are added."""
    leaves = nodes.where(F.size("left") == 1).select("tree", "node", F.col("n0")[0].alias("n0"), F.col("n1")[0].alias("n1"))
    ends = {(r.tree, r.node): (r.n0, r.n1) for r in leaves.toPandas().itertuples()} if any(tops) else {}  # at most a row per group
    tops, added = [dict(t) for t in tops], []
    for t, top in enumerate(tops):
        for n in sorted(top, reverse=True):
            pair = [ends.get((t, c)) for c in (2 * n, 2 * n + 1)]
            if all(pair) and len({b > a for a, b in pair}) == 1:
                ends[t, n] = tuple(map(sum, zip(*pair, strict=True)))
                added.append((t, n, [-1], [0], [-1], [ends[t, n][0]], [ends[t, n][1]]))
                del top[n]
    return (nodes.unionByName(nodes.sparkSession.createDataFrame(added, NODE_KIND)) if added else nodes), tops


def fit(data: DataFrame, f: int, trees: int, max_depth: int, seed: int, partitions: int | None = None, bound: int = SUBTREE_CELLS) -> ForestModel:
    """Forest over (raw, target): ``f`` features, target 0 or 1; trees fully grown up to ``max_depth`` (62 at most)."""
    if not 0 <= max_depth <= 62:
        raise ValueError("max_depth must be from 0 to 62")
    ends = bin_ends(data, f, seed)
    one = data.groupBy(binned(F.col("raw"), ends).alias("cell"))
    cells = one.agg(F.xxhash64("cell").alias("hash"), F.count_if(F.col("target") != 1).alias("n0"), F.count_if(F.col("target") == 1).alias("n1"))
    cells = staged(cells.repartition(partitions or shuffle_partitions(data.sparkSession), "cell"), "cells")
    tops = split_tops(cells, f, trees, seed, max_depth, bound) if cells.count() > bound else [{} for _ in range(trees)]
    nodes, tops = join_leaves(staged(grow_subtrees(cells, f, trees, seed, max_depth, tops), "nodes"), tops)
    return ForestModel(nodes, ends, tops)


class ForestModel(Model, MLWritable, MLReadable):
    """A fitted forest: ``nodes`` (see NODE_KIND), the ends of the bins and the trees' first splits."""

    def __init__(self, nodes: DataFrame, ends: list[list[float]], tops: Tops):
        super().__init__()
        self.nodes, self.ends, self.tops = nodes, ends, tops

    def _transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability`` (of both classes) and ``prediction``; equal cells are scored once."""
        keyed = df.withColumn("_cell", binned(F.col("raw"), self.ends))
        scores = self._scores(keyed.select(F.col("_cell").alias("cell")).distinct())
        p = F.col("_p")
        out = keyed.join(scores.select(F.col("cell").alias("_cell"), p.alias("_p")), "_cell")
        return out.select(*df.columns, array_to_vector(F.array(1 - p, p)).alias("probability"), (p > 0.5).cast("double").alias("prediction"))

    def _scores(self, cells: DataFrame) -> DataFrame:
        """(cell, _p): mean share of the positive class in the leaves of all trees."""
        f, tops, parts = len(self.ends), self.tops, shuffle_partitions(cells.sparkSession)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, len(b), CHUNK_CELLS):
                    yield pa.record_batch({"cells": [b"".join(b["cell"][at : at + CHUNK_CELLS].to_pylist())]})

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for chunk, cells in zip(b["chunk"].to_pylist(), b["cells"].to_pylist(), strict=True):
                    x = matrix([cells], f)
                    for t, top in enumerate(tops):
                        at = routed(x, top)
                        nodes = np.unique(at)
                        rows = [np.flatnonzero(at == n).astype(np.int32) for n in nodes]
                        yield pa.record_batch({
                            "tree": pa.array([t] * len(nodes), pa.int32()), "node": pa.array(nodes), "chunk": pa.array([chunk] * len(nodes), pa.int64()),
                            "rows": [r.tobytes() for r in rows], "cells": [x[r].tobytes() for r in rows],
                        })

        def descend(left: pa.Table, right: pa.Table) -> pa.Table:
            if not right.num_rows:  # a tree whose sample is empty has no say
                left = left.slice(0, 0)
            out = {"chunk": left["chunk"], "tree": left["tree"], "rows": left["rows"]}
            feature, bin_, child, n0, n1 = (right[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("feature", "bin", "left", "n0", "n1"))
            share, shares = n1 / (n0 + n1), []
            for cells in left["cells"].to_pylist():
                x = matrix([cells], f)
                at = np.zeros(len(x), np.int64)
                on = np.flatnonzero(child[at] >= 0)
                while len(on):
                    i = at[on]
                    at[on] = child[i] + (x[on, feature[i]] > bin_[i])
                    on = on[child[at[on]] >= 0]
                shares.append(share[at].tobytes())
            return pa.table({**out, "shares": pa.array(shares, pa.binary())})

        def add(group: pa.Table) -> pa.Table:
            rows = sorted(zip(*(group[c].to_pylist() for c in ("tree", "rows", "shares")), strict=True), key=lambda r: r[0])
            cells = rows[0][2]  # the chunk itself stands as tree -1
            total, voters = np.zeros(len(cells) // f), len({r[0] for r in rows[1:]})
            for _, at, shares in rows[1:]:
                total[np.frombuffer(at, np.int32)] += np.frombuffer(shares, float)
            return pa.table({"cell": pa.array([cells[i : i + f] for i in range(0, len(cells), f)], pa.binary()), "_p": total / voters if voters else total + 0.5})

        chunks = staged(cells.repartition(parts, "cell").mapInArrow(pack, "cells binary").withColumn("chunk", F.monotonically_increasing_id()), "chunks")
        slices = -(-(chunks.agg(F.sum(F.octet_length("cells"))).first()[0] or 0) // (f * SLICE_CELLS)) or 1
        slice_ = F.pmod(F.xxhash64("chunk"), F.lit(slices)).alias("slice")
        keys = ["tree", "node", "slice"]
        left = chunks.mapInArrow(route, "tree int, node long, chunk long, rows binary, cells binary").select("*", slice_).repartition(parts, *keys)
        right = self.nodes.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<bigint>"))).repartition(parts, *keys)
        met = left.groupBy(*keys).cogroup(right.groupBy(*keys))
        shares = met.applyInArrow(descend, "chunk long, tree int, rows binary, shares binary")
        own = chunks.select("chunk", F.lit(-1).alias("tree"), F.lit(None).cast("binary").alias("rows"), F.col("cells").alias("shares"))
        return shares.unionByName(own).groupBy("chunk").applyInArrow(add, "cell binary, _p double")

    @property
    def toDebugString(self) -> str:  # noqa: N802
        """All trees as text, like that of Spark's forest; it reads them whole, so it is for small forests."""
        held = {(r.tree, r.node): r for r in self.nodes.toPandas().itertuples()}
        lines = [f"ForestModel (uid={self.uid}) with {len(self.tops)} trees"]

        def tell(t: int, node: int, i: int, depth: int) -> None:
            r = held.get((t, node))
            if node in self.tops[t]:
                (feature, bin_), below = self.tops[t][node], [(2 * node, 0), (2 * node + 1, 0)]
            elif r is None or r.left[i] < 0:
                lines.append(f"{'  ' * depth}Predict: {float(r is not None and r.n1[i] > r.n0[i])}")
                return
            else:
                (feature, bin_), below = (r.feature[i], r.bin[i]), [(node, r.left[i]), (node, r.left[i] + 1)]
            for sign, child in zip(("<=", ">"), below, strict=True):
                lines.append(f"{'  ' * depth}{'If' if sign == '<=' else 'Else'} (feature {feature} {sign} {self.ends[feature][bin_]})")
                tell(t, *child, depth + 1)

        for t in range(len(self.tops)):
            lines.append(f"  Tree {t}:")
            tell(t, 1, 0, 2)
        return "\n".join(lines)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802
        spark = self.model.nodes.sparkSession
        tops = [[[n, *split] for n, split in t.items()] for t in self.model.tops]
        DefaultParamsWriter.saveMetadata(self.model, path, spark, {"ends": self.model.ends, "tops": tops})
        self.model.nodes.write.parquet(f"{path}/nodes")


class _Reader(MLReader):
    def load(self, path: str) -> ForestModel:
        spark = SparkSession.active()
        meta = DefaultParamsReader.loadMetadata(path, spark)
        tops = [{n: (feature, bin_) for n, feature, bin_ in t} for t in meta["tops"]]
        model = ForestModel(spark.read.parquet(f"{path}/nodes"), meta["ends"], tops)
        model._resetUid(meta["uid"])
        return model
