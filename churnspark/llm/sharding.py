"""Sharding of indivisible groups of documents by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.operators.ordering import with_row_number
from churnspark.session import staged

ROW_BYTES = 8  # every document costs so many bytes beside its text
BUNDLES_PER_SHARD = 256


def differencing(sizes: list[int], shards: int) -> list[int]:
    """The shard of each item, by largest differencing.

    Every item starts as a partial partition: its size in one shard, nothing in the others. The two partial
    partitions with the largest spread are combined, the largest shard of one with the smallest of the other,
    until one is left.
    """
    if not sizes:
        return []
    none = ()
    heap = []
    for i, size in enumerate(sizes):
        parts = [(size, (i,))] + [(0, none)] * (shards - 1)
        heapq.heappush(heap, (-size, i, parts))
    turn = len(sizes)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        # Members stay a tree of pairs until the end, so combining costs no copies.
        parts = [
            (a + b, x if not y else y if not x else (x, y)) for (a, x), (b, y) in zip(one, reversed(two), strict=True)
        ]
        parts.sort(key=lambda p: -p[0])
        heapq.heappush(heap, (parts[-1][0] - parts[0][0], turn, parts))
        turn += 1
    shard_of = [0] * len(sizes)
    for shard, (_, tree) in enumerate(heap[0][2]):
        open_trees = [tree]
        while open_trees:
            for x in open_trees.pop():
                if isinstance(x, int):
                    shard_of[x] = shard
                else:
                    open_trees.append(x)
    return shard_of


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return per row of ``docs`` (<id>, size, text_crc32, law, shard, slot, grown_shard).

    Law `bytes`: the shards hold nearly equal bytes (UTF-8 of the text plus 8 a row), and rows with equal text
    lie in one shard. ``slot`` numbers the rows of a shard from 0 without gaps, in order of id.

    Groups of equal texts are the indivisible items. A group of more than a bundle's share (total / (256 x
    shards)) is an item of its own: there are at most 256 x shards of these. All other groups are hashed into as
    many bundles. So the differencing sees at most 512 x shards items, each a whole number of groups, at any
    corpus size, and a group that holds a third of all bytes gets a shard with little else.

    A null text has no bytes and counts as an empty one. Rows equal in id and text share a shard and get
    different slots. A null id comes first. Extra columns are ignored, an empty table gives no rows.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = staged(
        docs.select(
            docs[id_col].alias("id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("group"),
        ),
        "sizes",
    )
    bundles = BUNDLES_PER_SHARD * shards
    groups = staged(rows.groupBy("group").agg(F.sum("size").alias("bytes")), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    alone = F.col("bytes") * bundles > F.lit(total)
    bundle = F.pmod(F.xxhash64("group"), F.lit(bundles)).cast("string")
    items = groups.groupBy(F.when(alone, F.col("group")).otherwise(bundle).alias("item")).agg(F.sum("bytes").alias("bytes"))

    def assign(table: pa.Table) -> pa.Table:
        order = table.sort_by([("bytes", "descending"), ("item", "ascending")])
        found = differencing(order["bytes"].to_pylist(), shards)
        return pa.table({"item": order["item"], "shard": pa.array(found, pa.int32())})

    # At most 2 x bundles rows.
    plan = staged(items.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(assign, "item string, shard int"), "plan")
    large = groups.where(alone).select(F.col("group").alias("large"))  # at most `bundles` rows
    placed = (
        rows.join(F.broadcast(large), F.col("group") == F.col("large"), "left")
        .withColumn("item", F.coalesce("large", bundle))
        .join(F.broadcast(plan), "item")
    )
    placed = placed.select("id", "size", "text_crc32", "group", "shard")
    numbered = with_row_number(placed, ["id", "group"], by=["shard"], name="slot", start=0)
    return numbered.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
