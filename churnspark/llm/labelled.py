"""Bounded draws of labelled texts, the same in every run and at every layout of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnspark.session import broadcast_if_small, staged


def draw_labelled(
    docs: DataFrame, label_col: str, each: int, text_col: str = "text", labels: DataFrame | None = None, id_col: str = "doc_id"
) -> DataFrame:
    """At most ``each`` distinct texts of every label, by hash rank: rows (label, text, of).

    ``of`` is how many distinct texts the label has. The label is a column of ``docs`` or, joined by ``id_col``, of
    ``labels``. Only hashes of texts meet the labels and are ranked, no more than ``each`` of a label from any task;
    copies of a text count once, so that neither copies nor a frequent label crowd out the rest. Texts are then
    picked out by hash where they lie. Rows with a null text or label are left out.
    """
    keyed = docs.where(docs[text_col].isNotNull())
    key = F.xxhash64(keyed[text_col]).alias("key")
    if labels is None:
        known = keyed.select(key, keyed[label_col].alias("label"))
    else:
        known = keyed.select(keyed[id_col].alias("id"), key).join(labels.select(labels[id_col].alias("id"), labels[label_col].alias("label")), "id")
    distinct = staged(known.where("label IS NOT NULL").groupBy("label", "key").count().drop("count"), "labelled")
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("key", F.lit(1)), "key"))
    drawn = distinct.withColumn("rank", rank).where(F.col("rank") <= each).drop("rank")
    drawn = staged(drawn.join(distinct.groupBy("label").agg(F.count("*").alias("of")), "label"), "drawn")
    texts = keyed.select(key, keyed[text_col].alias("text")).join(broadcast_if_small(drawn), "key")
    return texts.groupBy("label", "key", "of").agg(F.first("text").alias("text")).select("label", "text", "of")
