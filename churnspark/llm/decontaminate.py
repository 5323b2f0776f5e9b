"""Benchmark decontamination: a prefix-filtered set join, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.session import staged

BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # what separates words, with A-Z still in place
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_BYTES = 32 << 20


def item_words(text: Column) -> Column:
    """Words of the text with A-Z in lower case; other letters stay as they are. A null text has none."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)  # ASCII only: lower() changes A-Z alone
    return F.array_remove(F.split(F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER)), BETWEEN), "")


def _fits(df: DataFrame, texts: Column) -> bool:
    """Whether the texts of ``df``, measured, are small enough to broadcast."""
    return (df.agg(F.sum(texts + 64)).first()[0] or 0) <= BROADCAST_BYTES


def _measured(df: DataFrame, texts: Column) -> DataFrame:
    """Hint a broadcast if the texts of ``df`` fit the limit; else leave the join to Spark."""
    return F.broadcast(df) if _fits(df, texts) else df


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = 10,
) -> DataFrame:
    """Return per row of ``docs`` (<id>, n_words, n_hit, n_items, items, contaminated).

    A window is ``width`` consecutive words of an item; an item of fewer words, but not none, is one window.
    ``n_hit`` counts the words inside any occurrence of a window, ``items`` lists the items found, sorted as
    texts and joined by commas.

    Words of the windows are ordered by their frequency in all documents. A text that contains a window
    contains its rarest word, so that word alone, with its place in the window, joins the documents (the
    necessary prefix of a full containment); where the window would not fit into the text around the word the
    pair is dropped (length and position), and the rest is compared word by word.

    A null or empty text has no words and no hits; an item without words is never found. Rows that agree in id
    and text get equal results, one each. Extra columns are ignored. Empty tables give no rows, or no hits.
    """
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    texts = texts.select("id", F.xxhash64("text").alias("text_key"), item_words(F.col("text")).alias("words"))
    items = benchmark.select(
        benchmark[item_col].cast("string").alias("item"), item_words(benchmark[item_text_col]).alias("words")
    ).where(F.size("words") > 0)

    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - width + 1, F.lit(1)))
    windows = items.select("item", "words", F.explode(starts).alias("at"))
    windows = windows.select("item", F.slice("words", F.col("at"), width).alias("window")).distinct()
    windows = windows.select("item", "window", F.xxhash64("window").alias("window_key"))
    distinct = windows.groupBy("window_key", "window").agg(F.lit(1).alias("one")).drop("one")

    # Rarity: how often each word of a window occurs in all documents.
    vocabulary = distinct.select(F.explode("window").alias("word")).distinct()
    vocabulary = _measured(vocabulary, F.octet_length("word"))
    counted = texts.select(F.explode("words").alias("word")).join(vocabulary, "word", "left_semi").groupBy("word").count()
    places = distinct.select("window_key", "window", F.posexplode("window").alias("place", "word"))
    rarity = places.join(counted, "word", "left").select(
        "window_key", "window", "place", "word", F.coalesce("count", F.lit(0)).alias("n")
    )
    # A window with a word that no document has cannot occur.
    prefix = rarity.groupBy("window_key", "window").agg(F.min(F.struct("n", "word", "place")).alias("rarest"))
    prefix = prefix.where("rarest.n > 0").select(
        F.col("rarest.word").alias("prefix"), F.col("rarest.place").alias("place"), "window_key", "window"
    )
    prefix = staged(prefix, "prefix")

    begin = F.col("at") - F.col("place")
    size = F.size("window")
    fitting = (F.col("word") == F.col("prefix")) & (begin >= 0) & (begin + size <= F.col("n"))
    same = F.slice("words", F.greatest(begin + 1, F.lit(1)), size) == F.col("window")
    spread = texts.select("id", "text_key", "words", F.size("words").alias("n"), F.posexplode("words").alias("at", "word"))
    if _fits(prefix, F.octet_length(F.array_join("window", " "))):
        found = spread.join(F.broadcast(prefix), fitting & same)
    else:  # single words meet the windows; the text comes back only for the pairs that are left
        pairs = spread.drop("words").join(prefix, fitting).withColumnsRenamed({"id": "pair_id", "text_key": "pair_key"})
        whole = texts.distinct()
        found = pairs.join(whole, F.col("id").eqNullSafe(F.col("pair_id")) & (F.col("text_key") == F.col("pair_key")) & same)
    found = found.select("id", "text_key", begin.alias("begin"), size.alias("size"), "window_key")

    # Words covered by the occurrences: a running maximum of their ends merges overlaps.
    runs = found.groupBy("id", "text_key", "begin").agg(F.max(F.col("begin") + F.col("size")).alias("end"))
    earlier = Window.partitionBy("id", "text_key").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("reached", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    fresh = F.greatest(F.col("end") - F.greatest("begin", "reached"), F.lit(0))
    hits = runs.groupBy("id", "text_key").agg(F.sum(fresh).alias("n_hit"))

    named = windows.select("window_key", "item")
    named = _measured(named, F.octet_length("item"))
    per_item = found.select("id", "text_key", "window_key").distinct().join(named, "window_key").select("id", "text_key", "item")
    per_item = per_item.distinct().groupBy("id", "text_key").agg(F.sort_array(F.collect_list("item")).alias("items"))

    result = texts.select("id", "text_key", F.size("words").cast("long").alias("n_words"))
    for part, name in ((hits, "h"), (per_item, "p")):
        part = part.select(F.col("id").alias(f"{name}_id"), F.col("text_key").alias(f"{name}_key"), part.columns[-1])
        result = result.join(
            part, F.col("id").eqNullSafe(F.col(f"{name}_id")) & (F.col("text_key") == F.col(f"{name}_key")), "left"
        )
    return result.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.array_join("items", ","), F.lit("")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )
