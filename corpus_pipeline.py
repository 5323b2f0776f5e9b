"""A training corpus from documents: language, near duplicates, benchmark passages, source mix, shards.

Every stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes each as Parquet to the shared folder
and reads it again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.llm.decontaminate import decontaminate
from churnspark.llm.language import UNKNOWN, fit_language_model, predict_language
from churnspark.llm.mixing import mix_sources
from churnspark.llm.ngram_join import ngram_join
from churnspark.llm.sharding import shard_documents
from churnspark.session import staged

LEAST_KNOWN = 0.5  # share of a text's words that the language model has evidence of
LEAST_MARGIN = 1 / 15  # of the score over the even chance, as a share of what is above it: 0.3 with four languages
MOST_HIT = 0.0  # share of a document's words that may lie in benchmark passages


ROW, DIGEST, NUMBER = "row", "digest", "number"


def _held(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one, so that none of their names can clash with a stage's own."""
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias(ROW)


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as (row, digest, number), written once: a digest of all columns and a number that no two
    rows share.

    Ids may be null or repeated, so rows are told apart by these. Digests are the same in every run; the numbers
    tell rows apart that are equal in all columns, where it does not matter which is which.
    """
    values = [F.coalesce(F.md5(docs[f"`{c}`"].cast("string")), F.lit("")) for c in docs.columns]
    digest = F.md5(F.concat_ws(":", *values)).alias(DIGEST)
    return staged(docs.select(_held(docs), digest, F.monotonically_increasing_id().alias(NUMBER)), "keyed")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages.

    Those without letters, with evidence of less than half of their words, or without a likely language go; so do
    null and empty texts. With a single learned language the evidence alone decides. Rows with a null ``lang`` or a
    null id are judged like others. All columns come back as they were, whatever their names.
    """
    train = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2
    model = fit_language_model(docs.where(train))
    even = 1 / max(1, len(model.languages))
    rest = F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != "text"]).alias(ROW)
    found = predict_language(docs.select(rest, docs["text"]), model, share_col="known")
    likely = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= even + LEAST_MARGIN * (1 - even))
    back = [F.col("text") if c == "text" else F.col(f"{ROW}.`{c}`") for c in docs.columns]
    return found.where(likely & (F.col("known") >= LEAST_KNOWN)).select(*back)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest id, and of those the smallest digest.

    Near duplicates share at least 0.8 of their five-word n-grams (Jaccard). A null id comes last; rows that share
    an id are rows of their own. Rows without words are near duplicates only of rows equal in all columns. All
    columns come back as they were, whatever their names.
    """
    keyed = _keyed(docs)
    joined = ngram_join(keyed.select(NUMBER, f"{ROW}.text"), id_col=NUMBER, width=5, percent=80)
    found = keyed.select(NUMBER, DIGEST, f"{ROW}.doc_id").join(joined, NUMBER)
    alone = F.when(F.col("n_shingles") == 0, F.col(DIGEST))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", DIGEST, NUMBER)
    first = found.groupBy(alone, F.when(alone.isNull(), F.col("component_id"))).agg(F.min(order).alias("first"))
    return keyed.join(first.select(f"first.{NUMBER}"), NUMBER, "left_semi").select(f"{ROW}.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item; each row is judged by its own text, null and empty ones stay.

    All columns come back as they were, whatever their names.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    held = docs.select(_held(docs), F.md5(F.coalesce(docs["text"], F.lit(""))).alias("text_key"))
    found = decontaminate(held.select("text_key", f"{ROW}.text"), benchmark, id_col="text_key")
    clean = found.where(F.col("n_hit") <= MOST_HIT * F.col("n_words")).select("text_key").distinct()
    return held.join(clean, "text_key", "left_semi").select(f"{ROW}.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them: a row for each time.

    A null source is a source; texts without words are not taken. All columns come back as they were, whatever
    their names.
    """
    keyed = _keyed(docs)
    mixed = mix_sources(keyed.select(f"{ROW}.doc_id", f"{ROW}.source", f"{ROW}.text", DIGEST, NUMBER), also=(DIGEST, NUMBER))
    rows = keyed.join(mixed.where("times > 0").select(NUMBER, "times"), NUMBER)
    return rows.select(ROW, F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select(f"{ROW}.*")


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and slot (doc_id, size, text_crc32, law, shard, slot, grown_shard); null and repeated ids are
    rows like others, and other columns stay behind."""
    return shard_documents(docs)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# The language and sharding stages have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
