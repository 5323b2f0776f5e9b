"""Inference log, run metrics, aggregate metrics and lineage as append tables; reading and flattening them."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.functions.columns import now_ms
from churnspark.sources.tables import append_table

DAY_MS = 86_400_000
METRIC_LAYOUT = ("deployment", "day")


def prediction_uuid(model: str, *keys) -> Column:
    """Stable id of one prediction: the same model, keys and time always give the same id.

    The keys (with the request's time among them) are hashed as a JSON list, so neither a null nor a
    separator inside a key makes two lists equal.
    """
    return F.md5(F.to_json(F.array(F.lit(model), *[F.col(k).cast("string") for k in keys])))


def with_day(df: DataFrame, start_ms: str = "start_ms") -> DataFrame:
    """Add the epoch day used as partition column (independent of the session time zone)."""
    return df.withColumn("day", F.floor(F.col(start_ms) / F.lit(DAY_MS)).cast("int"))


def append_inference_log(scored: DataFrame, table: str) -> None:
    """Append scored rows (uuid, model, deployment, start_ms, end_ms, input, probability, explanation)."""
    append_table(with_day(scored), table, METRIC_LAYOUT)


def append_run_metrics(spark: SparkSession, table: str, run_id: str, metrics: Mapping[str, float]) -> None:
    """Append one row per named metric of a training run, rounded to two places."""
    rows = [(run_id, k, round(float(v), 2)) for k, v in metrics.items()]
    append_table(spark.createDataFrame(rows, "run_id string, metric string, value double"), table)


def append_aggregate(df: DataFrame, table: str) -> None:
    """Append aggregate metrics with their interval and deployment (deployment, start_ms, end_ms, ...)."""
    append_table(with_day(df), table, METRIC_LAYOUT)


def record_lineage(spark: SparkSession, table: str, model: str, source_table: str, source_query: str, job: str) -> None:
    """Append which table, query and job a model was trained from."""
    row = spark.createDataFrame(
        [(model, source_table, source_query, job)], "model string, source_table string, source_query string, job string"
    )
    append_table(row.withColumn("recorded_ms", now_ms()), table)


def read_metrics(
    spark: SparkSession, table: str, model: str | None = None, deployment: str | None = None,
    start_ms: int | None = None, end_ms: int | None = None,
) -> DataFrame:
    """Metrics of a model and deployment that started in [start_ms, end_ms]; open ends mean 0 and now.

    The interval is also put on the ``day`` partition column, so only the days asked for are read.
    """
    df = spark.table(table)
    lo = 0 if start_ms is None else start_ms
    hi = now_ms() if end_ms is None else F.lit(end_ms)
    if model is not None:
        df = df.filter(F.col("model") == model)
    if deployment is not None:
        df = df.filter(F.col("deployment") == deployment)
    if "day" in df.columns:
        df = df.filter((F.col("day") >= lo // DAY_MS) & (F.col("day") <= F.floor(hi / F.lit(DAY_MS))))
    return df.filter((F.col("start_ms") >= lo) & (F.col("start_ms") <= hi))


def export_once(df: DataFrame, table: str) -> None:
    """Write the flattened metrics unless the target is already there."""
    df.write.format("parquet").mode("ignore").saveAsTable(table)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs as columns named by their path; arrays and maps stay whole."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for f in schema.fields:
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, (*path, f.name))
            else:
                yield (*path, f.name)

    return df.select(
        *[F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)) for path in leaves(df.schema, ())]
    )


def parse_metrics(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Replace a JSON text column by the fields of its declared schema."""
    others = [c for c in df.columns if c != column]
    return df.withColumn("_j", F.from_json(column, schema)).select(*others, "_j.*")


_TYPE = re.compile(r"`(?:[^`]|``)*`|OBJECT<>|OBJECT<|VOID(?!:)|DECIMAL\(\d+, ?\d+\)")
_AS_COLUMN = {"OBJECT<": "STRUCT<", "OBJECT<>": "VARIANT", "VOID": "STRING"}  # an empty object has no columns, a key that is always null no type


def json_schema(df: DataFrame, column: str) -> str:
    """One type, as DDL text, that holds the JSON texts of all rows: the union of their keys at every level.

    Numbers that are not all whole become DOUBLE, a key with values of different kinds VARIANT. The types of the rows
    are merged by an aggregation; only the merged one, which grows with the number of distinct keys, is returned.
    """
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(column))).first()[0]
    return _TYPE.sub(lambda m: _AS_COLUMN.get(m[0], m[0] if m[0][0] == "`" else "DOUBLE"), found)


def flatten_json(df: DataFrame, column: str, sep: str = ".", unreadable: str = "unreadable") -> DataFrame:
    """Replace a JSON text column by a column for every key path that occurs in any row, whatever keys the rows have.

    A row without a key gets a null there. Arrays stay whole; values of different kinds under one key come as JSON
    text. A text that is no JSON object goes to the column ``unreadable`` and has nulls in the others. Keys that
    differ only in upper and lower case need ``spark.sql.caseSensitive``.
    """
    parsed = F.try_parse_json(column)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    known = df.withColumn("_variant", F.when(is_object, parsed))
    kind = json_schema(known.select(F.when(is_object, F.col(column)).alias(column)), column)
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    bad = F.when(F.col("_variant").isNull(), F.col(column)).alias(unreadable)
    if not kind.startswith("STRUCT<"):
        return known.select(*others, bad)
    opened = known.select(*others, F.try_variant_get("_variant", "$", kind).alias("_json"), bad)
    flat = flatten(opened.select(*others, "_json.*", unreadable), sep)
    texts = {f.name: F.to_json(f"`{f.name}`") for f in flat.schema.fields if isinstance(f.dataType, T.VariantType)}
    return flat.withColumns(texts) if texts else flat
