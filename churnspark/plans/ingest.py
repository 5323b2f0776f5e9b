"""Queries over scans, sinks, the catalog and the metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.functions.columns import ts_to_ms
from churnspark.plans.frames import CALL_MS, CHURN_CTE, CLEAN_CTE, LOG_CTE, NUMERIC, call_ms, churn_frame, clean_churn, inference_log, planted_probability, PLANTED_SQL, table
from churnspark.plans.registry import query
from churnspark.session import scratch_path, staged, work_table
from churnspark.sources import metrics as M
from churnspark.sources import tables as T

CHURN_COLUMNS = "customer_id, segment, region, senior, last_priority, tenure, monthly_charges, total_charges, churn, churn_planted"
CHURN_ALL = f"with {CHURN_CTE} select {CHURN_COLUMNS} from churn"

# Raw customers with blanks, NA and unreadable numbers put in by rule, as text, the way a raw file holds them.
_RAW_SQL = """
  select cast(c_custkey as varchar) as customer_id,
    case when c_custkey % 7 = 0 then ' ' when c_custkey % 11 = 0 then '  ' when c_custkey % 13 = 0 then 'NA' else c_mktsegment end as segment,
    case when c_custkey % 5 = 0 then 'x1' when c_custkey % 17 = 0 then ' ' when c_custkey % 19 = 0 then 'NA' else cast(c_acctbal as varchar) end as balance
  from customer"""


def raw_customers(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key.cast("string").alias("customer_id"),
        F.when(key % 7 == 0, " ").when(key % 11 == 0, "  ").when(key % 13 == 0, "NA").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(key % 5 == 0, "x1").when(key % 17 == 0, " ").when(key % 19 == 0, "NA").otherwise(F.col("c_acctbal").cast("string")).alias("balance"),
    )


@query(
    f"""with raw as ({_RAW_SQL})
    select customer_id, nullif(segment, 'NA') as segment, try_cast(nullif(trim(balance), '') as double) as balance from raw"""
)
def scan_csv_schema(spark, sf):
    path = scratch_path(spark, "csv")
    T.write_csv(raw_customers(spark, sf), path)
    return T.read_customers(spark, path, "customer_id string, segment string, balance double")


@query(CHURN_ALL)
def scan_table(spark, sf):
    name = work_table(spark, "scan")
    T.replace_table(churn_frame(spark, sf), name)
    return T.read_table(spark, name)


@query(
    f"""with {CHURN_CTE}
    select 'missing' as source, {CHURN_COLUMNS} from churn union all
    select 'empty' as source, {CHURN_COLUMNS} from churn union all
    select 'filled' as source, {CHURN_COLUMNS} from churn"""
)
def scan_fallback(spark, sf):
    """A missing table and an empty one fall back to the file; a filled one is read."""
    frame = staged(churn_frame(spark, sf))
    path = scratch_path(spark, "csv")
    T.write_csv(frame, path)
    missing, empty, filled = (work_table(spark, n) for n in ("missing", "empty", "filled"))
    T.replace_table(frame.limit(0), empty)
    T.replace_table(frame, filled)
    parts = [
        T.read_with_fallback(spark, t, path, frame.schema).select(F.lit(s).alias("source"), "*")
        for s, t in (("missing", missing), ("empty", empty), ("filled", filled))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(CHURN_ALL)
def sink_csv(spark, sf):
    frame = churn_frame(spark, sf)
    path = scratch_path(spark, "csv")
    T.write_csv(frame, path)
    return T.read_customers(spark, path, frame.schema)


@query(CHURN_ALL)
def sink_table_if_absent(spark, sf):
    """The second write finds the name taken and changes nothing."""
    frame, name = churn_frame(spark, sf), work_table(spark, "once")
    T.create_table_once(frame, name)
    T.create_table_once(frame.filter("churn = 'Yes'"), name)
    return spark.table(name)


@query(f"with {CHURN_CTE} select {CHURN_COLUMNS} from churn where churn = 'Yes'")
def sink_table_overwrite(spark, sf):
    frame, name = churn_frame(spark, sf), work_table(spark, "replace")
    T.replace_table(frame, name)
    T.replace_table(frame.filter("churn = 'Yes'"), name)
    return spark.table(name)


@query()
def catalog_describe(spark, sf):
    name = work_table(spark, "described")
    T.replace_table(churn_frame(spark, sf), name)
    return T.describe(spark, name)


@query(f"with {CHURN_CTE} select segment, region, count(*) as n from churn group by segment, region")
def register_view(spark, sf):
    T.register(churn_frame(spark, sf), "churn_view")
    return spark.sql("SELECT segment, region, count(*) AS n FROM churn_view GROUP BY segment, region")


_ROUNDED = {"tenure": 6, "monthly_charges": 2, "total_charges": 2}
_RECORD = ["customer_id", "segment", "region", "senior", "last_priority", "tenure", "monthly_charges", "total_charges", "churn", "churn_planted"]


@query(
    f"""with {CHURN_CTE} select customer_id, cast(to_json({{{", ".join(f"'{c}': {f'round({c}, {_ROUNDED[c]})' if c in _ROUNDED else c}" for c in _RECORD)}}}) as varchar) as record from churn"""
)
def rows_to_json(spark, sf):
    """Rows to JSON records, the text itself: every field, absent ones as null."""
    fields = churn_frame(spark, sf).select(*[(F.round(c, _ROUNDED[c]) if c in _ROUNDED else F.col(c)).alias(c) for c in _RECORD])
    return T.to_json_records(fields, keep=["customer_id"])


METRICS_SCHEMA = "metrics struct<probability: double, input_data: struct<k: bigint>>, uuid string"


def flat_metrics(spark, sf) -> DataFrame:
    log = inference_log(spark, sf).select("deployment", F.col("start_ms"), F.col("end_ms"), "metrics_json")
    return M.flatten(M.parse_metrics(log, "metrics_json", METRICS_SCHEMA))


@query(
    f"""with {LOG_CTE} select deployment, start_ms, end_ms, uuid, probability as "metrics.probability",
    input_k as "metrics.input_data.k" from log"""
)
def json_flatten(spark, sf):
    return flat_metrics(spark, sf)


_WHEN = "case when event_id % 50 <> 0 then {} end"


@query(
    f"""with {LOG_CTE} select deployment, start_ms, end_ms, {_WHEN.format("uuid")} as uuid, {_WHEN.format("probability")} as "metrics.probability",
    {_WHEN.format("input_k")} as "metrics.input_data.k",
    case when event_id % 4 = 1 and event_id % 50 <> 0 then 'z' || event_id % 3 end as "metrics.zone.name",
    case when event_id % 4 = 1 and event_id % 50 <> 0 then event_id % 8 / 4e0 end as "metrics.zone.cost",
    case when event_id % 4 = 2 and event_id % 50 <> 0 then event_id % 5 end as "metrics.retries", cast(null as varchar) as "metrics.note",
    case when event_id % 50 = 0 then 'cut off {{' end as unreadable from log"""
)
def json_flatten_open(spark, sf):
    """Metrics whose keys no schema declares: rows differ in their keys, some texts are cut off."""
    log, k = inference_log(spark, sf), F.col("event_id")
    some = F.when(k % 4 == 1, F.format_string(', "zone": {"name": "z%d", "cost": %s}', k % 3, (k % 8 / 4).cast("string")))
    some = some.when(k % 4 == 2, F.format_string(', "retries": %d', k % 5)).when(k % 4 == 3, ', "note": null').otherwise("")
    text = F.concat(F.substring_index("metrics_json", "}}", 1), F.lit("}"), some, F.lit("}"), F.substring_index("metrics_json", "}}", -1))
    text = F.when(k % 50 == 0, "cut off {").otherwise(text)
    return M.flatten_json(log.select("deployment", "start_ms", "end_ms", text.alias("metrics_json")), "metrics_json")


def _metric_interval(spark, sf):
    """The middle half of the log's time span, in whole milliseconds."""
    r = table(spark, sf, "events").agg(F.min(ts_to_ms("ts")).alias("a"), F.max(ts_to_ms("ts")).alias("b")).first()
    quarter = (r["b"] - r["a"]) // 4
    return r["a"] + quarter, r["b"] - quarter


@query(
    f"""with {LOG_CTE}, span as (select min(start_ms) as a, max(start_ms) as b from log)
    select uuid, deployment, start_ms, end_ms, probability from log, span
    where deployment = 'dep-1' and start_ms between a + (b - a) // 4 and b - (b - a) // 4"""
)
def read_metrics(spark, sf):
    """Metrics of one deployment in an interval; only the partitions of that deployment and those days are read."""
    name = work_table(spark, "metrics")
    M.append_inference_log(inference_log(spark, sf).select("uuid", F.lit("churn").alias("model"), "deployment", "start_ms", "end_ms", "probability"), name)
    lo, hi = _metric_interval(spark, sf)
    return M.read_metrics(spark, name, "churn", "dep-1", lo, hi).select("uuid", "deployment", "start_ms", "end_ms", "probability")


@query(
    f"""with {LOG_CTE} select deployment, start_ms, end_ms, uuid, probability as "metrics.probability",
    input_k as "metrics.input_data.k" from log"""
)
def sink_metrics_once(spark, sf):
    flat, name = flat_metrics(spark, sf), work_table(spark, "flat")
    M.export_once(flat, name)
    M.export_once(flat.filter("deployment = 'dep-0'"), name)
    return spark.table(name)


@query(
    f"""with {CLEAN_CTE} select md5('["churn","' || customer_id || '","' || {CALL_MS} || '"]') as uuid, 'churn' as model,
    'dep-' || cast(cast(customer_id as bigint) % 3 as varchar) as deployment, customer_id, {CALL_MS} as start_ms, {CALL_MS} + 250 as end_ms,
    segment, region, senior, last_priority, round(tenure, 6) as tenure, round(monthly_charges, 6) as monthly_charges,
    round(total_charges, 6) as total_charges, round({PLANTED_SQL}, 9) as probability,
    1.6e0 * cast(segment = 'BUILDING' as double) as segment_weight from clean"""
)
def track_predictions(spark, sf):
    """Predictions logged with id, times, all inputs, probability and explanation, and read back."""
    name = work_table(spark, "tracked")
    fields = ["segment", "region", "senior", "last_priority", "tenure", "monthly_charges", "total_charges"]
    scored = clean_churn(spark, sf).select(
        "customer_id",
        call_ms().alias("start_ms"),
        (call_ms() + 250).alias("end_ms"),
        F.struct(*fields).alias("input"),
        F.create_map(F.lit("segment"), 1.6 * (F.col("segment") == "BUILDING").cast("double")).alias("explanation"),
        F.round(planted_probability(), 9).alias("probability"),
        F.concat(F.lit("dep-"), (F.col("customer_id").cast("long") % 3).cast("string")).alias("deployment"),
    )
    scored = scored.withColumn("model", F.lit("churn")).withColumn("uuid", M.prediction_uuid("churn", "customer_id", "start_ms"))
    M.append_inference_log(scored, name)
    rounded = [F.round(f"input.{c}", 6).alias(c) if c in NUMERIC else F.col(f"input.{c}").alias(c) for c in fields]
    told = ["uuid", "model", "deployment", "customer_id", "start_ms", "end_ms", *rounded, "probability"]
    return spark.table(name).select(*told, F.col("explanation")["segment"].alias("segment_weight"))


@query(
    f"""with {LOG_CTE} select deployment, round(avg(cast((probability >= 0.5) = (label_raw = 'Yes') as double)), 9) as accuracy,
    min(start_ms) as start_ms, max(start_ms) as end_ms, 'accuracy' as metric from log group by deployment"""
)
def track_aggregate(spark, sf):
    name = work_table(spark, "aggregates")
    per = inference_log(spark, sf).groupBy("deployment").agg(
        F.round(F.avg(((F.col("probability") >= 0.5) == (F.col("label_raw") == "Yes")).cast("double")), 9).alias("accuracy"),
        F.min("start_ms").alias("start_ms"),
        F.max("start_ms").alias("end_ms"),
    )
    M.append_aggregate(per.withColumn("metric", F.lit("accuracy")), name)
    return spark.table(name).drop("day")


@query(
    f"""with {CLEAN_CTE} select 'run-1' as run_id, 'positive_share' as metric,
    round(avg(cast(churn_planted = 'Yes' as double)), 2) as value from clean"""
)
def track_run_metrics(spark, sf):
    name = work_table(spark, "runs")
    share = clean_churn(spark, sf).agg(F.avg((F.col("churn_planted") == "Yes").cast("double")).alias("s")).first()["s"]
    M.append_run_metrics(spark, name, "run-1", {"positive_share": share})
    return spark.table(name)


@query(
    f"""with {CHURN_CTE} select 'churn' as model, true as named, 'train' as job, count(*) as n_rows,
    count(*) filter (where churn = 'Yes') as n_churned from churn"""
)
def lineage_record(spark, sf):
    """Lineage of a training table, and what the recorded query reads."""
    source, name = work_table(spark, "training"), work_table(spark, "lineage")
    T.replace_table(churn_frame(spark, sf), source)
    M.record_lineage(spark, name, "churn", source, f"SELECT * FROM {source}", "train")
    record = spark.table(name).first()
    held = spark.sql(record["source_query"]).agg(F.count("*").alias("n_rows"), F.count_if(F.col("churn") == "Yes").alias("n_churned"))
    return held.select(
        F.lit(record["model"]).alias("model"), F.lit(record["source_table"] == source).alias("named"), F.lit(record["job"]).alias("job"), "n_rows", "n_churned"
    )
