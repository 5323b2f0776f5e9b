"""Input frames that the queries share, derived from the given tables, and the same frames as SQL CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.functions.columns import hash_uniform, ts_to_ms

CUTOFF = "2000-08-01"

CATEGORICAL = ["segment", "region", "senior", "last_priority"]
NUMERIC = ["tenure", "monthly_charges", "total_charges"]
FEATURES = CATEGORICAL + NUMERIC


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def churn_frame(spark: SparkSession, sf: str) -> DataFrame:
    """One row per customer: features from the orders before the cutoff, label from the orders after it.

    Money is summed in whole cents, so sums and rounded means do not depend on the order of addition.
    """
    before = F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz")
    orders = (
        table(spark, sf, "orders")
        .withColumn("early", before)
        .groupBy("o_custkey")
        .agg(
            F.expr("max_by(o_orderpriority, o_orderkey) filter (where early)").alias("last_priority"),
            F.expr("datediff(max(o_orderdate) filter (where early), min(o_orderdate) filter (where early)) / 30.0D").alias("tenure"),
            F.expr("sum(bigint(round(o_totalprice * 100))) filter (where early)").alias("cents"),
            F.count_if("early").alias("n_early"),
            F.count_if(~F.col("early")).alias("n_late"),
        )
    )
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    place = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    frame = (
        table(spark, sf, "customer")
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("c_mktsegment").alias("segment"),
            F.col("r_name").alias("region"),
            F.when(F.col("c_acctbal") < 0, "1").otherwise("0").alias("senior"),
            "last_priority",
            "tenure",
            F.expr("((2 * cents + n_early) div (2 * n_early)) / 100.0D").alias("monthly_charges"),
            F.expr("cents / 100.0D").alias("total_charges"),
            F.when(F.coalesce("n_early", F.lit(0)) == 0, F.lit(None).cast("string"))
            .when(F.col("n_late") == 0, "Yes")
            .otherwise("No")
            .alias("churn"),
        )
    )
    chance = F.lit(1.0) / (F.lit(1.0) + F.exp(-planted_score()))
    return frame.withColumn(
        "churn_planted",
        F.when(chance.isNull(), F.lit(None).cast("string"))
        .when(hash_uniform("planted", "customer_id") < chance, "Yes")
        .otherwise("No"),
    )


def planted_score():
    """The known logistic score behind ``churn_planted``; also the fixed-coefficient model of the checks."""
    return (
        F.lit(-1.3)
        + F.lit(1.6) * (F.col("segment") == "BUILDING").cast("double")
        + F.lit(1.0) * F.col("senior").isin("1", "Yes").cast("double")
        - F.lit(0.12) * (F.col("tenure") - 52.0)
        + F.lit(0.000004) * (F.col("monthly_charges") - 250000.0)
    )


def planted_probability():
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-planted_score()))


PLANTED_SCORE_SQL = """(-1.3e0 + 1.6e0 * cast(segment = 'BUILDING' as double)
    + 1.0e0 * cast(senior in ('1', 'Yes') as double)
    - 0.12e0 * (tenure - 52.0e0) + 0.000004e0 * (monthly_charges - 250000.0e0))"""
PLANTED_SQL = f"(1e0 / (1e0 + exp(-{PLANTED_SCORE_SQL})))"


def uniform_sql(seed, key: str) -> str:
    return f"(cast('0x' || substr(md5('{seed}:' || {key}), 1, 8) as bigint) / 4294967296e0)"


CHURN_CTE = f"""
churn_orders as (
  select o_custkey,
    max_by(o_orderpriority, o_orderkey) filter (where o_orderdate < timestamp '{CUTOFF}') as last_priority,
    date_diff('day', min(o_orderdate) filter (where o_orderdate < timestamp '{CUTOFF}'),
      max(o_orderdate) filter (where o_orderdate < timestamp '{CUTOFF}')) / 30e0 as tenure,
    cast(sum(cast(round(o_totalprice * 100) as bigint)) filter (where o_orderdate < timestamp '{CUTOFF}') as bigint) as cents,
    count(*) filter (where o_orderdate < timestamp '{CUTOFF}') as n_early,
    count(*) filter (where o_orderdate >= timestamp '{CUTOFF}') as n_late
  from orders group by o_custkey),
churn_base as (
  select cast(c_custkey as varchar) as customer_id, c_mktsegment as segment, r_name as region,
    case when c_acctbal < 0 then '1' else '0' end as senior,
    last_priority, tenure, ((2 * cents + n_early) // (2 * n_early)) / 100e0 as monthly_charges, cents / 100e0 as total_charges,
    case when coalesce(n_early, 0) = 0 then null when n_late = 0 then 'Yes' else 'No' end as churn
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    left join churn_orders on o_custkey = c_custkey),
churn as (
  select *, case when {PLANTED_SQL} is null then null
      when {uniform_sql('planted', 'customer_id')} < {PLANTED_SQL} then 'Yes' else 'No' end as churn_planted
  from churn_base)
"""


def clean_churn(spark: SparkSession, sf: str) -> DataFrame:
    """The training rows: complete, with the senior flag as Yes/No."""
    return churn_frame(spark, sf).dropna("any").replace({"1": "Yes", "0": "No"}, subset=["senior"])


CLEAN_CTE = f"""{CHURN_CTE},
clean as (
  select customer_id, segment, region, case senior when '1' then 'Yes' when '0' then 'No' else senior end as senior,
    last_priority, tenure, monthly_charges, total_charges, churn, churn_planted
  from churn
  where customer_id is not null and segment is not null and region is not null and senior is not null
    and last_priority is not null and tenure is not null and monthly_charges is not null
    and total_charges is not null and churn is not null and churn_planted is not null)
"""


def request_frame(clean: DataFrame) -> DataFrame:
    """Scoring requests: complete customers with some fields left out by rule."""
    key = F.col("customer_id").cast("long")
    return clean.select(
        "customer_id",
        F.when(key % 3 != 0, F.col("segment")).alias("segment"),
        "region",
        "senior",
        "last_priority",
        F.when(key % 4 != 0, F.col("tenure")).alias("tenure"),
        "monthly_charges",
        "total_charges",
    )


def call_ms():
    """When a customer's scoring call came in, by rule: on one of ten days, at a second of their own."""
    key = F.col("customer_id").cast("long")
    return F.lit(1_700_000_000_000) + (key % 10) * 86_400_000 + key * 1000


CALL_MS = "(1700000000000 + (cast(customer_id as bigint) % 10) * 86400000 + cast(customer_id as bigint) * 1000)"


REQUEST_CTE = f"""{CLEAN_CTE},
requests as (
  select customer_id, case when cast(customer_id as bigint) % 3 <> 0 then segment end as segment, region, senior,
    last_priority, case when cast(customer_id as bigint) % 4 <> 0 then tenure end as tenure,
    monthly_charges, total_charges
  from clean)
"""


def inference_log(spark: SparkSession, sf: str) -> DataFrame:
    """One row per scored call, from the event table, with the raw label that arrives later."""
    return inference_columns(table(spark, sf, "events"))


def inference_columns(events: DataFrame) -> DataFrame:
    start = ts_to_ms("ts")
    return events.select(
        F.concat(F.lit("p"), F.col("event_id").cast("string")).alias("uuid"),
        F.concat(F.lit("dep-"), (F.col("user_id") % 3).cast("string")).alias("deployment"),
        "event_id",
        "ts",
        start.alias("start_ms"),
        (start + F.col("event_id") % 3000).alias("end_ms"),
        F.least(F.lit(1.0), F.col("value") / 100).alias("probability"),
        F.when(F.col("event_type").isin("purchase", "signup"), "Yes").otherwise("No").alias("label_raw"),
        F.when(
            F.col("event_type") != "error",
            F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") % 72).cast("int")),
        ).alias("label_ts"),
        F.format_string(
            '{"metrics":{"probability":%s,"input_data":%s},"uuid":"p%d"}',
            F.least(F.lit(1.0), F.col("value") / 100).cast("string"),
            F.col("props"),
            F.col("event_id"),
        ).alias("metrics_json"),
    )


LOG_CTE = """
log as (
  select 'p' || cast(event_id as varchar) as uuid, 'dep-' || cast(user_id % 3 as varchar) as deployment, event_id, ts,
    epoch_us(ts) // 1000 as start_ms, epoch_us(ts) // 1000 + event_id % 3000 as end_ms,
    least(1e0, value / 100) as probability,
    case when event_type in ('purchase', 'signup') then 'Yes' else 'No' end as label_raw,
    case when event_type <> 'error' then ts + to_hours(cast(event_id % 72 as integer)) end as label_ts,
    cast(json_extract_string(props, '$.k') as bigint) as input_k
  from events)
"""


def labelled_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a label where known, a score and the score's decision."""
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("n_chars") - 1000) / F.lit(500.0)))
    return (
        table(spark, sf, "documents")
        .select("doc_id", "lang", "source", "n_chars")
        .join(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y")), "doc_id", "left")
        .withColumn("score", score)
        .withColumn("yhat", (F.col("score") >= 0.5).cast("int"))
    )


SCORES_CTE = """
scores as (
  select d.doc_id, d.lang, d.source, d.n_chars, l.quality as y,
    1e0 / (1e0 + exp(-(n_chars - 1000) / 500e0)) as score,
    cast(1e0 / (1e0 + exp(-(n_chars - 1000) / 500e0)) >= 0.5 as integer) as yhat
  from documents d left join labels l on d.doc_id = l.doc_id)
"""


def registry_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(models, builds, deployments) from nation, supplier and customer; a higher id is later."""
    models = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("model_id"), F.col("n_name").alias("model_name"))
    suppliers = table(spark, sf, "supplier")
    builds = suppliers.select(
        F.col("s_suppkey").alias("build_id"),
        F.col("s_nationkey").cast("long").alias("model_id"),
        F.concat((F.col("s_suppkey") / 10).cast("long").cast("string"), F.lit("."), (F.col("s_suppkey") % 10).cast("string")).alias("version"),
    )
    n_builds = suppliers.agg(F.count("*")).scalar()
    deployments = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("deployment_id"), (F.col("c_custkey") % n_builds).alias("build_id")
    )
    return models, builds, deployments


REGISTRY_CTE = """
models as (select cast(n_nationkey as bigint) as model_id, n_name as model_name from nation),
builds as (select s_suppkey as build_id, cast(s_nationkey as bigint) as model_id,
    cast(s_suppkey // 10 as varchar) || '.' || cast(s_suppkey % 10 as varchar) as version from supplier),
deployments as (select c_custkey as deployment_id, c_custkey % (select count(*) from supplier) as build_id from customer)
"""
