"""Queries over ordered numbering, blocks, sorting, top-k, sampling and splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnspark.operators import evaluation as E
from churnspark.operators import monitoring as N
from churnspark.operators import sampling as S
from churnspark.operators.explain import top_features as top_weights
from churnspark.plans.frames import (
    CLEAN_CTE, LOG_CTE, PLANTED_SQL, REGISTRY_CTE, SCORES_CTE, churn_frame, clean_churn, inference_log, labelled_scores,
    planted_probability, registry_tables, CHURN_CTE, uniform_sql,
)
from churnspark.plans.registry import query
from churnspark.session import staged


@query(
    f"""with {LOG_CTE}, r as (select *, row_number() over (order by ts, event_id) - 1 as rn from log where label_ts is not null)
    select rn // 100 as block, round(avg(cast((probability >= 0.5) = (label_raw = 'Yes') as double)), 9) as accuracy,
      arg_min(start_ms, rn) as start_ms, arg_max(start_ms, rn) as end_ms
    from r group by 1 having count(*) = 100"""
)
def accuracy_per_100(spark, sf):
    log = inference_log(spark, sf).filter(F.col("label_ts").isNotNull())
    rows = log.select("ts", "event_id", "start_ms", (F.col("probability") >= 0.5).alias("yhat"), (F.col("label_raw") == "Yes").alias("y"))
    blocks = E.accuracy_per_n(rows, ["ts", "event_id"], "y", "yhat", "start_ms", 100)
    return blocks.withColumn("accuracy", F.round("accuracy", 9))


@query(f"with {LOG_CTE} select uuid, start_ms, row_number() over (order by start_ms, uuid) - 1 as sequence from log")
def sequence_index(spark, sf):
    return E.with_sequence(inference_log(spark, sf).select("uuid", "start_ms"), ["start_ms", "uuid"], start=0)


@query(
    f"""with {SCORES_CTE}, c as (select score, sum(y) as pos, sum(1 - y) as neg from scores where y is not null group by score),
    r as (select *, sum(pos) over w as tps, sum(neg) over w as fps, lead(pos) over w2 as pos_next, lead(neg) over w2 as neg_next,
      row_number() over w2 as rn, sum(pos) over () as p, sum(neg) over () as n
      from c window w as (order by score desc rows unbounded preceding), w2 as (order by score desc))
    select round(score, 9) as threshold, round(fps / n, 9) as fpr, round(tps / p, 9) as tpr from r
    where rn = 1 or pos_next is null or pos_next <> pos or neg_next <> neg
    union all select null, 0e0, 0e0"""
)
def roc_curve(spark, sf):
    r = E.roc_curve(labelled_scores(spark, sf), "y", "score")
    return r.select(*[F.round(c, 9).alias(c) for c in ("threshold", "fpr", "tpr")])


@query(
    f"""with {CLEAN_CTE}, r as (select *, row_number() over (order by cast(customer_id as bigint)) as i, count(*) over () as n from clean)
    select customer_id, churn, ({uniform_sql(7, 'customer_id')} < i / n or churn = 'Yes') as final_label from r"""
)
def ramped_label_noise(spark, sf):
    clean = staged(clean_churn(spark, sf).select("customer_id", "churn"))
    return S.ramp_noise(clean, [F.col("customer_id").cast("long")], "churn", 7, "customer_id")


@query(
    f"""with {CLEAN_CTE}, t as (select customer_id, {PLANTED_SQL} as p from clean order by md5('83:' || customer_id), customer_id limit 10)
    select customer_id, round(p, 9) as probability from t order by p desc, customer_id"""
)
def sort_probability(spark, sf):
    """Ten sampled customers, the most likely to leave first."""
    scored = clean_churn(spark, sf).select("customer_id", planted_probability().alias("probability"))
    few = S.sample_n(staged(scored), 10, "customer_id", 83)
    return few.orderBy(F.desc("probability"), "customer_id").withColumn("probability", F.round("probability", 9))


@query(f"with {LOG_CTE} select uuid, deployment, start_ms, probability from log order by start_ms, uuid")
def sort_time(spark, sf):
    return inference_log(spark, sf).select("uuid", "deployment", "start_ms", "probability").orderBy("start_ms", "uuid")


@query(
    f"""with {LOG_CTE} (select 'head' as side, uuid, start_ms from log order by start_ms, uuid limit 5)
    union all (select 'tail', uuid, start_ms from log order by start_ms desc, uuid desc limit 5)"""
)
def head_tail(spark, sf):
    log = inference_log(spark, sf).select("uuid", "start_ms")
    head = log.orderBy("start_ms", "uuid").limit(5).select(F.lit("head").alias("side"), "*")
    tail = log.orderBy(F.desc("start_ms"), F.desc("uuid")).limit(5).select(F.lit("tail").alias("side"), "*")
    return head.unionByName(tail)


@query(
    f"""with {REGISTRY_CTE} select model_id, build_id, version from builds
    qualify row_number() over (partition by model_id order by
      cast(split_part(version, '.', 1) as integer) desc, cast(split_part(version, '.', 2) as integer) desc) = 1"""
)
def latest_semver(spark, sf):
    _, builds, _ = registry_tables(spark, sf)
    return N.max_version(builds, "version", by=["model_id"]).select("model_id", "build_id", "version")


_STAGE = "['rc', '', '.post', '-b'][1 + build_id % 4]"
_STAGED = f"version || {_STAGE} || case when build_id % 4 = 1 then '' else cast(build_id % 23 as varchar) end"


@query(
    f"""with {REGISTRY_CTE} select model_id, build_id, {_STAGED} as version from builds
    qualify row_number() over (partition by model_id order by
      cast(split_part(version, '.', 1) as integer) desc, cast(split_part(version, '.', 2) as integer) desc,
      [2, 3, 4, 1][1 + build_id % 4] desc, build_id % 23 desc) = 1"""
)
def latest_public_version(spark, sf):
    """Builds with pre-releases and post releases of their version."""
    _, builds, _ = registry_tables(spark, sf)
    k = F.col("build_id")
    stage = F.element_at(F.array(*map(F.lit, ("rc", "", ".post", "-b"))), (k % 4 + 1).cast("int"))
    named = builds.withColumn("version", F.concat("version", stage, F.when(k % 4 == 1, "").otherwise((k % 23).cast("string"))))
    return N.max_version(named, "version", by=["model_id"]).select("model_id", "build_id", "version")


def _weights():
    return F.create_map(
        F.lit("segment"), F.lit(1.6) * (F.col("segment") == "BUILDING").cast("double"),
        F.lit("senior"), (F.col("senior") == "Yes").cast("double"),
        F.lit("tenure"), F.lit(-0.12) * (F.col("tenure") - 52.0),
        F.lit("monthly_charges"), F.lit(0.000004) * (F.col("monthly_charges") - 250000.0),
    )


@query(
    f"""with {CLEAN_CTE}, w as (select customer_id,
      unnest(['segment', 'senior', 'tenure', 'monthly_charges']) as feature, unnest([1.6e0 * cast(segment = 'BUILDING' as double),
      cast(senior = 'Yes' as double), -0.12e0 * (tenure - 52), 0.000004e0 * (monthly_charges - 250000)]) as weight from clean)
    select customer_id, feature, round(weight, 6) + 0e0 as weight from w
    qualify row_number() over (partition by customer_id order by abs(weight) desc, feature) <= 2"""
)
def top_features(spark, sf):
    """The two strongest terms of the fixed-coefficient model per customer, sorted inside the row."""
    rows = clean_churn(spark, sf).select("customer_id", _weights().alias("w"))
    top = rows.select("customer_id", F.explode(top_weights("w", 2)).alias("t"))
    return top.select("customer_id", F.col("t.feature").alias("feature"), (F.round(F.col("t.weight"), 6) + 0.0).alias("weight"))


@query(f"with {CHURN_CTE} select customer_id, segment, churn from churn where churn is not null and {uniform_sql(83, 'customer_id')} < 0.5")
def sample_fraction(spark, sf):
    known = churn_frame(spark, sf).filter(F.col("churn").isNotNull()).select("customer_id", "segment", "churn")
    return S.hash_sample(known, "customer_id", 0.5, 83)


@query("select event_id, event_type, value from events order by md5('11:' || cast(event_id as varchar)), event_id limit 1000")
def sample_n(spark, sf):
    """Exactly 1000 of the logged events."""
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "event_type", "value")
    return S.sample_n(events, 1000, "event_id", 11)


@query("select c_custkey from customer order by md5('5:' || cast(c_custkey as varchar)), c_custkey limit 10")
def sample_ids(spark, sf):
    return S.sample_n(spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey"), 10, "c_custkey", 5)


@query(
    f"""with {CLEAN_CTE} select customer_id, churn_planted, row_number() over (order by md5('42:' || customer_id), customer_id)
      <= ceil(0.25e0 * count(*) over ()) as is_test from clean"""
)
def train_test_split(spark, sf):
    clean = staged(clean_churn(spark, sf).select("customer_id", "churn_planted"))
    return S.train_test_split(clean, "customer_id", 0.25, 42)


@query(
    f"""with {CLEAN_CTE} select customer_id, churn_planted,
    cast((row_number() over (partition by churn_planted order by md5('42:' || customer_id), customer_id) - 1) % 5 as integer) as fold from clean"""
)
def stratified_folds(spark, sf):
    return S.folds(clean_churn(spark, sf).select("customer_id", "churn_planted"), "churn_planted", "customer_id", 5, 42)
