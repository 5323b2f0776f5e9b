"""Queries over joins: labels that arrive late, names for codes, feature metadata and the model registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnspark.operators import features as X
from churnspark.operators import monitoring as N
from churnspark.operators.explain import feature_meta
from churnspark.plans.cleaning import DEFAULTS_CTE, DICTIONARY_CTE, SPEC
from churnspark.plans.frames import (
    CATEGORICAL, FEATURES, LOG_CTE, NUMERIC, REGISTRY_CTE, clean_churn, churn_frame, inference_log, registry_tables, request_frame,
)
from churnspark.plans.registry import query
from churnspark.session import staged


def late_labels(spark, sf):
    """Label events, the purchases corrected a second time ten days later."""
    log = inference_log(spark, sf).filter(F.col("label_ts").isNotNull())
    first = log.select("uuid", "label_ts", F.lit("No").alias("label"))
    final = log.select("uuid", (F.col("label_ts") + F.make_dt_interval(days=F.lit(10))).alias("label_ts"), F.col("label_raw").alias("label"))
    return first.unionByName(final)


@query(
    f"""with {LOG_CTE} select uuid, deployment, start_ms, probability,
    case when label_ts is not null then label_raw end as label,
    case when label_ts is not null then label_ts + interval 10 days end as label_ts from log"""
)
def join_delayed_labels(spark, sf):
    preds = inference_log(spark, sf).select("uuid", "deployment", "start_ms", "probability")
    return N.attach_labels(preds, late_labels(spark, sf))


@query(f"with {DICTIONARY_CTE} select c.customer_id, c.feature, d.value from (select customer_id, unnest([{', '.join(repr(c) for c in CATEGORICAL)}]) as feature, unnest([{', '.join(CATEGORICAL)}]) as value from clean) c join dictionary d on c.feature = d.feature and c.value = d.value")
def join_code_names(spark, sf):
    """Codes back to names: encode every customer, then look each code up."""
    clean = clean_churn(spark, sf).select("customer_id", *FEATURES)
    dictionary = staged(X.fit_dictionary(clean, CATEGORICAL), "dictionary")
    coded = X.encode_ordinal(clean, dictionary, SPEC)
    rows = coded.select("customer_id", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("int").alias("code")) for c in CATEGORICAL
    ])).alias("c")).select("customer_id", "c.feature", "c.code")
    return X.decode(rows, dictionary).select("customer_id", "feature", "value")


@query(
    f"""with {DEFAULTS_CTE} select r.customer_id, {", ".join(f"d.{c} as default_{c}" for c in FEATURES)} from requests r, defaults d"""
)
def join_defaults(spark, sf):
    """The one row of defaults beside every request."""
    clean = staged(clean_churn(spark, sf), "clean")
    row = X.default_values(clean, SPEC).select(F.struct(*FEATURES)).scalar()
    return request_frame(clean).select("customer_id", *[row[c].alias(f"default_{c}") for c in FEATURES])


STATS_CTE = "stats as (" + " union all ".join(
    f"select '{c}' as feature, quantile_cont({c}, 0.5) as median, avg({c}) as mean, min({c}) as min, max({c}) as max, "
    f"stddev_samp({c}) as std from clean" for c in NUMERIC
) + ")"
META_CTE = """meta as (
  select feature, 'mean' as name, cast(null as integer) as code, cast(null as varchar) as category, mean as stat from stats
  union all select feature, 'min', null, null, min from stats
  union all select feature, 'max', null, null, max from stats
  union all select feature, 'category', code, value, null from dictionary)"""
FIELD_LIST = f"unnest([{', '.join(repr(c) for c in FEATURES)}])"


@query(
    f"""with {DICTIONARY_CTE}, {STATS_CTE}, {META_CTE}
    select m.feature, m.name, m.code, m.category, round(m.stat, 2) as stat, count(*) as n_customers
    from (select customer_id, {FIELD_LIST} as feature from clean) c join meta m on c.feature = m.feature group by all"""
)
def join_feature_meta(spark, sf):
    """Numeric statistics and category lists merged per feature, then looked up for each customer's fields."""
    clean = staged(clean_churn(spark, sf), "clean")
    dictionary, _, stats = X.fit_tables(clean, SPEC)
    meta = feature_meta(stats, dictionary)
    fields = clean.select("customer_id", F.explode(F.array(*[F.lit(c) for c in FEATURES])).alias("feature"))
    # Fields are counted per feature before the lookup, so the customers never multiply with the metadata.
    counted = fields.groupBy("feature").agg(F.count("*").alias("n_customers"))
    return counted.join(meta, "feature").select(
        "feature", "name", "code", "category", F.round("stat", 2).alias("stat"), "n_customers"
    )


@query(
    f"""with {REGISTRY_CTE},
    b as (select model_id, max(build_id) as build_id from builds group by model_id),
    d as (select build_id, max(deployment_id) as deployment_id from deployments group by build_id)
    select model_name, models.model_id, b.build_id as latest_build_id, d.deployment_id as latest_deployment_id
    from models join b on models.model_id = b.model_id join d on b.build_id = d.build_id"""
)
def join_latest_version(spark, sf):
    return N.latest_deployment(*registry_tables(spark, sf))


@query(
    f"""with {DICTIONARY_CTE}, train as (select * from clean where region <> 'ASIA'),
    known as ({" union ".join(f"select '{c}' as feature, {c} as value from train" for c in CATEGORICAL)})
    select feature, value, count(*) as n from (
      {" union all ".join(f"select '{c}' as feature, {c} as value from churn" for c in CATEGORICAL)}) c
    where value is not null and not exists (select 1 from known k where k.feature = c.feature and k.value = c.value)
    group by feature, value"""
)
def unknown_category_report(spark, sf):
    """Values of the raw customers that a model trained outside Asia on cleaned rows has not seen."""
    train = clean_churn(spark, sf).filter(F.col("region") != "ASIA")
    return X.unseen(churn_frame(spark, sf), X.fit_dictionary(train, CATEGORICAL), CATEGORICAL)
