"""Queries over projections, filters, cleaning and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnspark.functions import columns as C
from churnspark.operators import cleaning as K
from churnspark.operators import features as X
from churnspark.operators.ordering import with_row_number
from churnspark.plans.frames import (
    CATEGORICAL, CHURN_CTE, CLEAN_CTE, FEATURES, LOG_CTE, NUMERIC, REQUEST_CTE,
    churn_frame, clean_churn, inference_log, request_frame, table,
)
from churnspark.plans.ingest import _RAW_SQL, CHURN_COLUMNS, raw_customers
from churnspark.plans.registry import query
from churnspark.session import staged

SPEC = X.FeatureSpec(tuple(FEATURES), tuple(CATEGORICAL))
FEATURE_LIST = ", ".join(FEATURES)


@query(f"with {CHURN_CTE} select {CHURN_COLUMNS} from churn where churn is not null")
def filter_label_known(spark, sf):
    return K.known_labels(churn_frame(spark, sf), "churn")


@query(f"with {CHURN_CTE} select {CHURN_COLUMNS} from churn where churn = 'Yes'")
def filter_eq(spark, sf):
    return churn_frame(spark, sf).filter(F.col("churn") == "Yes")


@query(
    f"""with raw as ({_RAW_SQL}) select customer_id, case when segment = ' ' then null else segment end as segment,
    case when balance = ' ' then null else balance end as balance from raw"""
)
def blank_to_null(spark, sf):
    return K.blank_to_null(raw_customers(spark, sf))


@query(
    f"""with raw as ({_RAW_SQL}) select customer_id, segment, balance from raw
    where segment <> ' ' and balance <> ' ' and customer_id is not null"""
)
def drop_incomplete(spark, sf):
    return K.drop_incomplete(K.blank_to_null(raw_customers(spark, sf)))


@query(f"""with {LOG_CTE} select uuid, probability as "metrics.probability", label_ts from log where label_ts is not null""")
def drop_null_subset(spark, sf):
    log = inference_log(spark, sf).select("uuid", F.col("probability").alias("metrics.probability"), F.col("label_ts"))
    return log.dropna(subset=["`metrics.probability`", "label_ts"])


@query(f"with {CHURN_CTE} select {FEATURE_LIST} from churn")
def project_features(spark, sf):
    return K.select_features(churn_frame(spark, sf), SPEC)


@query(f"with {CHURN_CTE} select {FEATURE_LIST}, churn_planted from churn")
def drop_pii(spark, sf):
    return churn_frame(spark, sf).drop("customer_id", "churn")


@query(f"with {CHURN_CTE} select customer_id, case senior when '1' then 'Yes' when '0' then 'No' else senior end as senior from churn")
def binary_recode(spark, sf):
    return K.recode(churn_frame(spark, sf), "senior", {"1": "Yes", "0": "No"}).select("customer_id", "senior")


@query(
    f"""with raw as ({_RAW_SQL}) select cast(customer_id as bigint) as customer_id, segment,
    try_cast(nullif(trim(balance), '') as double) as balance from raw"""
)
def cast_numeric(spark, sf):
    return K.cast_cols(raw_customers(spark, sf), {"customer_id": "bigint", "balance": "double"})


@query(f"with {CHURN_CTE} select customer_id, churn = 'Yes' as churned from churn")
def label_to_bool(spark, sf):
    return churn_frame(spark, sf).select("customer_id", C.label_bool("churn").alias("churned"))


@query(
    f"""with {REQUEST_CTE} select customer_id, segment, region, senior, last_priority, tenure,
    case when cast(customer_id as bigint) % 11 <> 0 then monthly_charges end as monthly_charges, total_charges,
    case when cast(customer_id as bigint) % 11 = 0 then 'monthly_charges' end as rejected from requests"""
)
def cast_request(spark, sf):
    """Requests arrive as text; each field takes the type that its feature was trained with, some by rule unreadable."""
    clean = clean_churn(spark, sf)
    texts = request_frame(clean).select("customer_id", *[F.col(c).cast("string").alias(c) for c in FEATURES])
    unreadable = F.when(F.col("customer_id").cast("long") % 11 == 0, "a lot").otherwise(F.col("monthly_charges"))
    return K.cast_request(texts.withColumn("monthly_charges", unreadable), clean.select(*FEATURES).schema, ["customer_id"], "rejected")


DEFAULTS_CTE = f"""{REQUEST_CTE},
defaults as (
  select {", ".join(f"min({c}) as {c}" for c in CATEGORICAL)},
    {", ".join(f"quantile_cont({c}, 0.5) as {c}" for c in NUMERIC)} from clean)
"""


@query(
    f"""with {DEFAULTS_CTE} select r.customer_id,
    {", ".join(f"coalesce(r.{c}, d.{c}) as {c}" for c in FEATURES)} from requests r, defaults d"""
)
def fill_defaults(spark, sf):
    clean = staged(clean_churn(spark, sf), "clean")
    return K.fill_defaults(request_frame(clean), X.default_values(clean, SPEC))


@query(
    f"""with {DEFAULTS_CTE} select r.customer_id, r.segment, d.region as region from requests r, defaults d"""
)
def map_defaults(spark, sf):
    """Map-typed requests: every request supplies the key segment, with a null value by rule, and no region."""
    clean = staged(clean_churn(spark, sf), "clean")
    d = X.default_values(clean, SPEC).select(F.create_map(F.lit("segment"), "segment", F.lit("region"), "region")).scalar()
    r = request_frame(clean).select("customer_id", F.create_map(F.lit("segment"), F.col("segment")).alias("args"), d.alias("defaults"))
    full = r.select("customer_id", C.overlay("defaults", "args").alias("m"))
    return full.select("customer_id", F.col("m")["segment"].alias("segment"), F.col("m")["region"].alias("region"))


@query(f"with {CLEAN_CTE} select customer_id, segment, row_number() over (order by cast(customer_id as bigint)) - 1 as id from clean")
def assign_row_id(spark, sf):
    rows = clean_churn(spark, sf).select("customer_id", "segment")
    return with_row_number(rows, [F.col("customer_id").cast("long")], name="id", start=0)


@query(
    f"""with {CLEAN_CTE}, ids as (select *, row_number() over (order by cast(customer_id as bigint)) - 1 as id from clean)
    select id, customer_id, segment, churn from ids where id = (select count(*) // 2 from clean)"""
)
def lookup_id(spark, sf):
    """One customer by the row id that cleaning assigned: the one in the middle."""
    rows = clean_churn(spark, sf).select("customer_id", "segment", "churn")
    numbered = staged(with_row_number(rows, [F.col("customer_id").cast("long")], name="id", start=0), "ids")
    middle = numbered.count() // 2
    return K.by_id(numbered, "id", middle).select("id", "customer_id", "segment", "churn")


@query(f"with {LOG_CTE} select uuid, probability >= 0.5 as with_tie, probability > 0.5 as without_tie from log")
def threshold_label(spark, sf):
    return inference_log(spark, sf).select(
        "uuid", C.threshold_label("probability").alias("with_tie"), C.threshold_label("probability", tie=False).alias("without_tie")
    )


@query(f"with {LOG_CTE} select uuid, epoch_ms(start_ms) as start_ts, epoch_ms(end_ms) as end_ts from log")
def epoch_ms_to_ts(spark, sf):
    return inference_log(spark, sf).select(
        "uuid",
        C.ms_to_ts("start_ms").cast("timestamp_ntz").alias("start_ts"),
        C.ms_to_ts("end_ms").cast("timestamp_ntz").alias("end_ts"),
    )


@query(
    f"""with {LOG_CTE} select uuid, end_ms - start_ms as processing_ms,
    ((end_ms - start_ms) % 1000) * 1000000 as processing_time_compat from log"""
)
def processing_time(spark, sf):
    log = inference_log(spark, sf).select("uuid", C.ms_to_ts("start_ms").alias("s"), C.ms_to_ts("end_ms").alias("e"))
    return log.select(
        "uuid",
        C.processing_ms("s", "e").alias("processing_ms"),
        C.processing_time_compat("s", "e").alias("processing_time_compat"),
    )


@query(f"with {LOG_CTE} select uuid, epoch_us(ts) // 1000 as ms, strftime(ts, '%d%m%Y%H%M%S') as suffix from log")
def now_ms(spark, sf):
    """The two clock helpers on the log's own times."""
    return inference_log(spark, sf).select("uuid", C.ts_to_ms("ts").alias("ms"), C.run_suffix("ts").alias("suffix"))


@query(
    f"""with {CHURN_CTE} select segment, format('{{1}} of {{0}} customers churned and {{2}} stayed', count(*),
      count(*) filter (where churn = 'Yes'), count(*) filter (where churn = 'No')) as summary,
    round(avg(monthly_charges), 2) as mean_charge, substr(min(last_priority), 1, 5) as short_priority
    from churn where churn is not null group by segment"""
)
def format_summary(spark, sf):
    per = K.known_labels(churn_frame(spark, sf), "churn").groupBy("segment").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("churn") == "Yes").alias("churned"),
        F.count_if(F.col("churn") == "No").alias("remained"),
        F.round(F.avg("monthly_charges"), 2).alias("mean_charge"),
        F.min("last_priority").alias("p"),
    )
    return per.select(
        "segment", C.format_summary("total", "churned", "remained").alias("summary"), "mean_charge", C.short_text("p").alias("short_priority")
    )


@query(
    f"""with {CHURN_CTE}, five as (select customer_id, segment, region, senior, last_priority, churn from churn
      order by cast(customer_id as bigint) limit 5)
    select customer_id, field, value from (
      select customer_id, 'segment' as field, segment as value from five union all
      select customer_id, 'region', region from five union all
      select customer_id, 'senior', senior from five union all
      select customer_id, 'last_priority', last_priority from five union all
      select customer_id, 'churn', churn from five)"""
)
def transpose_preview(spark, sf):
    """The first five customers, one field per row."""
    few = churn_frame(spark, sf).orderBy(F.col("customer_id").cast("long")).limit(5)
    return K.melt(few.select("customer_id", "segment", "region", "senior", "last_priority", "churn"), "customer_id")


_CATEGORY_UNION = " union all ".join(f"select '{c}' as feature, {c} as value from clean" for c in CATEGORICAL)
DICTIONARY_CTE = f"""{CLEAN_CTE}, cats as ({_CATEGORY_UNION}),
dictionary as (select feature, value, cast(row_number() over (partition by feature order by value) - 1 as integer) as code
  from (select distinct feature, value from cats) where value is not null)"""


@query(f"with {DICTIONARY_CTE} select feature, code as index, value from dictionary")
def enumerate_categories(spark, sf):
    return X.categories(X.fit_dictionary(clean_churn(spark, sf), CATEGORICAL))


@query(
    f"""with {LOG_CTE}, ext as (select min(probability) as lo, max(probability) as hi from log)
    select uuid,
      cast(greatest(0, least(6, floor((probability - 0.6 + 0.3) / 0.6 * 7))) as integer) as weight_bin,
      cast(greatest(0, least(6, floor(probability * 7))) as integer) as probability_bin,
      cast(greatest(0, least(6, floor((probability - lo) / (hi - lo) * 7))) as integer) as extent_bin
    from log, ext"""
)
def quantize7(spark, sf):
    """The three colour domains: weights in [-0.3, 0.3], probabilities in [0, 1], and the data's own extent."""
    log = inference_log(spark, sf).select("uuid", "probability")
    ext = log.agg(F.min("probability").alias("lo"), F.max("probability").alias("hi")).select(F.struct("lo", "hi")).scalar()
    return log.select(
        "uuid",
        C.quantize(F.col("probability") - 0.6, -0.3, 0.3).alias("weight_bin"),
        C.quantize("probability", 0, 1).alias("probability_bin"),
        C.quantize("probability", ext["lo"], ext["hi"]).alias("extent_bin"),
    )


@query(
    """with p as (select page_id, url, string_split(regexp_extract(url, '\\?([^#]*)', 1), '&') as parts from pages),
    kv as (select page_id, url, unnest(parts) as part from p)
    select page_id, split_part(part, '=', 1) as name, regexp_extract(part, '=(.*)$', 1) as value from kv where part <> ''"""
)
def query_params(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", C.url_params("url").alias("params"))
    return pages.select("page_id", F.explode("params").alias("name", "value"))


@query(
    f"""with raw as ({_RAW_SQL}) select customer_id, balance, try_cast(nullif(trim(balance), '') as double) is not null as accepted from raw"""
)
def validate_numeric(spark, sf):
    return raw_customers(spark, sf).select("customer_id", "balance", C.valid_override("balance").alias("accepted"))
