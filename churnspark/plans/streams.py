"""Streaming queries over the given tables, each run over all input and compared with its batch form."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from churnspark.plans.frames import CALL_MS, CLEAN_CTE, FEATURES, LOG_CTE, PLANTED_SQL, call_ms, clean_churn, inference_columns, inference_log, table
from churnspark.plans.ingest import _RAW_SQL, raw_customers
from churnspark.plans.joins import late_labels
from churnspark.plans.modelling import planted
from churnspark.plans.registry import query
from churnspark.session import scratch_path, staged
from churnspark.sources import tables as T
from churnspark.streaming import jobs as J

INGEST_SQL = f"""with raw as ({_RAW_SQL})
    select customer_id, nullif(segment, 'NA') as segment, try_cast(nullif(trim(balance), '') as double) as balance from raw"""


def _event_stream(spark, sf):
    return J.table_stream(spark, sf, table(spark, sf, "events").schema, "events.parquet")


@query(INGEST_SQL)
def ingest_incremental(spark, sf):
    """Two deliveries of customer files; the second run loads only what is new."""
    src, dst, ckpt = (scratch_path(spark, n) for n in ("incoming", "loaded", "ingest_state"))
    raw = raw_customers(spark, sf)
    early = F.col("customer_id").cast("long") % 2 == 0
    schema = "customer_id string, segment string, balance double"
    T.write_csv(raw.filter(early), f"{src}/day=1")
    J.ingest_stream(spark, f"{src}/*", dst, ckpt, schema)
    T.write_csv(raw.filter(~early), f"{src}/day=2")
    return J.ingest_stream(spark, f"{src}/*", dst, ckpt, schema)


query(INGEST_SQL, name="stream_ingest")(ingest_incremental)


@query(
    f"""with {CLEAN_CTE}, calls as (select *, unnest([0, 60000]) as wait from clean)
    select md5('["churn","' || customer_id || '","' || ({CALL_MS} + wait) || '"]') as uuid, 'churn' as model, customer_id,
    {CALL_MS} + wait as call_ms, round({PLANTED_SQL}, 9) as probability from calls"""
)
def stream_score(spark, sf):
    """Two calls for each customer, a minute apart: two predictions."""
    waits = F.explode(F.array(F.lit(0), F.lit(60_000)))
    calls = clean_churn(spark, sf).select("customer_id", *FEATURES, waits.alias("wait"))
    requests = staged(calls.select("customer_id", *FEATURES, (call_ms() + F.col("wait")).alias("call_ms")), "requests")
    stream = J.table_stream(spark, requests.inputFiles()[0].rsplit("/", 1)[0], requests.schema)
    scored = J.score_stream(stream, "churn", ["customer_id", "call_ms"], planted)
    out = scored.select("uuid", "model", "customer_id", "call_ms", F.round("probability", 9).alias("probability"))
    return J.run_available(out, scratch_path(spark, "scored"), scratch_path(spark, "score_state"))


@query(
    f"""with {LOG_CTE} select uuid, deployment, start_ms, probability,
    case when label_ts is not null then label_raw end as label,
    case when label_ts is not null then label_ts + interval 10 days end as label_ts from log"""
)
def stream_delayed_labels(spark, sf):
    """What `join_delayed_labels` returns, from streams: labels given twice, in four deliveries by event time, the
    job restarted for each. A last event far ahead on both sides moves the watermark past all predictions."""
    log = inference_log(spark, sf)
    preds = staged(log.select("uuid", F.col("ts").cast("timestamp").alias("ts"), "deployment", "start_ms", "probability"), "predictions")
    labels = staged(late_labels(spark, sf).select("uuid", "label", F.col("label_ts").cast("timestamp").alias("label_ts")), "labels")
    first, last = preds.agg(F.min("ts"), F.max("ts")).first()
    cuts = [first + (last - first) * k / 3 for k in (1, 2)]
    ahead = last + timedelta(days=60)
    src = {name: scratch_path(spark, name) for name in ("preds", "labels")}
    dst, ckpt = scratch_path(spark, "labelled"), scratch_path(spark, "label_state")
    for k, (low, high) in enumerate(zip([None, *cuts, ahead], [*cuts, ahead, None], strict=True)):
        for name, frame, time in (("preds", preds, "ts"), ("labels", labels, "label_ts")):
            part = frame.where((F.col(time) >= F.lit(low) if low else F.lit(True)) & (F.col(time) < F.lit(high) if high else F.lit(True)))
            if high is None:
                beat = {time: F.lit(ahead), "uuid": F.lit("none")}
                part = frame.limit(1).select(*[beat.get(c, F.lit(None).cast(t)).alias(c) for c, t in frame.dtypes])
            part.write.parquet(f"{src[name]}/delivery={k}")
        stream = J.delayed_labels_stream(
            J.table_stream(spark, f"{src['preds']}/*", preds.schema), J.table_stream(spark, f"{src['labels']}/*", labels.schema), "14 days", "1 hour"
        )
        with J.state_on_disk(spark):
            out = J.run_available(stream, dst, ckpt)
    return out.select("uuid", "deployment", "start_ms", "probability", "label", F.col("label_ts").cast("timestamp_ntz").alias("label_ts"))


@query(
    f"""with {LOG_CTE}, w as (select max(ts) - interval 2 hours as mark from log)
    select time_bucket(interval 1 hour, ts) as window_start, time_bucket(interval 1 hour, ts) + interval 1 hour as window_end,
      round(avg(cast((probability >= 0.5) = (label_raw = 'Yes') as double)), 9) as accuracy, count(*) as n
    from log, w group by 1, 2, mark having window_end <= mark"""
)
def stream_accuracy(spark, sf):
    """Accuracy per hour, each hour once the watermark has passed its end."""
    log = inference_columns(_event_stream(spark, sf)).select(
        F.col("ts").cast("timestamp").alias("ts"), (F.col("probability") >= 0.5).alias("yhat"), (F.col("label_raw") == "Yes").alias("y")
    )
    per = J.accuracy_stream(log, "ts", "y", "yhat", "1 hour", "2 hours")
    out = J.run_available(per, scratch_path(spark, "accuracy"), scratch_path(spark, "accuracy_state"))
    return out.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        F.round("accuracy", 9).alias("accuracy"), "n",
    )
