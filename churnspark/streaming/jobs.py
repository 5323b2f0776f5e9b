"""Streaming jobs: file ingest, scoring, labels that arrive late, and accuracy per window."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from churnspark.operators.explain import Predict
from churnspark.operators.models import ExplainedModel
from churnspark.sources.metrics import DAY_MS, METRIC_LAYOUT, prediction_uuid, with_day
from churnspark.sources.tables import write_batch


def customer_stream(spark: SparkSession, path: str, schema: T.StructType | str, max_files: int | None = None) -> DataFrame:
    """New CSV files under ``path`` as a stream, read like :func:`churnspark.sources.tables.read_customers`."""
    reader = spark.readStream.schema(schema).option("header", True).option("sep", ",").option("nullValue", "NA")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)


def table_stream(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(path)


_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
_STATE_ON_DISK = {
    _STATE_STORE: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_ROCKSDB}.boundedMemoryUsage": "true",  # of all stores of an executor together
    f"{_ROCKSDB}.maxMemoryUsageMB": "256",
    f"{_ROCKSDB}.trackTotalNumberOfRows": "false",  # the count costs a look-up a row
    "spark.sql.streaming.join.stateFormatVersion": "3",  # one store a partition instead of four
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state on the executors' disks; their memory for it is bounded.

    Spark's default store holds all state in the executors' heaps, and that of a stopped run until it is cleaned up.
    A session that names a state store keeps it, and a checkpoint keeps the one it was begun with.
    """
    put = {} if spark.conf.get(_STATE_STORE, None) else {k: v for k, v in _STATE_ON_DISK.items() if spark.conf.get(k, None) is None}
    for key, value in put.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in put:
            spark.conf.unset(key)


def start_append(df: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append a stream to Parquet: everything available now, or a batch per ``interval`` until stopped.

    The checkpoint records which input is done, so a restart continues without loss or repetition.
    """
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def run_available(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over all input that is there and return what its sink holds."""
    start_append(df, path, checkpoint).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ingest_stream(spark: SparkSession, src: str, dst: str, checkpoint: str, schema: T.StructType | str) -> DataFrame:
    """Load the files that arrived since the last run; each file is loaded once."""
    return run_available(customer_stream(spark, src, schema), dst, checkpoint)


def score_stream(requests: DataFrame, model: str, keys: list[str], predict: Predict) -> DataFrame:
    """Requests with their probability and stable prediction id, as they arrive."""
    return predict(requests).withColumn("uuid", prediction_uuid(model, *keys)).withColumn("model", F.lit(model))


def _clock() -> Column:
    """The time at which a row is made, in ms."""
    return F.reflect(F.lit("java.lang.System"), F.lit("currentTimeMillis")).cast("long")


def log_answers(
    batch: DataFrame, em: ExplainedModel, key: str, asked_at: str, model: str, deployment: str, table: str, n_samples: int = 5000,
    rejected: str | None = None, batch_key: str | None = None,
) -> None:
    """Answer and explain requests (<key>, <asked_at> in ms, fields...) and write the answers to the inference log.

    The prediction id holds the request's time, so two calls for one key are two predictions, and requests whose
    id the log has already are left out. ``start_ms`` is the request's time and ``end_ms`` the time at which its
    answer was there. Requests with an unreadable value go to the table ``rejected`` with what they held, and all
    others are answered; without such a table they are an error.

    The tables are partitioned by batch, a call without a key being a batch of its own. With ``batch_key`` both hold the batch under that key, and writing it again replaces it: a batch that is
    retried adds nothing, even if it died between the two writes.
    """
    spark = batch.sparkSession
    carry = ["start_ms", key]
    asked = batch.select(prediction_uuid(model, key, asked_at).alias("uuid"), F.col(asked_at).cast("long").alias("start_ms"), *[c for c in batch.columns if c != asked_at])
    asked = asked.dropDuplicates(["uuid"])
    if spark.catalog.tableExists(table):
        log = spark.table(table).where(F.col("deployment") == deployment)
        log = log.where(F.col("batch") != batch_key) if batch_key else log
        days = batch.select(F.floor(F.col(asked_at).cast("long") / DAY_MS).cast("int").alias("day")).distinct()
        asked = asked.join(log.join(days, "day", "left_semi").select("uuid"), "uuid", "left_anti")
    if rejected:
        answers, bad = em.serve_readable(asked, "uuid", n_samples, carry=carry)
    else:
        answers, bad = em.serve(asked, "uuid", n_samples, carry=carry), None
    named = lambda df: df.withColumns({"model": F.lit(model), "deployment": F.lit(deployment)})
    out = named(answers).withColumn("end_ms", _clock())
    _write(with_day(out.select("uuid", "model", "deployment", "start_ms", "end_ms", key, "data", "probability", "explanation")), table, batch_key)
    if bad is not None:
        _write(with_day(named(bad).select("uuid", "model", "deployment", "start_ms", key, "request", "unreadable")), rejected, batch_key)


def _write(df: DataFrame, table: str, batch_key: str | None) -> None:
    write_batch(df, table, batch_key or f"call-{uuid.uuid4().hex}", METRIC_LAYOUT)


def serve_stream(
    requests: DataFrame, em: ExplainedModel, key: str, asked_at: str, model: str, deployment: str, table: str, checkpoint: str, n_samples: int = 5000,
    rejected: str | None = None, name: str = "serve",
) -> StreamingQuery:
    """Answer the requests of each micro-batch and log the answers (see ``log_answers``), each batch once.

    ``name`` tells apart the streams that write to one log. Unreadable requests go to ``<table>_rejected`` unless
    another table is named.
    """

    def answer(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            log_answers(batch, em, key, asked_at, model, deployment, table, n_samples, rejected or f"{table}_rejected", f"{name}-{number}")

    return requests.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def delayed_labels_stream(preds: DataFrame, labels: DataFrame, within: str, delay: str) -> DataFrame:
    """Each prediction (uuid, ts, ...) once, with its last label of at most ``within`` later, or nulls without one.

    An interval join meets predictions and label events, in whichever order they arrive; an aggregation per
    prediction then keeps the last label however many there are (of equal times the greatest text). The row comes
    out when the watermark passes ``ts`` + ``within``, as until then a later label may replace the one at hand. A
    prediction repeated with the same uuid and time is one. Both event times must be TIMESTAMP; state older than
    the bound and the watermark delay is dropped. Start it under ``state_on_disk``: the state grows with the rows
    of ``within``.
    """
    left = preds.withWatermark("ts", delay).alias("p")
    right = labels.select(F.col("uuid").alias("label_uuid"), "label", "label_ts").withWatermark("label_ts", delay).alias("l")
    bound = F.expr(f"p.uuid = l.label_uuid AND l.label_ts >= p.ts AND l.label_ts <= p.ts + interval {within}")
    met = left.join(right, bound, "leftOuter")
    rest = [c for c in preds.columns if c not in ("uuid", "ts")]
    last = F.max_by("label", F.struct("label_ts", "label")).alias("label"), F.max("label_ts").alias("label_ts")
    one = met.groupBy("uuid", "ts").agg(F.first(F.struct(F.lit(1).alias("_one"), *rest)).alias("_rest"), *last)
    return one.select(*[c if c in ("uuid", "ts") else F.col(f"_rest.`{c}`").alias(c) for c in preds.columns], "label", "label_ts")


def accuracy_stream(log: DataFrame, ts: str, y: str, yhat: str, width: str, delay: str, by=()) -> DataFrame:
    """(by..., window_start, window_end, accuracy, n) of each tumbling window once the watermark has passed it."""
    return (
        log.withWatermark(ts, delay)
        .groupBy(*by, F.window(ts, width).alias("w"))
        .agg(F.avg((F.col(y) == F.col(yhat)).cast("double")).alias("accuracy"), F.count("*").alias("n"))
        .select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "accuracy", "n")
    )
