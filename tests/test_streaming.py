import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from churnspark.operators import models as M
from churnspark.operators.features import FeatureSpec
from churnspark.session import work_table
from churnspark.sources.metrics import prediction_uuid
from churnspark.sources import tables as T
from churnspark.streaming import jobs as J

T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def test_ingest_takes_each_file_once(spark, tmp_path, rows):
    src, dst, ckpt = (str(tmp_path / n) for n in ("src", "dst", "ckpt"))
    schema = "k string, x double"
    T.write_csv(spark.createDataFrame([("a", 1.0), ("b", None)], schema), f"{src}/1")
    assert rows(J.ingest_stream(spark, f"{src}/*", dst, ckpt, schema)) == [("a", 1.0), ("b", None)]
    assert J.ingest_stream(spark, f"{src}/*", dst, ckpt, schema).count() == 2
    T.write_csv(spark.createDataFrame([("c", 3.0)], schema), f"{src}/2")
    assert J.ingest_stream(spark, f"{src}/*", dst, ckpt, schema).count() == 3


def _feed(spark, path, batches, schema):
    """One Parquet file per batch, read one per micro-batch in order."""
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.parquet(f"{path}/b{i}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def test_label_after_the_bound_is_not_attached(spark, tmp_path):
    preds = _feed(spark, str(tmp_path / "p"), [[("a", at(0)), ("b", at(0)), ("c", at(0))], [("z", at(500))]], "uuid string, ts timestamp")
    labels = _feed(
        spark, str(tmp_path / "l"),
        [[("a", "Yes", at(5)), ("b", "Yes", at(30)), ("c", "No", at(-1))], [("y", "No", at(500))]],
        "uuid string, label string, label_ts timestamp",
    )
    out = J.run_available(J.delayed_labels_stream(preds, labels, "24 hours", "1 hour"), str(tmp_path / "o"), str(tmp_path / "k"))
    got = {r.uuid: r.label for r in out.collect()}
    # b came too late, c before its prediction; z still waits for its label
    assert got == {"a": "Yes", "b": None, "c": None}


def test_the_last_of_many_labels_wins_across_restarts(spark, tmp_path):
    """Labels repeated within and across micro-batches, before their prediction, and after a restart."""
    kinds = {"p": "uuid string, ts timestamp, score double, n long", "l": "uuid string, label string, label_ts timestamp"}
    deliveries = [
        ([("a", at(0), 0.5, 1 << 60), ("b", at(0), 0.1, 2)], [("a", "No", at(1)), ("a", "No", at(1)), ("c", "Yes", at(2))]),
        ([("c", at(1), None, None), ("c", at(1), None, None)], [("a", "Yes", at(3)), ("a", "No", at(2)), ("b", "No", at(4))]),
        ([("d", at(5), 0.2, 3)], [("b", "Yes", at(9)), ("a", "Yes", at(30)), ("orphan", "Yes", at(9))]),
        ([("none", at(500), None, None)], [("none", None, at(500))]),
    ]
    for k, parts in enumerate(deliveries):
        for (name, schema), rows in zip(kinds.items(), parts, strict=True):
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/delivery={k}")
        stream = [spark.readStream.schema(schema).parquet(f"{tmp_path}/{name}/*") for name, schema in kinds.items()]
        out = J.run_available(J.delayed_labels_stream(*stream, "24 hours", "1 hour"), str(tmp_path / "o"), str(tmp_path / "k"))
    got = sorted((r.uuid, r.label, r.label_ts, r.n) for r in out.collect())
    assert got == [("a", "Yes", at(3), 1 << 60), ("b", "Yes", at(9), 2), ("c", "Yes", at(2), None), ("d", None, None, 3)]


def test_delayed_labels_keep_their_state_on_disk(spark, sf, monkeypatch):
    """The query's state must not lie in the executors' heaps; the session's settings are as before afterwards."""
    from churnspark.plans import streams

    taken, run = [], J.run_available
    monkeypatch.setattr(J, "run_available", lambda df, path, checkpoint: taken.append(checkpoint) or run(df, path, checkpoint))
    before = set(spark.sql("SET").collect())
    streams.stream_delayed_labels(spark, sf)
    assert set(spark.sql("SET").collect()) == before
    said = [json.loads(line) for line in Path(taken[0], "offsets", "0").read_text().splitlines() if line.startswith("{")]
    conf = next(line["conf"] for line in said if "conf" in line)
    assert len(taken) == 4 and conf["spark.sql.streaming.stateStore.providerClass"].endswith("RocksDBStateStoreProvider")


def test_a_named_state_store_is_kept(spark):
    key, own = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(key, own)
    try:
        with J.state_on_disk(spark):
            assert spark.conf.get(key) == own and spark.conf.get("spark.sql.streaming.join.stateFormatVersion") == "2"
        assert spark.conf.get(key) == own
    finally:
        spark.conf.unset(key)


def test_accuracy_drops_rows_behind_the_watermark(spark, tmp_path):
    schema = "ts timestamp, y boolean, yhat boolean"
    batches = [[(at(0.2), True, True), (at(0.4), True, False)], [(at(5), True, True)], [(at(5.5), True, True)], [(at(0.5), True, True)], [(at(9), True, True)]]
    log = _feed(spark, str(tmp_path / "s"), batches, schema)
    out = J.run_available(J.accuracy_stream(log, "ts", "y", "yhat", "1 hour", "1 hour"), str(tmp_path / "o"), str(tmp_path / "k"))
    got = {r.window_start: (r.accuracy, r.n) for r in out.collect()}
    assert got[at(0)] == (0.5, 2)  # the late row at 0.5 is left out
    assert got[at(5)] == (1.0, 2) and at(9) not in got


@pytest.fixture(scope="module")
def em(spark):
    rows = [(f"r{i}", "uv"[i % 2], float(i % 17), "Yes" if (i % 2 == 0) != (i % 11 == 0) else "No") for i in range(200)]
    data = spark.createDataFrame(rows, "id string, a string, x double, y string")
    spec = FeatureSpec(("a", "x"), ("a",))
    return M.ExplainedModel.build(data, spec, "y", M.fit_logistic(data, spec, "y"))


def test_scoring_stream_equals_batch(spark, em, tmp_path):
    batches = [[("q1", "u", 1.0)], [("q2", "v", 2.0), ("q3", "u", 3.0)]]
    stream = _feed(spark, str(tmp_path / "r"), batches, "id string, a string, x double")
    out = J.run_available(J.score_stream(stream, "churn", ["id"], em.predict), str(tmp_path / "o"), str(tmp_path / "k"))
    got = {r.id: r.probability for r in out.collect()}
    batch = spark.createDataFrame(sum(batches, []), "id string, a string, x double")
    assert got == {r.id: r.probability for r in em.predict(batch).collect()}
    assert out.select("uuid").distinct().count() == 3


def test_serving_stream_logs_explanations(spark, em, tmp_path):
    stream = _feed(spark, str(tmp_path / "r"), [[("q1", "u", 1.0, 5)], [("q2", "v", None, 6), ("q1", "u", 1.0, 7)]], "id string, a string, x double, at long")
    table = work_table(spark, "served")
    J.serve_stream(stream, em, "id", "at", "churn", "dep-1", table, str(tmp_path / "k"), n_samples=100).awaitTermination()
    rows = spark.table(table).collect()
    got = {r.id: r for r in rows}
    assert len({r.uuid for r in rows}) == 3 and sorted((r.id, r.start_ms) for r in rows) == [("q1", 5), ("q1", 7), ("q2", 6)]
    assert set(got["q1"].explanation) == {"a", "x"}
    assert got["q2"].data.x == 8.0 and got["q1"].deployment == "dep-1"
    assert spark.table(table).filter((F.col("day") == 0) & (F.col("end_ms") > F.col("start_ms"))).count() == 3
    again = spark.createDataFrame([("q2", "v", None, 6), ("q3", "v", 1.0, 8)], "id string, a string, x double, at long")
    J.log_answers(again, em, "id", "at", "churn", "dep-1", table, n_samples=100)  # a batch that is partly repeated
    assert spark.table(table).count() == 4


def test_one_unreadable_request_does_not_stop_the_others(spark, em, tmp_path):
    stream = _feed(spark, str(tmp_path / "r"), [[("q1", "u", "1.5", 5), ("q2", "v", "abc", 6), ("q3", "u", None, 7)]], "id string, a string, x string, at long")
    table = work_table(spark, "served")
    J.serve_stream(stream, em, "id", "at", "churn", "dep-1", table, str(tmp_path / "k"), n_samples=100).awaitTermination()
    assert {(r.id, r.data.x) for r in spark.table(table).collect()} == {("q1", 1.5), ("q3", 8.0)}
    bad = spark.table(f"{table}_rejected").collect()
    assert [(r.id, r.start_ms, r.unreadable, json.loads(r.request)["x"]) for r in bad] == [("q2", 6, "x", "abc")]


def test_a_batch_that_died_between_its_writes_is_written_once(spark, em, monkeypatch):
    batch = spark.createDataFrame([("q1", "u", "1.5", 5), ("q2", "v", "abc", 6)], "id string, a string, x string, at long")
    table, aside = work_table(spark, "served"), work_table(spark, "aside")
    ask = lambda key: J.log_answers(batch, em, "id", "at", "churn", "dep-1", table, 100, aside, key)
    write, calls = J._write, []

    def dies(df, name, key):
        calls.append(name)
        if name == aside and len(calls) == 2:
            raise OSError("lost")
        write(df, name, key)

    monkeypatch.setattr(J, "_write", dies)
    with pytest.raises(OSError, match="lost"):
        ask("s-0")
    for _ in range(2):
        ask("s-0")
    assert [r.id for r in spark.table(table).collect()] == ["q1"] and [r.id for r in spark.table(aside).collect()] == ["q2"]
    ask("s-1")  # the same requests in another batch are known
    assert spark.table(table).count() == 1


def test_unreadable_request_is_not_answered(spark, em):
    bad = spark.createDataFrame([("q1", "u", "abc")], "id string, a string, x string")
    with pytest.raises(Exception, match="unreadable x: abc"):
        em.serve(bad, "id", 100).collect()


def test_prediction_ids_differ(spark):
    keys = spark.createDataFrame([("a", None), (None, "a"), ("a:b", "c"), ("a", "b:c")], "k string, l string")
    assert keys.select(prediction_uuid("m", "k", "l").alias("u")).distinct().count() == 4
