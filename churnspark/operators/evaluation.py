"""Confusion counts, classification report, accuracy, AUC, ROC and accuracy over blocks and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.operators.ordering import with_row_number, with_running_total


def confusion(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """(actual, predicted, n) over rows where both are known."""
    return (
        df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
        .groupBy(F.col(y).alias("actual"), F.col(yhat).alias("predicted"))
        .agg(F.count("*").alias("n"))
    )


def classification_report(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """(class, precision, recall, f1, support) per class, then accuracy, macro avg and weighted avg rows.

    A ratio with nothing below the line is 0. The rows are counted once; the report works on the counts.
    """
    cm = confusion(df, y, yhat)
    sides = cm.select(
        "n",
        (F.col("actual") == F.col("predicted")).alias("hit"),
        F.explode(F.array(F.struct(F.col("actual").alias("class"), F.lit(True).alias("is_actual")),
                          F.struct(F.col("predicted").alias("class"), F.lit(False).alias("is_actual")))).alias("s"),
    )
    per = sides.groupBy(F.col("s.class").cast("string").alias("class")).agg(
        F.sum(F.when(F.col("hit") & F.col("s.is_actual"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("s.is_actual"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("s.is_actual"), F.col("n")).otherwise(0)).alias("predicted"),
    )
    ratio = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    per = per.withColumn("precision", ratio(F.col("tp"), F.col("predicted"))).withColumn(
        "recall", ratio(F.col("tp"), F.col("support"))
    )
    per = per.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    names = ["precision", "recall", "f1"]
    classes = per.select("class", *names, "support")
    total = F.sum("support")
    accuracy = per.select("tp", "support").agg((F.sum("tp") / F.sum("support")).alias("a"), F.sum("support").alias("support"))
    return (
        classes.unionByName(accuracy.select(F.lit("accuracy").alias("class"), *[F.col("a").alias(c) for c in names], "support"))
        .unionByName(per.agg(*[F.avg(c).alias(c) for c in names], total.alias("support")).select(F.lit("macro avg").alias("class"), *names, "support"))
        .unionByName(
            per.agg(*[(F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in names], total.alias("support"))
            .select(F.lit("weighted avg").alias("class"), *names, "support")
        )
    )


def accuracy(df: DataFrame, y: str, yhat: str, by=()) -> DataFrame:
    known = df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    return known.groupBy(*by).agg(
        F.avg((F.col(y) == F.col(yhat)).cast("double")).alias("accuracy"), F.count("*").alias("n")
    )


def _score_counts(df: DataFrame, y: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    return (
        df.filter(F.col(y).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.sum(F.col(y).cast("long")).alias("pos"), F.sum(1 - F.col(y).cast("long")).alias("neg"))
    )


def auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Area under the ROC curve from rank sums over distinct scores, ties counted half."""
    ranked = with_running_total(_score_counts(df, y, score), ["score"], ["pos", "neg"])
    wins = F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2.0))
    return ranked.agg((wins / (F.max("pos_total").cast("double") * F.max("neg_total"))).alias("auc"))


def roc_curve(df: DataFrame, y: str, score: str, drop_intermediate: bool = True) -> DataFrame:
    """(threshold, fpr, tpr) from the origin (threshold null) downwards through the distinct scores.

    ``drop_intermediate`` leaves out points that lie on the straight line between their neighbours.
    """
    counts = _score_counts(df, y, score).withColumn("down", -F.col("score"))
    run = with_running_total(counts, ["down"], ["pos", "neg"], following=["pos", "neg"])
    if drop_intermediate:
        first = F.col("pos_upto") + F.col("neg_upto") == F.col("pos") + F.col("neg")
        last = F.col("pos_next").isNull()
        bend = (F.col("pos_next") != F.col("pos")) | (F.col("neg_next") != F.col("neg"))
        run = run.filter(first | last | bend)
    points = run.select(
        F.col("score").alias("threshold"),
        (F.col("neg_upto") / F.col("neg_total")).alias("fpr"),
        (F.col("pos_upto") / F.col("pos_total")).alias("tpr"),
    )
    origin = df.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return origin.unionByName(points)


def accuracy_per_n(df: DataFrame, order: list[str], y: str, yhat: str, time_ms: str, n: int = 100) -> DataFrame:
    """(block, accuracy, start_ms, end_ms) of consecutive blocks of ``n`` rows; an incomplete last block is left out."""
    rows = df.select(*dict.fromkeys([y, yhat, time_ms, *order]))
    numbered = with_row_number(rows, order, name="_rn", start=0)
    return (
        numbered.groupBy(F.floor(F.col("_rn") / n).cast("long").alias("block"))
        .agg(
            F.avg((F.col(y) == F.col(yhat)).cast("double")).alias("accuracy"),
            F.min_by(time_ms, "_rn").alias("start_ms"),
            F.max_by(time_ms, "_rn").alias("end_ms"),
            F.count("*").alias("_n"),
        )
        .filter(F.col("_n") == n)
        .drop("_n")
    )


def accuracy_by_window(df: DataFrame, ts: str, y: str, yhat: str, width: str, by=()) -> DataFrame:
    """(by..., window_start, window_end, accuracy, n) per tumbling window."""
    return (
        df.groupBy(*by, F.window(F.col(ts).cast("timestamp"), width).alias("w"))
        .agg(F.avg((F.col(y) == F.col(yhat)).cast("double")).alias("accuracy"), F.count("*").alias("n"))
        .select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "accuracy", "n")
    )


def with_sequence(df: DataFrame, order, start: int = 0, name: str = "sequence") -> DataFrame:
    return with_row_number(df, order, name=name, start=start)
