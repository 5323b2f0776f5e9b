"""Labels that arrive after the prediction, and the model registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.functions.columns import version_key


def attach_labels(preds: DataFrame, labels: DataFrame) -> DataFrame:
    """Each prediction with its latest label by uuid; predictions without one stay, label null.

    Repeated labels are reduced before the shuffle, so a uuid with very many label events costs one row.
    """
    last = labels.groupBy("uuid").agg(
        F.max_by("label", F.struct("label_ts", "label")).alias("label"), F.max("label_ts").alias("label_ts")
    )
    return preds.join(last, "uuid", "left")


def latest_deployment(models: DataFrame, builds: DataFrame, deployments: DataFrame, name: str | None = None) -> DataFrame:
    """The last build of each model (or of the one named) and that build's last deployment."""
    if name is not None:
        models = models.filter(F.col("model_name") == name)
    last_build = builds.groupBy("model_id").agg(F.max("build_id").alias("build_id"))
    last_deployment = deployments.groupBy("build_id").agg(F.max("deployment_id").alias("deployment_id"))
    return (
        models.join(last_build, "model_id")
        .join(last_deployment, "build_id")
        .select("model_name", "model_id", F.col("build_id").alias("latest_build_id"), F.col("deployment_id").alias("latest_deployment_id"))
    )


def max_version(df: DataFrame, version: str, by=()) -> DataFrame:
    """The row with the highest version per group (see ``version_key``); of equal versions any one."""
    return df.groupBy(*by).agg(F.max_by(F.struct(*[c for c in df.columns if c not in by]), version_key(version)).alias("_m")).select(*by, "_m.*")
