"""Classifiers over encoded features, and the bundled model that scores, explains, saves and loads itself."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.operators import explain as L
from churnspark.operators import forest
from churnspark.operators.cleaning import cast_request, fill_defaults
from churnspark.operators.evaluation import accuracy
from churnspark.operators.features import QUARTILES, FeatureSpec, categories, fit_dictionary, fit_tables, onehot_rows
from churnspark.operators.ordering import exact_quantiles
from churnspark.operators.sampling import folds
from churnspark.session import staged

# Ten inverse regularisation strengths from 1e-4 to 1e4, evenly spaced on a log scale.
STRENGTHS = tuple(float(c) for c in np.logspace(-4, 4, 10))


def preparation(spec: FeatureSpec, onehot: bool = True) -> list:
    """Stages from raw features to a scaled vector: sorted codes, all levels as indicators, then the numerics."""
    codes = [f"{c}_code" for c in spec.categorical]
    index = StringIndexer(inputCols=list(spec.categorical), outputCols=codes, stringOrderType="alphabetAsc", handleInvalid="error")
    stages = [index]
    inputs = [f"{c}_code" if c in spec.categorical else c for c in spec.features]
    if onehot:
        levels = [f"{c}_levels" for c in spec.categorical]
        stages.append(OneHotEncoder(inputCols=codes, outputCols=levels, dropLast=False))
        inputs = levels + list(spec.numeric)
    stages.append(VectorAssembler(inputCols=inputs, outputCol="raw"))
    stages.append(StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True))
    return stages


def with_target(df: DataFrame, label: str, positive: str) -> DataFrame:
    return df.withColumn("target", (F.col(label) == positive).cast("double"))


def _encoded(prep: PipelineModel, df: DataFrame, keep=()) -> tuple[DataFrame, int]:
    """Encode once and write: every fit and every iteration reads only vector and target. Also the row count.

    Files are rebalanced to the advisory partition size, so the number of tasks of an iteration follows the bytes.
    """
    data = staged(prep.transform(df).select("features", "target", *keep).hint("rebalance"), "encoded")
    return data, data.count()


def reg_param(c: float, rows: int, scaled_rows: int) -> float:
    """Spark's strength for inverse strength ``c``: the mean loss replaces the sum over ``rows``.

    The scaler divides by the sample deviation; the factor restores what scaling by the population
    deviation would penalise.
    """
    return (scaled_rows - 1) / scaled_rows / (c * rows)


def _logistic(reg: float, max_iter: int, solver: str = "lbfgs") -> LogisticRegression:
    if solver != "lbfgs":
        raise ValueError(f"solver {solver!r} is not available; use 'lbfgs'")
    return LogisticRegression(
        featuresCol="features", labelCol="target", regParam=reg, elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-6
    )


def fit_logistic(train: DataFrame, spec: FeatureSpec, label: str, positive: str = "Yes", c: float = 1.0, max_iter: int = 100) -> PipelineModel:
    """Encode, scale and fit one logistic regression with inverse strength ``c``."""
    train = with_target(train, label, positive)
    prep = Pipeline(stages=preparation(spec)).fit(train)
    data, n = _encoded(prep, train)
    return PipelineModel(stages=[*prep.stages, _logistic(reg_param(c, n, n), max_iter).fit(data)])


def relational_margin(model: PipelineModel, train: DataFrame, rows: DataFrame, spec: FeatureSpec, key: str) -> tuple[DataFrame, DataFrame]:
    """What a fitted logistic model says, worked out anew from the long one-hot matrix of ``train`` and ``rows``.

    Returns the columns of the matrix (position, name, mean, deviation, weight; weights for columns scaled by the
    population deviation) and (key, margin) of ``rows``.
    """
    spark = train.sparkSession
    dictionary = staged(fit_dictionary(train, spec.categorical), "dictionary")
    n = train.count()
    moments = staged(onehot_rows(train, dictionary, spec, key), "long").groupBy("position", "name").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("ss"))
    mean = F.col("s") / n
    moments = moments.select("position", "name", mean.alias("mean"), F.sqrt(F.greatest(F.col("ss") / n - mean * mean, F.lit(0.0))).alias("deviation"))
    last = model.stages[-1]
    shrink = float(np.sqrt((n - 1) / n)) if n > 1 else 1.0
    weights = spark.createDataFrame([(i, float(w) * shrink) for i, w in enumerate(last.coefficients)], "position int, weight double")
    columns = staged(moments.join(weights, "position"), "columns")  # as many rows as the model has coefficients
    slope = F.when(F.col("deviation") > 0, F.col("weight") / F.col("deviation")).otherwise(0.0)
    offset = columns.agg(F.sum(slope * F.col("mean"))).scalar()
    sums = onehot_rows(rows, dictionary, spec, key).join(columns, ["position", "name"]).groupBy(key).agg(F.sum(F.col("x") * slope).alias("dot"))
    return columns, sums.select(key, (F.col("dot") - offset + F.lit(float(last.intercept))).alias("margin"))


def fit_certificate(model: PipelineModel, train: DataFrame, spec: FeatureSpec, label: str, key: str, positive: str = "Yes", c: float = 1.0) -> DataFrame:
    """(name, weight, gradient): how far each coefficient is from the optimum of C * sum(log loss) + |w|^2 / 2.

    ``gradient`` is the objective's derivative per row of ``train``, from sums over the long one-hot matrix; the
    intercept has no penalty. All of them near zero prove the fit, as the objective is convex.
    """
    columns, margin = relational_margin(model, train, train, spec, key)
    excess = 1.0 / (1.0 + F.exp(-F.col("margin"))) - F.col("target")
    rest = staged(margin.join(with_target(train, label, positive).select(key, "target"), key).select(key, excess.alias("excess")), "excess")
    n, total = rest.count(), rest.agg(F.sum("excess")).scalar()
    dictionary = fit_dictionary(train, spec.categorical)
    sums = onehot_rows(train, dictionary, spec, key).join(rest, key).groupBy("position", "name").agg(F.sum(F.col("x") * F.col("excess")).alias("sx"))
    slope = F.when(F.col("deviation") > 0, (F.col("sx") - F.col("mean") * total) / F.col("deviation")).otherwise(0.0)
    out = columns.join(sums, ["position", "name"]).select("name", "weight", ((c * slope + F.col("weight")) / n).alias("gradient"))
    free = rest.agg(F.lit("intercept").alias("name"), F.lit(float(model.stages[-1].intercept)).alias("weight"), (F.sum("excess") * c / n).alias("gradient"))
    return out.unionByName(free)


@dataclass
class Search:
    """A cross-validated fit: the model, its strength and the mean accuracy per strength."""

    model: PipelineModel
    strength: float
    scores: dict[float, float]


def fit_logistic_cv(
    train: DataFrame, spec: FeatureSpec, label: str, key: str, positive: str = "Yes", cv: int = 5, max_iter: int = 100,
    solver: str = "lbfgs", strengths=STRENGTHS, seed: int = 42, parallelism: int = 8,
) -> Search:
    """Choose the strength by mean accuracy over stratified folds (the weakest on ties) and refit on all rows.

    Encoding and scaling are fitted once on all training rows, and only the classifier is repeated.
    """
    _logistic(0.0, max_iter, solver)  # reject an unknown solver before any work
    train = with_target(folds(train, label, key, cv, seed, name="fold"), label, positive)
    prep = Pipeline(stages=preparation(spec)).fit(train)
    data, n = _encoded(prep, train, keep=["fold"])
    strengths = sorted(strengths)
    classifier = _logistic(0.0, max_iter)
    in_fold = n * (cv - 1) / cv
    grid = ParamGridBuilder().addGrid(classifier.regParam, [reg_param(c, in_fold, n) for c in strengths]).build()
    search = CrossValidator(
        estimator=classifier, estimatorParamMaps=grid, numFolds=cv, foldCol="fold", parallelism=parallelism,
        evaluator=MulticlassClassificationEvaluator(labelCol="target", metricName="accuracy"),
    ).fit(data)
    best = strengths[int(np.argmax(search.avgMetrics))]
    final = _logistic(reg_param(best, n, n), max_iter).fit(data)
    return Search(PipelineModel(stages=[*prep.stages, final]), best, {c: float(a) for c, a in zip(strengths, search.avgMetrics)})


def param_search(train: DataFrame, test: DataFrame, spec: FeatureSpec, label: str, key: str, experiments, positive: str = "Yes") -> DataFrame:
    """One row per experiment (cv, solver, max_iter): chosen strength, train and test accuracy."""
    rows = []
    for cv, solver, max_iter in experiments:
        found = fit_logistic_cv(train, spec, label, key, positive, cv, max_iter, solver)
        sides = [score(found.model, df, label, positive) for df in (train, test)]
        rows.append((cv, solver, max_iter, found.strength, *[round(s, 2) for s in sides]))
    return train.sparkSession.createDataFrame(
        rows, "cv int, solver string, max_iter int, strength double, train_score double, test_score double"
    )


def fit_forest(
    train: DataFrame, spec: FeatureSpec, label: str, positive: str = "Yes", trees: int = 100, max_depth: int = 30, seed: int = 42,
    partitions: int | None = None,
) -> PipelineModel:
    """Random forest on codes and numerics; the codes count as numbers, not as categories. Scaling would not change
    its trees and is left out.

    The model depends on rows, parameters and seed only, not on ``partitions``, into which the rows are dealt.
    """
    train = with_target(train, label, positive)
    prep = Pipeline(stages=preparation(spec, onehot=False)[:-1]).fit(train)
    encoded = staged(prep.transform(train).select("raw", "target").hint("rebalance"), "encoded")
    return PipelineModel(stages=[*prep.stages, forest.fit(encoded, len(spec.features), trees, max_depth, seed, partitions)])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with ``probability`` (of the positive class) and ``prediction`` (0 or 1)."""
    scored = model.transform(df.drop("probability", "prediction"))
    others = [c for c in df.columns if c not in ("probability", "prediction")]
    return scored.select(*others, vector_to_array("probability")[1].alias("probability"), F.col("prediction").cast("int").alias("prediction"))


def predict_label(model: PipelineModel, df: DataFrame, positive: str = "Yes", negative: str = "No") -> DataFrame:
    out = predict(model, df)
    return out.withColumn("predicted", F.when(F.col("prediction") == 1, positive).otherwise(negative))


def score(model: PipelineModel, df: DataFrame, label: str, positive: str = "Yes") -> float:
    """Share of correct predictions."""
    scored = with_target(predict(model, df), label, positive)
    return accuracy(scored, "target", "prediction").first()["accuracy"]


def compare_models(models: dict[str, PipelineModel], train: DataFrame, test: DataFrame, label: str, positive: str = "Yes") -> DataFrame:
    """(model, side, accuracy, n) of every model on both sides of the split."""
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    parts = [
        accuracy(with_target(predict(m, both), label, positive), "target", "prediction", by=["side"]).select(
            F.lit(name).alias("model"), "side", "accuracy", "n"
        )
        for name, m in models.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass
class ExplainedModel:
    """A fitted model with what serving needs beside it: defaults, statistics, dictionary and draw cells."""

    spec: FeatureSpec
    label: str
    model: PipelineModel
    dictionary: DataFrame
    defaults: DataFrame
    stats: DataFrame
    perturbation: L.Perturbation
    types: T.StructType = field(repr=False)

    @staticmethod
    def build(data: DataFrame, spec: FeatureSpec, label: str, model: PipelineModel) -> ExplainedModel:
        """Bundle ``model`` with the tables fitted on all cleaned rows of ``data``."""
        features = data.select(*spec.features)
        quantiles = exact_quantiles(features, list(spec.numeric), QUARTILES)
        dictionary, defaults, stats = fit_tables(features, spec, quantiles)
        perturbation = L.Perturbation.fit(features, spec, quantiles)
        return ExplainedModel(spec, label, model, dictionary, defaults, stats, perturbation, features.schema)

    @property
    def label_name(self) -> str:
        return f"{self.label} probability"

    @property
    def categories(self) -> DataFrame:
        return categories(self.dictionary)

    def predict(self, df: DataFrame) -> DataFrame:
        return predict(self.model, df).drop("prediction")

    def predict_df(self, df: DataFrame) -> DataFrame:
        """``df`` with the probability under the name ``<label> probability``."""
        return self.predict(df).withColumnRenamed("probability", self.label_name)

    def explain(self, df: DataFrame, n_samples: int = 5000, k: int = 10, seed: int = 1) -> DataFrame:
        return L.explain(df, self.perturbation, self.predict, n_samples, k, seed)

    def serve(self, requests: DataFrame, key: str, n_samples: int = 5000, k: int = 10, seed: int = 1, carry=()) -> DataFrame:
        """(key, carry..., data, probability, explanation) for requests that name any subset of the features."""
        cast = cast_request(requests, self.types, keep=[key, *carry])
        filled = staged(fill_defaults(cast, self.defaults).select(key, *carry, *self.spec.features), "requests")
        return self._answers(filled, [key, *carry], n_samples, k, seed)

    def serve_readable(self, requests: DataFrame, key: str, n_samples: int = 5000, k: int = 10, seed: int = 1, carry=()) -> tuple[DataFrame, DataFrame]:
        """What :meth:`serve` returns for the requests that can be read, and the others: (key, carry..., request,
        unreadable), the request as JSON and the names of its unreadable fields."""
        kept = [key, *carry]
        fields = [c for c in requests.columns if c not in kept]
        raw = requests.withColumn("_request", F.to_json(F.struct(*fields)) if fields else F.lit("{}"))
        cast = cast_request(raw, self.types, keep=[*kept, "_request"], rejected="_unreadable")
        text = F.when(F.col("_unreadable").isNotNull(), F.col("_request")).alias("_request")
        filled = fill_defaults(cast, self.defaults).select(*kept, *self.spec.features, text, "_unreadable")
        filled = staged(filled, "requests")
        rejected = filled.where("_unreadable IS NOT NULL").select(*kept, F.col("_request").alias("request"), F.col("_unreadable").alias("unreadable"))
        return self._answers(filled.where("_unreadable IS NULL").select(*kept, *self.spec.features), kept, n_samples, k, seed), rejected

    def _answers(self, filled: DataFrame, kept: list[str], n_samples: int, k: int, seed: int) -> DataFrame:
        out = self.explain(filled, n_samples, k, seed)
        return out.select(*kept, F.struct(*self.spec.features).alias("data"), "probability", "explanation")

    def what_if(self, df: DataFrame, key: str, feature: str, numbers=None) -> DataFrame:
        """Re-score with every category of a categorical feature, or with the supplied numbers of a numeric one."""
        if feature in self.spec.categorical:
            values = L.category_values(self.dictionary, feature)
        else:
            values = F.array(*[F.lit(float(v)) for v in numbers])
        return L.what_if(df, key, feature, values, self.predict)

    def feature_card(self, explained: DataFrame, key: str) -> DataFrame:
        return L.feature_card(explained, key, self.spec, self.stats, self.dictionary)

    def save(self, path: str) -> None:
        """Write everything under ``path``, replacing an earlier model there."""
        self.model.write().overwrite().save(f"{path}/model")
        for name in ("dictionary", "defaults", "stats"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")
        self.perturbation.cells.write.mode("overwrite").parquet(f"{path}/cells")
        meta = {"features": self.spec.features, "categorical": self.spec.categorical, "label": self.label, "types": self.types.jsonValue()}
        spark = self.dictionary.sparkSession
        spark.createDataFrame([(json.dumps(meta),)], "value string").write.mode("overwrite").text(f"{path}/spec")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ExplainedModel:
        """Read a saved model; a missing path raises."""
        meta = json.loads(spark.read.text(f"{path}/spec").first()["value"])
        spec = FeatureSpec(tuple(meta["features"]), tuple(meta["categorical"]))
        read = lambda name: spark.read.parquet(f"{path}/{name}")
        return ExplainedModel(
            spec, meta["label"], PipelineModel.load(f"{path}/model"), read("dictionary"), read("defaults"), read("stats"),
            L.Perturbation(spec, read("cells")), T.StructType.fromJson(meta["types"]),
        )
