"""Queries over feature encoding, classifiers and scoring.

Where the model has fixed coefficients the result is checked against SQL; fitted models are checked by the
test suite (zero gradient at the fit, equal scores after reload, invariants of the split).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.operators import features as X
from churnspark.operators import models as M
from churnspark.operators.sampling import train_test_split
from churnspark.plans.cleaning import DICTIONARY_CTE, SPEC
from churnspark.plans.frames import CATEGORICAL, FEATURES, NUMERIC, PLANTED_SQL, CLEAN_CTE, clean_churn, planted_probability
from churnspark.plans.registry import query
from churnspark.session import scratch_path, staged

LABEL = "churn_planted"


def training_rows(spark, sf) -> DataFrame:
    """Cleaned customers with the label that carries a signal, marked as train or test."""
    rows = staged(clean_churn(spark, sf).select("customer_id", *FEATURES, LABEL), "training")
    return staged(train_test_split(rows, "customer_id", 0.25, 42), "split")


def sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.filter(~F.col("is_test")), rows.filter("is_test")


def planted(df: DataFrame) -> DataFrame:
    """The fixed-coefficient model."""
    return df.withColumn("probability", planted_probability())


@query(
    f"""with {CLEAN_CTE} {" union all ".join(
        f"select '{c}' as feature, {str(c in CATEGORICAL).lower()} as is_categorical, {i} as position, count({c}) as n from clean" for i, c in enumerate(FEATURES))}"""
)
def infer_feature_spec(spark, sf):
    """Features and kinds read off the schema, with the values known for each."""
    clean = clean_churn(spark, sf).drop("churn")
    spec = X.FeatureSpec.infer(clean, label=LABEL, drop=("customer_id",))
    counts = clean.agg(*[F.count(c).alias(c) for c in spec.features])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(c in spec.categorical).alias("is_categorical"), F.lit(i).alias("position"), F.col(c).alias("n"))
        for i, c in enumerate(spec.features)
    ])).alias("f")).select("f.*")


@query(
    f"""with {DICTIONARY_CTE} select customer_id, {", ".join(
        f"cast((select code from dictionary d where d.feature = '{c}' and d.value = clean.{c}) as double) as {c}" for c in CATEGORICAL)},
    {", ".join(NUMERIC)} from clean"""
)
def encode_ordinal(spark, sf):
    clean = staged(clean_churn(spark, sf).select("customer_id", *FEATURES))
    dictionary = staged(X.fit_dictionary(clean, CATEGORICAL), "dictionary")
    return X.encode_ordinal(clean, dictionary, SPEC)


_FEATURE_ORDER = " ".join(f"when '{c}' then {i}" for i, c in enumerate(CATEGORICAL))
ONEHOT_CTE = f"""{DICTIONARY_CTE},
levels as (select feature, value, cast(row_number() over (order by case feature {_FEATURE_ORDER} end, value) - 1 as integer) as position from dictionary),
matrix as (
  {" union all ".join(f"select customer_id, position, '{c}=' || value as name, 1e0 as x from clean join levels on levels.feature = '{c}' and levels.value = clean.{c}" for c in CATEGORICAL)}
  union all {" union all ".join(f"select customer_id, cast((select count(*) from levels) + {i} as integer), '{c}', {c} from clean" for i, c in enumerate(NUMERIC))})
"""


@query(f"with {ONEHOT_CTE} select customer_id, position, name, x from matrix")
def encode_onehot(spark, sf):
    """The model matrix in long form, zero entries left out."""
    clean = staged(clean_churn(spark, sf).select("customer_id", *FEATURES))
    dictionary = staged(X.fit_dictionary(clean, CATEGORICAL), "dictionary")
    return X.onehot_rows(clean, dictionary, SPEC, "customer_id")


_CODED = ", ".join(
    f"cast((select code from dictionary d where d.feature = '{c}' and d.value = clean.{c}) as double) as {c}" for c in CATEGORICAL
)


@query(
    f"""with {DICTIONARY_CTE}, coded as (select customer_id, {_CODED}, {", ".join(NUMERIC)} from clean)
    select customer_id, {", ".join(f"round(({c} - avg({c}) over ()) / stddev_pop({c}) over (), 6) + 0e0 as {c}" for c in FEATURES)} from coded"""
)
def standardize(spark, sf):
    """Codes and numerics scaled by mean and population deviation."""
    clean = staged(clean_churn(spark, sf).select("customer_id", *FEATURES))
    dictionary = staged(X.fit_dictionary(clean, CATEGORICAL), "dictionary")
    coded = staged(X.encode_ordinal(clean, dictionary, SPEC), "coded")
    scaled = X.standardize(coded, FEATURES, X.fit_scaler(coded, FEATURES))
    return scaled.select("customer_id", *[(F.round(c, 6) + 0.0).alias(c) for c in FEATURES])


@query()
def fit_model(spark, sf):
    """Encode, scale and classify as one fitted object: its coefficients by name."""
    train, _ = sides(training_rows(spark, sf))
    model = M.fit_logistic(train, SPEC, LABEL)
    indexer, lr = model.stages[0], model.stages[-1]
    names = [f"{c}={v}" for c, labels in zip(SPEC.categorical, indexer.labelsArray) for v in labels] + list(SPEC.numeric)
    rows = [("intercept", float(lr.intercept))] + [(n, float(w)) for n, w in zip(names, lr.coefficients)]
    return spark.createDataFrame(rows, "name string, weight double")


@query(f"""with {ONEHOT_CTE} select name, true as stationary from (select distinct name from matrix) union all select 'intercept', true""")
def fit_gradient(spark, sf):
    """The coefficients of `fit_model`: no step along any of them lowers the penalised loss."""
    train, _ = sides(training_rows(spark, sf))
    found = M.fit_certificate(M.fit_logistic(train, SPEC, LABEL), train, SPEC, LABEL, "customer_id")
    return found.select("name", (F.abs("gradient") < 1e-4).alias("stationary"))


@query(f"with {CLEAN_CTE} select customer_id, true as same, true as same_label from clean")
def score_residual(spark, sf):
    """The scores of `score_probability` and `score_label` against the sigmoid of the margin from the long matrix."""
    rows = training_rows(spark, sf)
    train = sides(rows)[0]
    model = M.fit_logistic(train, SPEC, LABEL)
    _, margin = M.relational_margin(model, train, rows, SPEC, "customer_id")
    p = 1.0 / (1.0 + F.exp(-F.col("margin")))
    both = M.predict_label(model, rows).join(margin, "customer_id")
    agrees = (F.col("predicted") == "Yes") == (F.col("margin") > 0)
    return both.select("customer_id", (F.abs(p - F.col("probability")) < 1e-9).alias("same"), (agrees | (F.abs("margin") < 1e-9)).alias("same_label"))


@query("select round(-4 + 8 * i / 9e0, 6) + 0e0 as log_strength, true as as_ruled from range(10) t(i)")
def cv_choice(spark, sf):
    """The strength that `logreg_cv` chooses is the weakest of those with the best mean accuracy, and its refit is optimal."""
    train, _ = sides(training_rows(spark, sf))
    found = M.fit_logistic_cv(train, SPEC, LABEL, "customer_id")
    best = max(found.scores.values())
    right = found.strength == min(c for c, a in found.scores.items() if a == best) and all(0 <= a <= 1 for a in found.scores.values())
    worst = M.fit_certificate(found.model, train, SPEC, LABEL, "customer_id", c=found.strength).agg(F.max(F.abs("gradient")).alias("g")).first()["g"]
    rows = [(round(math.log10(c), 6) + 0.0, right and worst < 1e-3) for c in found.scores]
    return spark.createDataFrame(rows, "log_strength double, as_ruled boolean")


@query()
def logreg_cv(spark, sf):
    """Mean cross-validated accuracy per strength, the chosen one marked."""
    train, _ = sides(training_rows(spark, sf))
    found = M.fit_logistic_cv(train, SPEC, LABEL, "customer_id")
    rows = [(float(c), float(a), c == found.strength) for c, a in found.scores.items()]
    return spark.createDataFrame(rows, "strength double, mean_accuracy double, chosen boolean")


@query()
def param_search(spark, sf):
    train, test = sides(training_rows(spark, sf))
    return M.param_search(train, test, SPEC, LABEL, "customer_id", [(3, "lbfgs", 50), (5, "lbfgs", 100)])


@query()
def random_forest(spark, sf):
    """Class probability of every customer by the forest."""
    rows = training_rows(spark, sf)
    model = M.fit_forest(sides(rows)[0], SPEC, LABEL)
    return M.predict(model, rows).select("customer_id", "is_test", LABEL, "probability", "prediction")


@query(f"with {CLEAN_CTE} select customer_id, round({PLANTED_SQL}, 9) as probability from clean")
def score_fixed(spark, sf):
    """Scores of the fixed-coefficient model."""
    return planted(clean_churn(spark, sf)).select("customer_id", F.round("probability", 9).alias("probability"))


@query()
def score_probability(spark, sf):
    """Every cleaned row, train and test, with its probability under the label's name."""
    rows = training_rows(spark, sf)
    model = M.fit_logistic(sides(rows)[0], SPEC, LABEL)
    return M.predict(model, rows).select("customer_id", *FEATURES, F.col("probability").alias(f"{LABEL} probability"))


@query()
def score_label(spark, sf):
    rows = training_rows(spark, sf)
    model = M.fit_logistic(sides(rows)[0], SPEC, LABEL)
    return M.predict_label(model, rows).select("customer_id", LABEL, "predicted")


@query()
def compare_models(spark, sf):
    """Train and test accuracy of the logistic model and the forest."""
    train, test = sides(training_rows(spark, sf))
    models = {"logistic": M.fit_logistic(train, SPEC, LABEL), "forest": M.fit_forest(train, SPEC, LABEL)}
    return M.compare_models(models, train, test, LABEL)


def explained_model(spark, sf) -> tuple[M.ExplainedModel, DataFrame]:
    """A logistic model fitted on the train side and bundled over all cleaned rows."""
    rows = training_rows(spark, sf)
    model = M.fit_logistic(sides(rows)[0], SPEC, LABEL)
    return M.ExplainedModel.build(rows, SPEC, LABEL, model), rows.select("customer_id", *FEATURES)


@query(f"with {CLEAN_CTE} select customer_id, true as same_score from clean")
def model_save_load(spark, sf):
    """Every customer scored by the model and by its reloaded copy."""
    em, rows = explained_model(spark, sf)
    path = scratch_path(spark, "model")
    em.save(path)
    again = M.ExplainedModel.load(spark, path)
    both = again.predict(em.predict(rows).withColumnRenamed("probability", "first"))
    return both.select("customer_id", (F.abs(F.col("first") - F.col("probability")) < 1e-12).alias("same_score"))
