"""Queries over counts, statistics, distributions and classification metrics."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from churnspark.operators import evaluation as E
from churnspark.operators import explore as P
from churnspark.operators import features as X
from churnspark.operators.explain import map_extent, quartile_cells
from churnspark.operators.ordering import exact_quantiles
from churnspark.operators.sampling import train_test_split
from churnspark.plans.cleaning import DICTIONARY_CTE, SPEC
from churnspark.plans.frames import (
    CATEGORICAL, CHURN_CTE, CLEAN_CTE, LOG_CTE, NUMERIC, PLANTED_SCORE_SQL, SCORES_CTE,
    churn_frame, clean_churn, inference_log, labelled_scores, planted_score,
)
from churnspark.plans.joins import STATS_CTE
from churnspark.plans.registry import query
from churnspark.session import staged


@query(f"with {CHURN_CTE} select count(*) as n from churn")
def count_all(spark, sf):
    return churn_frame(spark, sf).agg(F.count("*").alias("n"))


@query(f'with {CHURN_CTE} select last_priority, count(*) as "count" from churn group by last_priority')
def group_count(spark, sf):
    return P.group_count(churn_frame(spark, sf), "last_priority")


@query(f"with {CHURN_CTE} select churn, count(*) as n from churn group by churn")
def sql_group_count(spark, sf):
    churn_frame(spark, sf).createOrReplaceTempView("churn_by_label")
    return spark.sql("SELECT churn, count(*) AS n FROM churn_by_label GROUP BY churn")


@query(f'with {CHURN_CTE} select last_priority, count(*) as "count" from churn where last_priority is not null group by last_priority')
def group_count_nonnull(spark, sf):
    return P.group_count(churn_frame(spark, sf), "last_priority", dropna=True)


@query(
    f"""with {CHURN_CTE} select count(*) as total, count(*) filter (where churn = 'Yes') as churned,
    count(*) filter (where churn = 'No') as remained from churn where churn is not null"""
)
def churn_totals(spark, sf):
    return P.churn_totals(churn_frame(spark, sf), "churn")


@query(
    f"""with {CLEAN_CTE}, {STATS_CTE} select feature, round(median, 4) as median, round(mean, 4) as mean,
    round(min, 4) as min, round(max, 4) as max, round(std, 4) as std from stats"""
)
def numeric_stats(spark, sf):
    stats = X.numeric_stats(staged(clean_churn(spark, sf)), NUMERIC)
    return stats.select("feature", *[F.round(c, 4).alias(c) for c in ("median", "mean", "min", "max", "std")])


@query(
    f"""with {CLEAN_CTE} select {", ".join(f"min({c}) as {c}" for c in CATEGORICAL)},
    {", ".join(f"quantile_cont({c}, 0.5) as {c}" for c in NUMERIC)} from clean"""
)
def default_values(spark, sf):
    return X.default_values(staged(clean_churn(spark, sf)), SPEC)


@query(f"with {DICTIONARY_CTE} select feature, value, code from dictionary")
def category_dictionary(spark, sf):
    return X.fit_dictionary(clean_churn(spark, sf), CATEGORICAL)


@query(
    f"""with {CHURN_CTE}, s as (select min(tenure) as lo, max(tenure) as hi, count(tenure) as n,
      quantile_cont(tenure, 0.75) - quantile_cont(tenure, 0.25) as iqr from churn),
    b as (select lo, hi, cast(least(50, case when iqr = 0 then floor(sqrt(n))
      else ceil((hi - lo) / (2e0 * iqr / pow(n, 1e0 / 3e0))) end) as integer) as bins from s),
    c as (select cast(least(bins - 1, floor((tenure - lo) / (hi - lo) * bins)) as integer) as bin, count(*) as n
      from churn, b where tenure is not null group by 1),
    g as (select unnest(range(bins)) as bin, lo, hi, bins from b)
    select cast(g.bin as integer) as bin, round(lo + g.bin * (hi - lo) / bins, 6) as lo,
      round(lo + (g.bin + 1) * (hi - lo) / bins, 6) as hi, coalesce(c.n, 0) as n
    from g left join c on g.bin = c.bin"""
)
def histogram(spark, sf):
    h = P.histogram(staged(churn_frame(spark, sf).select("tenure")), "tenure")
    return h.select("bin", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), "n")


@query(
    f"""with {CHURN_CTE}, q as (select churn, quantile_cont(tenure, 0.25) as q1, quantile_cont(tenure, 0.5) as median,
      quantile_cont(tenure, 0.75) as q3 from churn where churn is not null and tenure is not null group by churn)
    select churn, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
      min(tenure) filter (where tenure between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as whisker_lo,
      max(tenure) filter (where tenure between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as whisker_hi,
      count(*) filter (where not (tenure between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))) as outliers
    from churn join q using (churn) where tenure is not null group by churn, q1, median, q3"""
)
def box_stats(spark, sf):
    b = P.box_stats(staged(churn_frame(spark, sf).select("churn", "tenure")), "churn", "tenure")
    return b.select("churn", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")], "whisker_lo", "whisker_hi", "outliers")


PAIRS = list(combinations(["monthly_charges", "total_charges", "tenure"], 2))
_BIN = "cast(least(9, floor(({c} - {c}_lo) / ({c}_hi - {c}_lo) * 10)) as integer)"


@query(
    f"""with {CHURN_CTE}, e as (select {", ".join(f"min({c}) as {c}_lo, max({c}) as {c}_hi" for c in NUMERIC)} from churn),
    b as (select churn, {", ".join(_BIN.format(c=c) + f" as {c}_bin" for c in NUMERIC)} from churn, e)
    select churn, x, y, x_bin, y_bin, count(*) as n from (
      {" union all ".join(f"select churn, '{a}' as x, '{b}' as y, {a}_bin as x_bin, {b}_bin as y_bin from b" for a, b in PAIRS)})
    where x_bin is not null and y_bin is not null group by churn, x, y, x_bin, y_bin"""
)
def pairwise_bins(spark, sf):
    return P.pairwise_bins(staged(churn_frame(spark, sf)), ["monthly_charges", "total_charges", "tenure"], "churn")


@query(
    f"""with {CHURN_CTE} {" union all ".join(
        f"select churn, '{a}' as x, '{b}' as y, round(corr({a}, {b}), 9) as corr from churn where churn is not null group by churn"
        for a, b in PAIRS)}"""
)
def pairwise_corr(spark, sf):
    known = churn_frame(spark, sf).filter(F.col("churn").isNotNull())
    c = P.pairwise_corr(known, ["monthly_charges", "total_charges", "tenure"], "churn")
    return c.withColumn("corr", F.round("corr", 9))


@query(
    f"""with {CHURN_CTE}, v as (select churn, tenure as v, count(*) as c from churn
      where churn is not null and tenure is not null group by churn, tenure),
    s as (select churn, count(*) as n, stddev_samp(tenure) * pow(count(*), -0.2e0) as h, min(tenure) as mn, max(tenure) as mx
      from churn where churn is not null and tenure is not null group by churn),
    g as (select churn, h, mn - 3 * h as lo, mx + 3 * h as hi, unnest(range(200)) as point from s)
    select g.churn, cast(point as integer) as point, round(lo + point * (hi - lo) / 199, 6) as x,
      round(sum(c * exp(-0.5e0 * pow((lo + point * (hi - lo) / 199 - v) / h, 2))) / (any_value(h) * sqrt(2 * pi()))
        / (select sum(c) from v), 9) as density
    from g join v on g.churn = v.churn group by g.churn, point, lo, hi"""
)
def density_by_class(spark, sf):
    d = P.density_by_class(churn_frame(spark, sf), "tenure", "churn")
    return d.select("churn", "point", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


@query(
    f"""with {CHURN_CTE}, v as (select churn, monthly_charges as v from churn where churn is not null and monthly_charges is not null),
    s as (select churn, stddev_samp(v) * pow(count(*), -0.2e0) as h, min(v) as mn, max(v) as mx from v group by churn),
    g as (select churn, h, mn - 3 * h as lo, mx + 3 * h as hi, ((mx + 3 * h) - (mn - 3 * h)) / 4095 as step from s),
    c as (select g.churn, floor((v - lo) / step) as i, (v - lo) / step - floor((v - lo) / step) as far from v join g on v.churn = g.churn),
    w as (select churn, i, sum(w) as w from (select churn, i, 1 - far as w from c union all select churn, i + 1, far from c) group by churn, i),
    p as (select *, unnest(range(200)) as point from g)
    select p.churn, cast(point as integer) as point, round(lo + point * (hi - lo) / 199, 4) as x,
      round(1e6 * sum(w * exp(-0.5e0 * pow((lo + point * (hi - lo) / 199 - lo - i * step) / h, 2))) / (any_value(h) * sqrt(2 * pi())) / (select count(*) from v), 6) as density
    from p join w on p.churn = w.churn group by p.churn, point, lo, hi"""
)
def binned_density(spark, sf):
    """Densities per million of the mean charge, a column with as many values as rows."""
    d = P.binned_density(churn_frame(spark, sf), "monthly_charges", "churn")
    return d.select("churn", "point", F.round("x", 4).alias("x"), F.round(1e6 * F.col("density"), 6).alias("density"))


@query(f"with {SCORES_CTE} select y as actual, yhat as predicted, count(*) as n from scores where y is not null group by y, yhat")
def confusion_matrix(spark, sf):
    return E.confusion(labelled_scores(spark, sf), "y", "yhat")


@query(
    f"""with {SCORES_CTE}, cm as (select y, yhat, count(*) as n from scores where y is not null group by y, yhat),
    k as (select y as c from cm union select yhat from cm),
    t as (select cast(c as varchar) as class,
      coalesce(sum(n) filter (where y = c and yhat = c), 0) as tp, coalesce(sum(n) filter (where y = c), 0) as support,
      coalesce(sum(n) filter (where yhat = c), 0) as predicted from k, cm group by c),
    p as (select class, tp, support, case when predicted = 0 then 0e0 else tp / predicted end as precision,
      case when support = 0 then 0e0 else tp / support end as recall from t),
    f as (select *, case when precision + recall = 0 then 0e0 else 2 * precision * recall / (precision + recall) end as f1 from p)
    select class, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1, cast(support as bigint) as support from (
      select class, precision, recall, f1, support from f
      union all select 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) from f
      union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from f
      union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
        sum(f1 * support) / sum(support), sum(support) from f)"""
)
def classification_report(spark, sf):
    r = E.classification_report(labelled_scores(spark, sf), "y", "yhat")
    return r.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


_SPLIT_SQL = """row_number() over (order by md5('42:' || cast(doc_id as varchar)), doc_id)
      <= ceil(0.25e0 * count(*) over ())"""


@query(
    f"""with {SCORES_CTE}, s as (select *, {_SPLIT_SQL} as is_test from scores where y is not null)
    select is_test, round(avg(cast(y = yhat as double)), 9) as accuracy, count(*) as n from s group by is_test"""
)
def accuracy_score(spark, sf):
    """Share correct on the train and on the test side of the split."""
    known = labelled_scores(spark, sf).filter(F.col("y").isNotNull())
    split = train_test_split(known, "doc_id", 0.25, 42)
    return E.accuracy(split, "y", "yhat", by=["is_test"]).withColumn("accuracy", F.round("accuracy", 9))


@query(
    f"""with {SCORES_CTE}, r as (select y, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2e0 as rk
      from scores where y is not null)
    select round((sum(rk) filter (where y = 1) - sum(y) * (sum(y) + 1) / 2e0) / (sum(y) * cast(count(*) - sum(y) as double)), 9) as auc from r"""
)
def auc(spark, sf):
    return E.auc(labelled_scores(spark, sf), "y", "score").select(F.round("auc", 9).alias("auc"))


@query(
    f"""with {CLEAN_CTE} {" union all ".join(
        f"select '{c}' as feature, round(avg({c}), 4) as mean, round(stddev_pop({c}), 4) as std from clean" for c in NUMERIC)}"""
)
def standardize_params(spark, sf):
    return X.fit_scaler(clean_churn(spark, sf), NUMERIC).select("feature", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


@query(
    f"""with {CLEAN_CTE}, v as ({" union all ".join(f"select '{c}' as feature, {c} as v from clean" for c in NUMERIC)}),
    q as (select feature, quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as q2, quantile_cont(v, 0.75) as q3,
      min(v) as lo, max(v) as hi, count(*) as total from v group by feature),
    b as (select v.feature, v, cast(v > q1 as integer) + cast(v > q2 as integer) + cast(v > q3 as integer) as bin, q1, q2, q3, lo, hi, total
      from v join q on v.feature = q.feature)
    select feature, bin, round(avg(v), 4) as mean, round(stddev_pop(v), 4) as std, count(*) as n, round(count(*) / any_value(total), 9) as share,
      round(any_value(case bin when 0 then lo when 1 then q1 when 2 then q2 else q3 end), 4) as min,
      round(any_value(case bin when 0 then q1 when 1 then q2 when 2 then q3 else hi end), 4) as max
    from b group by feature, bin"""
)
def quartile_bins(spark, sf):
    cells = quartile_cells(staged(clean_churn(spark, sf).select(*NUMERIC)), NUMERIC)
    return cells.select(
        "feature", "bin", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "n",
        F.round("share", 9).alias("share"), F.round("min", 4).alias("min"), F.round("max", 4).alias("max"),
    )


@query(
    f"""with {DICTIONARY_CTE} select feature, value, count(*) as n,
    round(count(*) / sum(count(*)) over (partition by feature), 9) as share from cats group by feature, value"""
)
def category_frequencies(spark, sf):
    return X.category_frequencies(clean_churn(spark, sf), CATEGORICAL).withColumn("share", F.round("share", 9))


@query(
    f"""with {CLEAN_CTE}, w as (select customer_id, unnest(['segment', 'senior', 'tenure', 'charges']) as k, unnest([
        1.6e0 * cast(segment = 'BUILDING' as double), 1e0 * cast(senior = 'Yes' as double), -0.12e0 * (tenure - 52), 0.000004e0 * (monthly_charges - 250000)]) as v
      from clean),
    p as (select {PLANTED_SCORE_SQL} as s from clean)
    select round((select min(v) from w), 6) as weight_min, round((select max(v) from w), 6) as weight_max,
      round(min(1e0 / (1e0 + exp(-s))), 9) as probability_min, round(max(1e0 / (1e0 + exp(-s))), 9) as probability_max from p"""
)
def nested_extent(spark, sf):
    """Extent over every value of every weight map, and of the probability, in one pass."""
    clean = clean_churn(spark, sf)
    weights = F.create_map(
        F.lit("segment"), F.lit(1.6) * (F.col("segment") == "BUILDING").cast("double"),
        F.lit("senior"), F.lit(1.0) * (F.col("senior") == "Yes").cast("double"),
        F.lit("tenure"), F.lit(-0.12) * (F.col("tenure") - 52.0),
        F.lit("charges"), F.lit(0.000004) * (F.col("monthly_charges") - 250000.0),
    )
    scored = clean.select(weights.alias("explanation"), (1.0 / (1.0 + F.exp(-planted_score()))).alias("probability"))
    ext = map_extent(scored, "explanation", "probability")
    return ext.select(
        F.round("weight_min", 6).alias("weight_min"), F.round("weight_max", 6).alias("weight_max"),
        F.round("probability_min", 9).alias("probability_min"), F.round("probability_max", 9).alias("probability_max"),
    )


@query(
    f"""with {LOG_CTE} select deployment, time_bucket(interval 1 hour, ts) as window_start, time_bucket(interval 1 hour, ts) + interval 1 hour as window_end,
    round(avg(cast((probability >= 0.5) = (label_raw = 'Yes') as double)), 9) as accuracy, count(*) as n
    from log where label_ts is not null group by deployment, 2, 3"""
)
def accuracy_by_time(spark, sf):
    log = inference_log(spark, sf).filter(F.col("label_ts").isNotNull()).select(
        "deployment", "ts", (F.col("probability") >= 0.5).alias("yhat"), (F.col("label_raw") == "Yes").alias("y")
    )
    per = E.accuracy_by_window(log, "ts", "y", "yhat", "1 hour", by=["deployment"])
    return per.select(
        "deployment", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), F.round("accuracy", 9).alias("accuracy"), "n",
    )


@query(
    f"""with {CLEAN_CTE} {" union all ".join(
        f"select '{c}' as feature, {p}e0 as prob, round(quantile_cont({c}, {p}), 6) as value from clean" for c in NUMERIC for p in (0.25, 0.5, 0.75))}"""
)
def quartiles(spark, sf):
    q = exact_quantiles(staged(clean_churn(spark, sf).select(*NUMERIC)), NUMERIC, [0.25, 0.5, 0.75])
    return q.withColumn("value", F.round("value", 6))
