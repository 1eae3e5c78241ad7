"""Scoring from a coefficient table, and a check of a fit.

A model is a table (feature, coef): numeric columns by name, plan levels as
``plan_type_<level>``, and ``INTERCEPT``. Scoring is one Spark expression over
that table's few rows: one-hot by looking a row's level up (a level the table
doesn't have adds nothing), dot product, sigmoid. No MLlib object is needed
where scores are made, and any table of that form can be scored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import model as md

INTERCEPT = "(intercept)"
LEVEL = "plan_type_"
#: Below this share of a coefficient's data term a residual counts as none.
TOLERANCE = 1e-3


def coefficient_table(model: PipelineModel) -> DataFrame:
    """A fitted model as (feature, coef), the intercept included."""
    names = [*md.NUMERIC_FEATURES, *(f"{LEVEL}{v}" for v in model.stages[0].labels), INTERCEPT]
    fitted = model.stages[-1]
    values = [*fitted.coefficients.toArray().tolist(), float(fitted.intercept)]
    return SparkSession.active().createDataFrame(list(zip(names, values)), "feature string, coef double")


def _with_coefficients(rows: DataFrame, coefficients: DataFrame) -> DataFrame:
    """``rows`` beside the whole table as one map (as many entries as the model has coefficients)."""
    table = coefficients.agg(F.map_from_entries(F.collect_list(F.struct("feature", "coef"))).alias("_coefficients"))
    return rows.crossJoin(F.broadcast(table))


def margin() -> Column:
    """M5/M6: intercept plus dot product; missing values, levels and coefficients add nothing."""
    def value(key: Column) -> Column:
        return F.coalesce(F.try_element_at(F.col("_coefficients"), key), F.lit(0.0))
    terms = [value(F.lit(c)) * F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in md.NUMERIC_FEATURES]
    terms.append(value(F.concat(F.lit(LEVEL), F.coalesce("plan_type", F.lit("")))))
    return reduce(lambda a, b: a + b, terms, value(F.lit(INTERCEPT)))


def probability(z: Column) -> Column:
    """M8: the positive class's probability."""
    return 1.0 / (1.0 + F.exp(-z))


def score(rows: DataFrame, coefficients: DataFrame) -> DataFrame:
    """company_id, as_of_date, label, churn_probability of snapshots."""
    return _with_coefficients(rows, coefficients).select(*md.ID_COLS, F.col(md.LABEL).alias("label"), probability(margin()).alias("churn_probability"))


def residuals(weighted: DataFrame, coefficients: DataFrame) -> DataFrame:
    """M7: how far a fit is from the stated objective's optimum.

    ``weighted``: training snapshots with their class weight (``weight``). For
    each coefficient b with column x the objective C * sum(w * loss) + |b|^2/2
    has the first-order residual C * sum(w * (p - y) * x) + b (the intercept
    without b). One row a coefficient: feature, residual, scale (the data
    term, C * sum(w * |x|)), within_tolerance. One aggregate pass."""
    rows = _with_coefficients(weighted, coefficients)
    error = md.C * F.col("weight") * (probability(margin()) - F.col(md.LABEL))
    size = md.C * F.col("weight")
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in md.NUMERIC_FEATURES]
    entries += [F.struct(F.concat(F.lit(LEVEL), "plan_type").alias("feature"), F.lit(1.0).alias("x")),
                F.struct(F.lit(INTERCEPT).alias("feature"), F.lit(1.0).alias("x"))]
    terms = rows.select(error.alias("error"), size.alias("size"), F.inline(F.array(*entries)))
    sums = terms.groupBy("feature").agg(F.sum(F.col("error") * F.col("x")).alias("data"),
                                        F.sum(F.col("size") * F.abs("x")).alias("scale"))
    penalty = F.when(F.col("feature") == INTERCEPT, 0.0).otherwise(F.col("coef"))
    found = coefficients.join(sums, "feature", "left").select(
        "feature", (F.coalesce("data", F.lit(0.0)) + penalty).alias("residual"), F.coalesce("scale", F.lit(0.0)).alias("scale"))
    return found.withColumn("within_tolerance", F.abs("residual") <= TOLERANCE * F.greatest("scale", F.lit(1.0)))


def discriminant(train: DataFrame) -> DataFrame:
    """A model in closed form: (feature, coef) of a discriminant that takes the
    columns as independent and the classes as equally frequent.

    coef = (mean of churners - mean of others) / variance inside the classes
    (0 for a column that doesn't vary), the intercept puts the middle between
    the means at 1/2. Deterministic, so all that scores a coefficient table
    is checked exactly against SQL. Two aggregate passes (numeric columns;
    plan levels), at most one row a level."""
    y = F.col(md.LABEL)
    one, other = (lambda c: F.when(y == 1, c)), (lambda c: F.when(y != 1, c))
    columns = []
    for name in md.NUMERIC_FEATURES:
        x = F.col(name).cast("double")
        columns.append(F.struct(F.lit(name).alias("feature"), F.avg(one(x)).alias("m1"), F.avg(other(x)).alias("m0"),
                                F.var_pop(one(x)).alias("v1"), F.var_pop(other(x)).alias("v0")))
    totals = train.agg(F.count_if(y == 1).alias("n1"), F.count_if(y != 1).alias("n0"), F.array(*columns).alias("columns"))
    numeric = totals.select("n1", "n0", F.inline("columns"))
    levels = (train.where("plan_type is not null").groupBy("plan_type")
              .agg(F.count_if(y == 1).alias("c1"), F.count_if(y != 1).alias("c0")).crossJoin(F.broadcast(totals.select("n1", "n0"))))
    m1, m0 = F.col("c1") / F.col("n1"), F.col("c0") / F.col("n0")
    levels = levels.select("n1", "n0", F.concat(F.lit(LEVEL), "plan_type").alias("feature"), m1.alias("m1"), m0.alias("m0"),
                           (m1 * (1 - m1)).alias("v1"), (m0 * (1 - m0)).alias("v0"))
    inside = (F.col("n1") * F.col("v1") + F.col("n0") * F.col("v0")) / (F.col("n1") + F.col("n0"))
    rows = numeric.unionByName(levels).select(
        "feature", F.when(inside > 0, (F.col("m1") - F.col("m0")) / inside).otherwise(0.0).alias("coef"),
        ((F.col("m1") + F.col("m0")) / 2).alias("middle"))
    middle = rows.agg(F.lit(INTERCEPT).alias("feature"), (-F.sum(F.col("coef") * F.col("middle"))).alias("coef"))
    return rows.select("feature", "coef").unionByName(middle)


def largest(coefficients: DataFrame, n: int = 10) -> DataFrame:
    """H5: the n largest coefficients (the intercept is none), ties by name."""
    return coefficients.where(F.col("feature") != INTERCEPT).orderBy(F.col("coef").desc(), "feature").limit(n)
