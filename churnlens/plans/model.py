"""Churn model on MLlib.

Logistic regression with balanced class weights and the same objective as
an L2 (C = 1) fit without feature scaling:  C * sum(w_i * loss_i) + |b|^2 / 2.
Spark minimises (1/sum w) * sum(w_i * loss_i) + regParam/2 * |b|^2, and
balanced weights sum to n_train, so regParam = 1 / (C * n_train) with
standardization off gives the same optimum. L-BFGS runs distributed (one
tree-aggregate per iteration); no rows are collected.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Model inputs and target.
NUMERIC_FEATURES = ["active_users_30d", "logins_30d", "invites_30d", "uploads_30d",
                    "tickets_60d", "failed_payments_60d", "months_since_signup"]
CATEGORICAL_FEATURES = ["plan_type"]
LABEL = "churn_in_next_30d"
ID_COLS = ["company_id", "as_of_date"]
EXCLUDED = ["days_to_first_invite", "churn_flag_static"]  # look past the snapshot
DEFAULT_CUTOFF = _dt.date(2024, 9, 1)
FIXTURE_CUTOFF = _dt.date(2000, 1, 1)
MAX_ITER = 2000
C = 1.0


def model_input(features: DataFrame) -> DataFrame:
    """A4/M2: the projected columns the model reads, snapshot present."""
    return features.select(*ID_COLS, *NUMERIC_FEATURES, "days_to_first_invite",
                           *CATEGORICAL_FEATURES, LABEL).where(F.col("as_of_date").isNotNull())


def time_split(df: DataFrame, cutoff: _dt.date) -> tuple[DataFrame, DataFrame]:
    """M1: train = snapshots before the cutoff, test = on/after it."""
    c = F.lit(cutoff).cast("date")
    return df.where(F.col("as_of_date") < c), df.where(F.col("as_of_date") >= c)


def split_counts(df: DataFrame, cutoff: _dt.date) -> DataFrame:
    """M1 counts: rows and positives per split, one aggregate pass."""
    part = F.when(F.col("as_of_date") < F.lit(cutoff).cast("date"), "train").otherwise("test")
    return (df.groupBy(part.alias("split"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.sum(F.col(LABEL)).cast("bigint").alias("churners")))


def train_stats(train: DataFrame):
    """One aggregate pass over the training split: rows, positives and
    NULLs per model input column (feeds both imputation and weights)."""
    cols = NUMERIC_FEATURES + CATEGORICAL_FEATURES
    return train.agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(LABEL)).alias("_p"),
                     *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()


def impute(train: DataFrame, others: list[DataFrame],
           stats=None) -> tuple[DataFrame, list[DataFrame]]:
    """M3/M4: median for numeric columns and most frequent value (ties by
    name) for the categorical one, fitted on train only.

    One aggregate pass counts NULLs per column; statistics are computed
    only for columns that have NULLs (filling a column without NULLs is a
    no-op, and the feature table COALESCEs every count). The median is the
    numpy-exact one from the distributed distinct-value summary, never a
    single-task percentile buffer."""
    from .evaluate import exact_quantile
    cols = NUMERIC_FEATURES + CATEGORICAL_FEATURES
    nulls = stats if stats is not None else train.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    fill: dict[str, object] = {}
    for c in NUMERIC_FEATURES:
        if nulls[c]:
            m = exact_quantile(train, c, 0.5)
            if m is not None:
                fill[c] = float(m)
    if nulls["plan_type"]:
        top = (train.where(F.col("plan_type").isNotNull()).groupBy("plan_type").count()
               .orderBy(F.col("count").desc(), F.col("plan_type").asc()).limit(1).collect())
        if top:
            fill["plan_type"] = top[0]["plan_type"]

    def apply(df: DataFrame) -> DataFrame:
        out = []
        for c in df.columns:
            e = F.col(c).cast("double") if c in NUMERIC_FEATURES else F.col(c)
            out.append((F.coalesce(e, F.lit(fill[c])) if c in fill else e).alias(c))
        return df.select(*out)
    return apply(train), [apply(d) for d in others]


def imputer_statistics(features: DataFrame, cutoff: _dt.date) -> DataFrame:
    """M3/M4 on columns with NULLs or ties: the training split's median of
    ``days_to_first_invite`` and its most frequent plan (ties by name)."""
    from .evaluate import exact_quantile
    train, _ = time_split(model_input(features), cutoff)
    median = exact_quantile(train, "days_to_first_invite", 0.5)
    plans = train.where(F.col("plan_type").isNotNull()).groupBy("plan_type").count()
    top = plans.orderBy(F.col("count").desc(), "plan_type").limit(1)
    return top.select(F.lit(median).alias("median_days_to_first_invite"),
                      F.col("plan_type").alias("most_frequent_plan"))


def training_summary(features: DataFrame, cutoff: _dt.date) -> DataFrame:
    """Rows, positives and balanced class weights of the training split."""
    train, _ = time_split(model_input(features), cutoff)
    n, p = F.count(F.lit(1)), F.sum(F.col(LABEL)).cast("bigint")
    return train.agg(n.alias("rows"), p.alias("positives"), F.round(n / (2.0 * p), 6).alias("weight_positive"),
                     F.round(n / (2.0 * (n - p)), 6).alias("weight_negative"))


def class_weights(train: DataFrame, with_count: bool = False, stats=None):
    """Balanced weights n / (2 * n_class); fails clearly without both
    classes. One aggregate pass (or precomputed ``train_stats``);
    ``with_count`` also returns n."""
    if stats is None:
        cnt = train.agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(LABEL)).alias("_p")).first()
    else:
        cnt = stats
    n, p = int(cnt["_n"]), int(cnt["_p"] or 0)
    if p == 0 or p == n:
        raise ValueError(f"training split needs both classes (rows={n}, positives={p})")
    w_pos, w_neg = n / (2.0 * p), n / (2.0 * (n - p))
    out = train.withColumn("weight", F.when(F.col(LABEL) == 1, F.lit(w_pos)).otherwise(F.lit(w_neg)))
    return (out, n) if with_count else out


def equal_rows(train: DataFrame) -> DataFrame:
    """The training rows, equal ones (model columns, label and weight) as one
    row with the sum of their weights: the same weighted loss, so the same fit.
    Most snapshots are alike (few counts, quiet months), so what every
    iteration reads grows far slower than the table. NULLs and NaNs group too."""
    columns = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, LABEL]
    return (train.groupBy(*columns, F.col("weight").alias("_each")).agg(F.count(F.lit(1)).alias("_copies"))
            .select(*columns, (F.col("_each") * F.col("_copies")).alias("weight")))


def build_pipeline(n_train: int) -> Pipeline:
    """M5/M6/M7: one-hot (alphabetical levels, unseen -> all zeros),
    assembler, weighted logistic regression."""
    idx = StringIndexer(inputCol="plan_type", outputCol="plan_type_idx", handleInvalid="keep",
                        stringOrderType="alphabetAsc")
    # The indexer puts unseen levels at the last index; dropLast removes
    # exactly that slot, so every known level keeps a column.
    ohe = OneHotEncoder(inputCols=["plan_type_idx"], outputCols=["plan_type_ohe"], dropLast=True)
    asm = VectorAssembler(inputCols=NUMERIC_FEATURES + ["plan_type_ohe"], outputCol="features")
    lr = LogisticRegression(featuresCol="features", labelCol=LABEL, weightCol="weight",
                            maxIter=MAX_ITER, regParam=1.0 / (C * n_train), elasticNetParam=0.0,
                            standardization=False, family="binomial", tol=1e-8)
    return Pipeline(stages=[idx, ohe, asm, lr])


def fit(features: DataFrame, cutoff: _dt.date, keep=lambda df: df) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Train on the pre-cutoff snapshots; returns (model, train, test), equal
    training rows as one (``equal_rows``). ``keep`` writes them once."""
    train, test = time_split(model_input(features), cutoff)
    stats = train_stats(train)
    train, (test,) = impute(train, [test], stats)
    train, n_train = class_weights(train, with_count=True, stats=stats)
    train = keep(equal_rows(train))
    model = build_pipeline(n_train).fit(train)
    return model, train, test


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M8: positive-class probability per snapshot."""
    return model.transform(df).select(
        *ID_COLS, F.col(LABEL).alias("label"),
        vector_to_array("probability")[1].alias("churn_probability"))


def predictions(model: PipelineModel, test: DataFrame) -> DataFrame:
    """Gold.company_churn_predictions (test snapshots only)."""
    return score(model, test).select(*ID_COLS, "churn_probability")


def coefficients(model: PipelineModel, top: int | None = None) -> DataFrame:
    """Coefficient per feature name, largest first (H5: the ``top`` first)."""
    idx_model, lr = model.stages[0], model.stages[-1]
    names = list(NUMERIC_FEATURES) + [f"plan_type_{v}" for v in idx_model.labels]
    rows = [(n, float(c)) for n, c in zip(names, lr.coefficients.toArray())]
    spark = SparkSession.active()
    df = spark.createDataFrame(rows, "feature string, coef double").orderBy(
        F.col("coef").desc(), F.col("feature").asc())
    return df.limit(top) if top else df


def heuristic_scores(features: DataFrame, cutoff: _dt.date) -> DataFrame:
    """A transparent baseline scorer (friction vs. engagement and tenure)
    in (0, 1]: (failed payments + tickets + 1) /
    (failed payments + tickets + logins + active users + tenure months + 2).
    Deterministic, so the risk tables built on it are checked exactly
    against SQL; the MLlib model output feeds the same builders."""
    fr = F.col("failed_payments_60d") + F.col("tickets_60d")
    return (features.where(F.col("as_of_date") >= F.lit(cutoff).cast("date"))
            .select(*ID_COLS, F.col(LABEL).alias("label"),
                    ((fr + 1).cast("double")
                     / (fr + F.col("logins_30d") + F.col("active_users_30d")
                        + F.col("months_since_signup") + 2).cast("double"))
                    .alias("churn_probability")))
