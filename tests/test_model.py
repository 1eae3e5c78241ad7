"""Model checks: objective optimality, unseen levels, class guard."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnlens.plans import model as md
from churnlens.plans import scoring
from churnlens.plans.warehouse import Warehouse
from conftest import SMOKE_DIR


def test_fit_is_optimal_for_the_reference_objective(spark):
    """Gradient of C*sum(w_i*loss_i) + |beta|^2/2 (intercept unpenalised)
    at the fitted coefficients is ~0 relative to the data term."""
    wh = Warehouse.for_testdata(spark, SMOKE_DIR)
    model, train, _ = wh.model()
    lr = model.stages[-1]
    x = model.transform(train).select(
        vector_to_array("features").alias("x"), F.col(md.LABEL).cast("double").alias("y"),
        "weight").toPandas()  # test-sized fixture only
    X = np.vstack(x["x"].to_numpy())
    y, w = x["y"].to_numpy(), x["weight"].to_numpy()
    beta, b0 = lr.coefficients.toArray(), lr.intercept
    p = 1.0 / (1.0 + np.exp(-(X @ beta + b0)))
    g_beta = md.C * (X.T @ (w * (p - y))) + beta
    g_b0 = md.C * np.sum(w * (p - y))
    scale = md.C * np.abs(X.T @ (w * y)).max()
    assert np.abs(g_beta).max() / scale < 1e-3
    assert abs(g_b0) / scale < 1e-3


def test_unseen_plan_is_all_zero_one_hot(spark):
    rows = [("a", dt.date(2024, 1, 31), *[float(i % 3) for i in range(7)], None, "Basic", i % 2)
            for i in range(20)]
    schema = ", ".join(["company_id string", "as_of_date date"]
                       + [f"{c} double" for c in md.NUMERIC_FEATURES]
                       + ["days_to_first_invite int", "plan_type string", f"{md.LABEL} int"])
    df = spark.createDataFrame(rows, schema)
    train = md.class_weights(df)
    m = md.build_pipeline(20).fit(train)
    test = df.limit(1).withColumn("plan_type", F.lit("Platinum")).withColumn("weight", F.lit(1.0))
    vec = m.transform(test).select(vector_to_array("plan_type_ohe").alias("v")).first().v
    assert vec == [0.0]  # one known level, unseen -> all zeros


def test_single_class_training_fails_clearly(spark):
    df = spark.createDataFrame([(0,), (0,)], f"{md.LABEL} int")
    with pytest.raises(ValueError, match="both classes"):
        md.class_weights(df)


def test_impute_median_and_most_frequent_fitted_on_train(spark):
    cols = md.ID_COLS + md.NUMERIC_FEATURES + ["days_to_first_invite", "plan_type", md.LABEL]
    schema = ", ".join(["company_id string", "as_of_date date"]
                       + [f"{c} double" for c in md.NUMERIC_FEATURES]
                       + ["days_to_first_invite int", "plan_type string", f"{md.LABEL} int"])
    d = dt.date(2024, 1, 31)
    vals = [1.0, 2.0, 10.0, 4.0, None]           # median of non-null = 3.0 (mean of middles)
    plans = ["Pro", "Basic", "Pro", "Basic", None]  # tie 2-2 -> alphabetical "Basic"
    rows = [("c", d, v, *([0.0] * 6), None, p, 0) for v, p in zip(vals, plans)]
    train = spark.createDataFrame(rows, schema)
    test = spark.createDataFrame([("t", d, None, *([0.0] * 6), None, None, 0)], schema)
    tr, (te,) = md.impute(train, [test])
    assert cols == tr.columns
    r = te.first()
    assert r[md.NUMERIC_FEATURES[0]] == 3.0 and r.plan_type == "Basic"
    assert tr.where(tr[md.NUMERIC_FEATURES[0]].isNull()).count() == 0


def test_scores_from_the_coefficient_table_equal_mllib(spark):
    """The table alone gives MLlib's probabilities; an unseen or missing level adds nothing to the others."""
    wh = Warehouse.for_testdata(spark, SMOKE_DIR)
    fitted, _, test = wh.model()
    table = scoring.coefficient_table(fitted)
    assert table.count() == len(md.NUMERIC_FEATURES) + len(fitted.stages[0].labels) + 1
    odd = test.limit(3).withColumn("plan_type", F.lit("Platinum"))
    for rows in (test, odd):
        both = (md.score(fitted, rows).withColumnRenamed("churn_probability", "p")
                .join(scoring.score(rows, table).select(*md.ID_COLS, "churn_probability"), md.ID_COLS))
        r = both.agg(F.count("*").alias("n"), F.max(F.abs(F.col("p") - F.col("churn_probability"))).alias("d")).first()
        assert r.n == rows.count() and r.d < 1e-9
    missing = odd.withColumn("plan_type", F.lit(None).cast("string"))
    assert sorted(scoring.score(odd, table).collect()) == sorted(scoring.score(missing, table).collect())


def test_residuals_tell_a_fit_from_others(spark):
    wh = Warehouse.for_testdata(spark, SMOKE_DIR)
    fitted, train, _ = wh.model()
    table = scoring.coefficient_table(fitted)
    found = {r.feature: r for r in scoring.residuals(train, table).collect()}
    assert found.keys() == {r.feature for r in table.collect()} and all(r.within_tolerance for r in found.values())
    moved = table.withColumn("coef", F.col("coef") + F.when(F.col("feature") == "logins_30d", 0.05).otherwise(0.0))
    assert not all(r.within_tolerance for r in scoring.residuals(train, moved).collect())
    # one coefficient's by itself
    coef = {r.feature: r.coef for r in table.collect()}["logins_30d"]
    data = train.crossJoin(table.agg(F.map_from_entries(F.collect_list(F.struct("feature", "coef"))).alias("_coefficients")))
    data = data.agg(F.sum(F.col("weight") * (scoring.probability(scoring.margin()) - F.col(md.LABEL)) * F.col("logins_30d"))).first()[0]
    assert found["logins_30d"].residual == pytest.approx(md.C * data + coef)


def test_discriminant(spark):
    """Closed form on a hand-made split: means, variances inside the classes, levels as 0/1 columns."""
    values = [(1, 4.0, "A"), (1, 6.0, "B"), (0, 1.0, "A"), (0, 3.0, "A"), (0, 2.0, "A")]
    rows = [("c", dt.date(2024, 1, 31), x, *([2.0] * 6), None, plan, y) for y, x, plan in values]
    schema = ", ".join(["company_id string", "as_of_date date"] + [f"{c} double" for c in md.NUMERIC_FEATURES]
                       + ["days_to_first_invite int", "plan_type string", f"{md.LABEL} int"])
    coef = {r.feature: r.coef for r in scoring.discriminant(spark.createDataFrame(rows, schema)).collect()}
    first = md.NUMERIC_FEATURES[0]
    inside = (2 * 1.0 + 3 * (2 / 3)) / 5
    level = (0.5 - 1.0) / (2 * 0.25 / 5), (0.5 - 0.0) / (2 * 0.25 / 5)
    assert coef[first] == pytest.approx(3 / inside) and coef[md.NUMERIC_FEATURES[1]] == 0
    assert (coef["plan_type_A"], coef["plan_type_B"]) == pytest.approx(level)
    assert coef[scoring.INTERCEPT] == pytest.approx(-(3 / inside * 3.5 + level[0] * 0.75 + level[1] * 0.25))


def _snapshots(spark, copies):
    """40 different snapshots before the cutoff, each ``copies`` times, and one after it."""
    rows = [(f"c{i}", dt.date(1999, 1, 31), *[float((i * 7 + j) % (3 + j)) for j in range(7)], None, "Basic" if i % 4 else "Pro", int(i % 3 == 0))
            for i in range(40) for _ in range(copies)]
    rows.append(("z", dt.date(2000, 1, 31), *[0.0] * 7, None, "Basic", 0))
    schema = ", ".join(["company_id string", "as_of_date date"] + [f"{c} double" for c in md.NUMERIC_FEATURES]
                       + ["days_to_first_invite int", "plan_type string", f"{md.LABEL} int"])
    return spark.createDataFrame(rows, schema)


def test_equal_training_rows_are_read_once_an_iteration(spark):
    """Copies of a snapshot add weight, not rows, and the fit is the stated objective's all the same."""
    model, train, test = md.fit(_snapshots(spark, 25), md.FIXTURE_CUTOFF)
    assert train.count() == 40 and test.count() == 1
    assert train.agg(F.sum("weight")).first()[0] == pytest.approx(1000.0)
    found = scoring.residuals(train, scoring.coefficient_table(model))
    assert found.where("not within_tolerance").count() == 0
    whole = md.class_weights(md.time_split(_snapshots(spark, 25), md.FIXTURE_CUTOFF)[0])
    every = scoring.coefficient_table(md.build_pipeline(1000).fit(whole)).collect()
    for a, b in zip(every, scoring.coefficient_table(model).collect()):
        assert a.feature == b.feature and a.coef == pytest.approx(b.coef, rel=1e-3, abs=1e-4)
