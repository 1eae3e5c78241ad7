"""Ranking metrics against direct numpy definitions on random scores."""

import numpy as np
import pytest

from churnlens.plans import evaluate as ev


def _frame(spark, scores, labels):
    return spark.createDataFrame([(float(s), int(y)) for s, y in zip(scores, labels)],
                                 "score double, label int")


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    n = 3000
    s = np.round(rng.beta(1.2, 6.0, n), 3)           # many ties, skewed mass near 0
    y = (rng.random(n) < s * 0.8).astype(int)
    return s, y


def test_auc_ap_exact(spark, data):
    s, y = data
    summ = ev.score_summary(_frame(spark, s, y))
    r = ev.auc_ap(summ).first()
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert r.roc_auc == pytest.approx(round(gt / (len(pos) * len(neg)), 6), abs=1e-6)
    order = np.unique(s)[::-1]
    ap, prev_r = 0.0, 0.0
    for t in order:
        tp = ((s >= t) & (y == 1)).sum()
        fp = ((s >= t) & (y == 0)).sum()
        rec = tp / y.sum()
        ap += (rec - prev_r) * tp / (tp + fp)
        prev_r = rec
    assert r.average_precision == pytest.approx(ap, abs=2e-6)


def test_thresholds_equal_numpy_quantile(spark, data):
    s, y = data
    summ = ev.score_summary(_frame(spark, s, y))
    got = {r.top_fraction: r for r in ev.top_k_report(summ).collect()}
    base = y.mean()
    for k in ev.TOP_K_FRACTIONS:
        thr = np.quantile(s, 1 - k)
        assert got[k].threshold == thr                      # bit-exact
        pred = s >= thr
        tp = int((pred & (y == 1)).sum())
        assert got[k].flagged == int(pred.sum()) and got[k].tp == tp
        prec = tp / (pred.sum() + 1e-9)
        assert got[k].lift == pytest.approx(round(prec / base, 6), abs=1e-6)


def test_exact_median(spark, data):
    s, _ = data
    df = spark.createDataFrame([(float(v),) for v in s] + [(None,)], "x double")
    assert ev.exact_quantile(df, "x", 0.5) == pytest.approx(float(np.median(s)), abs=1e-12)


def test_histogram_matches_numpy_counts(spark, data):
    s, y = data
    h = ev.score_histogram(_frame(spark, s, y)).collect()
    for cls in (0, 1):
        want, _ = np.histogram(s[y == cls], bins=50)
        got = [r["count"] for r in sorted((r for r in h if r.label == cls), key=lambda r: r.bin)]
        assert got == list(want)


def test_single_class_gives_null_metrics_not_errors(spark):
    summ = ev.score_summary(_frame(spark, [0.1, 0.2, 0.2], [0, 0, 0]))
    r = ev.auc_ap(summ).first()
    assert r.roc_auc is None and r.average_precision is None and r.positives == 0
    top = ev.top_k_report(summ).collect()
    assert len(top) == 4 and all(t.lift is None and t.tp == 0 for t in top)


def test_tercile_tiers_match_numpy(spark, data):
    from churnlens.plans import dashboards as db
    s, _ = data
    df = spark.createDataFrame([(float(v),) for v in s], "logins_30d double")
    edges = db.tercile_edges(df)
    assert edges[1][0] == np.quantile(s, 1 / 3) and edges[2][0] == np.quantile(s, 2 / 3)
