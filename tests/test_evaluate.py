import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from vireo.operators import evaluate as E


def _brute(y, p):
    pos, neg = p[y == 1], p[y == 0]
    auc = sum((pp > nn) + 0.5 * (pp == nn) for pp in pos for nn in neg) / (len(pos) * len(neg))
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        sel = p >= t
        tp = (y[sel] == 1).sum()
        r = tp / len(pos)
        prec = tp / sel.sum()
        ap += (r - prev_r) * prec
        prev_r = r
    return auc, ap


def _data(seed=1, n=300):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.35).astype(int)
    p = np.round(np.clip(0.3 * y + rng.random(n) * 0.7, 0, 1), 2)
    return y, p


def test_auc_ap_against_brute_force(spark):
    y, p = _data()
    df = spark.createDataFrame(pd.DataFrame({"m": "a", "y": y, "p": p}))
    r = E.ranking_metrics(df, ["m"], "y", "p").first()
    auc, ap = _brute(y, p)
    assert abs(r.roc_auc - auc) < 1e-12 and abs(r.pr_auc - ap) < 1e-12
    assert abs(r.brier_score - np.mean((p - y) ** 2)) < 1e-12
    flipped = df.withColumn("p", 1 - F.col("p"))
    r2 = E.ranking_metrics(flipped, ["m"], "y", "p").first()
    assert abs(r.roc_auc + r2.roc_auc - 1) < 1e-12


def test_threshold_choice(spark):
    y, p = _data(2)
    df = spark.createDataFrame(pd.DataFrame({"m": "a", "y": y, "p": p}))
    r = E.select_threshold(df, ["m"], "y", "p", "max_recall").first()
    # highest threshold that still reaches full recall
    assert r.recall == 1.0 and r.threshold == p[y == 1].min()
    none = E.select_threshold(df, ["m"], "y", "p", "max_precision", min_precision=1.01).first()
    assert none.threshold == 0.5


def test_calibration_curve(spark):
    df = spark.createDataFrame([(0, 0.05), (1, 0.1), (1, 0.95), (0, 0.85)], "y int, p double")
    c = {r.bin: r for r in E.calibration_curve(df, [], "y", "p").collect()}
    assert set(c) == {0, 8, 9} and c[0].n == 2


def test_champion_gate(spark):
    m = spark.createDataFrame([("new", 0.70, 0.40, 0.10, 0.85), ("old", 0.75, 0.40, 0.10, 0.80)],
                              "model string, recall double, precision double, brier_score double, roc_auc double")
    r = E.champion_gate(m, "new", "old").first()
    assert not r.approved and r.reasons == "recall dropped"
    m2 = spark.createDataFrame([("new", 0.80, None, None, None)], "model string, recall double, precision double, "
                               "brier_score double, roc_auc double")
    r2 = E.champion_gate(m2, "new", "old", parity_defaults=True).first()
    assert not r2.approved


def test_performance_drift_insufficient(spark):
    pred = spark.createDataFrame([("a", 0.9, 1, "g"), ("b", 0.1, 0, "g"), ("c", 0.5, 1, "g")],
                                 "request_id string, risk_score double, risk_label int, grp string")
    lab = spark.createDataFrame([("a", 1), ("b", 0)], "request_id string, label int")
    r = E.performance_drift(pred, lab, ["grp"], pred_label="risk_label").first()
    assert r.status == "insufficient_data" and r.n_samples == 2


def test_max_f2_threshold_against_brute_force(spark):
    y, p = _data(5, 200)
    df = spark.createDataFrame(pd.DataFrame({"m": "a", "y": y, "p": p}))
    got = E.select_threshold(df, ["m"], "y", "p", "max_f2", min_recall=0.5).first()
    # brute force over distinct thresholds (ascending, first best wins), with
    # thresholds below the highest full-recall one dropped
    ts = sorted(set(p))
    full = max(t for t in ts if ((p >= t) & (y == 1)).sum() == (y == 1).sum())
    best, best_t = -1.0, 0.5
    for t in ts:
        if t < full:
            continue
        tp = ((p >= t) & (y == 1)).sum()
        prec, rec = tp / (p >= t).sum(), tp / (y == 1).sum()
        if rec < 0.5:
            continue
        f2 = 5 * prec * rec / (4 * prec + rec) if (4 * prec + rec) > 0 else 0.0
        if f2 > best:
            best, best_t = f2, t
    assert got.threshold == best_t and abs(got.f2 - best) < 1e-12
