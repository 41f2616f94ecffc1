"""Model evaluation over a predictions table ``(group..., y, p)``.

Threshold curves (PR, ROC, average precision, threshold choice) are built
from one table of distinct scores per group with positive / negative counts.
Cumulative counts come from ``ordered_prefix_sums`` (bucketed by score), so
no window ever spans a whole group, and thresholds are chosen with
``max_by`` aggregations - O(distinct scores), never O(n^2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo import config as C
from vireo.functions.stats import combine_one_row, join_groups, ordered_prefix_sums


def _safe_div(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _f_beta(p, r, beta2: float):
    return F.when((beta2 * p + r) > 0, (1 + beta2) * p * r / (beta2 * p + r)).otherwise(F.lit(0.0))


# E1 ------------------------------------------------------------------------
def confusion_counts(df: DataFrame, by: list[str], y: str, yhat) -> DataFrame:
    pred = F.col(yhat) if isinstance(yhat, str) else yhat
    yy = F.col(y)
    return df.groupBy(*by).agg(F.count_if((yy == 0) & (pred == 0)).alias("tn"),
                               F.count_if((yy == 0) & (pred == 1)).alias("fp"),
                               F.count_if((yy == 1) & (pred == 0)).alias("fn"),
                               F.count_if((yy == 1) & (pred == 1)).alias("tp"))


def metrics_from_counts(df: DataFrame) -> DataFrame:
    """recall, precision, f1, f2 from tn/fp/fn/tp (0 on zero division)."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    r = _safe_div(tp, tp + fn)
    p = _safe_div(tp, tp + fp)
    return df.withColumn("recall", r).withColumn("precision", p) \
             .withColumn("f1", _f_beta(F.col("precision"), F.col("recall"), 1.0)) \
             .withColumn("f2", _f_beta(F.col("precision"), F.col("recall"), 4.0))


def classification_metrics(df: DataFrame, by: list[str], y: str, p: str, threshold: float = 0.5) -> DataFrame:
    return metrics_from_counts(confusion_counts(df, by, y, (F.col(p) >= threshold).cast("int")))


# Curves ---------------------------------------------------------------------
def score_table(df: DataFrame, by: list[str], y: str, p: str) -> DataFrame:
    """One row per (group, distinct score) with counts at that score and at or
    above it (``tp_ge``/``fp_ge``), the squared errors at it, and group totals
    ``P``/``N``.

    The predictions are scanned once: distinct scores are counted, dealt to
    ranges of the score that hold about equally many of them (whatever the
    scores look like), and written; the running counts are then windows inside
    a (group, range)."""
    from vireo.session import cut_lineage
    g = df.where(F.col(p).isNotNull()).groupBy(*by, F.col(p).alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"),
        F.sum(F.pow(F.col(p) - F.col(y), 2)).alias("sq"), F.count(y).alias("labelled"))
    # the number of a range is written with its rows: ranges are drawn from a sample
    g = cut_lineage(g.repartitionByRange("score").withColumn("__range", F.spark_partition_id()))
    cum = ordered_prefix_sums(g, by, "score", ["pos", "neg"], F.col("__range"), descending=True)
    tot = g.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    if by:
        j = join_groups(cum, tot, by)
    else:
        t = tot.first()
        j = cum.withColumns({c: F.lit(int(t[c] or 0)).cast("bigint") for c in ("P", "N")})
    return j.select(*by, "score", "pos", "neg", "sq", "labelled", (F.col("pos_cum") + F.col("pos")).alias("tp_ge"),
                    (F.col("neg_cum") + F.col("neg")).alias("fp_ge"), "P", "N")


# E2 / E3 / E4 ----------------------------------------------------------------
def ranking_metrics(df: DataFrame, by: list[str], y: str, p: str) -> DataFrame:
    """Average precision (ties grouped), ROC AUC (ties count half), Brier."""
    return ranking_from_scores(score_table(df, by, y, p), by)


def ranking_from_scores(st: DataFrame, by: list[str]) -> DataFrame:
    """E2-E4 from the table of distinct scores."""
    prec = F.col("tp_ge") / (F.col("tp_ge") + F.col("fp_ge"))
    ap_term = F.when(F.col("P") > 0, F.col("pos") / F.col("P") * prec).otherwise(0.0)
    auc_term = F.col("pos") * (F.col("N") - F.col("fp_ge") + 0.5 * F.col("neg"))
    r = st.groupBy(*by).agg(F.sum(ap_term).alias("pr_auc"), F.sum(auc_term).alias("__auc"),
                            F.first("P").alias("n_positive"), F.first("N").alias("n_negative"),
                            F.try_divide(F.sum("sq"), F.sum("labelled")).alias("brier_score"))
    auc = F.when((F.col("n_positive") > 0) & (F.col("n_negative") > 0), F.col("__auc") / (F.col("n_positive") * F.col("n_negative")))
    return r.select(*by, "pr_auc", "n_positive", "n_negative", auc.alias("roc_auc"), "brier_score")


# E5 ------------------------------------------------------------------------
def calibration_curve(df: DataFrame, by: list[str], y: str, p: str, n_bins: int = 10) -> DataFrame:
    """Uniform bins, right-closed (the first also holds 0); empty bins dropped."""
    inner = [round(i / n_bins, 4) for i in range(1, n_bins)]
    arr = F.array(*[F.lit(float(e)) for e in inner])
    b = F.size(F.filter(arr, lambda e: e < F.col(p)))
    return df.where(F.col(p).isNotNull()).groupBy(*by, b.alias("bin")).agg(
        F.avg(F.col(y).cast("double")).alias("prob_true"), F.avg(F.col(p)).alias("prob_pred"),
        F.count(F.lit(1)).alias("n"))


def calibration_error(curve: DataFrame, by: list[str]) -> DataFrame:
    """Unweighted mean |true - pred| over non-empty bins, plus the weighted ECE."""
    gap = F.abs(F.col("prob_true") - F.col("prob_pred"))
    return curve.groupBy(*by).agg(F.avg(gap).alias("calibration_error"),
                                  (F.sum(gap * F.col("n")) / F.sum("n")).alias("ece"))


# E6 ------------------------------------------------------------------------
def pr_curve(df: DataFrame, by: list[str], y: str, p: str, truncate: bool = True) -> DataFrame:
    """Precision / recall / fpr at each distinct threshold (``score >= t``).

    ``truncate`` drops thresholds below the highest one that already reaches
    full recall, like the usual precision-recall curve.
    """
    return _curve(score_table(df, by, y, p), by, truncate)


def _curve(st: DataFrame, by: list[str], truncate: bool = True) -> DataFrame:
    out = st.select(*by, F.col("score").alias("threshold"), "tp_ge", "fp_ge", "P", "N",
                    (F.col("tp_ge") / (F.col("tp_ge") + F.col("fp_ge"))).alias("precision"),
                    _safe_div(F.col("tp_ge"), F.col("P")).alias("recall"),
                    _safe_div(F.col("fp_ge"), F.col("N")).alias("fpr"))
    if truncate:
        # the lowest kept threshold: one value per group from an aggregation,
        # joined back on the group keys (a table with one row per group)
        if by:
            full = st.where(F.col("tp_ge") == F.col("P")).groupBy(*by).agg(F.max("score").alias("__tmin"))
            out = out.join(full, by, "left")
        else:
            tmin = st.where(F.col("tp_ge") == F.col("P")).agg(F.max("score")).first()[0]
            out = out.withColumn("__tmin", F.lit(tmin).cast("double"))
        out = out.where(F.col("__tmin").isNull() | (F.col("threshold") >= F.col("__tmin"))).drop("__tmin")
    return out


def point_on_curve(curve: DataFrame, by: list[str], at: str, level: float, want: str) -> DataFrame:
    """Best ``want`` among points with ``at >= level`` (e.g. precision at recall .75)."""
    name = f"{want}_at_{at}_" + f"{level:.2f}".replace(".", "")
    return curve.where(F.col(at) >= level).groupBy(*by).agg(F.max(want).alias(name))


# E7 / E8 -------------------------------------------------------------------
def _objective(obj: str):
    p, r = F.col("precision"), F.col("recall")
    if obj == "max_recall":
        return r
    if obj == "max_f2":
        return _f_beta(p, r, 4.0)
    if obj == "max_precision":
        return p
    return _f_beta(p, r, 1.0)


def select_threshold(df: DataFrame, by: list[str], y: str, p: str, objective: str = "max_recall",
                     min_precision: float | None = None, min_recall: float | None = 0.75,
                     max_fpr: float | None = None, fallback: float = 0.5, fpr_quirk: bool = False) -> DataFrame:
    """Best threshold per group; the first best in ascending threshold order
    wins; no candidate -> ``fallback``.  Returns the metrics at it.

    The confusion counts at the chosen threshold are read from the written
    table of distinct scores (counts at or above each score, class totals); the
    predictions are scanned once, to make it.  FPR is FP / (FP + TN); ``fpr_quirk``
    reproduces the original rule that sets FPR to 0 when every prediction
    falls in one class.
    """
    from vireo.session import cut_lineage
    # read four times below: the curve, its cut, the totals and the fallback
    st = cut_lineage(score_table(df, by, y, p).drop("sq", "labelled"))
    cur = _curve(st, by)
    fpr = F.col("fpr")
    if fpr_quirk:
        one_class = (F.col("tp_ge") + F.col("fp_ge") == F.col("P") + F.col("N")) | \
                    (F.col("tp_ge") + F.col("fp_ge") == 0)
        fpr = F.when(one_class, F.lit(0.0)).otherwise(fpr)
    cand = cur.withColumn("fpr", fpr)
    if min_precision is not None:
        cand = cand.where(F.col("precision") >= min_precision)
    if min_recall is not None:
        cand = cand.where(F.col("recall") >= min_recall)
    if max_fpr is not None:
        cand = cand.where(F.col("fpr") <= max_fpr)
    cand = cand.withColumn("objective_score", _objective(objective))
    order = F.struct(F.col("objective_score"), -F.col("threshold"))
    best = cand.groupBy(*by).agg(F.max_by(F.struct("threshold", "tp_ge", "fp_ge"), order).alias("b"))
    tot = st.groupBy(*by).agg(F.first("P").alias("P"), F.first("N").alias("N"))
    # fallback threshold: counts at or above it are those of the smallest
    # distinct score >= fallback
    fb = st.where(F.col("score") >= fallback).groupBy(*by).agg(
        F.min_by(F.struct("tp_ge", "fp_ge"), F.col("score")).alias("f"))
    if by:
        j = tot.join(best, by, "left").join(fb, by, "left")
    else:
        j = combine_one_row(tot, best.select(F.col("b.threshold").alias("b_t"), F.col("b.tp_ge").alias("b_tp"),
                                             F.col("b.fp_ge").alias("b_fp")),
                            fb.select(F.col("f.tp_ge").alias("f_tp"), F.col("f.fp_ge").alias("f_fp")))
        j = j.select(F.col("P").cast("bigint").alias("P"), F.col("N").cast("bigint").alias("N"),
                     F.when(F.col("b_t").isNotNull(), F.struct(F.col("b_t").alias("threshold"),
                            F.col("b_tp").cast("bigint").alias("tp_ge"), F.col("b_fp").cast("bigint").alias("fp_ge")))
                     .alias("b"),
                     F.when(F.col("f_tp").isNotNull(), F.struct(F.col("f_tp").cast("bigint").alias("tp_ge"),
                            F.col("f_fp").cast("bigint").alias("fp_ge"))).alias("f"))
    has_best = F.col("b").isNotNull()
    tp = F.when(has_best, F.col("b.tp_ge")).otherwise(F.coalesce(F.col("f.tp_ge"), F.lit(0)))
    fp = F.when(has_best, F.col("b.fp_ge")).otherwise(F.coalesce(F.col("f.fp_ge"), F.lit(0)))
    counts = j.select(*by, F.when(has_best, F.col("b.threshold")).otherwise(F.lit(float(fallback))).alias("threshold"),
                      (F.col("N") - fp).cast("bigint").alias("tn"), fp.cast("bigint").alias("fp"),
                      (F.col("P") - tp).cast("bigint").alias("fn"), tp.cast("bigint").alias("tp"))
    m = metrics_from_counts(counts)
    return m.withColumn("fpr", _safe_div(F.col("fp"), F.col("fp") + F.col("tn")))


# E9 ------------------------------------------------------------------------
def evaluate_predictions(df: DataFrame, by: list[str], y: str, p: str, threshold: float = 0.5,
                         n_bins: int = 10) -> DataFrame:
    m = classification_metrics(df, by, y, p, threshold)
    n = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_samples"), F.count_if(F.col(y) == 1).alias("n_positive"),
                            F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier_score"))
    n = n.withColumn("n_negative", F.col("n_samples") - F.col("n_positive")) \
         .withColumn("baseline_rate", _safe_div(F.col("n_positive"), F.col("n_samples")))
    ce = calibration_error(calibration_curve(df, by, y, p, n_bins), by)
    return m.join(n, by).join(ce, by, "left")


# E10 / E11 -----------------------------------------------------------------
def rank_models(metrics: DataFrame, primary: str, partition: list[str] | None = None,
                model: str = "model") -> DataFrame:
    """Rank 1..n by (primary desc, model asc) within each partition.

    ``metrics`` has one row per model and partition, so each window
    partition holds only the candidate models.
    """
    w = Window.partitionBy(*(partition or [])).orderBy(F.col(primary).desc_nulls_last(), F.col(model))
    return metrics.withColumn("rank", F.row_number().over(w))


def best_models(metrics: DataFrame, primary: str, partition: list[str] | None = None,
                model: str = "model") -> DataFrame:
    return rank_models(metrics, primary, partition, model).where(F.col("rank") == 1)


# E12 -----------------------------------------------------------------------
def champion_gate(metrics: DataFrame, challenger: str, champion: str, keys: list[str] | None = None,
                  model: str = "model", parity_defaults: bool = False) -> DataFrame:
    """Compare a challenger's metrics to the champion's, per key.

    Rejects when recall drops > .02, precision > .05, Brier rises > .02 or
    AUC is lower.  A missing metric is an explicit failure unless
    ``parity_defaults`` applies the original fallback values.
    """
    keys = list(keys or [])
    names = ["recall", "precision", "brier_score", "roc_auc"]
    ch = metrics.where(F.col(model) == challenger).select(*keys, *[F.col(n).alias(f"ch_{n}") for n in names])
    cp = metrics.where(F.col(model) == champion).select(*keys, *[F.col(n).alias(f"cp_{n}") for n in names])
    j = ch.join(cp, keys, "full_outer") if keys else ch.withColumn("__k", F.lit(0)).join(
        cp.withColumn("__k", F.lit(0)), "__k", "full_outer").drop("__k")
    if parity_defaults:
        cp_def = {"recall": 0.75, "precision": 0.4, "brier_score": 0.15, "roc_auc": 0.8}
        ch_def = {"recall": 0.0, "precision": 0.0, "brier_score": 1.0, "roc_auc": 0.0}
        for n in names:
            j = j.withColumn(f"cp_{n}", F.coalesce(F.col(f"cp_{n}"), F.lit(cp_def[n]))) \
                 .withColumn(f"ch_{n}", F.coalesce(F.col(f"ch_{n}"), F.lit(ch_def[n])))
    reasons = F.array_compact(F.array(
        F.when(F.col("cp_recall") - F.col("ch_recall") > C.GATE_MAX_RECALL_DROP, F.lit("recall dropped")),
        F.when(F.col("cp_precision") - F.col("ch_precision") > C.GATE_MAX_PRECISION_DROP, F.lit("precision dropped")),
        F.when(F.col("ch_brier_score") - F.col("cp_brier_score") > C.GATE_MAX_BRIER_RISE, F.lit("brier worse")),
        F.when(F.col("ch_roc_auc") < F.col("cp_roc_auc"), F.lit("auc lower")),
        *[F.when(F.col(f"ch_{n}").isNull() | F.col(f"cp_{n}").isNull(), F.lit(f"missing {n}")) for n in names]))
    return j.select(*keys, *[F.col(f"ch_{n}") for n in names], *[F.col(f"cp_{n}") for n in names],
                    (F.size(reasons) == 0).alias("approved"), F.concat_ws("; ", reasons).alias("reasons"))


# E13 -----------------------------------------------------------------------
def performance_drift(pred: DataFrame, labels: DataFrame, by: list[str], keys=("request_id",),
                      score: str = "risk_score", label: str = "label", pred_label: str | None = None,
                      min_n: int = C.PERF_MIN_SAMPLES) -> DataFrame:
    """Predictions joined to late labels; metrics and alerts per group.

    Status: ``insufficient_data`` under ``min_n`` joined rows, ``red`` when
    recall < .70, precision < .30 or AUC < .75, else ``green``.  Groups with
    predictions but no labels report ``no_data``.
    """
    from vireo.session import cut_lineage
    lab = labels.select(*keys, F.col(label).alias("__y"), F.lit(True).alias("__labelled"))
    yhat = F.col(pred_label) if pred_label else (F.col(score) >= 0.5).cast("int")
    # one join, from which the few columns below are read twice: the counts and the scores
    j = cut_lineage(pred.join(lab, list(keys), "left").select(*by, F.col(score).alias("__s"), yhat.alias("__hat"), "__y", "__labelled"))
    seen = j.where("__labelled")
    hit = lambda a, b: F.count_if(F.col("__labelled") & (F.col("__y") == a) & (F.col("__hat") == b))
    n = j.groupBy(*by).agg(F.count_if("__labelled").alias("n_samples"), F.avg("__y").alias("positive_rate"), hit(0, 0).alias("tn"),
                           hit(0, 1).alias("fp"), hit(1, 0).alias("fn"), hit(1, 1).alias("tp"))
    m = metrics_from_counts(n).withColumn("n_samples", F.when(F.col("n_samples") > 0, F.col("n_samples")))
    none = F.col("n_samples").isNull()
    m = m.withColumns({c: F.when(~none, F.col(c)) for c in ("recall", "precision", "f1")})
    out = join_groups(m, ranking_metrics(seen, by, "__y", "__s"), by, "left")
    alerts = F.array_compact(F.array(
        F.when(F.col("recall") < C.PERF_RECALL_MIN, F.lit("recall low")),
        F.when(F.col("precision") < C.PERF_PRECISION_MIN, F.lit("precision low")),
        F.when(F.col("roc_auc") < C.PERF_AUC_MIN, F.lit("auc low"))))
    st = (F.when(F.col("n_samples").isNull(), F.lit("no_data"))
           .when(F.col("n_samples") < min_n, F.lit("insufficient_data"))
           .when(F.size(alerts) > 0, F.lit("red")).otherwise(F.lit("green")))
    return out.select(*by, st.alias("status"), F.coalesce(F.col("n_samples"), F.lit(0)).alias("n_samples"),
                      "positive_rate", "recall", "precision", "f1", "roc_auc", "pr_auc", "brier_score",
                      F.when(F.col("n_samples") >= min_n, F.concat_ws("; ", alerts)).alias("alerts"))


# D12 -----------------------------------------------------------------------
def subgroup_gap(df: DataFrame, model: str, group: str, y: str, p: str, reference: str) -> DataFrame:
    """AUC per subgroup and its gap to the reference subgroup, per model."""
    r = ranking_metrics(df, [model, group], y, p).select(model, group, "roc_auc")
    ref = r.where(F.col(group) == reference).select(model, F.col("roc_auc").alias("ref_auc"))
    return r.join(ref, model, "left").withColumn("auc_gap", F.col("roc_auc") - F.col("ref_auc"))
