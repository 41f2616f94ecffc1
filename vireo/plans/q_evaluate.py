"""Registered queries: evaluation of the scored orders."""

from pyspark.sql import functions as F

from vireo.operators import evaluate as E
from vireo.operators.explore import pivot_metrics
from vireo.plans.bindings import scored, table, with_views
from vireo.plans.catalog import query


def _r(df, cols, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def _st_sql(by: str) -> str:
    return f"""st AS (SELECT {by}, score, pos, neg,
  CAST(sum(pos) OVER (PARTITION BY {by} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp_ge,
  CAST(sum(neg) OVER (PARTITION BY {by} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp_ge,
  CAST(sum(pos) OVER (PARTITION BY {by}) AS BIGINT) AS P, CAST(sum(neg) OVER (PARTITION BY {by}) AS BIGINT) AS N
  FROM (SELECT {by}, risk_score AS score, count(*) FILTER (WHERE label = 1) AS pos,
               count(*) FILTER (WHERE label <> 1) AS neg FROM v2 WHERE risk_score IS NOT NULL GROUP BY ALL))"""


def _metrics_sql(src: str, by: str, thr: str) -> str:
    return f"""SELECT {by}, {thr} AS threshold, tn, fp, fn, tp,
  round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) AS recall, round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) AS precision,
  round(CASE WHEN (1.0 * p_ + r_) > 0 THEN (1 + 1.0) * p_ * r_ / (1.0 * p_ + r_) ELSE 0.0 END, 6) AS f1,
  round(CASE WHEN (4.0 * p_ + r_) > 0 THEN (1 + 4.0) * p_ * r_ / (4.0 * p_ + r_) ELSE 0.0 END, 6) AS f2
FROM (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS p_, coalesce(tp / nullif(tp + fn, 0), 0.0) AS r_ FROM {src})"""


@query("e1_metrics_at_05_by_model", with_views(_metrics_sql("""(
  SELECT model, count(*) FILTER (WHERE label = 0 AND risk_score < 0.5) AS tn,
    count(*) FILTER (WHERE label = 0 AND risk_score >= 0.5) AS fp, count(*) FILTER (WHERE label = 1 AND risk_score < 0.5) AS fn,
    count(*) FILTER (WHERE label = 1 AND risk_score >= 0.5) AS tp FROM v2 GROUP BY model)""", "model",
                                                       "CAST(0.5 AS DOUBLE)"), "v2"))
def e1_metrics_at_05_by_model(spark, d):
    m = E.classification_metrics(scored(spark, d), ["model"], "label", "risk_score", 0.5)
    return _r(m.withColumn("threshold", F.lit(0.5)), ["recall", "precision", "f1", "f2"]) \
        .select("model", "threshold", "tn", "fp", "fn", "tp", "recall", "precision", "f1", "f2")


RANK_SQL = """
SELECT {by}, round(sum(CASE WHEN P > 0 THEN pos / P * (tp_ge / (tp_ge + fp_ge)) ELSE 0.0 END), 6) AS pr_auc,
  first(P) AS n_positive, first(N) AS n_negative,
  round(CASE WHEN first(P) > 0 AND first(N) > 0 THEN sum(pos * (N - fp_ge + 0.5 * neg)) / (first(P) * first(N)) END, 6)
    AS roc_auc,
  round((SELECT avg(pow(risk_score - label, 2)) FROM v2 x WHERE {join}), 6) AS brier_score
FROM st GROUP BY {by}"""


@query("e2_e3_ranking_metrics_by_model_segment", with_views(
    RANK_SQL.format(by="model, segment", join="x.model = st.model AND x.segment = st.segment"), "v2",
    ctes=[_st_sql("model, segment")]))
def e2_e3_ranking_metrics_by_model_segment(spark, d):
    r = E.ranking_metrics(scored(spark, d), ["model", "segment"], "label", "risk_score")
    return _r(r, ["pr_auc", "roc_auc", "brier_score"])


@query("e5_calibration_curve_by_model", with_views("""
SELECT model, CAST(len(list_filter([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9], lambda e: e < risk_score)) AS INTEGER)
    AS bin, round(avg(CAST(label AS DOUBLE)), 6) AS prob_true, round(avg(risk_score), 6) AS prob_pred, count(*) AS n
FROM v2 WHERE risk_score IS NOT NULL GROUP BY ALL""", "v2"))
def e5_calibration_curve_by_model(spark, d):
    return _r(E.calibration_curve(scored(spark, d), ["model"], "label", "risk_score"), ["prob_true", "prob_pred"])


@query("e6_pr_curve_by_model", with_views("""
SELECT model, score AS threshold, tp_ge, fp_ge, P, N, round(tp_ge / (tp_ge + fp_ge), 6) AS precision,
  round(coalesce(tp_ge / nullif(P, 0), 0.0), 6) AS recall, round(coalesce(fp_ge / nullif(N, 0), 0.0), 6) AS fpr
FROM st LEFT JOIN (SELECT model, max(score) AS tmin FROM st WHERE tp_ge = P GROUP BY model) f USING (model)
WHERE tmin IS NULL OR score >= tmin""", "v2", ctes=[_st_sql("model")]))
def e6_pr_curve_by_model(spark, d):
    return _r(E.pr_curve(scored(spark, d), ["model"], "label", "risk_score"), ["precision", "recall", "fpr"])


_OBJ = {
    "max_recall": "recall",
    "max_f2": "CASE WHEN (4.0 * precision + recall) > 0 THEN (1 + 4.0) * precision * recall / (4.0 * precision + recall) ELSE 0.0 END",
    "balanced": "CASE WHEN (1.0 * precision + recall) > 0 THEN (1 + 1.0) * precision * recall / (1.0 * precision + recall) ELSE 0.0 END",
    "max_precision": "precision",
}


def _select_sql(objective: str, min_precision=None, min_recall=0.75, max_fpr=None) -> str:
    conds = ["TRUE"]
    if min_precision is not None:
        conds.append(f"precision >= {min_precision}")
    if min_recall is not None:
        conds.append(f"recall >= {min_recall}")
    if max_fpr is not None:
        conds.append(f"fpr <= {max_fpr}")
    return with_views(f"""
, cur AS (SELECT model, score AS threshold, tp_ge / (tp_ge + fp_ge) AS precision,
    coalesce(tp_ge / nullif(P, 0), 0.0) AS recall, coalesce(fp_ge / nullif(N, 0), 0.0) AS fpr
  FROM st LEFT JOIN (SELECT model, max(score) AS tmin FROM st WHERE tp_ge = P GROUP BY model) f USING (model)
  WHERE tmin IS NULL OR score >= tmin),
cand AS (SELECT *, {_OBJ[objective]} AS os FROM cur WHERE {' AND '.join(conds)}),
best AS (SELECT model, threshold FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY os DESC, threshold ASC)
         AS rn FROM cand) WHERE rn = 1),
ch AS (SELECT g.model, coalesce(b.threshold, 0.5) AS thr FROM (SELECT DISTINCT model FROM v2) g
       LEFT JOIN best b USING (model)),
cnt AS (SELECT v2.model, ch.thr, count(*) FILTER (WHERE label = 0 AND risk_score < thr) AS tn,
    count(*) FILTER (WHERE label = 0 AND risk_score >= thr) AS fp,
    count(*) FILTER (WHERE label = 1 AND risk_score < thr) AS fn,
    count(*) FILTER (WHERE label = 1 AND risk_score >= thr) AS tp FROM v2 JOIN ch USING (model) GROUP BY ALL)
SELECT *, round(coalesce(fp / nullif(fp + tn, 0), 0.0), 6) AS fpr FROM ({_metrics_sql('cnt', 'model', 'thr')})
""", "v2", ctes=[_st_sql("model")]).replace(")\n, cur AS", "),\ncur AS")


def _select(spark, d, **kw):
    m = E.select_threshold(scored(spark, d), ["model"], "label", "risk_score", **kw)
    return _r(m, ["recall", "precision", "f1", "f2", "fpr"]).select(
        "model", "threshold", "tn", "fp", "fn", "tp", "recall", "precision", "f1", "f2", "fpr")


@query("e7_threshold_max_recall", _select_sql("max_recall"))
def e7_threshold_max_recall(spark, d):
    return _select(spark, d, objective="max_recall")


@query("e7_threshold_max_f2", _select_sql("max_f2"))
def e7_threshold_max_f2(spark, d):
    return _select(spark, d, objective="max_f2")


@query("e7_threshold_balanced_min_precision", _select_sql("balanced", min_precision=0.35, min_recall=0.5))
def e7_threshold_balanced_min_precision(spark, d):
    return _select(spark, d, objective="balanced", min_precision=0.35, min_recall=0.5)


@query("e8_threshold_constrained_fpr", _select_sql("max_precision", min_recall=0.3, max_fpr=0.4))
def e8_threshold_constrained_fpr(spark, d):
    return _select(spark, d, objective="max_precision", min_recall=0.3, max_fpr=0.4)


@query("e9_evaluate_predictions", with_views("""
, cal AS (SELECT model, avg(abs(pt - pp)) AS ce, sum(abs(pt - pp) * n) / sum(n) AS ece FROM (
    SELECT model, len(list_filter([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9], lambda e: e < risk_score)) AS bin,
      avg(CAST(label AS DOUBLE)) AS pt, avg(risk_score) AS pp, count(*) AS n FROM v2 GROUP BY ALL) GROUP BY model),
cnt AS (SELECT model, count(*) FILTER (WHERE label = 0 AND risk_score < 0.5) AS tn,
    count(*) FILTER (WHERE label = 0 AND risk_score >= 0.5) AS fp, count(*) FILTER (WHERE label = 1 AND risk_score < 0.5) AS fn,
    count(*) FILTER (WHERE label = 1 AND risk_score >= 0.5) AS tp, count(*) AS n_samples,
    count(*) FILTER (WHERE label = 1) AS n_positive, avg(pow(risk_score - label, 2)) AS brier FROM v2 GROUP BY model)
SELECT m.*, c.n_samples, c.n_positive, c.n_samples - c.n_positive AS n_negative,
  round(c.n_positive / c.n_samples, 6) AS baseline_rate, round(c.brier, 6) AS brier_score,
  round(cal.ce, 6) AS calibration_error, round(cal.ece, 6) AS ece
FROM (SELECT model, tn, fp, fn, tp, recall, precision, f1, f2 FROM (""" + _metrics_sql("cnt", "model", "0.5") + """)) m
JOIN cnt c USING (model) JOIN cal USING (model)""", "v2").replace(")\n, cal AS", "),\ncal AS"))
def e9_evaluate_predictions(spark, d):
    m = E.evaluate_predictions(scored(spark, d), ["model"], "label", "risk_score")
    return _r(m, ["recall", "precision", "f1", "f2", "baseline_rate", "brier_score", "calibration_error", "ece"])


def _seg_metrics(spark, d):
    v2 = scored(spark, d)
    r = E.ranking_metrics(v2, ["model", "segment"], "label", "risk_score")
    m = E.classification_metrics(v2, ["model", "segment"], "label", "risk_score", 0.5)
    return r.join(m, ["model", "segment"])


SEG_SQL = with_views("""
, rk AS (""" + RANK_SQL.format(by="model, segment", join="x.model = st.model AND x.segment = st.segment") + """),
cm AS (SELECT model, segment, count(*) FILTER (WHERE label = 1 AND risk_score >= 0.5) AS tp,
    count(*) FILTER (WHERE label = 0 AND risk_score >= 0.5) AS fp, count(*) FILTER (WHERE label = 1 AND risk_score < 0.5)
    AS fn FROM v2 GROUP BY ALL),
sm AS (SELECT rk.*, round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) AS recall,
  round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) AS precision FROM rk JOIN cm USING (model, segment))""",
                     "v2", ctes=[_st_sql("model, segment")]).replace(")\n, rk AS", "),\nrk AS")


@query("e10_rank_models_by_segment", SEG_SQL + """
SELECT segment, model, pr_auc,
  CAST(row_number() OVER (PARTITION BY segment ORDER BY pr_auc DESC NULLS LAST, model) AS INTEGER) AS rank
FROM sm""")
def e10_rank_models_by_segment(spark, d):
    m = _r(_seg_metrics(spark, d), ["pr_auc"])
    return E.rank_models(m, "pr_auc", ["segment"]).select("segment", "model", "pr_auc", "rank")


@query("e11_best_model_by_segment", SEG_SQL + """
SELECT segment, model, pr_auc FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY pr_auc DESC NULLS LAST, model)
  AS rank FROM sm) WHERE rank = 1""")
def e11_best_model_by_segment(spark, d):
    m = _r(_seg_metrics(spark, d), ["pr_auc"])
    return E.best_models(m, "pr_auc", ["segment"]).select("segment", "model", "pr_auc")


@query("e12_champion_gate_by_segment", SEG_SQL + """
, g AS (SELECT a.segment, a.recall AS ch_recall, a.precision AS ch_precision, a.brier_score AS ch_brier_score,
    a.roc_auc AS ch_roc_auc, b.recall AS cp_recall, b.precision AS cp_precision, b.brier_score AS cp_brier_score,
    b.roc_auc AS cp_roc_auc
  FROM (SELECT * FROM sm WHERE model = 'm1') a FULL OUTER JOIN (SELECT * FROM sm WHERE model = 'm0') b USING (segment)),
r AS (SELECT *, list_filter([CASE WHEN cp_recall - ch_recall > 0.02 THEN 'recall dropped' END,
    CASE WHEN cp_precision - ch_precision > 0.05 THEN 'precision dropped' END,
    CASE WHEN ch_brier_score - cp_brier_score > 0.02 THEN 'brier worse' END,
    CASE WHEN ch_roc_auc < cp_roc_auc THEN 'auc lower' END], lambda x: x IS NOT NULL) AS rs FROM g)
SELECT segment, ch_recall, ch_precision, ch_brier_score, ch_roc_auc, cp_recall, cp_precision, cp_brier_score, cp_roc_auc,
  len(rs) = 0 AS approved, array_to_string(rs, '; ') AS reasons FROM r""".replace("\n, g AS", ",\ng AS"))
def e12_champion_gate_by_segment(spark, d):
    m = _r(_seg_metrics(spark, d), ["pr_auc", "roc_auc", "brier_score", "recall", "precision"])
    return E.champion_gate(m, "m1", "m0", ["segment"])


def _late_labels(spark, d):
    o = table(spark, d, "orders").where(F.col("o_orderstatus") != "O")
    return o.select(F.col("o_orderkey").alias("request_id"), (F.col("o_orderstatus") == "F").cast("int").alias("label"))


@query("e13_performance_drift_by_period", with_views("""
, j AS (SELECT p.model, p.period, p.risk_score, l.label FROM v2 p
        JOIN (SELECT o_orderkey AS request_id, CAST(o_orderstatus = 'F' AS INTEGER) AS label FROM orders
              WHERE o_orderstatus <> 'O') l USING (request_id)),
stp AS (SELECT model, period, score, pos, neg,
  sum(pos) OVER (PARTITION BY model, period ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp_ge,
  sum(neg) OVER (PARTITION BY model, period ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp_ge,
  sum(pos) OVER (PARTITION BY model, period) AS P, sum(neg) OVER (PARTITION BY model, period) AS N
  FROM (SELECT model, period, risk_score AS score, count(*) FILTER (WHERE label = 1) AS pos,
        count(*) FILTER (WHERE label <> 1) AS neg FROM j GROUP BY ALL)),
rk AS (SELECT model, period, sum(CASE WHEN P > 0 THEN pos / P * (tp_ge / (tp_ge + fp_ge)) ELSE 0.0 END) AS pr_auc,
  CASE WHEN first(P) > 0 AND first(N) > 0 THEN sum(pos * (N - fp_ge + 0.5 * neg)) / (first(P) * first(N)) END AS roc_auc
  FROM stp GROUP BY ALL),
c AS (SELECT model, period, count(*) AS n, avg(label) AS pr, avg(pow(risk_score - label, 2)) AS brier,
  count(*) FILTER (WHERE label = 1 AND risk_score >= 0.5) AS tp, count(*) FILTER (WHERE label = 0 AND risk_score >= 0.5) AS fp,
  count(*) FILTER (WHERE label = 1 AND risk_score < 0.5) AS fn FROM j GROUP BY ALL),
m AS (SELECT c.*, rk.pr_auc, rk.roc_auc, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
  coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision FROM c JOIN rk USING (model, period)),
a AS (SELECT *, list_filter([CASE WHEN recall < 0.7 THEN 'recall low' END, CASE WHEN precision < 0.3 THEN 'precision low' END,
  CASE WHEN roc_auc < 0.75 THEN 'auc low' END], lambda x: x IS NOT NULL) AS al FROM m)
SELECT g.model, g.period, CASE WHEN a.n IS NULL THEN 'no_data' WHEN a.n < 50 THEN 'insufficient_data'
    WHEN len(al) > 0 THEN 'red' ELSE 'green' END AS status, coalesce(a.n, 0) AS n_samples,
  round(pr, 6) AS positive_rate, round(recall, 6) AS recall, round(precision, 6) AS precision,
  round(CASE WHEN (precision + recall) > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 6) AS f1,
  round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, round(brier, 6) AS brier_score,
  CASE WHEN a.n >= 50 THEN array_to_string(al, '; ') END AS alerts
FROM (SELECT DISTINCT model, period FROM v2) g LEFT JOIN a USING (model, period)""", "v2").replace(")\n, j AS", "),\nj AS"))
def e13_performance_drift_by_period(spark, d):
    pred = scored(spark, d).drop("label")
    out = E.performance_drift(pred, _late_labels(spark, d), ["model", "period"])
    return _r(out, ["positive_rate", "recall", "precision", "f1", "roc_auc", "pr_auc", "brier_score"])


@query("x12_metric_pivot_by_model", with_views("""
SELECT model, round(sum(CASE WHEN P > 0 THEN pos / P * (tp_ge / (tp_ge + fp_ge)) ELSE 0.0 END), 6) AS pr_auc,
  round(sum(pos * (N - fp_ge + 0.5 * neg)) / (first(P) * first(N)), 6) AS roc_auc,
  round((SELECT avg(pow(risk_score - label, 2)) FROM v2 x WHERE x.model = st.model), 6) AS brier_score
FROM st GROUP BY model""", "v2", ctes=[_st_sql("model")]))
def x12_metric_pivot_by_model(spark, d):
    r = _r(E.ranking_metrics(scored(spark, d), ["model"], "label", "risk_score"), ["pr_auc", "roc_auc", "brier_score"])
    long = r.unpivot(["model"], ["pr_auc", "roc_auc", "brier_score"], "metric", "value")
    return pivot_metrics(long, "model", "metric", "value", ["pr_auc", "roc_auc", "brier_score"])


@query("d12_subgroup_auc_gap", with_views("""
, r AS (SELECT model, segment, CASE WHEN first(P) > 0 AND first(N) > 0 THEN
    sum(pos * (N - fp_ge + 0.5 * neg)) / (first(P) * first(N)) END AS roc_auc FROM st GROUP BY ALL)
SELECT r.model, r.segment, round(r.roc_auc, 6) AS roc_auc, round(f.roc_auc, 6) AS ref_auc,
  round(r.roc_auc - f.roc_auc, 6) AS auc_gap
FROM r LEFT JOIN (SELECT model, roc_auc FROM r WHERE segment = '1-URGENT') f USING (model)""",
                                           "v2", ctes=[_st_sql("model, segment")]).replace(")\n, r AS", "),\nr AS"))
def d12_subgroup_auc_gap(spark, d):
    g = E.subgroup_gap(scored(spark, d), "model", "segment", "label", "risk_score", "1-URGENT")
    return _r(g, ["roc_auc", "ref_auc", "auc_gap"])


@query("e6_points_on_pr_curve", with_views("""
, cur AS (SELECT model, tp_ge / (tp_ge + fp_ge) AS precision, coalesce(tp_ge / nullif(P, 0), 0.0) AS recall
  FROM st LEFT JOIN (SELECT model, max(score) AS tmin FROM st WHERE tp_ge = P GROUP BY model) f USING (model)
  WHERE tmin IS NULL OR score >= tmin)
SELECT g.model, round(a.p, 6) AS precision_at_recall_075, round(b.r, 6) AS recall_at_precision_080
FROM (SELECT DISTINCT model FROM v2) g
LEFT JOIN (SELECT model, max(precision) AS p FROM cur WHERE recall >= 0.75 GROUP BY model) a USING (model)
LEFT JOIN (SELECT model, max(recall) AS r FROM cur WHERE precision >= 0.8 GROUP BY model) b USING (model)""",
                                           "v2", ctes=[_st_sql("model")]).replace(")\n, cur AS", "),\ncur AS"))
def e6_points_on_pr_curve(spark, d):
    """Documented operating points: precision at recall >= .75, recall at
    precision >= .80."""
    v2 = scored(spark, d)
    cur = E.pr_curve(v2, ["model"], "label", "risk_score")
    a = E.point_on_curve(cur, ["model"], "recall", 0.75, "precision")
    b = E.point_on_curve(cur, ["model"], "precision", 0.8, "recall")
    g = v2.select("model").distinct()
    out = g.join(a, "model", "left").join(b, "model", "left")
    return out.select("model", F.round("precision_at_recall_075", 6).alias("precision_at_recall_075"),
                      F.round("recall_at_precision_080", 6).alias("recall_at_precision_080"))
