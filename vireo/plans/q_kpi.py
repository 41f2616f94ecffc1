"""Registered queries: documented KPIs and rules (D1-D11, D13-D16), audit and
latest-state queries (W10, W11)."""

from pyspark.sql import functions as F

from vireo.operators import kpi as K
from vireo.operators.drift import daily_score_psi
from vireo.plans.bindings import req_log, scored, subject_year, table, with_views
from vireo.plans.catalog import query
from vireo.plans.modeling import MODELING_SQL, modeling_long
from vireo.plans.sqlgen import edge_bin_sql, unit_edges_sql


def _ts_str(c):
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")


_RULES_SQL = ("(VALUES ('high', 'repeat', 'escalation', 5), ('high', 'none', 'immediate_action', 7), "
              "('medium', 'rising', 'prevention', 10), ('medium', 'none', 'active_monitoring', 14), "
              "('low', 'none', 'standard_followup', NULL)) r(band, modifier, decision, sla_days)")
_BAND = "CASE WHEN {c} >= 0.7 THEN 'high' WHEN {c} >= 0.3 THEN 'medium' WHEN {c} IS NOT NULL THEN 'low' END"


@query("d1_action_matrix", with_views(f"""
, s AS (SELECT subject, period, round(avg(risk_score), 6) AS score FROM v2 GROUP BY ALL),
l AS (SELECT *, lag(score) OVER (PARTITION BY subject ORDER BY period) AS prev_score FROM s),
b AS (SELECT *, {_BAND.format(c='score')} AS band, {_BAND.format(c='prev_score')} AS prev_band FROM l),
m AS (SELECT *, CASE WHEN band = 'high' AND prev_band = 'high' THEN 'repeat'
                     WHEN band = 'medium' AND score > prev_score THEN 'rising' ELSE 'none' END AS modifier FROM b)
SELECT m.band, m.modifier, subject, period, score, prev_score, r.decision, CAST(r.sla_days AS INTEGER) AS sla_days
FROM m LEFT JOIN {_RULES_SQL} USING (band, modifier)""", "v2").replace(")\n, s AS", "),\ns AS"))
def d1_action_matrix(spark, d):
    s = scored(spark, d).groupBy("subject", "period").agg(F.round(F.avg("risk_score"), 6).alias("score"))
    return K.action_matrix(s, "subject", "period", "score")


def _outcomes(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("key"), F.col("l_shipdate").alias("outcome_date"),
                     F.col("l_quantity").alias("value"), (F.col("l_returnflag") == "R").cast("int").alias("label"),
                     F.year("l_shipdate").alias("period"))


@query("d2_outcome_validation", """
WITH h AS (SELECT o_orderkey AS key, min(o_orderdate) AS sd FROM orders GROUP BY 1),
f AS (SELECT h.sd IS NOT NULL AS key_ok, coalesce(l_shipdate > h.sd, false) AS date_ok,
        coalesce(l_quantity BETWEEN 1 AND 50, false) AS value_ok, true AS label_ok
      FROM lineitem l LEFT JOIN h ON l.l_orderkey = h.key)
SELECT count(*) AS n, count(*) FILTER (WHERE key_ok) AS n_key_ok, count(*) FILTER (WHERE date_ok) AS n_date_ok,
  count(*) FILTER (WHERE value_ok) AS n_value_ok, count(*) FILTER (WHERE label_ok) AS n_label_ok,
  count(*) FILTER (WHERE key_ok AND date_ok AND value_ok AND label_ok) AS n_valid FROM f""")
def d2_outcome_validation(spark, d):
    hist = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("score_date"))
    flags = K.validate_outcomes(_outcomes(spark, d), hist, "key", "outcome_date", "score_date", "value", 1, 50, "label")
    return K.outcome_validation_summary(flags)


@query("d3_feedback_quality", with_views("""
, fo AS (SELECT l_orderkey AS key, min(l_shipdate) AS od, max(CAST(l_returnflag = 'R' AS INTEGER)) AS lab
        FROM lineitem GROUP BY 1),
c AS (SELECT count(*) AS n_high, count(*) FILTER (WHERE od IS NOT NULL) AS n_with_outcome,
        avg(date_diff('day', CAST(ts AS DATE), CAST(od AS DATE))) AS lagd,
        count(*) FILTER (WHERE date_diff('day', CAST(ts AS DATE), CAST(od AS DATE)) < 90) AS n_lag_ok,
        avg(CAST(lab AS DOUBLE)) AS ps
      FROM v2 LEFT JOIN fo ON v2.request_id = fo.key WHERE risk_score >= 0.5),
dd AS (SELECT count(*) AS n_duplicate_keys FROM (SELECT l_orderkey, year(l_shipdate) FROM lineitem GROUP BY ALL
       HAVING count(*) > 1))
SELECT n_high, n_with_outcome, round(n_with_outcome / n_high, 6) AS coverage, round(lagd, 6) AS mean_lag_days,
  n_lag_ok, round(ps, 6) AS positive_share, n_duplicate_keys, n_with_outcome / n_high >= 0.3 AS coverage_ok,
  n_lag_ok = n_with_outcome AS lag_ok, ps BETWEEN 0.2 AND 0.8 AS balance_ok, n_duplicate_keys = 0 AS consistency_ok
FROM c, dd""", "v2").replace(")\n, fo AS", "),\nfo AS"))
def d3_feedback_quality(spark, d):
    s = scored(spark, d).select(F.col("request_id").alias("key"), "risk_score", F.col("ts").alias("score_date"))
    return K.feedback_quality(s, _outcomes(spark, d), "key", "risk_score", "score_date", "outcome_date", "label",
                              "period", high=0.5)


def _seg(spark, d):
    v1 = subject_year(spark, d)
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("ra"), "c_mktsegment", "c_nationkey")
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return v1.join(c, "ra").join(n, "c_nationkey")


@query("d4_kpis_grouping_sets", with_views("""
SELECT ano, c_mktsegment, n_name, GROUPING(ano, c_mktsegment, n_name) AS grouping_id, count(*) AS n,
  round(avg(CAST(defasagem > 0 AS DOUBLE)), 6) AS lag_rate, round(avg(ian), 6) AS mean_ian
FROM v1 JOIN customer c ON v1.ra = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY GROUPING SETS ((ano), (c_mktsegment), (n_name), (ano, c_mktsegment), ())""", "v1"))
def d4_kpis_grouping_sets(spark, d):
    return K.kpis_by_segment(_seg(spark, d), [["ano"], ["c_mktsegment"], ["n_name"], ["ano", "c_mktsegment"], []])


@query("d5_relative_change_same_quarter", """
WITH r AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
             round(avg(CAST(o_orderstatus = 'F' AS DOUBLE)), 6) AS rate FROM orders GROUP BY ALL)
SELECT year, quarter, rate, lag(rate) OVER (PARTITION BY quarter ORDER BY year) AS baseline,
  round((rate - lag(rate) OVER (PARTITION BY quarter ORDER BY year)) / lag(rate) OVER (PARTITION BY quarter ORDER BY year), 6)
    AS relative_change
FROM r""")
def d5_relative_change_same_quarter(spark, d):
    o = table(spark, d, "orders")
    r = o.groupBy(F.year("o_orderdate").cast("int").alias("year"), F.quarter("o_orderdate").cast("int").alias("quarter")) \
         .agg(F.round(F.avg((F.col("o_orderstatus") == "F").cast("double")), 6).alias("rate"))
    return K.relative_change(r, ["quarter"], "year", "rate")


@query("d5_relative_change_with_gaps", """
WITH r AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
             round(avg(CAST(o_orderstatus = 'F' AS DOUBLE)), 6) AS rate FROM orders
           WHERE (year(o_orderdate) + quarter(o_orderdate)) % 4 <> 0 GROUP BY ALL)
SELECT r.year, r.quarter, r.rate, b.rate AS baseline, round((r.rate - b.rate) / nullif(b.rate, 0), 6) AS relative_change
FROM r LEFT JOIN r b ON b.quarter = r.quarter AND b.year = r.year - 2""")
def d5_relative_change_with_gaps(spark, d):
    """Change against two years before, in rates of which every fourth is absent."""
    o = table(spark, d, "orders")
    r = o.groupBy(F.year("o_orderdate").cast("int").alias("year"), F.quarter("o_orderdate").cast("int").alias("quarter")) \
         .agg(F.round(F.avg((F.col("o_orderstatus") == "F").cast("double")), 6).alias("rate")).where((F.col("year") + F.col("quarter")) % 4 != 0)
    return K.relative_change(r, ["quarter"], "year", "rate", lag=2)


@query("d6_process_kpis_by_segment", with_views("""
, s AS (SELECT segment, request_id AS key, ts FROM v2 WHERE risk_score >= 0.5),
j AS (SELECT s.segment, s.key, s.ts, min(l.l_shipdate) AS fa FROM s LEFT JOIN lineitem l ON l.l_orderkey = s.key
      WHERE l.l_shipdate IS NULL OR l.l_shipdate >= s.ts GROUP BY ALL),
a AS (SELECT segment, count(*) FILTER (WHERE fa IS NOT NULL) AS n_acted,
        avg(date_diff('day', CAST(ts AS DATE), CAST(fa AS DATE))) AS md FROM j GROUP BY segment)
SELECT h.segment, h.n_high, coalesce(a.n_acted, 0) AS n_acted, round(a.n_acted / h.n_high, 6) AS intervention_rate,
  round(a.md, 6) AS mean_days_to_action
FROM (SELECT segment, count(*) AS n_high FROM s GROUP BY segment) h LEFT JOIN a USING (segment)""", "v2")
       .replace(")\n, s AS", "),\ns AS"))
def d6_process_kpis_by_segment(spark, d):
    s = scored(spark, d).select("segment", F.col("request_id").alias("key"), "risk_score",
                                F.col("ts").alias("score_date"))
    a = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"),
                                           F.col("l_shipdate").cast("timestamp").alias("action_date"))
    return K.process_kpis(s, a, "key", "risk_score", "score_date", "action_date", ["segment"], high=0.5)


@query("d7_loss_bias_t_test", """
WITH m AS (SELECT c_acctbal, c_custkey IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1998) AS g FROM customer),
s AS (SELECT g, count(c_acctbal) AS n, avg(c_acctbal) AS mean, var_samp(c_acctbal) AS var FROM m GROUP BY g),
a AS (SELECT n AS n_1, mean AS mean_1, var AS var_1 FROM s WHERE g),
b AS (SELECT n AS n_0, mean AS mean_0, var AS var_0 FROM s WHERE NOT g)
SELECT n_1, n_0, round(mean_1, 6) AS mean_1, round(mean_0, 6) AS mean_0,
  round((mean_1 - mean_0) / sqrt(((n_1 - 1) * var_1 + (n_0 - 1) * var_0) / (n_1 + n_0 - 2) * (1.0 / n_1 + 1.0 / n_0)), 6) AS t,
  n_1 + n_0 - 2 AS dof FROM a, b""")
def d7_loss_bias_t_test(spark, d):
    c = table(spark, d, "customer")
    o98 = table(spark, d, "orders").where(F.year("o_orderdate") == 1998) \
        .select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("g", F.lit(True))
    m = c.join(o98, "c_custkey", "left").select("c_acctbal", F.coalesce("g", F.lit(False)).alias("g"))
    return K.two_sample_t(m, "g", "c_acctbal")


@query("d8_missing_target_association", with_views("""
SELECT feature, count(*) FILTER (WHERE miss) AS n_missing, round(avg(y) FILTER (WHERE miss), 6) AS rate_missing,
  round(avg(y) FILTER (WHERE NOT miss), 6) AS rate_present,
  round(avg(y) FILTER (WHERE miss) - avg(y) FILTER (WHERE NOT miss), 6) AS gap,
  coalesce(abs(avg(y) FILTER (WHERE miss) - avg(y) FILTER (WHERE NOT miss)) > 0.1, false) AS informative
FROM (SELECT CAST(em_risco AS DOUBLE) AS y, 'ida' AS feature, ida IS NULL AS miss FROM m
      UNION ALL SELECT CAST(em_risco AS DOUBLE), 'ieg', ieg IS NULL FROM m) GROUP BY feature""",
                                                   "v1", ctes=[MODELING_SQL]))
def d8_missing_target_association(spark, d):
    return K.missing_target_association(modeling_long(subject_year(spark, d)), ["ida", "ieg"], "em_risco")


@query("d9_ordinal_target_counts", with_views("""
SELECT ano, CASE WHEN defasagem >= 0 THEN 'adequado_avancado' WHEN defasagem = -1 THEN 'defasagem_leve'
  WHEN defasagem <= -2 THEN 'defasagem_severa' END AS level, count(*) AS n FROM v1 GROUP BY ALL""", "v1"))
def d9_ordinal_target_counts(spark, d):
    v1 = subject_year(spark, d)
    return v1.groupBy("ano", K.ordinal_target("defasagem").alias("level")).agg(F.count(F.lit(1)).alias("n"))


@query("d10_temporal_consistency", with_views("""
WITH_ d AS (SELECT ra, ano, count(*) AS n, max(ano - ano_ingresso) AS t FROM v1 GROUP BY ALL),
s AS (SELECT *, lag(ano) OVER (PARTITION BY ra ORDER BY ano) AS prev, lag(t) OVER (PARTITION BY ra ORDER BY ano) AS pt FROM d)
SELECT count(*) FILTER (WHERE n > 1) AS n_duplicate_keys,
  count(*) FILTER (WHERE prev IS NOT NULL AND ano - prev > 1) AS n_gaps, count(*) FILTER (WHERE t < pt) AS n_tenure_decreases
FROM s""", "v1").replace("\nWITH_ d AS", ",\nd AS"))
def d10_temporal_consistency(spark, d):
    v1 = subject_year(spark, d).withColumn("tenure", F.col("ano") - F.col("ano_ingresso"))
    return K.temporal_consistency(v1, "ra", "ano", "tenure")


@query("d11_subject_folds", with_views("""
SELECT CAST(CAST('0x' || substr(md5('42:' || ra), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold, count(DISTINCT ra) AS n_subjects, count(*) AS n_rows
FROM v1 GROUP BY fold""", "v1"))
def d11_subject_folds(spark, d):
    """Hash folds by subject: no subject spans two folds."""
    f = K.subject_folds(subject_year(spark, d), "ra", 5)
    return f.groupBy("fold").agg(F.countDistinct("ra").alias("n_subjects"), F.count(F.lit(1)).alias("n_rows"))


_D11 = """
s AS (SELECT ra, count(*) AS n_rows, count(*) FILTER (WHERE defasagem < 0) AS n_pos FROM v1 GROUP BY ra),
o AS (SELECT *, (row_number() OVER (ORDER BY n_rows DESC, n_pos DESC, md5(CAST(ra AS VARCHAR))) - 1) % 5 AS fold FROM s)"""


@query("d11_balanced_folds", with_views("SELECT ra, CAST(fold AS INTEGER) AS fold FROM o", "v1", ctes=[_D11]))
def d11_balanced_folds(spark, d):
    """Whole subjects in folds of equal size and class share."""
    f = K.balanced_folds(subject_year(spark, d).withColumn("late", (F.col("defasagem") < 0).cast("int")), "ra", "late", 5)
    return f.select("ra", "fold")


@query("d11_fold_balance", with_views("""
SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n_subjects, CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(sum(n_pos) AS BIGINT) AS n_pos,
  (SELECT max(x) - min(x) FROM (SELECT sum(n_rows) AS x FROM o GROUP BY fold)) <= (SELECT max(n_rows) FROM s) AS within_bound
FROM o GROUP BY fold""", "v1", ctes=[_D11]))
def d11_fold_balance(spark, d):
    f = K.balanced_folds(subject_year(spark, d).withColumn("late", (F.col("defasagem") < 0).cast("int")), "ra", "late", 5)
    per = f.groupBy("fold").agg(F.count(F.lit(1)).alias("n_subjects"), F.sum("n_rows").alias("n_rows"), F.sum("n_pos").alias("n_pos"),
                                F.max("n_rows").alias("__largest"))
    r = per.agg(F.max("n_rows") - F.min("n_rows"), F.max("__largest")).first()
    return per.drop("__largest").withColumn("within_bound", F.lit(bool(r[0] <= r[1])))


@query("d11_temporal_folds", with_views("""
SELECT p.fold, CASE WHEN ano = p.fold THEN 'test' ELSE 'train' END AS role, count(*) AS n, count(*) FILTER (WHERE defasagem < 0) AS n_pos
FROM v1, (SELECT DISTINCT ano AS fold FROM v1) p WHERE ano = p.fold OR ano < p.fold - 1 GROUP BY ALL""", "v1"))
def d11_temporal_folds(spark, d):
    """Every period tested on models of the periods before it, with a gap of one."""
    from vireo.operators.prepare import periods
    v = subject_year(spark, d)
    f = K.temporal_folds(v, "ano", periods(v, "ano"), gap=1)
    return f.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("defasagem") < 0).alias("n_pos"))


def _triggers_sql():
    from vireo.plans.catalog import REGISTRY
    return f"""
WITH daily AS (SELECT * FROM ({REGISTRY["w7_daily_score_psi_batch"][1]}) a),
perf AS (SELECT * FROM ({REGISTRY["e13_performance_drift_by_period"][1]}) b),
red AS (SELECT day - CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS island FROM daily WHERE status = 'red'),
t AS (SELECT (SELECT coalesce(max(psi), 0.0) FROM daily) AS max_psi,
  CAST((SELECT coalesce(max(n), 0) FROM (SELECT count(*) AS n FROM red GROUP BY island)) AS BIGINT) AS max_red_streak,
  (SELECT min(recall) FROM perf WHERE status <> 'insufficient_data') AS min_recall, (SELECT count(*) FROM labels) AS n_new_labels)
SELECT *, psi_trigger OR streak_trigger OR recall_trigger OR label_trigger AS retrain
FROM (SELECT *, max_psi >= 0.25 AS psi_trigger, max_red_streak > 7 AS streak_trigger,
  coalesce(min_recall < 0.65, false) AS recall_trigger, n_new_labels > 500 AS label_trigger FROM t)"""


@query("d13_retrain_triggers", _triggers_sql())
def d13_retrain_triggers(spark, d):
    """Daily score PSI streaks, recall floor per model-period, volume of new
    labels."""
    from vireo.operators.evaluate import performance_drift
    from vireo.plans.q_drift import _windows
    from vireo.plans.q_evaluate import _late_labels
    b, c = _windows(spark, d)
    daily = daily_score_psi(b.select("score"), c.select("ts", "score"))
    perf = performance_drift(scored(spark, d).drop("label"), _late_labels(spark, d), ["model", "period"])
    n_lab = table(spark, d, "labels").agg(F.count(F.lit(1)).alias("n"))
    return K.retrain_triggers(daily, perf.where(F.col("status") != "insufficient_data"), n_lab)


@query("d14_ops_dashboard_hourly", with_views("""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bucket, count(*) AS n,
  count(*) FILTER (WHERE status_code >= 500) AS n_errors,
  round(count(*) FILTER (WHERE status_code >= 500) / count(*), 6) AS error_rate,
  round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency
FROM v3 GROUP BY ALL""", "v3"))
def d14_ops_dashboard_hourly(spark, d):
    out = K.ops_dashboard(req_log(spark, d), "ts", "latency_ms", "status_code", "hour")
    return out.withColumn("bucket", _ts_str("bucket"))


@query("d15_error_bursts_5min", with_views("""
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(ws + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
  count(*) AS n, count(*) FILTER (WHERE status_code >= 500) AS n_errors,
  round(count(*) FILTER (WHERE status_code >= 500) / count(*), 6) AS error_rate,
  count(*) FILTER (WHERE status_code >= 500) / count(*) > 0.01 AS incident
FROM (SELECT *, time_bucket(INTERVAL 1 MINUTE, ts) - k * INTERVAL 1 MINUTE AS ws FROM v3, range(5) t(k)) GROUP BY ws""",
                                           "v3"))
def d15_error_bursts_5min(spark, d):
    out = K.error_bursts(req_log(spark, d), "ts", "status_code")
    return out.withColumn("window_start", _ts_str("window_start")).withColumn("window_end", _ts_str("window_end"))


@query("d15_volume_vs_trailing_mean", with_views("""
WITH_ s AS (SELECT endpoint, date_trunc('hour', ts) AS hour, count(*) AS n FROM v3 GROUP BY ALL),
grid AS (SELECT endpoint, unnest(generate_series(min(hour), (SELECT max(hour) FROM s), INTERVAL 1 HOUR)) AS hour FROM s GROUP BY endpoint),
h AS (SELECT grid.endpoint, grid.hour, coalesce(s.n, 0) AS n FROM grid LEFT JOIN s ON s.endpoint = grid.endpoint AND s.hour = grid.hour)
SELECT endpoint, strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, n,
  round(avg(n) OVER (PARTITION BY endpoint ORDER BY hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 6) AS expected,
  coalesce(abs(n - avg(n) OVER (PARTITION BY endpoint ORDER BY hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
    <= 0.2 * avg(n) OVER (PARTITION BY endpoint ORDER BY hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), true)
    AS within_tolerance
FROM h""", "v3").replace("\nWITH_ s AS", ",\ns AS"))
def d15_volume_vs_trailing_mean(spark, d):
    out = K.volume_anomalies(req_log(spark, d), "ts", ["endpoint"])
    return out.withColumn("hour", _ts_str("hour"))


@query("d16_winsorize_lineitem", """
WITH q AS (SELECT quantile_cont(l_quantity, 0.01) AS ql, quantile_cont(l_quantity, 0.99) AS qh,
             quantile_cont(l_extendedprice, 0.01) AS el, quantile_cont(l_extendedprice, 0.99) AS eh FROM lineitem)
SELECT l_orderkey, l_linenumber, round(least(greatest(l_quantity, ql), qh), 6) AS l_quantity,
  round(least(greatest(l_extendedprice, el), eh), 6) AS l_extendedprice FROM lineitem, q""")
def d16_winsorize_lineitem(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    w = K.winsorize(li, ["l_quantity", "l_extendedprice"])
    return w.select("l_orderkey", "l_linenumber", F.round("l_quantity", 6).alias("l_quantity"),
                    F.round("l_extendedprice", 6).alias("l_extendedprice"))


@query("d16_winsorize_with_nulls", """
WITH v AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 > 0 THEN l_quantity END AS x FROM lineitem),
q AS (SELECT quantile_cont(x, 0.01) AS lo, quantile_cont(x, 0.99) AS hi FROM v)
SELECT l_orderkey, l_linenumber, CASE WHEN x IS NOT NULL THEN round(least(greatest(x, lo), hi), 6) END AS x FROM v, q""")
def d16_winsorize_with_nulls(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") % 3 > 0, F.col("l_quantity")).alias("x"))
    return K.winsorize(li, ["x"]).select("l_orderkey", "l_linenumber", F.round("x", 6).alias("x"))


@query("w10_audit_newest_purchases", with_views("""
SELECT request_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, api_key, endpoint, latency_ms, status_code FROM v3
WHERE endpoint = 'purchase' ORDER BY v3.ts DESC, request_id DESC LIMIT 100""", "v3"))
def w10_audit_newest_purchases(spark, d):
    v3 = req_log(spark, d).select("ts", "request_id", "api_key", "endpoint", "latency_ms", "status_code")
    out = K.audit_newest(v3, "ts", "endpoint", "purchase", 100)
    return out.select("request_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "api_key",
                      "endpoint", "latency_ms", "status_code")


@query("w10_audit_counts", with_views("SELECT endpoint, count(*) AS n FROM v3 GROUP BY endpoint", "v3"))
def w10_audit_counts(spark, d):
    return K.audit_counts(req_log(spark, d), "endpoint")


@query("w11_latest_state_per_user", """
WITH r AS (SELECT user_id, ts, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
           FROM events)
SELECT a.user_id, strftime(a.ts, '%Y-%m-%d %H:%M:%S.%f') AS latest_ts, a.event_type AS current, b.event_type AS previous
FROM (SELECT * FROM r WHERE rn = 1) a LEFT JOIN (SELECT * FROM r WHERE rn = 2) b USING (user_id)""")
def w11_latest_state_per_user(spark, d):
    e = table(spark, d, "events")
    out = K.latest_per_key(e, "user_id", "ts", "event_type", tie="event_id")
    return out.withColumn("latest_ts", F.date_format("latest_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("d14_daily_score_histogram", f"""
WITH s AS (SELECT CAST(ts AS DATE) AS day, value / (value + 50) AS score FROM events WHERE value IS NOT NULL),
n AS (SELECT day, count(*) AS n FROM s GROUP BY day),
c AS (SELECT day, {edge_bin_sql('score')} AS bin, count(*) AS cnt FROM s WHERE {edge_bin_sql('score')} IS NOT NULL
      GROUP BY ALL)
SELECT n.day, CAST(r.bin AS INTEGER) AS bin, {unit_edges_sql()}[r.bin + 1] AS lo, {unit_edges_sql()}[r.bin + 2] AS hi,
  CAST(coalesce(c.cnt, 0) AS BIGINT) AS cnt, round(coalesce(c.cnt, 0) / n.n, 4) AS freq
FROM n, range(20) r(bin) LEFT JOIN c ON c.day = n.day AND c.bin = r.bin""")
def d14_daily_score_histogram(spark, d):
    """Dashboard panel: the score histogram per day (fixed 20 bins)."""
    from vireo.operators.profile import score_histogram
    e = table(spark, d, "events").where(F.col("value").isNotNull()) \
        .select(F.to_date("ts").alias("day"), (F.col("value") / (F.col("value") + 50)).alias("score"))
    return score_histogram(e, "score", by=["day"])
