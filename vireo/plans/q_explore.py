"""Registered queries: exploration."""

from pyspark.sql import functions as F

from vireo.operators import explore as X
from vireo.operators.features import add_tenure_col
from vireo.plans.bindings import scored, table, with_views
from vireo.plans.catalog import query
from vireo.plans.modeling import MODELING_SQL, modeling_table

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("x1_describe_lineitem", f"""
SELECT feature AS "column", count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
  round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS max
FROM (SELECT * FROM (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in LI_NUM)} FROM lineitem)
      UNPIVOT (value FOR feature IN ({', '.join(LI_NUM)}))) GROUP BY feature""")
def x1_describe_lineitem(spark, d):
    return X.describe(table(spark, d, "lineitem"), LI_NUM)


@query("x4_histogram_extendedprice", """
WITH mm AS (SELECT min(l_extendedprice) AS mn, max(l_extendedprice) AS mx FROM lineitem),
b AS (SELECT CAST(least(floor((l_extendedprice - mn) / (mx - mn) * 10), 9) AS INTEGER) AS bin, count(*) AS n
      FROM lineitem, mm WHERE l_extendedprice IS NOT NULL GROUP BY 1)
SELECT bin, round(mn + bin * ((mx - mn) / 10), 6) AS lo, round(mn + bin * ((mx - mn) / 10) + (mx - mn) / 10, 6) AS hi, n
FROM b, mm""")
def x4_histogram_extendedprice(spark, d):
    return X.histogram(table(spark, d, "lineitem"), "l_extendedprice", 10)


@query("x5_box_stats_by_returnflag", """
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
                  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY l_returnflag),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.l_returnflag, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
  round(min(l_extendedprice) FILTER (WHERE l_extendedprice BETWEEN lo AND hi), 6) AS whisker_lo,
  round(max(l_extendedprice) FILTER (WHERE l_extendedprice BETWEEN lo AND hi), 6) AS whisker_hi,
  count(*) FILTER (WHERE NOT (l_extendedprice BETWEEN lo AND hi)) AS n_outliers, count(*) AS n
FROM lineitem l JOIN f ON l.l_returnflag = f.l_returnflag
GROUP BY f.l_returnflag, q1, median, q3, iqr""")
def x5_box_stats_by_returnflag(spark, d):
    return X.box_stats(table(spark, d, "lineitem"), "l_extendedprice", ["l_returnflag"])


@query("x6_value_counts_priority", """
SELECT o_orderpriority AS value, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM orders), 4) AS pct
FROM orders GROUP BY o_orderpriority""")
def x6_value_counts_priority(spark, d):
    return X.value_counts(table(spark, d, "orders"), "o_orderpriority")


@query("x7_natural_brand_order", """
SELECT p_brand AS value, count(*) AS n,
  CASE WHEN upper(p_brand) = 'ALFA' THEN -1
       ELSE coalesce(CAST(nullif(regexp_extract(p_brand, '(\\d+)', 1), '') AS BIGINT), 99999) END AS sort_key
FROM part GROUP BY p_brand""")
def x7_natural_brand_order(spark, d):
    return X.natural_phase_order(table(spark, d, "part"), "p_brand")


@query("x8_rate_by_segment", with_views("""
SELECT c.c_mktsegment, count(*) AS n, CAST(sum(em_risco) AS BIGINT) AS n_risk, round(avg(em_risco) * 100, 4) AS rate_pct
FROM m JOIN customer c ON m.ra = c.c_custkey GROUP BY c.c_mktsegment""", "v1", ctes=[MODELING_SQL]))
def x8_rate_by_segment(spark, d):
    m = modeling_table(spark, d)
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("ra"), "c_mktsegment")
    return X.rate_by_group(m.join(c, "ra"), ["c_mktsegment"], "em_risco")


@query("x9_rate_by_tenure_min5", with_views("""
SELECT anos_pm, count(*) AS n, CAST(sum(em_risco) AS BIGINT) AS n_risk, round(avg(em_risco) * 100, 4) AS rate_pct
FROM (SELECT *, least(greatest(ano - ano_ingresso, 0), 15) AS anos_pm FROM m) GROUP BY anos_pm
HAVING count(*) >= 5""", "v1", ctes=[MODELING_SQL]))
def x9_rate_by_tenure_min5(spark, d):
    m = add_tenure_col(modeling_table(spark, d), "ano", "ano_ingresso")
    return X.rate_by_group(m, ["anos_pm"], "em_risco", min_n=5)


def _pairs_sql():
    from itertools import combinations
    parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
             for a, b in combinations(LI_NUM, 2)]
    return "\nUNION ALL ".join(parts)


@query("x10_correlation_lineitem", _pairs_sql())
def x10_correlation_lineitem(spark, d):
    return X.correlation_matrix(table(spark, d, "lineitem"), LI_NUM)


_MF = ["fase", "ian", "ida", "ieg", "ano_ingresso"]


@query("x10_top_correlated_target", with_views(f"""
SELECT feature, round(corr, 6) AS corr FROM (
  {' UNION ALL '.join(f"SELECT '{c}' AS feature, corr({c}, em_risco) AS corr FROM m" for c in _MF)})
WHERE corr IS NOT NULL ORDER BY abs(corr) DESC, feature LIMIT 5""", "v1", ctes=[MODELING_SQL]))
def x10_top_correlated_target(spark, d):
    return X.top_correlated(modeling_table(spark, d), "em_risco", _MF, k=5)


@query("x11_confusion_pct_by_model", with_views("""
SELECT model, count(*) FILTER (WHERE label = 0 AND yhat = 0) AS tn, count(*) FILTER (WHERE label = 0 AND yhat = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND yhat = 0) AS fn, count(*) FILTER (WHERE label = 1 AND yhat = 1) AS tp,
  count(*) AS n,
  round(count(*) FILTER (WHERE label = 0 AND yhat = 0) * 100.0 / count(*), 4) AS pct_tn,
  round(count(*) FILTER (WHERE label = 0 AND yhat = 1) * 100.0 / count(*), 4) AS pct_fp,
  round(count(*) FILTER (WHERE label = 1 AND yhat = 0) * 100.0 / count(*), 4) AS pct_fn,
  round(count(*) FILTER (WHERE label = 1 AND yhat = 1) * 100.0 / count(*), 4) AS pct_tp
FROM (SELECT *, CAST(risk_score >= 0.3 AS INTEGER) AS yhat FROM v2) GROUP BY model""", "v2"))
def x11_confusion_pct_by_model(spark, d):
    v2 = scored(spark, d).withColumn("yhat", (F.col("risk_score") >= 0.3).cast("int"))
    return X.confusion_percentages(v2, "label", "yhat", ["model"])


@query("x13_summary_totalprice_by_status", """
SELECT o_orderstatus, count(o_totalprice) AS n, round(avg(o_totalprice), 4) AS mean,
  round(quantile_cont(o_totalprice, 0.5), 4) AS median, round(min(o_totalprice), 4) AS min,
  round(max(o_totalprice), 4) AS max
FROM orders GROUP BY o_orderstatus""")
def x13_summary_totalprice_by_status(spark, d):
    return X.summary_stats(table(spark, d, "orders"), "o_totalprice", ["o_orderstatus"])


@query("x4_histogram_by_status", """
WITH mm AS (SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM orders),
b AS (SELECT o_orderstatus, CAST(least(floor((o_totalprice - mn) / (mx - mn) * 10), 9) AS INTEGER) AS bin, count(*) AS n
      FROM orders, mm WHERE o_totalprice IS NOT NULL GROUP BY ALL)
SELECT o_orderstatus, bin, round(mn + bin * ((mx - mn) / 10), 6) AS lo,
  round(mn + bin * ((mx - mn) / 10) + (mx - mn) / 10, 6) AS hi, n FROM b, mm""")
def x4_histogram_by_status(spark, d):
    """Equal-width histogram of order value, split by class (shared edges)."""
    return X.histogram(table(spark, d, "orders"), "o_totalprice", 10, by=["o_orderstatus"])
