"""Registered queries: profiles and summaries."""

from pyspark.sql import functions as F

from vireo.operators import profile as A
from vireo.plans import sqlgen as G
from vireo.plans.bindings import scored, table, with_views
from vireo.plans.catalog import query

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("a1_numeric_profile_lineitem", G.numeric_profile("SELECT * FROM lineitem", LI_NUM))
def a1_numeric_profile_lineitem(spark, d):
    return A.numeric_profile(table(spark, d, "lineitem"), LI_NUM)


_CUST_NULLS = """SELECT CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
  CAST(c_nationkey AS DOUBLE) AS c_nationkey FROM customer"""


@query("a1_numeric_profile_customer_nulls", G.numeric_profile(_CUST_NULLS, ["c_acctbal", "c_nationkey"]))
def a1_numeric_profile_customer_nulls(spark, d):
    from vireo.plans.q_quality import customer_with_nulls
    return A.numeric_profile(customer_with_nulls(spark, d), ["c_acctbal", "c_nationkey"])


@query("a2_categorical_profile_part", G.categorical_profile("SELECT * FROM part", ["p_brand", "p_type", "p_name"]))
def a2_categorical_profile_part(spark, d):
    return A.categorical_profile(table(spark, d, "part"), ["p_brand", "p_type", "p_name"])


@query("a2_categorical_profile_events", G.categorical_profile("SELECT * FROM events", ["event_type"]))
def a2_categorical_profile_events(spark, d):
    return A.categorical_profile(table(spark, d, "events"), ["event_type"])


@query("a2_categorical_summary_customer", f"""
SELECT feature, 'categorical' AS type, CAST(count(*) AS BIGINT) AS count,
  round(CASE WHEN count(*) > 0 THEN 1 - count(value) / count(*) ELSE 0.0 END, 4) AS missing_rate,
  CAST(count(DISTINCT value) AS BIGINT) AS n_unique
FROM {G.unpivot('''SELECT c_name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
                   FROM customer''', ['c_name', 'c_mktsegment'], 'VARCHAR')} u GROUP BY feature""")
def a2_categorical_summary_customer(spark, d):
    from vireo.plans.q_quality import customer_with_nulls
    return A.categorical_summary(customer_with_nulls(spark, d), ["c_name", "c_mktsegment"])


_SQ = [("p05", 0.05), ("p10", 0.1), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p90", 0.9), ("p95", 0.95)]


@query("a3_score_summary_by_model", with_views(f"""
SELECT model, count(*) AS count, round(avg(risk_score), 4) AS mean, round(stddev_pop(risk_score), 4) AS std,
  round(min(risk_score), 4) AS min, round(max(risk_score), 4) AS max,
  {', '.join(f'round(quantile_cont(risk_score, {p}), 4) AS {n}' for n, p in _SQ)},
  round(avg(CAST(risk_score >= 0.5 AS DOUBLE)), 4) AS positive_rate
FROM v2 WHERE risk_score IS NOT NULL GROUP BY model""", "v2"))
def a3_score_summary_by_model(spark, d):
    return A.score_summary(scored(spark, d), "risk_score", ["model"])


@query("a3_score_histogram_by_model", with_views(f"""
SELECT g.model, g.bin, {G.unit_edges_sql()}[g.bin + 1] AS lo, {G.unit_edges_sql()}[g.bin + 2] AS hi,
  CAST(coalesce(c.cnt, 0) AS BIGINT) AS cnt, round(coalesce(c.cnt, 0) / g.n, 4) AS freq
FROM (SELECT model, n, CAST(b.bin AS INTEGER) AS bin FROM (SELECT model, count(*) AS n FROM v2 GROUP BY model) m,
      range(20) b(bin)) g
LEFT JOIN (SELECT model, {G.edge_bin_sql('risk_score')} AS bin, count(*) AS cnt FROM v2
           WHERE {G.edge_bin_sql('risk_score')} IS NOT NULL GROUP BY ALL) c
  ON g.model = c.model AND g.bin = c.bin""", "v2"))
def a3_score_histogram_by_model(spark, d):
    return A.score_histogram(scored(spark, d), "risk_score", by=["model"])


_SIG = {"l_quantity": "double", "l_discount": "double", "l_returnflag": "string", "l_linestatus": "string",
        "absent_feature": "double"}


@query("a4_feature_profiles_lineitem", f"""
SELECT feature, type, count, missing_rate FROM ({G.numeric_profile('SELECT * FROM lineitem',
                                                ['l_quantity', 'l_discount'])})
UNION ALL SELECT feature, 'categorical', CAST(count(*) AS BIGINT), round(1 - count(value) / count(*), 4)
FROM {G.unpivot('SELECT * FROM lineitem', ['l_returnflag', 'l_linestatus'], 'VARCHAR')} u GROUP BY feature
UNION ALL SELECT 'absent_feature', 'unknown', 0, 1.0""")
def a4_feature_profiles_lineitem(spark, d):
    return A.feature_profiles(table(spark, d, "lineitem"), _SIG)


def _li_req(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                     F.when(F.col("l_linenumber") == 3, F.lit(None)).otherwise(F.col("l_tax")).alias("l_tax"),
                     (F.col("l_discount") * 10).alias("risk_score"))


_LI_REQ = """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE l_tax END AS l_tax, l_discount * 10 AS risk_score FROM lineitem"""


@query("a14_request_aggregate", f"""
SELECT l_orderkey, count(*) AS n_instances,
  round(sum(CAST(l_quantity IS NULL AS INTEGER) + CAST(l_extendedprice IS NULL AS INTEGER)
            + CAST(l_discount IS NULL AS INTEGER) + CAST(l_tax IS NULL AS INTEGER)) / (count(*) * 4), 4) AS missing_rate,
  round(avg(risk_score), 4) AS risk_score_mean, round(min(risk_score), 4) AS risk_score_min,
  round(max(risk_score), 4) AS risk_score_max, round(stddev_pop(risk_score), 4) AS risk_score_std,
  round(avg(CAST(risk_score >= 0.5 AS DOUBLE)), 4) AS positive_rate
FROM ({_LI_REQ}) t GROUP BY l_orderkey""")
def a14_request_aggregate(spark, d):
    return A.request_aggregate(_li_req(spark, d), "l_orderkey", LI_NUM, "risk_score")


@query("a14_request_feature_stats", f"""
SELECT l_orderkey, feature, round(avg(value), 6) AS mean, round(min(value), 6) AS min, round(max(value), 6) AS max
FROM (SELECT l_orderkey, CAST(l_quantity AS DOUBLE) AS l_quantity,
        CAST(l_extendedprice AS DOUBLE) AS l_extendedprice, CAST(l_discount AS DOUBLE) AS l_discount,
        CAST(l_tax AS DOUBLE) AS l_tax FROM ({_LI_REQ}) s)
      UNPIVOT INCLUDE NULLS (value FOR feature IN (l_quantity, l_extendedprice, l_discount, l_tax)) u
GROUP BY l_orderkey, feature""")
def a14_request_feature_stats(spark, d):
    return A.request_feature_stats(_li_req(spark, d), "l_orderkey", LI_NUM, digits=6)


@query("a15_row_events", """
SELECT l_orderkey AS request_id, l_linenumber AS instance_index,
  CAST(json_object('l_linenumber', l_linenumber, 'l_returnflag', l_returnflag, 'l_linestatus', l_linestatus)
       AS VARCHAR) AS features_sanitized
FROM lineitem""")
def a15_row_events(spark, d):
    li = table(spark, d, "lineitem").withColumn("nome", F.lit("x"))
    return A.row_events(li, "l_orderkey", "l_linenumber", ["l_linenumber", "nome", "l_returnflag", "l_linestatus"])


def _li_bins(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_quantity", (F.col("l_discount") * 100).alias("discount_pct"),
                     F.when(F.col("l_linenumber") == 1, F.lit(None)).otherwise(F.col("l_tax") * 100).alias("tax_pct"))


_LI_BINS = """SELECT l_quantity, l_discount * 100 AS discount_pct,
  CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax * 100 END AS tax_pct FROM lineitem"""
_BIN_SQL = f"""
SELECT feature, CAST(count(*) FILTER (WHERE value < 4) AS BIGINT) AS low,
  CAST(count(*) FILTER (WHERE value >= 4 AND value < 7) AS BIGINT) AS medium,
  CAST(count(*) FILTER (WHERE value >= 7) AS BIGINT) AS high,
  CAST(count(*) FILTER (WHERE value IS NULL) AS BIGINT) AS missing
FROM {G.unpivot(_LI_BINS, ['l_quantity', 'discount_pct', 'tax_pct'])} u GROUP BY feature"""


@query("a16_batch_bins", _BIN_SQL)
def a16_batch_bins(spark, d):
    return A.batch_bins(_li_bins(spark, d), ["l_quantity", "discount_pct", "tax_pct"])


@query("a16_top_missing", f"SELECT feature, missing FROM ({_BIN_SQL}) WHERE missing > 0 "
                          "ORDER BY missing DESC, feature LIMIT 5")
def a16_top_missing(spark, d):
    return A.top_missing(A.batch_bins(_li_bins(spark, d), ["l_quantity", "discount_pct", "tax_pct"]))


@query("a17_prediction_summary", with_views("""
SELECT subject, count(*) AS n, count(*) FILTER (WHERE risk_score >= 0.5) AS n_high_risk,
  round(avg(risk_score), 4) AS mean_score, count(*) FILTER (WHERE risk_score < 0.3) AS n_low,
  count(*) FILTER (WHERE risk_score >= 0.3 AND risk_score < 0.7) AS n_medium,
  count(*) FILTER (WHERE risk_score >= 0.7) AS n_high
FROM v2 GROUP BY subject""", "v2"))
def a17_prediction_summary(spark, d):
    return A.prediction_summary(scored(spark, d), "subject", "risk_score")


_LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax"]


@query("a18_input_summary_lineitem", f"""
SELECT feature, round(var_pop(value), 4) AS var_pop, round(avg(value), 4) AS mean, round(min(value), 4) AS min,
  round(max(value), 4) AS max, 4 AS n_received, 1 AS n_missing, 7 AS n_extra
FROM {G.unpivot('SELECT * FROM lineitem', _LI_ALL)} u GROUP BY feature
ORDER BY var_pop(value) DESC, feature LIMIT 3""")
def a18_input_summary_lineitem(spark, d):
    return A.input_summary(table(spark, d, "lineitem"),
                           ["l_quantity", "l_discount", "l_tax", "l_extendedprice", "absent"], top_n=3)


@query("a19_output_summary_by_model", with_views("""
SELECT model, round(min(risk_score), 4) AS min, round(avg(risk_score), 4) AS mean, round(max(risk_score), 4) AS max,
  round(coalesce(stddev_pop(risk_score), 0.0), 4) AS std, count(*) FILTER (WHERE label = 1) AS n_positive,
  round(avg(CAST(label = 1 AS DOUBLE)), 4) AS positive_rate
FROM v2 GROUP BY model""", "v2"))
def a19_output_summary_by_model(spark, d):
    return A.output_summary(scored(spark, d), "risk_score", "label", ["model"])


@query("a22_class_shares_orders", """
SELECT o_orderstatus AS class, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 4) AS share,
  round(max(count(*)) OVER () / min(count(*)) OVER (), 4) AS imbalance_ratio,
  min(count(*)) OVER () / sum(count(*)) OVER () < 0.1 AS minority_warning,
  max(count(*)) OVER () / min(count(*)) OVER () > 3.0 AS imbalanced
FROM orders GROUP BY o_orderstatus""")
def a22_class_shares_orders(spark, d):
    return A.class_shares(table(spark, d, "orders"), "o_orderstatus")


@query("a14_a11_numeric_means_roundtrip", f"""
SELECT l_orderkey AS request_id, feature, round(avg(value), 6) AS value
FROM (SELECT l_orderkey, CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
             CAST(l_discount AS DOUBLE) AS l_discount, CAST(l_tax AS DOUBLE) AS l_tax FROM ({_LI_REQ}) s)
  UNPIVOT INCLUDE NULLS (value FOR feature IN (l_quantity, l_extendedprice, l_discount, l_tax))
GROUP BY ALL""")
def a14_a11_numeric_means_roundtrip(spark, d):
    """Aggregate-mode events carry per-request feature means as JSON; the
    drift reader explodes them back to (request, feature, value)."""
    from vireo.operators.drift import extract_feature_values
    ev = A.request_aggregate(_li_req(spark, d), "l_orderkey", LI_NUM, "risk_score", digits=6, with_json=True) \
          .select(F.col("l_orderkey").alias("request_id"), "numeric_means")
    fv = extract_feature_values(ev)
    return fv.select("request_id", "feature", F.round(F.col("value").cast("double"), 6).alias("value"))
