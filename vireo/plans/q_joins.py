"""Registered queries: joins."""

from pyspark.sql import functions as F

from vireo.operators import joins as J
from vireo.plans.bindings import scored, table, with_views
from vireo.plans.catalog import query


def _labels(spark, d):
    """Ground truth arrives only for settled orders (status F or P)."""
    o = table(spark, d, "orders").where(F.col("o_orderstatus") != "O")
    return o.select(F.col("o_orderkey").alias("request_id"), (F.col("o_orderstatus") == "F").cast("int").alias("label"))


@query("j2_labeled_predictions_by_model", with_views("""
SELECT p.model, count(*) AS n, CAST(sum(l.label) AS BIGINT) AS n_pos, round(avg(p.risk_score), 6) AS mean_score
FROM v2 p JOIN (SELECT o_orderkey AS request_id, CAST(o_orderstatus = 'F' AS INTEGER) AS label
                FROM orders WHERE o_orderstatus <> 'O') l ON p.request_id = l.request_id
GROUP BY p.model""", "v2"))
def j2_labeled_predictions_by_model(spark, d):
    pred = scored(spark, d).drop("label")
    j = J.join_labels(pred, _labels(spark, d))
    return j.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("n_pos"),
                                  F.round(F.avg("risk_score"), 6).alias("mean_score"))


@query("j3_key_overlap_customer_orders", """
WITH a AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey IS NOT NULL),
b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey IS NOT NULL),
j AS (SELECT a.k AS ka, b.k AS kb FROM a FULL OUTER JOIN b ON a.k = b.k)
SELECT count(*) FILTER (WHERE ka IS NOT NULL AND kb IS NOT NULL) AS n_common,
  count(*) FILTER (WHERE kb IS NULL) AS n_only_a, count(*) FILTER (WHERE ka IS NULL) AS n_only_b,
  count(*) FILTER (WHERE ka IS NOT NULL AND kb IS NOT NULL) > 0 AS passed FROM j""")
def j3_key_overlap_customer_orders(spark, d):
    return J.key_overlap(table(spark, d, "customer"), table(spark, d, "orders"), "c_custkey", "o_custkey")


@query("j4_unmatched_customers", """
SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)""")
def j4_unmatched_customers(spark, d):
    c = table(spark, d, "customer")
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return J.unmatched(c, o, "c_custkey").select("c_custkey", "c_name")


@query("j4_matched_by_nation", """
SELECT c_nationkey, count(*) AS n FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey) GROUP BY c_nationkey""")
def j4_matched_by_nation(spark, d):
    c = table(spark, d, "customer")
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return J.matched(c, o, "c_custkey").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query("j4_match_split_summary", """
SELECT count(*) FILTER (WHERE hit) AS n_matched, count(*) FILTER (WHERE NOT hit) AS n_unmatched,
  count(*) AS n_rows, round(count(*) FILTER (WHERE NOT hit) * 100.0 / count(*), 4) AS pct_lost
FROM (SELECT c_custkey IN (SELECT o_custkey FROM orders) AS hit FROM customer)""")
def j4_match_split_summary(spark, d):
    return J.match_split_summary(table(spark, d, "customer"), table(spark, d, "orders"), "c_custkey", "o_custkey")
