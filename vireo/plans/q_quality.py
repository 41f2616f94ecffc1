"""Registered queries: data-quality checks (Q1-Q4, Q8-Q10)."""

from pyspark.sql import functions as F

from vireo.operators import quality as Q
from vireo.plans import sqlgen as G
from vireo.plans.bindings import subject_year, table, with_views
from vireo.plans.catalog import query

LINEITEM_RANGES = {"l_quantity": (1.0, 50.0), "l_discount": (0.0, 0.08), "l_tax": (0.0, 0.06)}
CUSTOMER_RANGES = {"c_acctbal": (-999.99, 9000.0), "c_nationkey": (0.0, 24.0)}


def customer_with_nulls(spark, d):
    """Nulls injected by rule into customer (the driver table holds none)."""
    c = table(spark, d, "customer")
    return c.select("c_custkey", "c_name", "c_nationkey",
                    F.when(F.col("c_custkey") % 11 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
                    F.when(F.col("c_custkey") % 3 == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
                    .alias("c_mktsegment"))


CUSTOMER_NULLS_SQL = """SELECT c_custkey, c_name, c_nationkey,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer"""
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("q1_duplicates_by_order", G.duplicates("SELECT * FROM lineitem", ["l_orderkey"]))
def q1_duplicates_by_order(spark, d):
    return Q.check_duplicates(table(spark, d, "lineitem"), "l_orderkey")


@query("q1_duplicates_by_line", G.duplicates("SELECT * FROM lineitem", ["l_orderkey", "l_linenumber"]))
def q1_duplicates_by_line(spark, d):
    return Q.check_duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("q2_ranges_lineitem", G.ranges("SELECT * FROM lineitem", LINEITEM_RANGES))
def q2_ranges_lineitem(spark, d):
    return Q.check_ranges(table(spark, d, "lineitem"), LINEITEM_RANGES)


@query("q2_violation_samples_lineitem", """
SELECT 'l_quantity' AS "column", l_quantity AS value, row_number() OVER (ORDER BY l_quantity) AS rank
FROM lineitem WHERE l_quantity < 2 OR l_quantity > 49 ORDER BY l_quantity LIMIT 5""")
def q2_violation_samples_lineitem(spark, d):
    """The first values outside a range, in value order."""
    return Q.range_violation_samples(table(spark, d, "lineitem"), {"l_quantity": (2, 49)}, 5)


@query("q10_row_reasons_lineitem", """
SELECT l_returnflag, count(*) AS n_rows, count(*) FILTER (WHERE l_quantity > 45 OR l_quantity < 1) AS n_range, count(*) FILTER (WHERE l_linenumber = 3) AS n_text,
  count(*) FILTER (WHERE l_linenumber = 4) AS n_missing, count(*) FILTER (WHERE NOT (l_quantity > 45 OR l_quantity < 1) AND l_linenumber NOT IN (3, 4)) AS n_fit
FROM lineitem GROUP BY l_returnflag""")
def q10_row_reasons_lineitem(spark, d):
    """Reasons to reject a row of a batch: a range, a number that does not parse, a missing value."""
    li = table(spark, d, "lineitem").select("l_returnflag", "l_quantity", F.when(F.col("l_linenumber") == 3, F.lit("x")).otherwise(F.col("l_tax").cast("string")).alias("l_tax"),
                                            F.when(F.col("l_linenumber") != 4, F.col("l_discount")).alias("l_discount"))
    r = Q.row_reasons(li, {"l_quantity": "double", "l_tax": "double", "l_discount": "double"}, {"l_quantity": (1, 45)}, ["l_discount"])
    why = lambda text: F.count_if(F.array_contains("reasons", text))
    return r.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"), why("l_quantity: outside [1, 45]").alias("n_range"),
                                         why("l_tax: not a number").alias("n_text"), why("l_discount: missing").alias("n_missing"),
                                         F.count_if(F.size("reasons") == 0).alias("n_fit"))


@query("q3_missing_customer", G.missing(CUSTOMER_NULLS_SQL, CUSTOMER_COLS, ["c_custkey", "c_acctbal"], 0.3))
def q3_missing_customer(spark, d):
    return Q.check_missing(customer_with_nulls(spark, d), ["c_custkey", "c_acctbal"], 0.3)


ALL_CHECKS_SQL = "\nUNION ALL ".join([
    G.duplicates(CUSTOMER_NULLS_SQL, ["c_custkey"]),
    G.ranges(CUSTOMER_NULLS_SQL, CUSTOMER_RANGES),
    G.missing(CUSTOMER_NULLS_SQL, CUSTOMER_COLS, ["c_custkey"], 0.3),
    G.dtypes(CUSTOMER_NULLS_SQL, ["c_acctbal", "c_nationkey", "c_mktsegment"]),
])


def _all_checks(spark, d):
    return Q.run_all_checks(customer_with_nulls(spark, d), "c_custkey", ["c_custkey"], CUSTOMER_RANGES,
                            ["c_acctbal", "c_nationkey", "c_mktsegment"], 0.3)


@query("q8_all_checks_customer", ALL_CHECKS_SQL)
def q8_all_checks_customer(spark, d):
    return _all_checks(spark, d)


@query("q8_summary_customer", f"""
WITH r AS ({ALL_CHECKS_SQL})
SELECT check_name, bool_and(passed) AS passed FROM r GROUP BY check_name
UNION ALL SELECT 'all', coalesce(bool_and(passed), true) FROM r""")
def q8_summary_customer(spark, d):
    return Q.summary(_all_checks(spark, d))


# Q9: features at t (all periods) against outcomes at t+1, keyed (ra, ano).
def _pair(spark, d):
    # V1 feeds about ten checks: materialise it once in the shared folder
    from vireo.session import cut_lineage
    v1 = cut_lineage(subject_year(spark, d))
    feats = v1.select("ra", "ano", "fase", "ian", "ida", "ieg")
    labels = v1.select("ra", (F.col("ano") - 1).alias("ano"), "defasagem")
    return feats, labels


_F_SQL = "SELECT ra, ano, fase, ian, ida, ieg FROM v1"
_L_SQL = "SELECT ra, ano - 1 AS ano, defasagem FROM v1"
_IR = {"ian": (0, 10), "ida": (0, 10), "ieg": (0, 10), "fase": (0, 10)}
_LR = {"defasagem": (-10, 10)}

PAIR_SQL = with_views(f"""
SELECT *, 'features' AS "table" FROM (
  {G.duplicates(_F_SQL, ["ra", "ano"])}
  UNION ALL {G.ranges(_F_SQL, _IR)}
  UNION ALL {G.missing(_F_SQL, ["ra", "ano", "fase", "ian", "ida", "ieg"], [], 0.3)}
  UNION ALL {G.dtypes(_F_SQL, ["ian", "ida", "ieg", "fase"])})
UNION ALL SELECT *, 'labels' FROM (
  {G.duplicates(_L_SQL, ["ra", "ano"])}
  UNION ALL {G.ranges(_L_SQL, _LR)}
  UNION ALL {G.missing(_L_SQL, ["ra", "ano", "defasagem"], [], 0.3)}
  UNION ALL {G.dtypes(_L_SQL, ["defasagem"])})
UNION ALL SELECT 'leakage', true, NULL, 'n_blocked', 0.0, '', 'features'
UNION ALL SELECT * FROM (
  WITH a AS (SELECT DISTINCT ra, ano FROM ({_F_SQL})), b AS (SELECT DISTINCT ra, ano FROM ({_L_SQL})),
  j AS (SELECT a.ra AS ka, b.ra AS kb FROM a FULL OUTER JOIN b ON a.ra = b.ra AND a.ano = b.ano),
  c AS (SELECT count(*) FILTER (WHERE ka IS NOT NULL AND kb IS NOT NULL) AS n_common,
               count(*) FILTER (WHERE kb IS NULL) AS n_only_a, count(*) FILTER (WHERE ka IS NULL) AS n_only_b FROM j)
  SELECT 'key_overlap', n_common > 0, 'ra,ano', 'n_common', CAST(n_common AS DOUBLE), NULL, 'pair' FROM c
  UNION ALL SELECT 'key_overlap', n_common > 0, 'ra,ano', 'n_only_features', CAST(n_only_a AS DOUBLE), NULL, 'pair' FROM c
  UNION ALL SELECT 'key_overlap', n_common > 0, 'ra,ano', 'n_only_labels', CAST(n_only_b AS DOUBLE), NULL, 'pair' FROM c)
""", "v1")


@query("q9_validate_pair", PAIR_SQL)
def q9_validate_pair(spark, d):
    feats, labels = _pair(spark, d)
    return Q.validate_pair(feats, labels, ["ra", "ano"], critical=[])


@query("q10_validate_training_schema", with_views("""
SELECT 'error' AS level, 'personal-data fields: [''ra'']' AS message
UNION ALL SELECT 'warning', 'ida: ' || CAST(n AS VARCHAR) || ' values outside [0.0, 8.0]'
  FROM (SELECT count(*) FILTER (WHERE ida < 0.0 OR ida > 8.0) AS n FROM v1) WHERE n > 0
UNION ALL SELECT 'warning', 'ieg: ' || CAST(n AS VARCHAR) || ' values outside [0.0, 8.0]'
  FROM (SELECT count(*) FILTER (WHERE ieg < 0.0 OR ieg > 8.0) AS n FROM v1) WHERE n > 0
UNION ALL SELECT 'warning', 'extra features: [''defasagem'']'
UNION ALL SELECT 'warning', 'imbalanced target: minority share below 10%'
  FROM (SELECT count(*) FILTER (WHERE defasagem = 1) AS p, count(*) FILTER (WHERE defasagem = 0) AS q FROM v1)
  WHERE p + q > 0 AND least(p, q) / (p + q) < 0.1
UNION ALL SELECT 'error', 'target must be 0/1 (' || CAST(n AS VARCHAR) || ' other values)'
  FROM (SELECT count(*) FILTER (WHERE defasagem NOT IN (0, 1)) AS n FROM v1) WHERE n > 0
""", "v1"))
def q10_validate_training_schema(spark, d):
    v1 = subject_year(spark, d)
    return Q.validate_schema(v1.select("ra", "ano", "fase", "ian", "ida", "ieg", "defasagem"),
                             ["ano", "fase", "ian", "ida", "ieg"], mode="training", extra_policy="ignore",
                             target="defasagem", feature_ranges={"ida": (0.0, 8.0), "ieg": (0.0, 8.0)})
