"""Registered queries: coercion, repair, standardisation, targets, bands."""

from pyspark.sql import functions as F

from vireo.functions import expr as X
from vireo.operators import prepare as P
from vireo.operators.explore import missing_table
from vireo.plans.bindings import scored, subject_year, table, with_views
from vireo.plans.catalog import query


def _events_text(spark, d):
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    return e.select("event_id", k.alias("k"),
                    F.when(F.col("event_id") % 10 == 0, F.lit("n/a")).otherwise(k).alias("mixed"),
                    "event_type")


_EV_TEXT = """SELECT event_id, json_extract_string(props, '$.k') AS k,
  CASE WHEN event_id % 10 = 0 THEN 'n/a' ELSE json_extract_string(props, '$.k') END AS mixed, event_type
FROM events"""


def _ratio_sql(c, src):
    return (f"(SELECT count(TRY_CAST({c} AS DOUBLE)) * 1.0 / nullif(count({c}), 0) FROM ({src}) s)")


@query("p3_coerce_mixed_events", f"""
SELECT event_id,
  CASE WHEN {_ratio_sql('k', _EV_TEXT)} >= 0.8 THEN TRY_CAST(k AS DOUBLE) END AS k,
  CASE WHEN {_ratio_sql('mixed', _EV_TEXT)} >= 0.8 THEN TRY_CAST(mixed AS DOUBLE) END AS mixed,
  CASE WHEN {_ratio_sql('event_type', _EV_TEXT)} >= 0.8 THEN NULL ELSE event_type END AS event_type
FROM ({_EV_TEXT}) t""")
def p3_coerce_mixed_events(spark, d):
    return P.coerce_mixed(_events_text(spark, d), min_ratio=0.8)


def _part_mixed(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice",
                    F.col("p_size").cast("string").alias("size_text"),
                    F.when(F.col("p_partkey") % 4 == 0, F.lit("x")).otherwise(F.col("p_size").cast("string"))
                    .alias("size_mixed"))


_PART_MIXED = """SELECT p_partkey, p_name, p_brand, p_size, p_retailprice, CAST(p_size AS VARCHAR) AS size_text,
  CASE WHEN p_partkey % 4 = 0 THEN 'x' ELSE CAST(p_size AS VARCHAR) END AS size_mixed FROM part"""


def _kind_sql(c):
    return (f"SELECT '{c}' AS \"column\", CASE WHEN (SELECT count(TRY_CAST({c} AS DOUBLE)) * 1.0 / "
            f"greatest(count(*), 1) FROM ({_PART_MIXED}) s) > 0.8 THEN 'numeric' ELSE 'categorical' END AS kind")


@query("p4_infer_types_part", "\nUNION ALL ".join(
    [f"SELECT '{c}' AS \"column\", 'numeric' AS kind" for c in ["p_partkey", "p_size", "p_retailprice"]]
    + [_kind_sql(c) for c in ["p_name", "p_brand", "size_text", "size_mixed"]]))
def p4_infer_types_part(spark, d):
    return P.column_type_table(_part_mixed(spark, d))


def _age_raw(spark, d):
    e = table(spark, d, "events")
    f = F.floor("value").cast("bigint")
    raw = (F.when(F.col("event_id") % 5 == 0,
                  F.concat(F.lit("1900-01-"), F.lpad(((f % 28) + 1).cast("string"), 2, "0")))
            .when(F.col("event_id") % 5 == 1, F.lit("texto"))
            .when(F.col("event_id") % 5 == 2, F.lit("2023-05-10"))
            .otherwise(F.concat(f.cast("string"), F.lit(".75"))))
    return e.select("event_id", raw.alias("raw"))


_AGE_SQL = """SELECT event_id,
  CASE WHEN event_id % 5 = 0 THEN '1900-01-' || lpad(CAST(CAST(floor(value) AS BIGINT) % 28 + 1 AS VARCHAR), 2, '0')
       WHEN event_id % 5 = 1 THEN 'texto' WHEN event_id % 5 = 2 THEN '2023-05-10'
       ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.75' END AS raw FROM events"""


@query("p5_repair_serial_age", f"""
SELECT event_id, raw,
  CAST(coalesce(
    CASE WHEN TRY_CAST(raw AS DOUBLE) IS NOT NULL AND trunc(TRY_CAST(raw AS DOUBLE)) BETWEEN 5 AND 30
         THEN trunc(TRY_CAST(raw AS DOUBLE)) END,
    CASE WHEN regexp_matches(raw, '^1900-[0-9]{{2}}-[0-9]{{2}}$')
          AND day(TRY_CAST(raw AS DATE)) BETWEEN 5 AND 30 THEN day(TRY_CAST(raw AS DATE)) END) AS BIGINT) AS age
FROM ({_AGE_SQL}) t""")
def p5_repair_serial_age(spark, d):
    r = _age_raw(spark, d)
    return r.select("event_id", "raw", X.repair_serial_age("raw").alias("age"))


# FIXED VALUES: sample school-type texts (from the original tests) used to
# build a text column from part.
SCHOOL_TEXTS = ["Pública", "Privada - Programa de Apadrinhamento", "Privada *Parcerias com Bolsa 100%",
                "Concluiu o 3º EM", "Nenhuma das opções acima", "Escola Pública", "Privada", None]


def _school(spark, d):
    p = table(spark, d, "part")
    k = F.col("p_partkey") % 9
    raw = F.when(k == 8, F.col("p_type"))
    for i, t in enumerate(SCHOOL_TEXTS):
        raw = raw.when(k == i, F.lit(t))
    return p.select("p_partkey", raw.alias("raw"))


def _school_sql():
    cases = " ".join(f"WHEN p_partkey % 9 = {i} THEN {('NULL' if t is None else repr(t))}"
                     for i, t in enumerate(SCHOOL_TEXTS))
    return f"SELECT p_partkey, CASE WHEN p_partkey % 9 = 8 THEN p_type {cases} END AS raw FROM part"


@query("p6_standardize_category", f"""
SELECT p_partkey, raw,
  CASE WHEN raw IS NULL THEN 'Desconhecido'
       WHEN strip_accents(lower(trim(raw))) LIKE '%publica%' THEN 'Publica'
       WHEN strip_accents(lower(trim(raw))) LIKE '%apadrinhamento%' THEN 'Privada_Apadrinhamento'
       WHEN strip_accents(lower(trim(raw))) LIKE '%bolsa%' OR strip_accents(lower(trim(raw))) LIKE '%parceira%'
            THEN 'Privada_Bolsa'
       WHEN strip_accents(lower(trim(raw))) LIKE '%privada%' THEN 'Privada'
       WHEN strip_accents(lower(trim(raw))) LIKE '%concluiu%' THEN 'Concluiu_EM'
       WHEN strip_accents(lower(trim(raw))) LIKE '%3%' AND strip_accents(lower(trim(raw))) LIKE '%em%'
            THEN 'Concluiu_EM'
       ELSE 'Outro' END AS category
FROM ({_school_sql()}) t""")
def p6_standardize_category(spark, d):
    s = _school(spark, d)
    return s.select("p_partkey", "raw", X.standardize_category("raw").alias("category"))


@query("p7_binary_target", with_views(
    "SELECT ra, ano, coalesce(CAST(defasagem < 0 AS INTEGER), 0) AS em_risco FROM v1", "v1"))
def p7_binary_target(spark, d):
    v1 = subject_year(spark, d)
    return P.add_binary_target(v1, "defasagem", "em_risco").select("ra", "ano", "em_risco")


YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]  # of the driver tables; names the oracle's columns


def _wide_sql():
    cols = []
    for y in YEARS:
        for c in ["fase", "ian", "ida", "ieg"]:
            cols.append(f"max(CASE WHEN ano = {y} THEN {c} END) AS {c}_{y}")
    return with_views(f"SELECT ra, {', '.join(cols)} FROM v1 GROUP BY ra", "v1")


@query("p8_wide_snapshot_table", _wide_sql())
def p8_wide_snapshot_table(spark, d):
    """Allow-listed features per period, suffixed ``_{year}``, one row per subject."""
    v1 = subject_year(spark, d)
    allowed = P.select_allowed_suffixed(v1, "x")  # names only: which columns are allowed
    cols = [c[:-2] for c in allowed.columns if c.endswith("_x") and c[:-2] in ("fase", "ian", "ida", "ieg")]
    return P.to_wide(v1, "ra", "ano", cols, P.periods(v1, "ano"))


@query("p13_risk_label_band", with_views("""
SELECT request_id, CAST(risk_score >= 0.5 AS INTEGER) AS risk_label,
  CASE WHEN risk_score >= 0.7 THEN 'high' WHEN risk_score >= 0.3 THEN 'medium'
       WHEN risk_score IS NOT NULL THEN 'low' END AS risk_band
FROM v2""", "v2"))
def p13_risk_label_band(spark, d):
    v2 = scored(spark, d)
    return v2.select("request_id", X.risk_label("risk_score", 0.5).alias("risk_label"),
                     X.risk_band("risk_score").alias("risk_band"))


@query("p14_value_bins", """
SELECT event_type, CASE WHEN value < 4 THEN 'low' WHEN value < 7 THEN 'medium' ELSE 'high' END AS bin,
  count(*) AS n
FROM events WHERE value IS NOT NULL GROUP BY ALL""")
def p14_value_bins(spark, d):
    e = table(spark, d, "events")
    return e.where(F.col("value").isNotNull()).groupBy("event_type", X.value_bin("value").alias("bin")) \
            .agg(F.count(F.lit(1)).alias("n"))


@query("a20_data_card_missing", with_views("""
SELECT ano, "column", n_missing, n_rows FROM (
  SELECT ano, count(*) AS n_rows, count(*) FILTER (WHERE fase IS NULL) AS fase,
    count(*) FILTER (WHERE ian IS NULL) AS ian, count(*) FILTER (WHERE ida IS NULL) AS ida,
    count(*) FILTER (WHERE ieg IS NULL) AS ieg, count(*) FILTER (WHERE defasagem IS NULL) AS defasagem
  FROM v1 GROUP BY ano) UNPIVOT (n_missing FOR "column" IN (fase, ian, ida, ieg, defasagem))""", "v1"))
def a20_data_card_missing(spark, d):
    from vireo.operators.profile import data_card_missing
    return data_card_missing(subject_year(spark, d), "ano", ["fase", "ian", "ida", "ieg", "defasagem"])


@query("a20_data_card_target", with_views("""
SELECT ano, count(*) AS n_rows, count(*) FILTER (WHERE em_risco = 1) AS n_pos,
  count(*) FILTER (WHERE em_risco = 0) AS n_neg, round(avg(em_risco), 4) AS pos_ratio
FROM (SELECT ano, coalesce(CAST(defasagem < 0 AS INTEGER), 0) AS em_risco FROM v1) GROUP BY ano""", "v1"))
def a20_data_card_target(spark, d):
    from vireo.operators.profile import data_card_target
    v1 = P.add_binary_target(subject_year(spark, d), "defasagem", "em_risco")
    return data_card_target(v1, "ano", "em_risco")


@query("x2_missing_table_customer", """
SELECT "column", n_missing, round(n_missing * 100.0 / n, 4) AS pct_missing FROM (
  SELECT count(*) AS n,
    count(*) FILTER (WHERE CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END IS NULL) AS c_acctbal,
    count(*) FILTER (WHERE CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END IS NULL) AS c_mktsegment,
    count(*) FILTER (WHERE c_name IS NULL) AS c_name
  FROM customer) UNPIVOT (n_missing FOR "column" IN (c_acctbal, c_mktsegment, c_name))
WHERE n_missing > 0""")
def x2_missing_table_customer(spark, d):
    from vireo.plans.q_quality import customer_with_nulls
    c = customer_with_nulls(spark, d)
    return missing_table(c, ["c_acctbal", "c_mktsegment", "c_name"])
