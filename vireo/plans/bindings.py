"""Views V1-V4: the driver tables bound to the subject/period data model.

Each view exists twice with identical meaning: a DataFrame builder (what the
library runs) and a SQL text (used by the DuckDB oracle as a CTE).  Both sides
use integer arithmetic wherever a value is later compared with a threshold, so
the two engines cannot disagree on a rounding tie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.sources.tables import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------------------
# V1 subject_year: one row per (ra, ano) built from orders.
# ---------------------------------------------------------------------------
def subject_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    n = F.count(F.lit(1))
    ano = F.year("o_orderdate").cast("int")
    agg = (o.groupBy(F.col("o_custkey").alias("ra"), ano.alias("ano"))
            .agg(F.least(n, F.lit(8)).cast("bigint").alias("fase"),
                 F.least(F.lit(2.0) * n, F.lit(10.0)).alias("ian"),
                 F.avg("o_totalprice").alias("_ida"),
                 (F.max("o_totalprice") / 50000).alias("ieg"),
                 (n - 2).cast("bigint").alias("defasagem")))
    # Nulls injected by rule (the driver tables hold none).
    agg = agg.withColumn(
        "ida", F.when((F.col("ra") + F.col("ano")) % 13 == 0, F.lit(None).cast("double"))
                .otherwise(F.col("_ida") / 50000)).drop("_ida")
    # First period per subject: a window over the aggregated table (at most
    # one row per subject and year), so the per-subject partition stays small
    # even for a subject holding a large share of the raw rows, and orders is
    # scanned once.
    from pyspark.sql import Window
    first = F.min("ano").over(Window.partitionBy("ra"))
    return agg.select("ra", "ano", "fase", "ian", "ida", "ieg", "defasagem", first.alias("ano_ingresso"))


V1_SQL = """
v1 AS (
  SELECT a.ra, a.ano, a.fase, a.ian, a.ida, a.ieg, a.defasagem, f.ano_ingresso
  FROM (
    SELECT o_custkey AS ra, CAST(year(o_orderdate) AS INTEGER) AS ano,
           CAST(least(count(*), 8) AS BIGINT) AS fase,
           least(CAST(2 AS DOUBLE) * count(*), 10.0) AS ian,
           CASE WHEN (o_custkey + CAST(year(o_orderdate) AS INTEGER)) % 13 = 0 THEN NULL
                ELSE avg(o_totalprice) / 50000 END AS ida,
           max(o_totalprice) / 50000 AS ieg,
           CAST(count(*) - 2 AS BIGINT) AS defasagem
    FROM orders GROUP BY o_custkey, CAST(year(o_orderdate) AS INTEGER)
  ) a
  JOIN (SELECT o_custkey AS ra, CAST(min(year(o_orderdate)) AS INTEGER) AS ano_ingresso
        FROM orders GROUP BY o_custkey) f ON a.ra = f.ra
)"""


# ---------------------------------------------------------------------------
# V2 scored: one prediction per order, with a label.
# risk_score = price / 500000 rounded half-up to 6 places, computed on
# integer cents so that both engines produce the same double.
# ---------------------------------------------------------------------------
def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    micro = F.floor((cents + 25) / 50).cast("bigint")
    score = F.least(F.greatest(micro.cast("double") / F.lit(1000000.0), F.lit(0.0)), F.lit(1.0))
    return o.select(
        F.col("o_orderkey").alias("request_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        score.alias("risk_score"),
        F.concat(F.lit("m"), (F.col("o_orderkey") % 3).cast("string")).alias("model"),
        F.col("o_orderpriority").alias("segment"),
        F.year("o_orderdate").cast("int").alias("period"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_custkey").alias("subject"),
    )


V2_SQL = """
v2 AS (
  SELECT o_orderkey AS request_id,
         CAST(o_orderstatus = 'F' AS INTEGER) AS label,
         least(greatest(CAST((CAST(round(o_totalprice * 100) AS BIGINT) + 25) // 50 AS DOUBLE)
                        / 1000000.0, 0.0), 1.0) AS risk_score,
         'm' || CAST(o_orderkey % 3 AS VARCHAR) AS model,
         o_orderpriority AS segment,
         CAST(year(o_orderdate) AS INTEGER) AS period,
         o_orderdate AS ts,
         o_custkey AS subject
  FROM orders
)"""


# ---------------------------------------------------------------------------
# V3 req_log: request log from events.
# ---------------------------------------------------------------------------
def req_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("api_key"),
        F.col("event_type").alias("endpoint"),
        F.col("value").alias("latency_ms"),
        F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).alias("status_code"),
    )


V3_SQL = """
v3 AS (
  SELECT event_id AS request_id, ts, user_id AS api_key, event_type AS endpoint,
         value AS latency_ms,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code
  FROM events
)"""


# ---------------------------------------------------------------------------
# V4 event_features: inference events with a JSON feature map.
# ---------------------------------------------------------------------------
def event_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id"),
        F.col("props").alias("features_sanitized"),
        F.col("value"),
        F.col("event_type"),
    )


def with_views(sql_body: str, *views: str, ctes: list[str] | None = None) -> str:
    """Prefix an oracle query with the view CTEs it needs plus extra CTEs."""
    known = {"v1": V1_SQL, "v2": V2_SQL, "v3": V3_SQL}
    parts = [known[v].strip() for v in views] + [c.strip() for c in (ctes or [])]
    if not parts:
        return sql_body.strip()
    return "WITH " + ",\n".join(parts) + "\n" + sql_body.strip()
