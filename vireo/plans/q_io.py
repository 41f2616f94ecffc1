"""Registered queries: sources and sinks (IO2-IO8) as write/read roundtrips
through the shared folder, plus baseline tables (A5) and score extraction (A12)."""

from pyspark.sql import functions as F

from vireo.operators import profile as A
from vireo.operators.drift import extract_scores
from vireo.plans import sqlgen as G
from vireo.plans.bindings import subject_year, table, with_views
from vireo.plans.catalog import query
from vireo.sources import tables as IO
from vireo.streaming.jobs import shared_path


@query("io2_io6_snapshot_roundtrip", with_views("""
SELECT ano, count(*) AS n_rows, count(ida) AS n_ida FROM v1 GROUP BY ano""", "v1"))
def io2_io6_snapshot_roundtrip(spark, d):
    """Write one snapshot per period (partitioned), read each period's folder
    back and union by name."""
    v1 = subject_year(spark, d)
    base = shared_path(spark, "snapshots")
    IO.write_snapshots(v1, base)
    years = [r[0] for r in spark.read.parquet(base).select("ano").distinct().collect()]  # partition names only
    paths = {int(y): f"{base}/ano={y}/" for y in years}
    out = IO.read_snapshots(spark, paths, "ano", fmt="parquet")
    return out.groupBy("ano").agg(F.count(F.lit(1)).alias("n_rows"), F.count("ida").alias("n_ida"))


@query("io3_read_labels_formats", """
SELECT fmt, label, count(*) AS n FROM (SELECT quality AS label FROM labels),
  (VALUES ('parquet'), ('csv'), ('jsonl')) f(fmt) GROUP BY ALL""")
def io3_read_labels_formats(spark, d):
    lab = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("request_id"),
                                           F.lit(None).cast("timestamp").alias("timestamp"),
                                           F.col("quality").cast("int").alias("label"))
    base = shared_path(spark, "labels")
    lab.write.parquet(f"{base}/l.parquet")
    lab.write.option("header", "true").csv(f"{base}/l.csv")
    lab.write.json(f"{base}/l.jsonl")
    parts = [IO.read_labels(spark, f"{base}/l.{ext}").withColumn("fmt", F.lit(name))
             for ext, name in (("parquet", "parquet"), ("csv", "csv"), ("jsonl", "jsonl"))]
    allf = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return allf.groupBy("fmt", "label").agg(F.count(F.lit(1)).alias("n"))


@query("io4_io7_events_by_date_range", """
SELECT CAST(ts AS DATE) AS dt, count(*) AS n FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP BY ALL""")
def io4_io7_events_by_date_range(spark, d):
    """Append events into date partitions (each row by its own date), then
    read a date range: only the matching partitions are scanned."""
    store = shared_path(spark, "events")
    IO.append_events(table(spark, d, "events"), store)
    ev = IO.read_events(spark, store, "2024-01-08", "2024-01-14")
    return ev.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


@query("io5_io8_tolerant_jsonl", """
SELECT event_type, count(*) AS n FROM events GROUP BY event_type""")
def io5_io8_tolerant_jsonl(spark, d):
    """JSON lines with a few corrupt lines mixed in: bad lines are skipped."""
    from pyspark.sql import types as T
    ev = table(spark, d, "events").select("event_id", F.col("ts").cast("string").alias("ts"), "event_type")
    base = shared_path(spark, "jsonl")
    IO.write_jsonl(ev, base)
    spark.createDataFrame([("{not json",), ("",), ('{"event_id": ',)], "value string").write.mode("append").text(base)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.StringType()),
                           T.StructField("event_type", T.StringType())])
    js = IO.read_jsonl(spark, base, schema)
    return js.where(F.col("event_id").isNotNull()).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


_EV = "SELECT CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, value FROM events"


@query("a5_baseline_numeric_events", f"""
SELECT 'v1' AS model_version, * FROM ({G.numeric_profile(_EV, ['k', 'value'])})""")
def a5_baseline_numeric_events(spark, d):
    e = table(spark, d, "events").select(F.get_json_object("props", "$.k").cast("double").alias("k"), "value",
                                         "event_type", (F.col("value") / (F.col("value") + 50)).alias("score"))
    tabs = A.build_baseline(e, {"k": "double", "value": "double", "event_type": "string"}, "score", "v1")
    return tabs["numeric"]


@query("a12_extract_scores", """
SELECT count(*) AS n, round(avg(s), 6) AS mean_score FROM (SELECT avg(l_discount * 10) AS s FROM lineitem
GROUP BY l_orderkey)""")
def a12_extract_scores(spark, d):
    li = table(spark, d, "lineitem").withColumn("risk_score", F.col("l_discount") * 10)
    agg = A.request_aggregate(li, "l_orderkey", ["l_quantity"], "risk_score", digits=12)
    s = extract_scores(agg)
    return s.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("mean_score"))


@query("io9_report_tables", """
SELECT 'by_type' AS report, event_type AS key, count(*) AS n FROM events GROUP BY ALL
UNION ALL SELECT 'by_day', CAST(CAST(ts AS DATE) AS VARCHAR), count(*) FROM events GROUP BY ALL""")
def io9_report_tables(spark, d):
    """Two report tables written with their JSON copies and read again: one as Parquet, one as JSON."""
    e = table(spark, d, "events")
    base = shared_path(spark, "reports")
    n = F.count(F.lit(1)).alias("n")
    IO.write_report_tables({"by_type": e.groupBy(F.col("event_type").alias("key")).agg(n),
                            "by_day": e.groupBy(F.to_date("ts").cast("string").alias("key")).agg(n)}, base, json_copy=True)
    a = spark.read.parquet(f"{base}/by_type").select(F.lit("by_type").alias("report"), "key", "n")
    b = spark.read.schema("key string, n bigint").json(f"{base}/by_day_json").select(F.lit("by_day").alias("report"), "key", "n")
    return a.unionByName(b)


@query("p10_select_by_prefix", """
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem""")
def p10_select_by_prefix(spark, d):
    """Columns by prefix, less those excluded."""
    from vireo.operators.prepare import select_by_prefix
    li = table(spark, d, "lineitem")
    return select_by_prefix(li, ["l_order", "l_line", "l_ship"], ["l_linestatus"])


@query("j5_profile_join", """
WITH b AS (SELECT event_type AS feature, count(*) AS n_baseline FROM events WHERE ts < TIMESTAMP '2024-01-22' GROUP BY ALL),
c AS (SELECT event_type AS feature, count(*) AS n_current FROM events WHERE ts >= TIMESTAMP '2024-01-22' AND event_type <> 'click' GROUP BY ALL)
SELECT feature, n_baseline, n_current FROM b LEFT JOIN c USING (feature)""")
def j5_profile_join(spark, d):
    """Baseline profile with the current one; a feature that is gone keeps its row."""
    from vireo.operators.joins import profile_join
    e = table(spark, d, "events").withColumnRenamed("event_type", "feature")
    before, after = e.where(F.col("ts") < "2024-01-22"), e.where((F.col("ts") >= "2024-01-22") & (F.col("feature") != "click"))
    return profile_join(before.groupBy("feature").agg(F.count(F.lit(1)).alias("n_baseline")), after.groupBy("feature").agg(F.count(F.lit(1)).alias("n_current")))
