"""Registered queries: windows and streams.

W1-W4(a) are batch forms with DuckDB oracles; the stream queries replay the
events table through Structured Streaming (``availableNow``) into the shared
checkpoint folder and return the written result.
"""

from pyspark.sql import functions as F

from vireo.operators.drift import psi, score_bins
from vireo.operators.evaluate import confusion_counts, metrics_from_counts
from vireo.plans.bindings import req_log, scored, table, with_views
from vireo.plans.catalog import REGISTRY, query
from vireo.streaming import jobs as W
from vireo.streaming import stateful as ST


def _ts_str(c, micro=False):
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss.SSSSSS" if micro else "yyyy-MM-dd HH:mm:ss")


@query("w1_rolling_60s_latency", with_views("""
SELECT request_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
  count(latency_ms) OVER w AS n, round(avg(latency_ms) OVER w, 6) AS mean,
  round(quantile_cont(latency_ms, 0.5) OVER w, 6) AS p50, round(quantile_cont(latency_ms, 0.95) OVER w, 6) AS p95
FROM v3 WINDOW w AS (ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW)""", "v3"))
def w1_rolling_60s_latency(spark, d):
    r = W.rolling_stats(req_log(spark, d).select("request_id", "ts", "latency_ms"), "ts", "latency_ms", 60)
    return r.select("request_id", _ts_str("ts", True).alias("ts"), "n", F.round("mean", 6).alias("mean"),
                    F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))


@query("w1_rolling_60s_latency_stream", f"""
SELECT * FROM ({REGISTRY["w1_rolling_60s_latency"][1]}) r
WHERE date_trunc('second', CAST(ts AS TIMESTAMP)) + INTERVAL 1 SECOND <= (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE""")
def w1_rolling_60s_latency_stream(spark, d):
    """Streaming twin of w1: the rows of every second that the watermark has passed."""
    s = _events_stream(spark, d).select(F.col("event_id").alias("request_id"), "ts", F.col("value").alias("latency_ms"))
    out = W.shared_path(spark, "w1")
    ST.run_stateful(ST.rolling_stats_stream(s, "request_id", "ts", "latency_ms"), out)
    return spark.read.parquet(out).select("request_id", _ts_str("ts", True).alias("ts"), "n", F.round("mean", 6).alias("mean"),
                                          F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))


MINUTE_SQL = """
SELECT strftime(time_bucket(INTERVAL 1 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n,
  count(*) FILTER (WHERE status_code < 400) AS n_success, count(*) FILTER (WHERE status_code >= 500) AS n_errors,
  round(avg(latency_ms), 6) AS mean_latency, round(quantile_cont(latency_ms, 0.5), 6) AS p50,
  round(quantile_cont(latency_ms, 0.95), 6) AS p95, round(quantile_cont(latency_ms, 0.99), 6) AS p99
FROM v3 GROUP BY ALL"""


def _minutes(spark, d):
    m = W.minute_metrics(req_log(spark, d), "ts", "latency_ms", "status_code")
    return m.select(_ts_str("window_start").alias("window_start"), "n", "n_success", "n_errors",
                    *[F.round(c, 6).alias(c) for c in ["mean_latency", "p50", "p95", "p99"]])


@query("w2_minute_metrics", with_views(MINUTE_SQL, "v3"))
def w2_minute_metrics(spark, d):
    return _minutes(spark, d)


@query("w3_slo_per_minute", with_views(f"""
SELECT window_start, n, round(n_errors / n, 6) AS error_rate, p95,
  coalesce(p95 <= 300.0, true) AND n_errors / n <= 0.01 AS slo_ok FROM ({MINUTE_SQL})""", "v3"))
def w3_slo_per_minute(spark, d):
    m = W.minute_metrics(req_log(spark, d), "ts", "latency_ms", "status_code")
    s = W.slo_status(m)
    return s.withColumn("window_start", _ts_str("window_start"))


@query("w4_rate_violations_by_key", with_views("""
SELECT api_key, count(*) AS n_minutes, max(n) AS max_per_minute, count(*) FILTER (WHERE n > 60) AS n_violations
FROM (SELECT api_key, date_trunc('minute', ts) AS m, count(*) AS n FROM v3 GROUP BY ALL) GROUP BY api_key""", "v3"))
def w4_rate_violations_by_key(spark, d):
    return W.rate_violations(req_log(spark, d), "api_key", "ts")


def _events_stream(spark, d):
    return W.file_stream(spark, f"{d}/events*.parquet")


@query("w2_minute_metrics_stream", with_views(f"""
SELECT * FROM ({MINUTE_SQL}) m
WHERE CAST(window_start AS TIMESTAMP) + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE""", "v3"))
def w2_minute_metrics_stream(spark, d):
    """Streaming twin of w2: the windows that the watermark has closed."""
    s = _events_stream(spark, d).select(
        F.col("ts"), F.col("value").alias("latency_ms"),
        F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).alias("status_code"))
    m = W.minute_metrics(s, "ts", "latency_ms", "status_code", watermark="2 minutes")
    out = W.shared_path(spark, "w2")
    W.run_available_now(m, out, mode="append")
    return spark.read.parquet(out).select(
        _ts_str("window_start").alias("window_start"), "n", "n_success", "n_errors",
        *[F.round(c, 6).alias(c) for c in ["mean_latency", "p50", "p95", "p99"]])


# a bucket small enough that the keys of the event table run it dry
BUCKET, REFILL = 2.0, 0.000005
SLICES = 3


@query("w4_token_bucket_stream", f"""
WITH RECURSIVE e AS (
  SELECT CAST(user_id AS VARCHAR) AS key, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM events),
r AS (SELECT key, i, us, CAST({BUCKET} - 1 AS DOUBLE) AS tokens, 0 AS rejected FROM e WHERE i = 1
  UNION ALL
  SELECT key, i, us, CASE WHEN t >= 1 THEN t - 1 ELSE t END, CAST(t < 1 AS INTEGER)
  FROM (SELECT e.key, e.i, e.us, least(CAST({BUCKET} AS DOUBLE), r.tokens + CAST({REFILL} AS DOUBLE) * (e.us - r.us) / 1000000.0::DOUBLE) AS t
        FROM r JOIN e ON e.key = r.key AND e.i = r.i + 1))
SELECT key, count(*) AS n_requests, CAST(sum(rejected) AS BIGINT) AS n_rejected FROM r GROUP BY key""")
def w4_token_bucket_stream(spark, d):
    """Exact token bucket per API key over the event log, replayed in slices
    of time; a bucket that has filled up again leaves no state."""
    e = table(spark, d, "events").select(F.col("user_id").alias("api_key"), "ts")
    out = W.shared_path(spark, "w4")
    ST.run_in_time_slices(e, "ts", SLICES, lambda s: ST.token_bucket(s, "api_key", "ts", capacity=BUCKET, refill=REFILL), out)
    r = spark.read.parquet(out)
    return r.groupBy("key").agg(F.sum("n_requests").alias("n_requests"), F.sum("n_rejected").alias("n_rejected"))


@query("w5_inference_log_stream", "SELECT CAST(ts AS DATE) AS dt, count(*) AS n FROM events GROUP BY ALL")
def w5_inference_log_stream(spark, d):
    """Events logged by date partition through a stream."""
    s = _events_stream(spark, d).withColumnRenamed("user_id", "id")
    out = W.shared_path(spark, "w5")
    W.run_available_now(W.inference_log(s, "ts"), out, partition_by=["dt"])
    return spark.read.parquet(out).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


@query("w7_daily_score_psi_stream", f"""SELECT day, psi FROM ({REGISTRY["w7_daily_score_psi_batch"][1]}) b
WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def w7_daily_score_psi_stream(spark, d):
    """Daily score bins counted by a watermarked stream, PSI against the
    first three weeks: the closed days of w7_daily_score_psi_batch."""
    from vireo.plans.q_drift import SPLIT
    s = _events_stream(spark, d).where(F.col("ts") >= F.lit(SPLIT)) \
        .select("ts", (F.col("value") / (F.col("value") + 50)).alias("score"))
    out = W.shared_path(spark, "w7")
    W.run_available_now(W.daily_score_bins(s, "ts", "score"), out)
    counts = spark.read.parquet(out)
    tot = counts.groupBy("day").agg(F.sum("cnt").alias("n"))
    grid = tot.select("day", "n", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("bin"))
    cur = grid.join(counts, ["day", "bin"], "left") \
              .select("day", "bin", (F.coalesce("cnt", F.lit(0)) / F.col("n")).alias("c_freq"))
    base = table(spark, d, "events").where(F.col("ts") < F.lit(SPLIT)) \
        .select((F.col("value") / (F.col("value") + 50)).alias("score"))
    b = score_bins(base, "score").withColumnRenamed("freq", "b_freq")
    p = psi(cur.join(F.broadcast(b), "bin"), ["day"])
    return p.select("day", F.round("psi", 4).alias("psi"))


@query("w8_label_join_stream", with_views("""
SELECT model, CAST(sum(CAST(label = 1 AND risk_score >= 0.5 AS INTEGER)) AS BIGINT) AS tp,
  CAST(sum(CAST(label = 0 AND risk_score >= 0.5 AS INTEGER)) AS BIGINT) AS fp,
  CAST(sum(CAST(label = 1 AND risk_score < 0.5 AS INTEGER)) AS BIGINT) AS fn,
  CAST(sum(CAST(label = 0 AND risk_score < 0.5 AS INTEGER)) AS BIGINT) AS tn
FROM v2 JOIN orders ON o_orderkey = request_id WHERE o_orderstatus <> 'O' GROUP BY model""", "v2"))
def w8_label_join_stream(spark, d):
    """Late labels as a stream joined to the predictions stored by period;
    counts per micro-batch are appended to a table, keyed by batch so that a
    batch replayed after a failure replaces its own rows.  Each batch reads the
    periods its labels name and no others."""
    o = table(spark, d, "orders")
    lab_dir, pred_dir = W.shared_path(spark, "w8-labels"), W.shared_path(spark, "w8-predictions")
    o.where(F.col("o_orderstatus") != "O").select(
        F.col("o_orderkey").alias("request_id"), (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        F.year("o_orderdate").alias("period")).repartition("period").write.parquet(lab_dir)
    scored(spark, d).drop("label").repartition("period").write.partitionBy("period").parquet(pred_dir)
    labels = W.file_stream(spark, f"{lab_dir}/*.parquet", max_files=2)
    out = W.shared_path(spark, "w8-metrics")

    def per_batch(bdf, bid):
        joined = W.label_join(bdf, bdf.sparkSession.read.parquet(pred_dir), ("request_id", "period"), partition="period")
        m = metrics_from_counts(confusion_counts(joined, ["model"], "label", (F.col("risk_score") >= 0.5).cast("int")))
        m.write.mode("overwrite").parquet(f"{out}/batch_id={bid}")

    W.run_available_now(labels, foreach_batch=per_batch)
    r = spark.read.parquet(out)
    return r.groupBy("model").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])


@query("w9_late_rows_dropped", """
WITH e AS (SELECT ts, date_trunc('hour', ts) + INTERVAL 1 HOUR AS e, ts < TIMESTAMP '2024-01-15' AS late FROM events),
m AS (SELECT max(ts) - INTERVAL 1 HOUR AS w FROM e)
SELECT count(*) FILTER (WHERE NOT late AND e.e <= w) AS rows_in_windows, count(*) FILTER (WHERE e.e > w) AS rows_open,
  count(*) FILTER (WHERE ts IS NULL) AS rows_without_time, count(*) FILTER (WHERE late AND e.e <= w) AS rows_dropped_late
FROM e, m""")
def w9_late_rows_dropped(spark, d):
    """Rows behind the watermark are counted, not silently lost: the second
    half of the month is streamed first; the first half arrives when the same
    stream runs again, after the watermark has passed it."""
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    src, out, ckpt = (W.shared_path(spark, n) for n in ("w9-src", "w9", "w9-ckpt"))
    cut = F.lit("2024-01-15").cast("timestamp")

    def run():
        s = W.file_stream(spark, f"{src}/*/*.parquet", schema=e.schema)
        g = W.minute_metrics(s.select("ts", F.col("value").alias("latency_ms"), F.lit(200).alias("status_code")),
                             "ts", "latency_ms", "status_code", length="1 hour", watermark="1 hour")
        return W.run_available_now(g, out, checkpoint=ckpt)

    e.where(F.col("ts") >= cut).write.parquet(f"{src}/a")
    progress = run()
    e.where(F.col("ts") < cut).write.parquet(f"{src}/b")
    progress += run()
    return W.watermark_account(spark.read.schema(e.schema).parquet(f"{src}/*"), spark.read.parquet(out), "ts",
                               W.final_watermark(progress), "1 hour")


@query("w11_latest_state_stream", """
WITH r AS (SELECT user_id, ts, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE ts IS NOT NULL)
SELECT CAST(a.user_id AS VARCHAR) AS key, strftime(a.ts, '%Y-%m-%d %H:%M:%S.%f') AS latest_ts, a.event_type AS current, b.event_type AS previous,
  c.event_type AS rolled_back_to
FROM (SELECT * FROM r WHERE rn = 1) a LEFT JOIN (SELECT * FROM r WHERE rn = 2) b USING (user_id) LEFT JOIN (SELECT * FROM r WHERE rn = 4) c USING (user_id)""")
def w11_latest_state_stream(spark, d):
    """Streaming twin of w11 from a log that arrives out of order, with the
    value three changes back."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    states = ST.run_latest_state(e, "ts", "user_id", "event_type", "event_id", W.shared_path(spark, "w11"))
    back = ST.rolled_back(states, 3).select(F.col("key").alias("k"), F.col("current").alias("rolled_back_to"))
    now = ST.rolled_back(states)
    return now.join(back, now["key"] == back["k"]).select("key", _ts_str("latest_ts", True).alias("latest_ts"), "current", "previous", "rolled_back_to")
