"""Structured Streaming jobs.

The windowed metrics are plain DataFrame functions: the same code runs on a
batch DataFrame and on a streaming one (``readStream``), which is how the
batch twins are tested.  Streams use event-time watermarks, checkpoints in
the shared folder named by ``spark.checkpoint.dir``, and ``availableNow``
triggers for replays.  Custom keyed state is in ``stateful``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vireo import config as C
from vireo.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def file_stream(spark: SparkSession, path_glob: str, schema: T.StructType | None = None,
                max_files: int | None = None) -> DataFrame:
    """A file source over Parquet files matching ``path_glob``; a trigger takes
    all files that are there, or at most ``max_files`` of them."""
    if schema is None:
        schema = spark.read.parquet(path_glob).schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path_glob)


#: triggers whose progress a query keeps (Spark's default forgets all but 100)
PROGRESS_UPDATES = 1_000_000


def run_available_now(df: DataFrame, path: str | None = None, checkpoint: str | None = None,
                      mode: str = "append", partition_by: list[str] | None = None, foreach_batch=None,
                      timeout: int | None = None) -> list:
    """Run a stream over everything available now; returns its progress list.
    ``timeout`` (seconds) is off unless given; every trigger's progress is kept."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(PROGRESS_UPDATES))
    checkpoint = checkpoint or shared_path(spark, "ckpt")
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format("parquet").option("path", path)
        if partition_by:
            w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination(timeout) if timeout else q.awaitTermination()
    if q.isActive:
        q.stop()
        raise TimeoutError("stream did not finish")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q.recentProgress


def _event_ts(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); the session is UTC."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


# W1 ------------------------------------------------------------------------
def rolling_stats(df: DataFrame, ts: str, value: str, seconds: int = 60, by: list[str] | None = None,
                  probs=(0.5, 0.95), bucket_seconds: int = 600) -> DataFrame:
    """Exact per-row statistics over the trailing ``seconds`` (inclusive).

    Rows are cut into time buckets; rows in the last ``seconds`` of a bucket
    are copied into the next one as context, so every frame lies inside one
    (group, bucket) partition and no window spans the whole table.  Smaller
    ``bucket_seconds`` means smaller partitions for bursty traffic at the
    cost of more copied context (``seconds / bucket_seconds`` of the rows).
    """
    by = list(by or [])
    lw = seconds * 1_000_000
    lb = max(bucket_seconds, seconds) * 1_000_000
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    own = df.withColumn("__us", us).withColumn("__b", F.floor(F.col("__us") / F.lit(lb)).cast("bigint")) \
            .withColumn("__own", F.lit(True))
    ctx = own.where(F.col("__us") >= (F.col("__b") + 1) * F.lit(lb) - F.lit(lw)) \
             .withColumn("__b", F.col("__b") + 1).withColumn("__own", F.lit(False))
    u = own.unionByName(ctx)
    w = Window.partitionBy(*by, "__b").orderBy("__us").rangeBetween(-lw, 0)
    cols = [F.count(value).over(w).alias("n"), F.sum(value).over(w).alias("sum"), F.avg(value).over(w).alias("mean")]
    cols += [F.percentile(value, float(p)).over(w).alias(f"p{int(round(p * 100)):02d}") for p in probs]
    out = u.select(*[c for c in df.columns], "__own", *cols).where(F.col("__own")).drop("__own")
    return out


# W2 / W3 -------------------------------------------------------------------
def minute_metrics(df: DataFrame, ts: str, latency: str, status: str, length: str = "1 minute",
                   watermark: str | None = "2 minutes", score: str | None = None,
                   threshold: float = 0.5) -> DataFrame:
    """Request counters and exact latency percentiles per tumbling window
    (plus positive predictions when a ``score`` column is given).

    The percentile state is per window (bounded by one window's traffic)."""
    d = _event_ts(df, ts)
    if watermark and d.isStreaming:
        d = d.withWatermark(ts, watermark)
    extra = [F.count_if(F.col(score) >= threshold).alias("n_positive")] if score else []
    g = d.groupBy(F.window(ts, length).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(status) < 400).alias("n_success"),
        F.count_if(F.col(status) >= 500).alias("n_errors"), F.avg(latency).alias("mean_latency"),
        F.percentile(latency, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99))).alias("pcts"), *extra)
    return g.select(F.col("w.start").alias("window_start"), "n", "n_success", "n_errors", "mean_latency",
                    F.col("pcts")[0].alias("p50"), F.col("pcts")[1].alias("p95"), F.col("pcts")[2].alias("p99"),
                    *(["n_positive"] if score else []))


def slo_status(metrics: DataFrame, p95_max: float = C.SLO_P95_MS, error_max: float = C.SLO_ERROR_RATE,
               lifetime_errors: bool = False) -> DataFrame:
    """Both conditions per window (a null p95 passes).

    ``lifetime_errors`` reproduces the original rule: the error rate counts
    every request up to the window (latency stays windowed).  The running
    totals come from bucketed prefix sums over the per-window table."""
    if lifetime_errors:
        from vireo.functions.stats import ordered_prefix_sums
        ps = ordered_prefix_sums(metrics, [], "window_start", ["n", "n_errors"], F.to_date("window_start"))
        metrics = ps.withColumn("n_errors", F.col("n_errors_cum") + F.col("n_errors")) \
                    .withColumn("n", F.col("n_cum") + F.col("n"))
    er = F.col("n_errors") / F.col("n")
    ok = F.coalesce(F.col("p95") <= p95_max, F.lit(True)) & (er <= error_max)
    return metrics.select("window_start", "n", F.round(er, 6).alias("error_rate"), F.round("p95", 6).alias("p95"),
                          ok.alias("slo_ok"))


# W4 ------------------------------------------------------------------------
def rate_violations(df: DataFrame, key: str, ts: str, limit: int = C.RATE_LIMIT_PER_MIN) -> DataFrame:
    """(a) fixed-minute policing: requests per key and minute over the limit."""
    m = df.groupBy(key, F.date_trunc("minute", F.col(ts)).alias("minute")).agg(F.count(F.lit(1)).alias("n"))
    return m.groupBy(key).agg(F.count(F.lit(1)).alias("n_minutes"), F.max("n").alias("max_per_minute"),
                              F.count_if(F.col("n") > limit).alias("n_violations"))


# W5 ------------------------------------------------------------------------
def inference_log(stream: DataFrame, ts: str = "ts", drop: list[str] | None = None) -> DataFrame:
    """Events with PII fields dropped and a per-row date partition column."""
    from vireo.operators.privacy import drop_pii_fields
    d = drop_pii_fields(stream)
    if drop:
        d = d.drop(*drop)
    return d.withColumn("dt", F.to_date(F.col(ts)))


# W6 ------------------------------------------------------------------------
def score_batches(stream: DataFrame, score, signature: dict[str, str], path: str, checkpoint: str | None = None,
                  ranges: dict | None = None, required: list[str] | None = None) -> list:
    """Score a stream of feature rows once each: rows that pass the row checks
    (Q10) go through ``score`` to ``path/scored``, the others with their reasons
    to ``path/rejected``, and a line of counts to ``path/account``.

    Every batch owns one folder per table, named by its number, and writes it
    by overwriting: a batch that is replayed after a failure, half written or
    not, ends in the same rows."""
    from vireo.operators.quality import row_reasons

    def write(batch: DataFrame, number: int) -> None:
        from vireo.session import cut_lineage
        checked = cut_lineage(row_reasons(batch, signature, ranges, required))
        bad = F.size("reasons") > 0
        score(checked.where(~bad).drop("reasons")).write.mode("overwrite").parquet(f"{path}/scored/batch={number}")
        checked.where(bad).write.mode("overwrite").parquet(f"{path}/rejected/batch={number}")
        (checked.agg(F.count(F.lit(1)).alias("n_in"), F.count_if(~bad).alias("n_scored"), F.count_if(bad).alias("n_rejected"))
         .write.mode("overwrite").parquet(f"{path}/account/batch={number}"))

    return run_available_now(stream, foreach_batch=write, checkpoint=checkpoint)


# W7 ------------------------------------------------------------------------
def daily_score_bins(stream: DataFrame, ts: str, score: str, watermark: str = "1 day") -> DataFrame:
    """Counts per (day, score bin) with an event-time watermark (append mode)."""
    from vireo.operators.profile import edge_bin, unit_edges
    d = _event_ts(stream, ts)
    if d.isStreaming:
        d = d.withWatermark(ts, watermark)
    b = edge_bin(F.col(score), unit_edges(C.SCORE_BINS))
    g = d.groupBy(F.window(ts, "1 day").alias("w"), b.alias("bin")).agg(F.count(F.lit(1)).alias("cnt"))
    return g.select(F.to_date(F.col("w.start")).alias("day"), "bin", "cnt")


# W8 ------------------------------------------------------------------------
#: periods or keys of a batch that are named in a filter
MAX_NAMED = 1000


def label_join(labels: DataFrame, predictions: DataFrame, keys=("request_id",), partition: str | None = None,
               key_range: bool = True) -> DataFrame:
    """Late labels joined to the static predictions table: no 90-day join state
    is kept.  With ``partition`` (a column of both) a batch of labels reads
    only the partitions it names: their values are listed and become a
    partition filter of the scan, as long as there are at most ``MAX_NAMED`` of
    them (periods are bounded by the calendar).  A range of the first key, from
    the batch's smallest to its largest, is pushed into the files."""
    if not labels.isStreaming and partition is not None:
        named = [r[0] for r in labels.select(partition).distinct().limit(MAX_NAMED + 1).collect()]
        if len(named) <= MAX_NAMED:
            predictions = predictions.where(F.col(partition).isin([v for v in named if v is not None]))
    if not labels.isStreaming and key_range:
        low, high = labels.agg(F.min(keys[0]), F.max(keys[0])).first()
        if low is not None:
            predictions = predictions.where(F.col(keys[0]).between(F.lit(low), F.lit(high)))
    return labels.join(predictions, list(keys), "inner")


# W9 ------------------------------------------------------------------------
def final_watermark(progress: list):
    """The watermark of the last trigger, as ISO text; None without one."""
    marks = [w for p in progress if (w := _progress(p).get("eventTime", {}).get("watermark"))]
    return max(marks, default=None)


def _progress(p) -> dict:
    import json
    return p if isinstance(p, dict) else json.loads(p.json)


def watermark_account(source: DataFrame, windows: DataFrame, ts: str, watermark: str, length: str) -> DataFrame:
    """Every row of a windowed stream's input accounted for, as events: in an
    emitted window, in a window still open, without a time, or dropped as late
    (the rest).  ``windows`` is the emitted table with its counts ``n``; a
    window that ends after the final ``watermark`` is open and drops nothing.

    (The state operators' own counter counts partially aggregated rows.)"""
    end = F.window(F.col(ts), length)["end"]
    per = (source.where(F.col(ts).isNotNull()).groupBy(end.alias("e")).agg(F.count(F.lit(1)).alias("n"))
           .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("timed"),
                F.coalesce(F.sum(F.when(F.col("e") > F.lit(watermark).cast("timestamp"), F.col("n"))), F.lit(0)).alias("rows_open")))
    nulls = source.agg(F.count_if(F.col(ts).isNull()).alias("rows_without_time"))
    done = windows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in_windows"))
    from vireo.operators.kpi import combine_one_row
    return combine_one_row(per, nulls, done).select(
        *[F.col(c).cast("bigint").alias(c) for c in ("rows_in_windows", "rows_open", "rows_without_time")],
        (F.col("timed") - F.col("rows_open") - F.col("rows_in_windows")).cast("bigint").alias("rows_dropped_late"))
