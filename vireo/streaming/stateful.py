"""Keyed state that Spark's window operators do not have (W1, W4, W11 as streams).

Each job is a ``StatefulProcessor`` for ``transformWithState``: its state
lives in RocksDB below the query's checkpoint, only the entries that a trigger
touches are read and written, and event-time timers end what is no longer
needed, so state follows the traffic within the watermark and never the length
of the log.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vireo.streaming.jobs import _event_ts, file_stream, run_available_now, shared_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_stateful(df: DataFrame, path: str | None = None, **kw) -> list:
    """``run_available_now`` with the state in RocksDB, which these processors need."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return run_available_now(df, path, **kw)


def run_in_time_slices(df: DataFrame, ts: str, slices: int, build, path: str, checkpoint: str | None = None) -> list:
    """Replay a stored log in time order: it is cut at quantiles of ``ts`` into
    ``slices`` of about equal size, and one query (one checkpoint) takes them
    one after the other, so that a trigger holds one slice.  ``build`` makes the
    streaming result from the source.  Rows without a time are left out."""
    spark = df.sparkSession
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    probs = F.array(*[F.lit(i / slices) for i in range(1, slices)]) if slices > 1 else None
    cuts = sorted(set(df.agg(F.percentile_approx(us, probs, 10_000)).first()[0] or [])) if slices > 1 else []
    part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>"), lambda c: c <= us))
    held, src = shared_path(spark, "slices"), shared_path(spark, "slice-source")
    df.where(us.isNotNull()).withColumn("__slice", part).repartition("__slice").write.partitionBy("__slice").parquet(held)
    checkpoint = checkpoint or shared_path(spark, "ckpt")
    progress = []
    for i in range(len(cuts) + 1):
        one = spark.read.schema(df.schema).parquet(f"{held}/__slice={i}")
        one.write.parquet(f"{src}/{i:06d}")
        progress += run_stateful(build(file_stream(spark, f"{src}/*/*.parquet", schema=df.schema)), path, checkpoint=checkpoint)
    return progress


# W1 ------------------------------------------------------------------------
def sliding_order_statistics(us: np.ndarray, values: np.ndarray, rows: np.ndarray, width: int, probs) -> list[tuple]:
    """(n, sum, mean, quantiles...) of the trailing ``width`` (inclusive, and
    with all rows of the same time) at each of ``rows`` of a time-ordered log.
    Values that are not numbers count for nothing.  Every value enters and
    leaves one ordered list once; no frame is sorted again."""
    number = ~np.isnan(values)
    total = np.concatenate(([0.0], np.cumsum(np.where(number, values, 0.0))))
    first, last = np.searchsorted(us, us[rows] - width, "left"), np.searchsorted(us, us[rows], "right")
    order: list[float] = []
    lo = hi = int(first[0]) if len(rows) else 0
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        while hi < b:
            if number[hi]:
                insort(order, float(values[hi]))
            hi += 1
        while lo < a:
            if number[lo]:
                del order[bisect_left(order, float(values[lo]))]
            lo += 1
        n = len(order)
        if not n:
            out.append((0, None, None, *[None] * len(probs)))
            continue
        qs = []
        for p in probs:
            h = p * (n - 1)
            i = int(h)
            qs.append(order[i] + (h - i) * (order[min(i + 1, n - 1)] - order[i]))
        s = float(total[b] - total[a])
        out.append((n, s, s / n, *qs))
    return out


class RollingStats(StatefulProcessor):
    """State of one (group, time bucket): its rows by second.  Seconds that the
    watermark has passed are answered, those older than the frame are removed,
    and the whole key ends with its bucket."""

    def __init__(self, seconds: int, probs, bucket_us: int, names: list[str]):
        self.width, self.probs, self.bucket_us, self.names = seconds * 1_000_000, list(probs), bucket_us, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getMapState("rows", "second bigint", "us array<bigint>, value array<double>, id array<bigint>, own array<boolean>")
        self.marks = handle.getValueState("marks", "answered bigint, alarm bigint")

    def handleInputRows(self, key, rows, timerValues):
        fresh: dict[int, list] = {}
        for pdf in rows:
            for us, v, i, own in zip(pdf["us__"].tolist(), pdf["v__"].tolist(), pdf["id__"].tolist(), pdf["own__"].tolist()):
                fresh.setdefault(us // 1_000_000, []).append((us, v, i, own))
        if not fresh:
            return
        for second, new in fresh.items():
            held = self.rows.getValue((second,)) if self.rows.containsKey((second,)) else ([], [], [], [])
            self.rows.updateValue((second,), tuple([*a, *b] for a, b in zip(held, zip(*new))))
        answered, alarm = self.marks.get() if self.marks.exists() else (-1, None)
        due = (min(fresh) + 1) * 1000
        if alarm is None or due < alarm:
            if alarm is not None:
                self.handle.deleteTimer(alarm)
            self.handle.registerTimer(due)
            alarm = due
        self.marks.update((answered, alarm))
        return
        yield  # rows are answered when the watermark passes them

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        answered = self.marks.get()[0]
        held = {k[0]: v for k, v in self.rows.iterator()}
        cols = [np.concatenate([np.asarray(held[s][i], dtype=t) for s in held]) if held else np.zeros(0, t)
                for i, t in enumerate((np.int64, np.float64, np.int64, bool))]
        order = np.lexsort((cols[2], cols[0]))
        us, value, ids, own = (c[order] for c in cols)
        # whole seconds only, as timers are set by them
        mark -= mark % 1_000_000
        at = np.flatnonzero(own & (us > answered) & (us < mark))
        if len(at):
            stats = sliding_order_statistics(us, value, at, self.width, self.probs)
            out = pd.DataFrame([(int(ids[r]), int(us[r]), *s) for r, s in zip(at.tolist(), stats)], columns=self.names)
            for i, k in enumerate(key[:-1]):
                out.insert(i, f"k{i}", k)
            out["n"] = out["n"].astype("int64")
            yield out
        if mark >= (int(key[-1]) + 1) * self.bucket_us:
            self.rows.clear()
            self.marks.clear()
            return
        for s in held:
            if (s + 1) * 1_000_000 <= mark - self.width:
                self.rows.removeKey((s,))
        pending = us[us >= mark]
        # the next second to answer, or the end of the bucket
        due = (int(pending[0]) // 1_000_000 + 1) * 1000 if len(pending) else (int(key[-1]) + 1) * self.bucket_us // 1000
        self.handle.registerTimer(due)
        self.marks.update((mark - 1, due))


def rolling_stats_stream(stream: DataFrame, row_id: str, ts: str, value: str, seconds: int = 60, by: list[str] | None = None,
                         probs=(0.5, 0.95), bucket_seconds: int = 600, watermark: str = "2 minutes") -> DataFrame:
    """W1 as a stream: per row the exact count, sum, mean and quantiles over the
    trailing ``seconds``, emitted once the watermark has passed the row's second.

    As in the batch form the log is cut into time buckets, and the end of a
    bucket is copied into the next one, so a group (or a log without groups)
    is spread over tasks and its state is that of a bucket at most."""
    by = list(by or [])
    lb, lw = max(bucket_seconds, seconds) * 1_000_000, seconds * 1_000_000
    d = _event_ts(stream, ts).withWatermark(ts, watermark)
    us = F.unix_micros(F.col(ts))
    own = F.floor(us / F.lit(lb)).cast("bigint")
    d = d.select(*by, ts, us.alias("us__"), F.col(value).cast("double").alias("v__"), F.col(row_id).cast("bigint").alias("id__"), own.alias("o__"))
    d = d.withColumn("b__", F.explode(F.when(F.col("us__") >= (F.col("o__") + 1) * F.lit(lb) - F.lit(lw),
                                             F.array(F.col("o__"), F.col("o__") + 1)).otherwise(F.array("o__"))))
    d = d.withColumn("own__", F.col("b__") == F.col("o__"))
    stats = ["n", "sum", "mean", *[f"p{int(round(p * 100)):02d}" for p in probs]]
    keys = [T.StructField(f"k{i}", stream.schema[c].dataType) for i, c in enumerate(by)]
    fields = [T.StructField("id__", T.LongType()), T.StructField("us__", T.LongType()), T.StructField("n", T.LongType()),
              *[T.StructField(c, T.DoubleType()) for c in stats[1:]]]
    out = d.groupBy(*by, "b__").transformWithStateInPandas(
        RollingStats(seconds, probs, lb, ["id__", "us__", *stats]), T.StructType(keys + fields), "Append", "EventTime")
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(by)], F.col("id__").alias(row_id),
                      F.timestamp_micros("us__").alias(ts), *stats)


# W4 ------------------------------------------------------------------------
def replay_bucket(times: list[int], tokens: float, last: int | None, capacity: float, refill: float, cost: float) -> tuple[float, int | None, int]:
    """(tokens, last time, rejected) after requests at ``times`` (microseconds, ascending)."""
    rejected = 0
    for us in times:
        # events older than the last one seen refill nothing
        if last is not None:
            tokens = min(capacity, tokens + refill * max(0, us - last) / 1e6)
        last = us if last is None else max(last, us)
        if tokens >= cost:
            tokens -= cost
        else:
            rejected += 1
    return tokens, last, rejected


class TokenBucket(StatefulProcessor):
    """Two numbers per key, until the bucket is full again: a full bucket is
    the same as none, so a timer at that time removes the key's state."""

    def __init__(self, capacity: float, refill: float, cost: float):
        self.capacity, self.refill, self.cost = capacity, refill, cost

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bucket = handle.getValueState("bucket", "tokens double, last_us bigint, alarm bigint")

    def handleInputRows(self, key, rows, timerValues):
        tokens, last, alarm = self.bucket.get() if self.bucket.exists() else (self.capacity, None, None)
        # a key's rows of one trigger come in chunks and are put in time order together
        times = np.sort(np.concatenate([pdf["us__"].to_numpy() for pdf in rows])).tolist()
        tokens, last, rejected = replay_bucket(times, tokens, last, self.capacity, self.refill, self.cost)
        full = last // 1000 + int((self.capacity - tokens) / self.refill * 1000) + 2
        if alarm != full:
            if alarm is not None:
                self.handle.deleteTimer(alarm)
            self.handle.registerTimer(full)
        self.bucket.update((float(tokens), int(last), full))
        yield pd.DataFrame({"key": [key[0]], "n_requests": [len(times)], "n_rejected": [rejected], "tokens": [tokens]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.bucket.clear()
        return
        yield


def token_bucket(stream: DataFrame, key: str, ts: str, capacity: float = 60.0, refill: float = 1.0, cost: float = 1.0,
                 watermark: str = "0 seconds") -> DataFrame:
    """W4(b): an exact token bucket per key.  One row per key and trigger.

    A key's rows of a trigger are replayed in time order and state carries
    across triggers, which must come in time order (``run_in_time_slices`` for a
    stored log; a trigger, and so a key's rows in memory, is then one slice);
    rows behind the watermark are dropped."""
    d = _event_ts(stream, ts).withWatermark(ts, watermark)
    d = d.select(F.col(key).cast("string").alias(key), ts, F.unix_micros(F.col(ts)).alias("us__")).where(F.col("us__").isNotNull())
    return d.groupBy(key).transformWithStateInPandas(
        TokenBucket(capacity, refill, cost), "key string, n_requests bigint, n_rejected bigint, tokens double", "Append", "EventTime")


# W11 -----------------------------------------------------------------------
class LatestState(StatefulProcessor):
    """The newest ``depth`` values of a key, newest first."""

    def __init__(self, depth: int):
        self.depth = depth

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.history = handle.getListState("history", "us bigint, tie bigint, value string")

    def handleInputRows(self, key, rows, timerValues):
        best = [tuple(r) for r in self.history.get()] if self.history.exists() else []
        for pdf in rows:
            chunk = list(zip(pdf["us__"].tolist(), pdf["tie__"].tolist(), pdf["v__"].tolist()))
            # a chunk adds at most ``depth`` entries, so a hot key holds that many more
            best = sorted(best + chunk, key=lambda r: (-r[0], -r[1]))[:self.depth]
        self.history.put([(int(u), int(t), None if v is None or v != v else str(v)) for u, t, v in best])
        yield pd.DataFrame({"key": [str(key[0])], "us": [[int(r[0]) for r in best]],
                            "history": [[None if r[2] is None or r[2] != r[2] else str(r[2]) for r in best]]})


def latest_state_stream(stream: DataFrame, key: str, ts: str, value: str, tie: str, depth: int = 10) -> DataFrame:
    """W11 as a stream (update mode): after each trigger the keys it touched,
    with the times and values (as text) of their newest ``depth`` changes,
    newest first; ``rolled_back`` reads a version from that.  Rows without a
    time are ignored; they have no place in the order."""
    d = stream.select(F.col(key).cast("string").alias(key), F.unix_micros(F.col(ts).cast("timestamp")).alias("us__"),
                      F.coalesce(F.col(tie).cast("bigint"), F.lit(-1)).alias("tie__"), F.col(value).cast("string").alias("v__"))
    return d.where(F.col("us__").isNotNull()).groupBy(key).transformWithStateInPandas(
        LatestState(depth), "key string, us array<bigint>, history array<string>", "Update", "None")


def rolled_back(states: DataFrame, versions: int = 0) -> DataFrame:
    """The value of every key ``versions`` changes ago (null if it is younger),
    and the one before it."""
    at = lambda c, i: F.try_element_at(c, F.lit(i + 1))
    return states.select("key", F.timestamp_micros(at("us", versions)).alias("latest_ts"), at("history", versions).alias("current"),
                         at("history", versions + 1).alias("previous"))


def run_latest_state(df: DataFrame, ts: str, key: str, value: str, tie: str, path: str, slices: int = 2, depth: int = 10) -> DataFrame:
    """Replay a log into the state per key; a batch replayed after a failure
    replaces its own folder.  Returns the last state of every key."""
    spark = df.sparkSession
    src, checkpoint = shared_path(spark, "latest-source"), shared_path(spark, "ckpt")
    df.repartition(slices, F.xxhash64(tie)).write.parquet(src)

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream = file_stream(spark, f"{src}/*.parquet", schema=df.schema, max_files=1)
    run_stateful(latest_state_stream(stream, key, ts, value, tie, depth), checkpoint=checkpoint, mode="update", foreach_batch=write)
    states = spark.read.option("basePath", path).parquet(path)
    return states.groupBy("key").agg(F.max_by(F.struct("us", "history"), "batch").alias("s")).select("key", "s.us", "s.history")
