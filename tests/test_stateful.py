"""Keyed stream state against brute force: sliding frames, token buckets, latest values."""
import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vireo.streaming import jobs as W
from vireo.streaming import stateful as ST

T0 = dt.datetime(2024, 1, 1)


def test_sliding_order_statistics_against_sorting():
    rng = np.random.default_rng(5)
    us = np.sort(rng.integers(0, 400, 300))
    values = np.where(rng.random(300) < 0.1, np.nan, rng.integers(0, 20, 300).astype(float))
    rows = np.arange(40, 300)
    for row, got in zip(rows, ST.sliding_order_statistics(us, values, rows, 30, (0.0, 0.5, 0.95, 1.0))):
        frame = values[(us >= us[row] - 30) & (us <= us[row])]
        frame = frame[~np.isnan(frame)]
        assert got[0] == len(frame)
        if len(frame):
            assert got[1:3] == pytest.approx((frame.sum(), frame.mean()))
            assert got[3:] == pytest.approx(tuple(np.quantile(frame, [0.0, 0.5, 0.95, 1.0])))
        else:
            assert got[1:] == (None,) * 6


def test_rolling_stream_over_several_triggers_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    n = 900
    pdf = pd.DataFrame({"id": np.arange(n), "g": rng.choice(["hot", "b"], n, p=[0.9, 0.1]),
                        "ts": pd.Timestamp(T0) + pd.to_timedelta(np.sort(rng.integers(0, 1_500_000, n)), unit="ms"),
                        "v": np.where(rng.random(n) < 0.05, np.nan, np.round(rng.random(n) * 100, 2))})
    src, out, ckpt = (W.shared_path(spark, x) for x in ("roll-src", "roll", "roll-ckpt"))
    schema = "id long, g string, ts timestamp, v double"
    marks = 0
    for i, part in enumerate(np.array_split(np.arange(n), 4)):
        # inside a trigger the rows come in any order
        spark.createDataFrame(pdf.iloc[rng.permutation(part)], schema).write.parquet(f"{src}/{i}")
        s = W.file_stream(spark, f"{src}/*/*.parquet", schema=spark.read.parquet(f"{src}/0").schema)
        ST.run_stateful(ST.rolling_stats_stream(s, "id", "ts", "v", 60, by=["g"], bucket_seconds=120, watermark="10 seconds"), out, checkpoint=ckpt)
        marks += 1
    got = {r.id: r for r in spark.read.parquet(out).collect()}
    last = pdf["ts"].max().floor("ms") - pd.Timedelta(seconds=10)
    closed = pdf[pdf["ts"].dt.floor("s") + pd.Timedelta(seconds=1) <= last]
    assert set(got) == set(closed["id"]) and len(got) == spark.read.parquet(out).count() and marks == 4
    for _, row in closed.iterrows():
        frame = pdf[(pdf.g == row.g) & (pdf.ts >= row.ts - pd.Timedelta(seconds=60)) & (pdf.ts <= row.ts)].v.dropna()
        r = got[row.id]
        assert r.g == row.g and r.n == len(frame)
        if len(frame):
            assert (r["sum"], r["mean"], r.p50, r.p95) == pytest.approx((frame.sum(), frame.mean(), frame.quantile(.5), frame.quantile(.95)))


def state_rows(progress):
    import json
    ops = [json.loads(p.json)["stateOperators"] for p in progress if json.loads(p.json).get("stateOperators")]
    return [o[0]["numRowsTotal"] for o in ops]


def test_token_bucket_with_a_hot_key_in_slices_and_expiry(spark):
    rng = random.Random(3)
    # a third of the requests from one key, the others spread; then a long silence and one late key
    rows = [("hot", T0 + dt.timedelta(milliseconds=rng.randrange(600_000))) for _ in range(3000)]
    rows += [(f"k{rng.randrange(400)}", T0 + dt.timedelta(milliseconds=rng.randrange(600_000))) for _ in range(6000)]
    rows += [("late", T0 + dt.timedelta(hours=5, seconds=i)) for i in range(3)] + [("none", None)]
    df = spark.createDataFrame(rows, "api_key string, ts timestamp")
    out = W.shared_path(spark, "tb")
    progress = ST.run_in_time_slices(df, "ts", 5, lambda s: ST.token_bucket(s, "api_key", "ts", 20.0, 2.0), out)
    got = {r.key: (r.n, r.r) for r in spark.read.parquet(out).groupBy("key").agg(F.sum("n_requests").alias("n"), F.sum("n_rejected").alias("r")).collect()}
    want = {}
    for k in {k for k, t in rows if t}:
        times = sorted(int((t - T0) / dt.timedelta(microseconds=1)) for kk, t in rows if kk == k and t)
        want[k] = (len(times), ST.replay_bucket(times, 20.0, None, 20.0, 2.0, 1.0)[2])
    assert got == want and got["hot"][1] > 0
    # one row per key and trigger, and no slice holds all of the hot key
    assert spark.read.parquet(out).groupBy("key").count().agg(F.max("count")).first()[0] <= 5
    assert spark.read.parquet(out).where("key = 'hot'").agg(F.max("n_requests")).first()[0] < 1500
    # buckets that are full again leave the state: at the end only the late key is there
    assert max(state_rows(progress)) > 300 and state_rows(progress)[-1] <= 6


def test_latest_state_and_rollback_across_triggers(spark):
    rng = random.Random(8)
    rows = [(i, f"u{rng.randrange(5)}" if i % 3 else "hot", T0 + dt.timedelta(seconds=rng.randrange(50)), rng.choice(["a", "b", None]))
            for i in range(300)] + [(1000, "gone", None, "x")]
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp, v string")
    states = ST.run_latest_state(df, "ts", "k", "v", "id", W.shared_path(spark, "latest"), slices=4, depth=4)
    for versions in (0, 2, 5):
        got = {r.key: (r.current, r.previous) for r in ST.rolled_back(states, versions).collect()}
        for k in {r[1] for r in rows} - {"gone"}:
            order = [v for _, _, v in sorted(((t, i, v) for i, kk, t, v in rows if kk == k and t), key=lambda x: (x[0], x[1]), reverse=True)][:4] + [None] * 9
            assert got[k] == (order[versions], order[versions + 1])
