"""Nulls, maps, gaps, hot score ranges, URIs and corrupt files."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from vireo.operators import kpi as K
from vireo.operators import ml as M
from vireo.operators import privacy as S
from vireo.sources import tables as IO


def test_winsorize_keeps_nulls_and_clips(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,), (float("nan"),)], "x double")
    got = [r.x for r in K.winsorize(df, ["x"], 0.05, 0.95).collect()]
    assert got[-2:] == [None, None] and min(x for x in got if x is not None) == 5.0


def test_sanitize_maps_and_arrays(spark):
    df = spark.createDataFrame([({"email": "a@b.com", "x": "call 123.456.789-00"}, ["mail a@b.com", None])], "m map<string,string>, a array<string>")
    r = S.sanitize(df).first()
    assert r.m["email"] == "[REDACTED]" and "123.456.789-00" not in r.m["x"] and "a@b.com" not in r.a[0] and r.a[1] is None


def test_silent_hours_are_anomalies(spark):
    hours = [0, 0, 1, 1, 2, 2, 6, 6]
    df = spark.createDataFrame([("e", dt.datetime(2024, 1, 1, h)) for h in hours], "endpoint string, ts timestamp")
    rows = {r.hour.hour: r for r in K.volume_anomalies(df, "ts", ["endpoint"]).collect()}
    assert sorted(rows) == list(range(7)) and rows[3].n == 0 and not rows[3].within_tolerance


def test_split_is_exact_with_repeated_keys_and_null_labels(spark):
    rows = [(i // 4, i % 4, None if i % 10 == 0 else i % 2) for i in range(1000)]
    out = M.stratified_split(spark.createDataFrame(rows, "ra long, ano long, label int"), "label", ["ra", "ano"], 0.2)
    got = {r.label: (r.n, r.t) for r in out.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert got == {k: (n, -(-n // 5)) for k, n in ((None, 100), (0, 400), (1, 500))}


def test_labels_by_uri_and_glob(spark, tmp_path):
    spark.createDataFrame([("r1", dt.datetime(2024, 1, 1), 1)], IO.LABEL_SCHEMA).write.parquet(str(tmp_path / "l.parquet"))
    for path in (f"{tmp_path}/l.parquet", f"file://{tmp_path}/l.parquet", f"{tmp_path}/*.parquet"):
        assert IO.read_labels(spark, path).count() == 1
    assert IO.read_labels(spark, f"file://{tmp_path}/none.parquet").count() == 0


def test_corrupt_event_file_is_skipped_for_that_read_only(spark, tmp_path):
    store = str(tmp_path / "ev")
    IO.append_events(spark.createDataFrame([(dt.datetime(2024, 1, 1), 1)], "ts timestamp, v int"), store)
    bad = tmp_path / "ev" / "dt=2024-01-02"
    bad.mkdir()
    (bad / "x.parquet").write_bytes(b"PAR1 this is no table")
    schema = "ts timestamp, v int, dt date"
    assert IO.read_events(spark, store).count() == 1
    with pytest.raises(Exception):
        spark.read.schema(schema).parquet(store).select("v").collect()


def test_token_bucket_over_slices():
    from vireo.streaming.stateful import replay_bucket
    us = (np.arange(30_000) * 500_000).tolist()
    whole = replay_bucket(us, 60.0, None, 60.0, 1.0, 1.0)
    tokens, last, rejected = 60.0, None, 0
    for part in np.array_split(us, 7):
        tokens, last, r = replay_bucket(part.tolist(), tokens, last, 60.0, 1.0, 1.0)
        rejected += r
    assert whole == (tokens, last, rejected) and abs(rejected - 14_941) <= 1


def test_clustered_scores_spread(spark):
    """Scores inside a hundredth of the interval are dealt to ranges evenly."""
    from vireo.operators.evaluate import score_table
    df = spark.range(40_000).select((0.43 + F.col("id") / 4_000_000.0).alias("p"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        st = score_table(df, [], "y", "p")
        ranges = spark.read.parquet(st.inputFiles()[0].rsplit("/", 1)[0]).groupBy("__range").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(ranges) >= 4 and max(r["count"] for r in ranges) < 2 * 40_000 / len(ranges)
    rows = st.orderBy("score").collect()
    assert rows[0].tp_ge + rows[0].fp_ge == 40_000 and all(a.tp_ge >= b.tp_ge for a, b in zip(rows, rows[1:]))
