"""Drift from stored baselines and daily counts."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vireo.operators import baselines as B
from vireo.operators import drift as D
from vireo.streaming.jobs import shared_path

SCHEMA = "ts timestamp, x double, y double, c string, score double"


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(6)
    rows = [(dt.datetime(2024, 3, 1 + i % 10, i % 24), rng.gauss(i % 10, 3) if rng.random() > .1 else None, float(rng.randrange(3)),
             rng.choice("aaabbcde") if rng.random() > .05 else None, rng.random() if rng.random() > .02 else None) for i in range(4000)]
    rows += [(dt.datetime(2024, 3, 9), float("nan"), None, "new", 1.5), (None, 1.0, 1.0, "a", .5)]
    return spark.createDataFrame(rows, SCHEMA)


def windows(log):
    return log.where(F.col("ts") < "2024-03-06"), log.where(F.col("ts") >= "2024-03-06")


def stored(spark, log, **kw):
    base, store = shared_path(spark, "b"), shared_path(spark, "days")
    before, after = windows(log)
    B.store_baseline(before, base, "v1", ["x", "y"], ["c"], "score", 3)
    baseline = B.read_baseline(spark, base, "v1")
    B.write_day_counts(after, "ts", baseline, store, "score")
    return baseline, store


def test_rows_from_days_equal_rows_from_both_windows(spark, log):
    baseline, store = stored(spark, log)
    before, after = windows(log)
    long = lambda d, cols, t: d.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) if t == "double" else F.col(c) for c in cols]).unpivot([], cols, "feature", "value")
    want = D.feature_drift(long(before, ["x", "y"], "double"), long(after, ["x", "y"], "double"), long(before, ["c"], "string"),
                           long(after, ["c"], "string"), after.count(), ["x", "y"], ["c"], top_k=3)
    got = B.drift_from_counts(B.read_day_counts(spark, store, baseline), baseline)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    a = D.score_drift(before.select("score"), after.select("score")).first()
    b = B.score_drift_from_counts(B.read_day_counts(spark, store, baseline), baseline).first()
    assert tuple(a) == tuple(b)


def test_a_day_counted_again_replaces_itself_and_days_add_up(spark, log):
    baseline, store = stored(spark, log)
    _, after = windows(log)
    whole = {tuple(r) for r in B.read_day_counts(spark, store, baseline).select("feature", "key", "cnt").collect()}
    B.write_day_counts(after.where("to_date(ts) = '2024-03-08'"), "ts", baseline, store, "score")
    assert {tuple(r) for r in B.read_day_counts(spark, store, baseline).select("feature", "key", "cnt").collect()} == whole
    two = B.read_day_counts(spark, store, baseline, "2024-03-07", "2024-03-08")
    raw = B.window_counts(after.where("to_date(ts) BETWEEN '2024-03-07' AND '2024-03-08'"), baseline, "score")
    assert {tuple(r)[:3] for r in two.collect()} == {tuple(r)[:3] for r in raw.collect()}


def test_one_scan_of_the_window_and_only_the_days_asked(spark, log):
    baseline, store = stored(spark, log)
    path = shared_path(spark, "raw")
    log.write.parquet(path)
    plan = B.window_counts(spark.read.parquet(path), baseline, "score")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    days = B.read_day_counts(spark, store, baseline, "2024-03-07", "2024-03-08")
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-03-07" in plan
    days.collect()
    # a drift run reads the stored tables and nothing of the baseline's window
    files = B.drift_from_counts(days, baseline).inputFiles()
    assert files and all(store in f or baseline.at in f for f in files)


def test_windows_without_rows(spark, log):
    baseline, store = stored(spark, log)
    nothing = B.window_counts(log.limit(0), baseline, "score")
    rows = {r.feature: r for r in B.drift_from_counts(nothing, baseline).collect()}
    assert set(rows) == {"x", "y", "c"} and all(r.psi == 0 and r.current_missing_rate == 0 for r in rows.values())
    assert B.global_status_from_counts(nothing, baseline).first().global_status == "no_data"
