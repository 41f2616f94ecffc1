import datetime as dt

import pytest
from pyspark.sql import functions as F

from vireo.operators import explore as X
from vireo.operators import features as FE
from vireo.operators import kpi as K
from vireo.operators import prepare as P
from vireo.operators.evaluate import select_threshold
from vireo.operators.joins import join_next_period, key_overlap, profile_join
from vireo.sources import tables as IO


def test_read_table_dispatch(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    df.write.parquet(str(tmp_path / "t.parquet"))
    df.write.option("header", "true").csv(str(tmp_path / "t.csv"))
    assert IO.read_table(spark, str(tmp_path / "t.parquet")).count() == 1
    assert IO.read_table(spark, str(tmp_path / "t.csv")).first().v == "a"
    with pytest.raises(ValueError):
        IO.read_table(spark, str(tmp_path / "t.xlsx"))


def test_read_labels_missing_is_empty(spark, tmp_path):
    assert IO.read_labels(spark, str(tmp_path / "nope.jsonl")).count() == 0
    assert IO.read_labels(spark, None).columns == ["request_id", "timestamp", "label"]


def test_append_events_partitions_by_own_date(spark, tmp_path):
    ev = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59), 1), (dt.datetime(2024, 1, 2, 0, 1), 2)],
                               "ts timestamp, v int")
    store = str(tmp_path / "store")
    IO.append_events(ev, store)
    got = {str(r.dt): r.v for r in IO.read_events(spark, store).collect()}
    assert got == {"2024-01-01": 1, "2024-01-02": 2}
    assert IO.read_events(spark, store, "2024-01-02", "2024-01-02").count() == 1


def test_read_jsonl_tolerant(spark, tmp_path):
    from pyspark.sql import types as T
    p = tmp_path / "log.jsonl"
    p.write_text('{"a": 1}\n{broken\n{"a": 3}\n')
    df = IO.read_jsonl(spark, str(p), T.StructType([T.StructField("a", T.LongType())]))
    assert sorted(r.a for r in df.collect()) == [1, 3]
    bad = spark.createDataFrame([('{"x": 1.5}',), ("not json",)], "j string")
    maps = [r[0] for r in bad.select(IO.parse_json_map(F.col("j"))).collect()]
    assert maps == [{"x": 1.5}, {}]


def test_schema_record_and_dtypes(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    r = P.schema_record(df, 2023, ["A", "B", "C"]).first()
    assert r.year == 2023 and r.n_rows == 1 and r.normalized_columns == ["a", "b", "c"] and r.n_columns == 3
    assert {(x.dtype, x.n_columns) for x in X.dtype_counts(df).collect()} == {("int", 1), ("double", 1), ("string", 1)}


def test_join_next_period_null_keys(spark):
    f = spark.createDataFrame([(None, 2022, 1.0), (1, 2022, 2.0)], "ra int, ano int, x double")
    lab = spark.createDataFrame([(None, 2023, 1), (1, 2023, 0)], "ra int, ano int, y int")
    assert join_next_period(f, lab, "ra", "ano").count() == 1
    assert join_next_period(f, lab, "ra", "ano", null_safe=True).count() == 2


def test_key_overlap_and_profile_join(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(2,), (3,), (4,), (4,)], "k int")
    r = key_overlap(a, b, "k").first()
    assert (r.n_common, r.n_only_a, r.n_only_b, r.passed) == (2, 1, 1, True)
    base = spark.createDataFrame([("f1", 0.1), ("f2", 0.2)], "feature string, b double")
    cur = spark.createDataFrame([("f1", 0.3)], "feature string, c double")
    assert profile_join(base, cur).count() == 2


def test_histogram_and_box(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)] + [(100.0,)], "v double")
    h = {r.bin: r.n for r in X.histogram(df, "v", 10).collect()}
    assert h[0] == 10 and h[9] == 1
    b = X.box_stats(df, "v").first()
    assert b.n_outliers == 1 and b.whisker_hi == 10.0


def test_composites_prefix_quirk(spark):
    df = spark.createDataFrame([(5.0, 1, 7.0)], "ida_2023 double, ida_2023_missing int, ieg_2023 double")
    strict = FE.add_row_composites(df, ["ida_2023", "ieg_2023"]).first()
    loose = FE.add_row_composites(df, year="2023").first()
    assert strict.media_indicadores == 6.0 and loose.media_indicadores == 13.0 / 3


def test_threshold_fpr_quirk(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "y int, p double")
    a = select_threshold(df, [], "y", "p", "max_recall", min_recall=1.0, max_fpr=0.5).first()
    assert a.threshold == 0.7 and a.fpr == 0.5


def test_audit_newest_and_quirk(spark):
    t0 = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([(t0 + dt.timedelta(minutes=i), "predict") for i in range(10)], "ts timestamp, action string")
    newest = [r.ts.minute for r in K.audit_newest(log, "ts", n=3).collect()]
    oldest = [r.ts.minute for r in K.audit_newest(log, "ts", n=3, oldest_quirk=True).collect()]
    assert newest == [9, 8, 7] and oldest == [0, 1, 2]


def test_latest_per_key_and_streaks(spark):
    log = spark.createDataFrame([("u", 1, "a"), ("u", 3, "c"), ("u", 2, "b"), ("v", 1, "x")], "k string, t int, s string")
    got = {r.k: (r.current, r.previous) for r in K.latest_per_key(log, "k", "t", "s").collect()}
    assert got == {"u": ("c", "b"), "v": ("x", None)}
    from vireo.operators.drift import status_streaks
    days = spark.createDataFrame([(dt.date(2024, 1, d), "red" if d in (1, 2, 3, 5) else "green") for d in range(1, 7)],
                                 "day date, status string")
    assert sorted(r.n_days for r in status_streaks(days).collect()) == [1, 3]


def test_ordinal_and_t_test(spark):
    df = spark.createDataFrame([(-3,), (-1,), (0,), (2,)], "d int")
    assert [r[0] for r in df.select(K.ordinal_target("d")).collect()] == [
        "defasagem_severa", "defasagem_leve", "adequado_avancado", "adequado_avancado"]
    g = spark.createDataFrame([(True, 1.0), (True, 2.0), (True, 3.0), (False, 2.0), (False, 3.0), (False, 4.0)],
                              "g boolean, v double")
    r = K.two_sample_t(g, "g", "v").first()
    assert r.dof == 4 and abs(r.t + 1.224745) < 1e-5


def test_read_events_parquet_and_csv(spark, tmp_path):
    store = str(tmp_path / "mixed")
    a = spark.createDataFrame([(dt.datetime(2024, 1, 1, 1), 1)], "ts timestamp, v int")
    b = spark.createDataFrame([(dt.datetime(2024, 1, 2, 1), 2)], "ts timestamp, v int")
    IO.append_events(a, store)
    IO.append_events(b, store, fmt="csv")
    got = sorted(r.v for r in IO.read_events(spark, store, fmt="both").collect())
    assert got == [1, 2]


def test_append_first_record_quirk(spark, tmp_path):
    ev = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59), 1), (dt.datetime(2024, 1, 2, 0, 1), 2)],
                               "ts timestamp, v int")
    store = str(tmp_path / "quirk")
    IO.append_events(ev, store, first_record_date=True)
    assert {str(r.dt) for r in IO.read_events(spark, store).collect()} == {"2024-01-01"}


def test_slo_lifetime_errors(spark):
    from vireo.streaming import jobs as W
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0, 10.0, 500)] + [(t0 + dt.timedelta(minutes=1, seconds=i), 10.0, 200) for i in range(9)]
    df = spark.createDataFrame(rows, "ts timestamp, latency double, status int")
    m = W.minute_metrics(df, "ts", "latency", "status")
    win = {r.window_start.minute: r.error_rate for r in W.slo_status(m).collect()}
    life = {r.window_start.minute: r.error_rate for r in W.slo_status(m, lifetime_errors=True).collect()}
    assert win == {0: 1.0, 1: 0.0} and life == {0: 1.0, 1: 0.1}


def test_latest_per_key_hot_key_against_pandas(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(9)
    n = 2000
    pdf = pd.DataFrame({"k": np.where(rng.random(n) < 0.4, "hot", rng.choice(list("abcdefgh"), n)),
                        "t": rng.permutation(n), "s": rng.choice(["x", "y", "z"], n)})
    got = {r.k: (r.current, r.previous) for r in K.latest_per_key(spark.createDataFrame(pdf), "k", "t", "s").collect()}
    for key, part in pdf.groupby("k"):
        srt = part.sort_values("t", ascending=False)
        want = (srt.s.iloc[0], srt.s.iloc[1] if len(srt) > 1 else None)
        assert got[key] == want
