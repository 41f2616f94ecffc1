import math

import pytest
from pyspark.sql import functions as F

from vireo.operators import drift as D
from vireo.operators import profile as A


def test_numeric_profile(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "v double")
    r = A.numeric_profile(df, ["v"]).first()
    assert r.mean == 5.5 and r.missing_rate == 0.0 and r["count"] == 10 and r.p50 == 5.5
    df2 = spark.createDataFrame([(float(i) if i <= 8 else None,) for i in range(1, 11)], "v double")
    r2 = A.numeric_profile(df2, ["v"]).first()
    assert r2.missing_rate == 0.2 and r2["count"] == 10
    empty = spark.createDataFrame([(None,)], "v double")
    r3 = A.numeric_profile(empty, ["v"]).first()
    assert r3["count"] == 0 and r3.missing_rate == 1.0


def test_categorical_profile_topk(spark):
    df = spark.createDataFrame([(x,) for x in "ABACAB"], "v string")
    rows = {r.value: r for r in A.categorical_profile(df, ["v"]).collect()}
    assert rows["A"].cnt == 3 and rows["A"]["rank"] == 1
    assert A.categorical_summary(df, ["v"]).first().n_unique == 3
    many = spark.createDataFrame([(f"v{i:02d}",) for i in range(15) for _ in range(2)], "v string")
    prof = {r.value: r for r in A.categorical_profile(many, ["v"], top_k=10).collect()}
    assert prof["__other__"].cnt == 10 and len(prof) == 11


def test_score_histogram(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 0.15, 0.5, 1.0, 1.5, float("nan")]], "p double")
    h = {r.bin: r for r in A.score_histogram(df, "p").collect()}
    assert len(h) == 20
    assert h[0].cnt == 1 and h[3].cnt == 1 and h[10].cnt == 1 and h[19].cnt == 1
    # out-of-range value counts in the denominator (5 non-NaN values)
    assert h[19].freq == 0.2


def test_psi_pairs(spark):
    eq = spark.createDataFrame([(0, i, 0.25, 0.25) for i in range(4)], "g int, bin int, b_freq double, c_freq double")
    assert D.psi(eq, ["g"]).first().psi == 0.0
    sh = spark.createDataFrame([(0, i, 0.25, c) for i, c in enumerate([0.5, 0.2, 0.2, 0.1])],
                               "g int, bin int, b_freq double, c_freq double")
    assert D.psi(sh, ["g"]).first().psi > 0.05


def test_numeric_psi_modes(spark):
    vals = spark.createDataFrame([("x", float(i)) for i in range(1, 1001)], "feature string, value double")
    q = D.numeric_psi(vals, vals).first().psi
    e = D.numeric_psi(vals, vals, baseline="equal").first().psi
    assert abs(q) < 1e-9
    assert abs(e - 0.3607) < 0.002


def test_categorical_psi_other_bucket(spark):
    base = spark.createDataFrame([("f", x) for x in "AAAAABBBCC"], "feature string, value string")
    top = D.categorical_profile_long(base, top_k=2)
    cur = spark.createDataFrame([("f", x) for x in "AAABBC"], "feature string, value string")
    assert D.categorical_psi(cur, top).first().psi >= 0


@pytest.mark.parametrize("v,want", [(0.05, "green"), (0.1, "yellow"), (0.25, "red"), (0.15, "yellow"), (0.30, "red")])
def test_status(spark, v, want):
    df = spark.createDataFrame([(v,)], "psi double")
    assert df.select(D.status("psi", 0.1, 0.25)).first()[0] == want


def test_missing_override(spark):
    df = spark.createDataFrame([("green", 0.06), ("green", 0.2), ("yellow", 0.0)], "s string, d double")
    got = [r[0] for r in df.select(D.with_missing_override(F.col("s"), "d")).collect()]
    assert got == ["yellow", "red", "yellow"]


def test_request_aggregate(spark):
    df = spark.createDataFrame([("r1", 10.0, None, 0.2), ("r1", 20.0, 1.0, 0.8), ("r2", 5.0, 2.0, 0.5)],
                               "request_id string, idade double, ian double, risk_score double")
    out = {r.request_id: r for r in A.request_aggregate(df, "request_id", ["idade", "ian"], "risk_score").collect()}
    assert out["r1"].n_instances == 2 and out["r1"].missing_rate == 0.25 and out["r1"].positive_rate == 0.5
    assert math.isclose(out["r1"].risk_score_std, 0.3)


def test_categorical_profile_against_pandas(spark):
    import pandas as pd
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    pdf = part.select("p_brand").toPandas()
    got = {(r.value, r.cnt, r["rank"]) for r in A.categorical_profile(part, ["p_brand"], top_k=5).collect()}
    vc = pdf.p_brand.value_counts().reset_index()
    vc.columns = ["value", "cnt"]
    vc = vc.sort_values(["cnt", "value"], ascending=[False, True]).reset_index(drop=True)
    want = {(v, int(c), i + 1) for i, (v, c) in enumerate(zip(vc.value[:5], vc.cnt[:5]))}
    rest = int(vc.cnt[5:].sum())
    if rest:
        want.add(("__other__", rest, 6))
    assert got == want
