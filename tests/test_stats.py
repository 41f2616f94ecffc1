import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vireo.functions import stats
from vireo.functions.stats import ordered_prefix_sums, quantiles, top_k_per_group


@pytest.mark.parametrize("accuracy", [50, 200, 2000])
def test_bracketed_quantiles_match_linear_interpolation(spark, monkeypatch, accuracy):
    # with a coarse sketch the groups here are large ones: values outside the brackets are only counted
    monkeypatch.setattr(stats, "SKETCH_ACCURACY", accuracy)
    monkeypatch.setattr(stats, "SMALL_GROUP", 10 * accuracy)
    rng = np.random.default_rng(7)
    n = 4000
    # group "hot" holds most rows; values with many ties
    g = np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b", "c"], n))
    v = np.round(rng.lognormal(3, 1, n), 1)
    pdf = pd.DataFrame({"g": g, "v": v})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = {r.g: r for r in quantiles(df, "v", probs, ["g"]).collect()}
    for key, part in pdf.groupby("g"):
        want = np.quantile(part.v.to_numpy(), probs)  # linear
        have = [got[key][f"q{int(round(p * 100)):02d}"] for p in probs]
        assert np.allclose(have, want, rtol=0, atol=1e-9), key
    whole = quantiles(df, "v", [0.5]).first()[0]
    assert abs(whole - np.quantile(v, 0.5)) < 1e-9


def test_quantile_methods_agree(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("v"))
    a = quantiles(df, "v", [0.5, 0.95], method="aggregate").first()
    d = quantiles(df, "v", [0.5, 0.95]).first()
    assert tuple(a) == tuple(d) == (500.5, 950.05)


def test_ordered_prefix_sums(spark):
    pdf = pd.DataFrame({"g": ["x"] * 6 + ["y"] * 3, "o": [1, 2, 3, 4, 5, 6, 1, 2, 3], "c": [1] * 9})
    df = spark.createDataFrame(pdf)
    out = ordered_prefix_sums(df, ["g"], "o", ["c"], F.floor(F.col("o") / 2))
    got = sorted((r.g, r.o, r.c_cum) for r in out.collect())
    assert got == [("x", i, i - 1) for i in range(1, 7)] + [("y", i, i - 1) for i in range(1, 4)]
    desc = ordered_prefix_sums(df, ["g"], "o", ["c"], F.floor(F.col("o") / 2), descending=True)
    got = sorted((r.g, r.o, r.c_cum) for r in desc.collect())
    assert got[0] == ("x", 1, 5)


@pytest.mark.parametrize("k", [1, 3])
def test_top_k_per_group_exact(spark, k):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 500, p=[0.9, 0.1]), "v": rng.permutation(500)})
    df = spark.createDataFrame(pdf)
    out = top_k_per_group(df, ["g"], [F.col("v").desc()], k, salt_buckets=8)
    got = sorted((r.g, r.v, r["rank"]) for r in out.collect())
    want = []
    for key, part in pdf.groupby("g"):
        top = sorted(part.v, reverse=True)[:k]
        want += [(key, v, i + 1) for i, v in enumerate(top)]
    assert got == sorted(want)


def test_operator_paths_agree(spark):
    """The default method and the plain aggregate give the same profile
    through a real operator."""
    from vireo.operators.profile import numeric_profile
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice"]
    default = sorted(tuple(r) for r in numeric_profile(df, cols).collect())
    assert default == sorted(tuple(r) for r in numeric_profile(df, cols, method="aggregate").collect())


def test_bracketed_quantiles_count_outside_values_only(spark):
    """A large group: few of its values are shuffled one by one; null groups and groups without values have a row."""
    df = spark.range(200_000).select(F.when(F.col("id") % 50 > 0, F.lit("g")).alias("g"), ((F.col("id") * 7919) % 200_003).cast("double").alias("v"))
    df = df.unionByName(spark.createDataFrame([("empty", None), ("empty", float("nan"))], "g string, v double"))
    out = quantiles(df, "v", [0.05, 0.5, 0.95], ["g"], also=[F.count(F.lit(1)).alias("rows")])
    got = {r.g: tuple(r)[1:] for r in out.collect()}
    pdf = df.toPandas()
    assert got["empty"] == (2, None, None, None)
    for key, part in (("g", pdf[pdf.g == "g"]), (None, pdf[pdf.g.isna()])):
        assert got[key][0] == len(part) and np.allclose(got[key][1:], np.quantile(part.v, [0.05, 0.5, 0.95]))
    assert list(quantiles(df, "v", [0.5]).first()) == [np.quantile(pdf.v.dropna(), 0.5)]
    assert quantiles(df.where("g = 'empty'"), "v", [0.5]).first()[0] is None
