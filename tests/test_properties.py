"""Property-based checks (hypothesis) of the distributed building blocks."""

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from vireo.functions.stats import quantiles
from vireo.operators import drift as D
from vireo.operators import evaluate as E

values = st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False).map(
    lambda x: round(x, 2)), min_size=1, max_size=60)


@settings(max_examples=8, deadline=None)
@given(values, st.sampled_from([1, 3, 40]))
def test_bracketed_quantiles_property(spark, vals, times):
    vals = vals * times
    df = spark.createDataFrame(pd.DataFrame({"g": ["a"] * len(vals), "v": vals}))
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    r = quantiles(df, "v", probs, ["g"], method="bracket").first()
    want = np.quantile(np.array(vals), probs)
    got = [r[f"q{int(round(p * 100)):02d}"] for p in probs]
    assert np.allclose(got, want, rtol=1e-12, atol=1e-9)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=50), min_size=5, max_size=80))
def test_psi_identical_is_zero(spark, vals):
    df = spark.createDataFrame([("f", float(v)) for v in vals], "feature string, value double")
    assert abs(D.numeric_psi(df, df).first().psi) < 1e-12


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20)), min_size=4, max_size=60))
def test_auc_symmetry(spark, pairs):
    ys = [y for y, _ in pairs]
    if len(set(ys)) < 2:
        return
    df = spark.createDataFrame([("m", y, p / 20.0) for y, p in pairs], "m string, y int, p double")
    a = E.ranking_metrics(df, ["m"], "y", "p").first().roc_auc
    b = E.ranking_metrics(df.selectExpr("m", "y", "1 - p AS p"), ["m"], "y", "p").first().roc_auc
    assert abs(a + b - 1) < 1e-12
