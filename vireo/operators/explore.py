"""Exploration operators (X1-X13): describe, histograms, box statistics,
value counts, group rates, correlations, pivots.

Wide statistics are computed with one ``unpivot`` + ``groupBy(column)`` so the
plan does not grow with the number of columns; quantiles use the distributed
exact method from ``vireo.functions.stats`` unless told otherwise.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vireo.functions.stats import join_groups, quantiles


def _q(n: str) -> str:
    return "`" + n.replace("`", "``") + "`"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def long_values(df: DataFrame, cols: list[str], name: str = "column", value: str = "value",
                ids: list[str] | None = None) -> DataFrame:
    """(ids..., column, value) with values cast to double."""
    sel = df.select(*(ids or []), *[F.col(_q(c)).cast("double").alias(c) for c in cols])
    return sel.unpivot(ids or [], cols, name, value)


# X1 ------------------------------------------------------------------------
def describe(df: DataFrame, cols: list[str] | None = None, method: str = "bracket",
             digits: int = 6) -> DataFrame:
    cols = cols or numeric_columns(df)
    lv = long_values(df, cols).where(F.col("value").isNotNull())
    j = quantiles(lv, "value", [0.25, 0.5, 0.75], ["column"], method=method, names=["p25", "p50", "p75"], few_groups=True, also=[
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max")])
    return j.select("column", "count", *[F.round(c, digits).alias(c)
                                          for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])


# X2 ------------------------------------------------------------------------
def missing_table(df: DataFrame, cols: list[str] | None = None, only_missing: bool = True) -> DataFrame:
    from vireo.functions.stats import null_counts
    cols = cols or df.columns
    out = null_counts(df, cols).select(
        "column", "n_missing", F.round(F.try_divide(F.col("n_missing") * 100.0, F.col("n_rows")), 4).alias("pct_missing"))
    return out.where(F.col("n_missing") > 0) if only_missing else out


# X3 ------------------------------------------------------------------------
def dtype_counts(df: DataFrame) -> DataFrame:
    counts: dict[str, int] = {}
    for f in df.schema.fields:
        counts[f.dataType.simpleString()] = counts.get(f.dataType.simpleString(), 0) + 1
    return df.sparkSession.createDataFrame(sorted(counts.items()), "dtype string, n_columns bigint")


def _scalar_row(df: DataFrame):
    """A one-row aggregate fetched to the driver (bounded: a few numbers)."""
    return df.first()


# X4 ------------------------------------------------------------------------
def histogram(df: DataFrame, col: str, bins: int = 10, by: list[str] | None = None) -> DataFrame:
    """Equal-width bins between the global min and max; the last bin is closed."""
    r = _scalar_row(df.agg(F.min(col).alias("mn"), F.max(col).alias("mx")))
    mn, mx = r["mn"], r["mx"]
    if mn is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    width = (mx - mn) if mx != mn else 1.0
    v = F.col(_q(col)).cast("double")
    b = F.least(F.floor((v - F.lit(float(mn))) / F.lit(float(width)) * F.lit(bins)), F.lit(bins - 1)).cast("int")
    out = (df.where(v.isNotNull()).groupBy(*(by or []), b.alias("bin"))
             .agg(F.count(F.lit(1)).alias("n")))
    lo = F.lit(float(mn)) + F.col("bin") * F.lit(width / bins)
    return out.select(*(by or []), "bin", F.round(lo, 6).alias("lo"),
                      F.round(lo + F.lit(width / bins), 6).alias("hi"), "n")


# X5 ------------------------------------------------------------------------
def box_stats(df: DataFrame, col: str, by: list[str] | None = None, whisker: float = 1.5,
              method: str = "bracket") -> DataFrame:
    by = list(by or [])
    qs = quantiles(df, col, [0.25, 0.5, 0.75], by, method=method, names=["q1", "median", "q3"])
    qs = qs.withColumn("iqr", F.col("q3") - F.col("q1")) \
           .withColumn("fence_lo", F.col("q1") - whisker * F.col("iqr")) \
           .withColumn("fence_hi", F.col("q3") + whisker * F.col("iqr"))
    v = F.col(_q(col)).cast("double")
    base = df.select(*by, v.alias("__v")).where(F.col("__v").isNotNull())
    if by:
        # qs has one row per group; AQE broadcasts it when small.
        j = join_groups(base, qs, by)
        by_ = by
    else:
        # whole column: the five numbers are driver-side literals
        r = qs.first()
        j = base.select("__v", *[F.lit(r[c]).alias(c) for c in ["q1", "median", "q3", "iqr", "fence_lo", "fence_hi"]]) \
                .withColumn("__all", F.lit(0))
        by_ = ["__all"]
    inside = (F.col("__v") >= F.col("fence_lo")) & (F.col("__v") <= F.col("fence_hi"))
    agg = j.groupBy(*by_).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.first("iqr").alias("iqr"),
        F.min(F.when(inside, F.col("__v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("__v"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"), F.count(F.lit(1)).alias("n"))
    return agg.select(*by, *[F.round(c, 6).alias(c) for c in
                             ["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"]],
                      "n_outliers", "n")


# X6 ------------------------------------------------------------------------
def value_counts(df: DataFrame, col: str, digits: int = 4) -> DataFrame:
    total = _scalar_row(df.agg(F.count(F.lit(1)).alias("n")))["n"]
    out = df.groupBy(F.col(_q(col)).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("pct", F.round(F.col("n") * 100.0 / F.lit(max(total, 1)), digits))


# X7 ------------------------------------------------------------------------
def phase_sort_key(col: str, first: str = "ALFA") -> F.Column:
    """ALFA first, then by the digits in the value (e.g. F1 < F2 < F10)."""
    v = F.col(_q(col))
    digits = F.regexp_extract(v, r"(\d+)", 1)
    return F.when(F.upper(v) == first, F.lit(-1)).otherwise(
        F.coalesce(F.when(digits != "", digits.cast("bigint")), F.lit(99999)))


def natural_phase_order(df: DataFrame, col: str) -> DataFrame:
    out = df.groupBy(F.col(_q(col)).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("sort_key", phase_sort_key("value"))


# X8 / X9 -------------------------------------------------------------------
def rate_by_group(df: DataFrame, by: list[str], target: str, min_n: int | None = None,
                  extra: list | None = None, digits: int = 4) -> DataFrame:
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                              F.sum(F.col(target)).cast("bigint").alias("n_risk"),
                              F.round(F.avg(F.col(target)) * 100, digits).alias("rate_pct"),
                              *(extra or []))
    return out.where(F.col("n") >= min_n) if min_n else out


# X10 -----------------------------------------------------------------------
def correlation_matrix(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Pairwise-complete Pearson for every unordered pair, one aggregation."""
    pairs = list(combinations(cols, 2))
    agg = df.agg(*[F.corr(F.col(_q(a)).cast("double"), F.col(_q(b)).cast("double")).alias(f"__{i}")
                   for i, (a, b) in enumerate(pairs)])
    stacked = F.inline(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                          F.col(f"__{i}").alias("corr"))
                                 for i, (a, b) in enumerate(pairs)]))
    return agg.select(stacked).select("col_a", "col_b", F.round("corr", digits).alias("corr"))


def top_correlated(df: DataFrame, target: str, cols: list[str], k: int = 5, digits: int = 6) -> DataFrame:
    agg = df.agg(*[F.corr(F.col(_q(c)).cast("double"), F.col(_q(target)).cast("double")).alias(c)
                   for c in cols])
    long = agg.unpivot([], cols, "feature", "corr").where(F.col("corr").isNotNull())
    # At most len(cols) rows: a global order is cheap here.
    return long.orderBy(F.abs("corr").desc(), "feature").limit(k) \
               .select("feature", F.round("corr", digits).alias("corr"))


# X11 -----------------------------------------------------------------------
def confusion_percentages(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    by = list(by or [])
    g = df.groupBy(*by).agg(
        F.count_if((F.col(y) == 0) & (F.col(yhat) == 0)).alias("tn"),
        F.count_if((F.col(y) == 0) & (F.col(yhat) == 1)).alias("fp"),
        F.count_if((F.col(y) == 1) & (F.col(yhat) == 0)).alias("fn"),
        F.count_if((F.col(y) == 1) & (F.col(yhat) == 1)).alias("tp"),
        F.count(F.lit(1)).alias("n"))
    return g.select(*by, "tn", "fp", "fn", "tp", "n",
                    *[F.round(F.col(c) * 100.0 / F.col("n"), 4).alias(f"pct_{c}") for c in ["tn", "fp", "fn", "tp"]])


# X12 -----------------------------------------------------------------------
def pivot_metrics(long: DataFrame, index: str = "model", metric: str = "metric", value: str = "value",
                  metrics: list[str] | None = None) -> DataFrame:
    g = long.groupBy(index)
    g = g.pivot(metric, metrics) if metrics else g.pivot(metric)
    return g.agg(F.first(value))


# X13 -----------------------------------------------------------------------
def summary_stats(df: DataFrame, col: str, by: list[str] | None = None, method: str = "bracket",
                  digits: int = 4) -> DataFrame:
    by = list(by or [])
    v = F.col(_q(col)).cast("double")
    j = quantiles(df, col, [0.5], by, method=method, names=["median"], also=[
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max")]).where("n > 0")
    return j.select(*by, "n", *[F.round(c, digits).alias(c) for c in ["mean", "median", "min", "max"]])
