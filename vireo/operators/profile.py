"""Profiles and summaries.

Profiles are long tables keyed by feature: one ``unpivot`` then one
``groupBy(feature)`` (partial aggregation, so a feature with billions of rows
is combined map-side); quantiles come from the distributed exact method;
top-k categories are ranked after aggregation with a two-stage bucketed
top-k.  Baselines are stored as versioned tables, not nested documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vireo import config as C
from vireo.functions.expr import risk_band
from vireo.functions.stats import quantiles, top_k_per_group


def _q(n: str) -> str:
    return "`" + n.replace("`", "``") + "`"


QNAMES = ["p05", "p25", "p50", "p75", "p95"]


def _long(df: DataFrame, cols: list[str], cast: str, ids: list[str] | None = None) -> DataFrame:
    sel = df.select(*(ids or []), *[F.col(_q(c)).cast(cast).alias(c) for c in cols])
    out = sel.unpivot(ids or [], cols, "feature", "value")
    if cast == "double":
        out = out.withColumn("value", F.nanvl("value", F.lit(None).cast("double")))
    return out


# A1 ------------------------------------------------------------------------
def numeric_profile(df: DataFrame, cols: list[str], method: str = "bracket", digits: int = 4) -> DataFrame:
    """count (rows; 0 if all null), missing_rate, p05..p95, mean, std, min, max."""
    lv = _long(df, cols, "double")
    j = quantiles(lv, "value", C.PROFILE_QUANTILES, ["feature"], method=method, names=QNAMES, few_groups=True, also=[
        F.count(F.lit(1)).alias("__rows"), F.count("value").alias("__nn"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")])
    r = lambda c: F.round(c, digits)
    return j.select(
        "feature", F.lit("numeric").alias("type"),
        F.when(F.col("__nn") == 0, F.lit(0)).otherwise(F.col("__rows")).cast("bigint").alias("count"),
        F.when(F.col("__nn") == 0, F.lit(1.0)).otherwise(r(1 - F.col("__nn") / F.col("__rows"))).alias("missing_rate"),
        *[r(F.col(q)).alias(q) for q in QNAMES],
        r(F.col("mean")).alias("mean"),
        F.when(F.col("__nn") > 1, r(F.col("std"))).when(F.col("__nn") == 1, F.lit(0.0)).alias("std"),
        r(F.col("min")).alias("min"), r(F.col("max")).alias("max"))


# A2 ------------------------------------------------------------------------
def categorical_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, cnt) for non-null values; map-side combined."""
    lv = _long(df, cols, "string").where(F.col("value").isNotNull())
    return lv.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt"))


def categorical_profile(df: DataFrame, cols: list[str], top_k: int = 10, digits: int = 4) -> DataFrame:
    """Top-k values per feature (count desc, value asc) plus ``__other__``."""
    vc = categorical_counts(df, cols)
    tot = vc.groupBy("feature").agg(F.sum("cnt").alias("__tot"))
    top = top_k_per_group(vc, ["feature"], [F.col("cnt").desc(), F.col("value").asc()], top_k)
    top_sum = top.groupBy("feature").agg(F.sum("cnt").alias("__top"))
    other = tot.join(top_sum, "feature").where(F.col("__tot") > F.col("__top")).select(
        "feature", F.lit("__other__").alias("value"), (F.col("__tot") - F.col("__top")).alias("cnt"),
        F.lit(top_k + 1).alias("rank"))
    rows = top.select("feature", "value", "cnt", "rank").unionByName(other)
    return rows.join(tot, "feature").select(
        "feature", "value", F.col("cnt").cast("bigint").alias("cnt"),
        F.round(F.col("cnt") / F.col("__tot"), digits).alias("freq"), F.col("rank").cast("int").alias("rank"))


def categorical_summary(df: DataFrame, cols: list[str], digits: int = 4) -> DataFrame:
    lv = _long(df, cols, "string")
    per = lv.groupBy("feature").agg(F.count(F.lit(1)).alias("count"), F.count("value").alias("__nn"))
    nun = categorical_counts(df, cols).groupBy("feature").agg(F.count(F.lit(1)).alias("n_unique"))
    return per.join(nun, "feature", "left").select(
        "feature", F.lit("categorical").alias("type"), F.col("count").cast("bigint").alias("count"),
        F.round(F.when(F.col("count") > 0, 1 - F.col("__nn") / F.col("count")).otherwise(0.0), digits)
        .alias("missing_rate"),
        F.coalesce(F.col("n_unique"), F.lit(0)).cast("bigint").alias("n_unique"))


# A3 ------------------------------------------------------------------------
def unit_edges(bins: int = C.SCORE_BINS) -> list[float]:
    """Histogram edges on [0, 1], rounded to 4 places - one array for every side."""
    return [round(i / bins, 4) for i in range(bins + 1)]


def edge_bin(col, edges: list[float]):
    """Index of the half-open bin holding ``col``; the last bin is closed;
    values outside [edges[0], edges[-1]] give null."""
    v = F.col(col) if isinstance(col, str) else col
    arr = F.array(*[F.lit(float(e)) for e in edges])
    idx = F.size(F.filter(arr, lambda e: v >= e)) - 1
    n = len(edges) - 1
    return F.when((v >= edges[0]) & (v <= edges[-1]), F.least(idx, F.lit(n - 1)))


def score_summary(df: DataFrame, score: str, by: list[str] | None = None, method: str = "bracket",
                  digits: int = 4) -> DataFrame:
    """count, mean, population std, min, max, 7 quantiles, positive rate."""
    by = list(by or [])
    s = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    base = df.select(*by, s.alias("__s")).where(F.col("__s").isNotNull())
    names = [f"p{int(round(q * 100)):02d}" for q in C.SCORE_QUANTILES]
    j = quantiles(base, "__s", C.SCORE_QUANTILES, by, method=method, names=names, also=[
        F.count(F.lit(1)).alias("count"), F.avg("__s").alias("mean"), F.stddev_pop("__s").alias("std"), F.min("__s").alias("min"),
        F.max("__s").alias("max"), F.avg((F.col("__s") >= 0.5).cast("double")).alias("positive_rate")])
    return j.select(*by, "count", *[F.round(c, digits).alias(c) for c in
                                    ["mean", "std", "min", "max", *names, "positive_rate"]])


def score_histogram(df: DataFrame, score: str, bins: int = C.SCORE_BINS, by: list[str] | None = None,
                    digits: int = 4) -> DataFrame:
    """Counts per bin on the fixed edges; out-of-range values count in the
    denominator only.  Empty bins are kept (a bounded bin list joined in)."""
    by = list(by or [])
    edges = unit_edges(bins)
    s = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    base = df.select(*by, s.alias("__s")).where(F.col("__s").isNotNull())
    tot = base.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    cnt = base.withColumn("bin", edge_bin("__s", edges)).where(F.col("bin").isNotNull()) \
              .groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("cnt"))
    spark = df.sparkSession
    binlist = spark.createDataFrame([(i, edges[i], edges[i + 1]) for i in range(bins)],
                                    "bin int, lo double, hi double")
    # every (group, bin): the bin list is a fixed small table
    grid = tot.withColumn("__bins", F.array(*[F.lit(i) for i in range(bins)])) \
              .select(*by, "__n", F.explode("__bins").alias("bin"))
    out = grid.join(cnt, [*by, "bin"], "left").join(F.broadcast(binlist), "bin")
    return out.select(*by, "bin", "lo", "hi", F.coalesce("cnt", F.lit(0)).cast("bigint").alias("cnt"),
                      F.round(F.coalesce("cnt", F.lit(0)) / F.col("__n"), digits).alias("freq"))


# A4 / A5 -------------------------------------------------------------------
def feature_profiles(df: DataFrame, signature: dict[str, str], method: str = "bracket") -> DataFrame:
    """Summary row per signature feature: numeric / categorical / unknown."""
    spark = df.sparkSession
    text_types = {"string", "object", "category"}
    present = [f for f in signature if f in df.columns]
    num = [f for f in present if signature[f] not in text_types]
    cat = [f for f in present if signature[f] in text_types]
    schema = "feature string, type string, count bigint, missing_rate double"
    parts = []
    if num:
        parts.append(numeric_profile(df, num, method).select("feature", "type", "count", "missing_rate"))
    if cat:
        parts.append(categorical_summary(df, cat).select("feature", "type", "count", "missing_rate"))
    unknown = [(f, "unknown", 0, 1.0) for f in signature if f not in df.columns]
    parts.append(spark.createDataFrame(unknown, schema))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_baseline(df: DataFrame, signature: dict[str, str], score: str, model_version: str,
                   method: str = "bracket") -> dict[str, DataFrame]:
    """Versioned baseline tables: numeric, categorical, score summary, score histogram.

    Real scores only: a missing score column is an error (no synthetic profile).
    """
    if score not in df.columns:
        raise ValueError(f"score column {score} not found")
    text_types = {"string", "object", "category"}
    num = [f for f in signature if f in df.columns and signature[f] not in text_types]
    cat = [f for f in signature if f in df.columns and signature[f] in text_types]
    v = F.lit(model_version).alias("model_version")
    out = {"score_summary": score_summary(df, score, method=method).select(v, "*"),
           "score_histogram": score_histogram(df, score).select(v, "*")}
    if num:
        out["numeric"] = numeric_profile(df, num, method).select(v, "*")
    if cat:
        out["categorical"] = categorical_profile(df, cat).select(v, "*")
    return out


# A14 -----------------------------------------------------------------------
def request_feature_stats(df: DataFrame, request: str, features: list[str], digits: int = 4) -> DataFrame:
    """Per (request, feature): mean / min / max of numeric inputs."""
    lv = _long(df, features, "double", ids=[request])
    return lv.groupBy(request, "feature").agg(
        F.round(F.avg("value"), digits).alias("mean"), F.round(F.min("value"), digits).alias("min"),
        F.round(F.max("value"), digits).alias("max"))


def request_aggregate(df: DataFrame, request: str, features: list[str], score: str,
                      threshold: float = 0.5, latency: str | None = None, digits: int = 4,
                      with_json: bool = False) -> DataFrame:
    """One privacy-safe event per request: counts, missing rate, score stats."""
    nfeat = len(features)
    nulls = sum((F.col(_q(c)).isNull().cast("int") for c in features), F.lit(0))
    s = F.col(score).cast("double")
    aggs = [F.count(F.lit(1)).alias("n_instances"),
            F.round(F.sum(nulls) / (F.count(F.lit(1)) * F.lit(nfeat)), digits).alias("missing_rate"),
            F.round(F.avg(s), digits).alias("risk_score_mean"), F.round(F.min(s), digits).alias("risk_score_min"),
            F.round(F.max(s), digits).alias("risk_score_max"), F.round(F.stddev_pop(s), digits).alias("risk_score_std"),
            F.round(F.avg((s >= threshold).cast("double")), digits).alias("positive_rate")]
    if latency:
        aggs.append(F.round(F.max(latency), digits).alias("latency_ms"))
    out = df.groupBy(request).agg(*aggs)
    if with_json:
        st = request_feature_stats(df, request, features, digits)
        js = st.groupBy(request).agg(
            F.to_json(F.map_from_entries(F.collect_list(F.struct("feature", "mean")))).alias("numeric_means"))
        out = out.join(js, request, "left")
    return out


# A15 -----------------------------------------------------------------------
def row_events(df: DataFrame, request: str, index_col: str, allowed: list[str], score: str | None = None,
               pii: list[str] = C.PII_FIELDS) -> DataFrame:
    """One event per instance with sanitized JSON of the allowed, non-PII fields.

    The instance index is an input column (no per-request window, so a huge
    request is not funnelled into one task).
    """
    keep = [c for c in allowed if c in df.columns and c.lower() not in {p.lower() for p in pii}]
    cols = [F.col(request).alias("request_id"), F.col(index_col).alias("instance_index"),
            F.to_json(F.struct(*[F.col(_q(c)) for c in keep])).alias("features_sanitized")]
    if score:
        cols.append(F.col(score).alias("risk_score"))
    return df.select(*cols)


# A16 -----------------------------------------------------------------------
def batch_bins(df: DataFrame, features: list[str], low: float = C.VALUE_BIN_LOW,
               high: float = C.VALUE_BIN_HIGH) -> DataFrame:
    lv = _long(df, features, "double")
    b = (F.when(F.col("value").isNull(), F.lit("missing")).when(F.col("value") < low, F.lit("low"))
          .when(F.col("value") < high, F.lit("medium")).otherwise(F.lit("high")))
    return lv.withColumn("bin", b).groupBy("feature").pivot("bin", ["low", "medium", "high", "missing"]) \
             .agg(F.count(F.lit(1))).na.fill(0, ["low", "medium", "high", "missing"])


def top_missing(bins: DataFrame, k: int = 5) -> DataFrame:
    """Top features by missing count (count desc, name asc); bounded by #features."""
    return bins.where(F.col("missing") > 0).orderBy(F.col("missing").desc(), "feature").limit(k) \
               .select("feature", "missing")


# A17 -----------------------------------------------------------------------
def prediction_summary(df: DataFrame, request: str, score: str, threshold: float = 0.5,
                       digits: int = 4) -> DataFrame:
    s = F.col(score)
    band = risk_band(score)
    return df.groupBy(request).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(s >= threshold).alias("n_high_risk"),
        F.round(F.avg(s), digits).alias("mean_score"),
        F.count_if(band == "low").alias("n_low"), F.count_if(band == "medium").alias("n_medium"),
        F.count_if(band == "high").alias("n_high"))


# A18 -----------------------------------------------------------------------
def input_summary(df: DataFrame, expected: list[str], top_n: int = 10, pii: list[str] = C.PII_FIELDS,
                  digits: int = 4) -> DataFrame:
    """Numeric stats for the ``top_n`` features by population variance."""
    low_pii = {p.lower() for p in pii}
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)
           and f.name.lower() not in low_pii]
    lv = _long(df, num, "double")
    st = lv.groupBy("feature").agg(F.var_pop("value").alias("var_pop"), F.avg("value").alias("mean"),
                                   F.min("value").alias("min"), F.max("value").alias("max"))
    top = st.where(F.col("var_pop").isNotNull()).orderBy(F.col("var_pop").desc(), "feature").limit(top_n)
    received = set(df.columns)
    return top.select("feature", *[F.round(c, digits).alias(c) for c in ["var_pop", "mean", "min", "max"]],
                      F.lit(len(received & set(expected))).alias("n_received"),
                      F.lit(len(set(expected) - received)).alias("n_missing"),
                      F.lit(len(received - set(expected) - low_pii)).alias("n_extra"))


# A19 -----------------------------------------------------------------------
def output_summary(df: DataFrame, score: str, label: str | None = None, by: list[str] | None = None,
                   threshold: float = 0.5, digits: int = 4) -> DataFrame:
    by = list(by or [])
    s = F.col(score)
    pos = F.col(label) == 1 if label else s >= threshold
    return df.groupBy(*by).agg(
        F.round(F.min(s), digits).alias("min"), F.round(F.avg(s), digits).alias("mean"),
        F.round(F.max(s), digits).alias("max"),
        F.round(F.coalesce(F.stddev_pop(s), F.lit(0.0)), digits).alias("std"),
        F.count_if(pos).alias("n_positive"), F.round(F.avg(pos.cast("double")), digits).alias("positive_rate"))


# A20 -----------------------------------------------------------------------
def data_card_missing(df: DataFrame, period: str, cols: list[str]) -> DataFrame:
    from vireo.functions.stats import null_counts
    return null_counts(df, cols, [period]).select(period, "column", "n_missing", "n_rows")


def data_card_target(df: DataFrame, period: str, target: str, digits: int = 4) -> DataFrame:
    t = F.col(target)
    return df.groupBy(period).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(t == 1).alias("n_pos"),
                                  F.count_if(t == 0).alias("n_neg"), F.round(F.avg(t), digits).alias("pos_ratio"))


# A22 -----------------------------------------------------------------------
def class_shares(df: DataFrame, target: str, digits: int = 4, warn_share: float = 0.1,
                 max_ratio: float = 3.0) -> DataFrame:
    """Per class: count and share; flags for a minority under ``warn_share``
    and a max/min ratio over ``max_ratio``.  The totals are three numbers
    taken from the (small) class table and applied as literals."""
    c = df.groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    t = c.agg(F.sum("n").alias("tot"), F.min("n").alias("mn"), F.max("n").alias("mx")).first()
    tot, mn, mx = (t["tot"] or 0), (t["mn"] or 0), (t["mx"] or 0)
    ratio = (mx / mn) if mn else None
    return c.select("class", "n", F.round(F.col("n") / F.lit(max(tot, 1)), digits).alias("share"),
                    F.round(F.lit(ratio).cast("double"), digits).alias("imbalance_ratio"),
                    F.lit(bool(tot) and mn / tot < warn_share).alias("minority_warning"),
                    F.lit(ratio is not None and ratio > max_ratio).alias("imbalanced"))
