"""Drift (A6-A13) and retrain triggers.

Inputs are long tables ``(feature, value)`` for a baseline window and a
current window.  Everything that is per-feature or per-bin is small (features
x bins) and is joined with ``broadcast`` - its size is bounded by the schema
width times the bin count, never by the number of rows.  The rows themselves
are only ever scanned, binned and counted (map-side combined).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo import config as C
from vireo.functions.stats import combine_one_row
from vireo.operators.profile import edge_bin, unit_edges
from vireo.sources.tables import parse_json_map


# A6 ------------------------------------------------------------------------
def psi(bins: DataFrame, group_cols: list[str], b_col: str = "b_freq", c_col: str = "c_freq",
        eps: float = C.PSI_EPS) -> DataFrame:
    """PSI per group from per-bin frequencies: +eps, renormalise, sum (c-b) ln(c/b).

    ``bins`` has one row per (group, bin) - a small table - so the
    renormalising totals are window sums over it.  With no groups the two
    totals are scalars taken from the bin table.
    """
    b = F.col(b_col) + eps
    c = F.col(c_col) + eps
    if group_cols:
        w = Window.partitionBy(*group_cols)
        nb, nc = b / F.sum(b).over(w), c / F.sum(c).over(w)
    else:
        t = bins.agg(F.sum(b).alias("b"), F.sum(c).alias("c")).first()
        nb, nc = b / F.lit(t["b"]), c / F.lit(t["c"])
    t2 = bins.select(*group_cols, nb.alias("__b"), nc.alias("__c"))
    term = F.sum((F.col("__c") - F.col("__b")) * F.log(F.col("__c") / F.col("__b"))).alias("psi")
    return t2.groupBy(*group_cols).agg(term) if group_cols else t2.agg(term)


# A7 ------------------------------------------------------------------------
def numeric_edges(profile: DataFrame) -> DataFrame:
    """Distinct sorted baseline quantiles (p05..p95); fewer than two -> [min, max]."""
    qs = F.array_sort(F.array_distinct(F.filter(F.array(*[F.col(q) for q in ["p05", "p25", "p50", "p75", "p95"]]),
                                                lambda x: x.isNotNull())))
    return profile.select("feature", F.when(F.size(qs) >= 2, qs).otherwise(F.array("min", "max")).alias("edges"))


def _bin_counts(values: DataFrame, edges: DataFrame) -> DataFrame:
    """Counts per (feature, bin); bin = number of finite edges <= value
    (the outer edges are -inf / +inf).  ``edges`` has one row per feature."""
    v = values.where(F.col("value").isNotNull()).join(F.broadcast(edges), "feature")
    b = F.size(F.filter("edges", lambda e: F.col("value") >= e))
    return v.groupBy("feature", b.alias("bin")).agg(F.count(F.lit(1)).alias("cnt"))


def numeric_psi(baseline_values: DataFrame, current_values: DataFrame, profile: DataFrame | None = None,
                baseline: str = "quantile") -> DataFrame:
    """PSI per numeric feature on bins cut at the baseline quantiles.

    ``baseline='quantile'`` (default) counts the baseline in the same bins;
    ``'equal'`` assumes an equal share per bin (the original rule, which
    scores identical data above zero).  A feature with no current values
    scores 0.
    """
    if profile is None:
        profile = numeric_profile_long(baseline_values)
    edges = numeric_edges(profile)
    grid = edges.select("feature", F.explode(F.sequence(F.lit(0), F.size("edges"))).alias("bin"),
                        (F.size("edges") + 1).alias("__nbins"))
    cur = _bin_counts(current_values, edges)
    ctot = cur.groupBy("feature").agg(F.sum("cnt").alias("__ct"))
    g = grid.join(cur, ["feature", "bin"], "left").join(ctot, "feature")
    if baseline == "equal":
        g = g.withColumn("b_freq", 1.0 / F.col("__nbins"))
    else:
        base = _bin_counts(baseline_values, edges)
        btot = base.groupBy("feature").agg(F.sum("cnt").alias("__bt"))
        g = g.join(base.withColumnRenamed("cnt", "__bc"), ["feature", "bin"], "left").join(btot, "feature", "left") \
             .withColumn("b_freq", F.coalesce(F.col("__bc"), F.lit(0)) / F.col("__bt"))
    g = g.withColumn("c_freq", F.coalesce(F.col("cnt"), F.lit(0)) / F.col("__ct"))
    out = psi(g, ["feature"])
    # features without current values: PSI 0
    return edges.select("feature").join(out, "feature", "left") \
                .select("feature", F.coalesce(F.col("psi"), F.lit(0.0)).alias("psi"))


# A8 ------------------------------------------------------------------------
def categorical_psi(current_values: DataFrame, top: DataFrame) -> DataFrame:
    """PSI per categorical feature over the baseline categories.

    ``top`` is the baseline categorical profile ``(feature, value, freq)``.
    Current values outside the categories go to ``__other__`` only when the
    baseline has that bucket; otherwise they are dropped (but still counted
    in the denominator).
    """
    cats = top.select("feature", "value", F.col("freq").alias("b_freq"))
    has_other = cats.where(F.col("value") == "__other__").select("feature").withColumn("__ho", F.lit(True))
    cv = current_values.where(F.col("value").isNotNull()).select("feature", F.col("value").cast("string"))
    tot = cv.groupBy("feature").agg(F.count(F.lit(1)).alias("__ct"))
    counts = cv.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt"))
    known = F.broadcast(cats.select("feature", "value").withColumn("__known", F.lit(True)))
    m = counts.join(known, ["feature", "value"], "left").join(F.broadcast(has_other), "feature", "left")
    m = m.withColumn("value", F.when(F.col("__known").isNotNull(), F.col("value"))
                     .when(F.col("__ho").isNotNull(), F.lit("__other__")))
    m = m.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.sum("cnt").alias("cnt"))
    g = cats.join(m, ["feature", "value"], "left").join(tot, "feature", "left") \
            .withColumn("c_freq", F.coalesce(F.try_divide(F.col("cnt"), F.col("__ct")), F.lit(0.0)))
    out = psi(g, ["feature"])
    present = tot.select("feature")
    return cats.select("feature").distinct().join(out.join(present, "feature"), "feature", "left") \
               .select("feature", F.coalesce(F.col("psi"), F.lit(0.0)).alias("psi"))


# A9 ------------------------------------------------------------------------
def status(value, warn: float, alert: float):
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v >= alert, F.lit("red")).when(v >= warn, F.lit("yellow")).otherwise(F.lit("green"))


def with_missing_override(st, delta, warn: float = C.MISSING_DELTA_WARN, alert: float = C.MISSING_DELTA_ALERT):
    d = F.abs(F.col(delta) if isinstance(delta, str) else delta)
    return F.when(d >= alert, F.lit("red")).when((d >= warn) & (st == "green"), F.lit("yellow")).otherwise(st)


# A11 / A12 ----------------------------------------------------------------
def extract_feature_values(events: DataFrame, request: str = "request_id",
                           json_cols=("numeric_means", "features_sanitized")) -> DataFrame:
    """JSON feature maps -> long ``(request, feature, value)``; bad JSON = {}."""
    out = None
    for c in json_cols:
        if c not in events.columns:
            continue
        part = events.select(request, F.explode(parse_json_map(F.col(c), "string")).alias("feature", "value"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no JSON feature column")
    return out


def extract_scores(events: DataFrame) -> DataFrame:
    cols = [c for c in ("risk_score_mean", "risk_score") if c in events.columns]
    return events.select(F.coalesce(*[F.col(c).cast("double") for c in cols]).alias("score")) \
                 .where(F.col("score").isNotNull())


# A13 -----------------------------------------------------------------------
def score_bins(scores: DataFrame, score: str = "score", bins: int = C.SCORE_BINS,
               by: list[str] | None = None) -> DataFrame:
    """(by..., bin, freq) on one shared edge array; the denominator counts
    out-of-range scores too."""
    by = list(by or [])
    edges = unit_edges(bins)
    s = scores.select(*by, F.col(score).cast("double").alias("__s")).where(F.col("__s").isNotNull())
    tot = s.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    cnt = s.withColumn("bin", edge_bin("__s", edges)).where(F.col("bin").isNotNull()) \
           .groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("cnt"))
    grid = tot.select(*by, "__n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    g = grid.join(cnt, [*by, "bin"], "left")
    return g.select(*by, "bin", (F.coalesce(F.col("cnt"), F.lit(0)) / F.col("__n")).alias("freq"))


def score_drift(baseline_scores: DataFrame, current_scores: DataFrame, score: str = "score",
                warn: float = C.PSI_WARN, alert: float = C.PSI_ALERT, digits: int = 4) -> DataFrame:
    """Score PSI on the fixed 20 bins plus the mean shift; one row."""
    b = score_bins(baseline_scores, score).withColumnRenamed("freq", "b_freq")
    c = score_bins(current_scores, score).withColumnRenamed("freq", "c_freq")
    g = b.join(c, "bin", "left").fillna(0.0, ["c_freq"])
    p = psi(g, []).select("psi")
    bm = baseline_scores.agg(F.avg(score).alias("baseline_mean"))
    cm = current_scores.agg(F.avg(score).alias("current_mean"), F.count(F.lit(1)).alias("__nc"))
    j = combine_one_row(p, bm, cm)
    st = F.when(F.col("__nc") == 0, F.lit("no_data")).otherwise(status("psi", warn, alert))
    return j.select(F.round(F.when(F.col("__nc") > 0, F.col("psi")).otherwise(0.0), digits).alias("psi"),
                    F.round("baseline_mean", digits).alias("baseline_mean"),
                    F.round(F.coalesce("current_mean", F.lit(0.0)), digits).alias("current_mean"),
                    F.round(F.coalesce(F.col("current_mean") - F.col("baseline_mean"), F.lit(0.0)), digits)
                    .alias("delta_mean"), st.alias("status"))


# A10 -----------------------------------------------------------------------
def feature_drift(base_num: DataFrame, cur_num: DataFrame, base_cat: DataFrame, cur_cat: DataFrame,
                  n_cur_events: int, numeric_features: list[str],
                  categorical_features: list[str], top_k: int = 10, baseline: str = "quantile",
                  method: str = "bracket", digits: int = 4) -> DataFrame:
    """Per-feature drift rows: psi, missing rates and delta, status.

    ``base_*`` / ``cur_*`` are long ``(feature, value)`` tables where a
    missing value is a null value; ``n_cur_events`` is the number of current
    events (the missing-rate basis, one scalar).
    """
    from vireo.session import cut_lineage
    parts = []
    if numeric_features:
        # the baseline profiles are small (one row per feature / category) and
        # are used twice below: store them once, as a baseline table would be
        nprof = cut_lineage(numeric_profile_long(base_num, method))
        p = numeric_psi(base_num, cur_num, nprof, baseline)
        parts.append((nprof.select("feature", "missing_rate"), p, cur_num, "numeric"))
    if categorical_features:
        cprof = cut_lineage(categorical_profile_long(base_cat, top_k))
        p = categorical_psi(cur_cat, cprof)
        bmiss = base_cat.groupBy("feature").agg((1 - F.count("value") / F.count(F.lit(1))).alias("missing_rate"))
        parts.append((bmiss, p, cur_cat, "categorical"))
    out = None
    for bmiss, p, cur, kind in parts:
        cnt = cur.where(F.col("value").isNotNull()).groupBy("feature").agg(F.count(F.lit(1)).alias("__nv"))
        j = p.join(bmiss, "feature", "left").join(cnt, "feature", "left")
        ne = F.lit(int(n_cur_events))
        cur_miss = F.when(ne > 0, 1 - F.coalesce(F.col("__nv"), F.lit(0)) / ne).otherwise(0.0)
        j = j.select("feature", F.lit(kind).alias("type"), F.col("psi"),
                     F.coalesce(F.col("missing_rate"), F.lit(0.0)).alias("baseline_missing_rate"),
                     cur_miss.alias("current_missing_rate"))
        out = j if out is None else out.unionByName(j)
    delta = F.col("current_missing_rate") - F.col("baseline_missing_rate")
    st = with_missing_override(status("psi", C.PSI_WARN, C.PSI_ALERT), delta)
    return out.select("feature", "type", F.round("psi", digits).alias("psi"),
                      F.round("baseline_missing_rate", digits).alias("baseline_missing_rate"),
                      F.round("current_missing_rate", digits).alias("current_missing_rate"),
                      F.round(delta, digits).alias("missing_delta"), st.alias("status"))


def numeric_profile_long(values: DataFrame, method: str = "bracket") -> DataFrame:
    """numeric_profile for a long (feature, value) table."""
    from vireo.functions.stats import quantiles
    v = values.withColumn("value", F.col("value").cast("double"))
    j = quantiles(v, "value", C.PROFILE_QUANTILES, ["feature"], method=method, names=["p05", "p25", "p50", "p75", "p95"], few_groups=True, also=[
        F.count(F.lit(1)).alias("__rows"), F.count("value").alias("__nn"), F.min("value").alias("min"), F.max("value").alias("max")])
    return j.select("feature", *[F.round(c, 4).alias(c) for c in ["p05", "p25", "p50", "p75", "p95", "min", "max"]],
                    F.when(F.col("__nn") == 0, F.lit(1.0)).otherwise(1 - F.col("__nn") / F.col("__rows"))
                    .alias("missing_rate"))


def categorical_profile_long(values: DataFrame, top_k: int = 10) -> DataFrame:
    """categorical_profile for a long (feature, value) table."""
    from vireo.functions.stats import top_k_per_group
    vc = values.where(F.col("value").isNotNull()).groupBy("feature", F.col("value").cast("string").alias("value")) \
               .agg(F.count(F.lit(1)).alias("cnt"))
    tot = vc.groupBy("feature").agg(F.sum("cnt").alias("__tot"))
    top = top_k_per_group(vc, ["feature"], [F.col("cnt").desc(), F.col("value").asc()], top_k)
    ts = top.groupBy("feature").agg(F.sum("cnt").alias("__top"))
    other = tot.join(ts, "feature").where(F.col("__tot") > F.col("__top")) \
               .select("feature", F.lit("__other__").alias("value"), (F.col("__tot") - F.col("__top")).alias("cnt"))
    rows = top.select("feature", "value", "cnt").unionByName(other)
    return rows.join(tot, "feature").select("feature", "value", "cnt",
                                            F.round(F.col("cnt") / F.col("__tot"), 4).alias("freq"))


def global_status(drift: DataFrame, score: DataFrame, n_cur_events: int,
                  yellow_share: float = C.YELLOW_SHARE_ALERT) -> DataFrame:
    """One row: red if any red (or score red); yellow if the yellow share is
    above the limit or the score is yellow; no_data without current events."""
    agg = drift.agg(F.count(F.lit(1)).alias("n_features"), F.count_if(F.col("status") == "red").alias("n_red"),
                    F.count_if(F.col("status") == "yellow").alias("n_yellow"))
    code = {"green": 0, "yellow": 1, "red": 2, "no_data": 3}
    sc = score.select(F.coalesce(*[F.when(F.col("status") == k, F.lit(v)) for k, v in code.items()]).alias("__sc"))
    j = combine_one_row(agg, sc)
    for c in ("n_features", "n_red", "n_yellow"):
        j = j.withColumn(c, F.col(c).cast("bigint"))
    back = F.coalesce(*[F.when(F.col("__sc") == v, F.lit(k)) for k, v in code.items()])
    j = j.withColumn("score_status", back).withColumn("n_requests", F.lit(int(n_cur_events)).cast("bigint"))
    g = (F.when(F.col("n_requests") == 0, F.lit("no_data"))
          .when((F.col("n_red") > 0) | (F.col("score_status") == "red"), F.lit("red"))
          .when((F.col("n_features") > 0) & (F.col("n_yellow") / F.col("n_features") > yellow_share), F.lit("yellow"))
          .when(F.col("score_status") == "yellow", F.lit("yellow")).otherwise(F.lit("green")))
    return j.select(g.alias("global_status"), "n_features", "n_red", "n_yellow",
                    (F.col("n_features") - F.col("n_red") - F.col("n_yellow")).alias("n_green"),
                    "score_status", "n_requests")


# W7 batch twin / D13 --------------------------------------------------------
def daily_score_psi(baseline_scores: DataFrame, current: DataFrame, ts: str = "ts", score: str = "score",
                    digits: int = 4) -> DataFrame:
    """PSI of each day's scores against one fixed baseline histogram."""
    b = score_bins(baseline_scores, score).withColumnRenamed("freq", "b_freq")
    cur = current.withColumn("day", F.to_date(F.col(ts)))
    c = score_bins(cur, score, by=["day"]).withColumnRenamed("freq", "c_freq")
    g = c.join(F.broadcast(b), "bin")  # b: 20 rows
    p = psi(g, ["day"])
    return p.select("day", F.round("psi", digits).alias("psi"), status("psi", C.PSI_WARN, C.PSI_ALERT).alias("status"))


def status_streaks(daily: DataFrame, by: list[str] | None = None, day: str = "day", flag=None) -> DataFrame:
    """Gaps-and-islands: length of each run of consecutive flagged days.

    The window runs over a per-day table (one row per day and group), so a
    partition holds at most one row per day - bounded by the calendar, not
    by the data (without ``by`` it is one partition of at most #days rows).
    """
    by = list(by or [])
    flag = flag if flag is not None else (F.col("status") == "red")
    d = daily.where(flag).select(*by, F.col(day))
    w = Window.partitionBy(*by).orderBy(day) if by else Window.orderBy(day)
    isl = d.withColumn("__grp", F.date_sub(F.col(day), F.row_number().over(w).cast("int")))
    return isl.groupBy(*by, "__grp").agg(F.min(day).alias("start_day"), F.max(day).alias("end_day"),
                                         F.count(F.lit(1)).alias("n_days")).drop("__grp")
